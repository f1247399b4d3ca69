"""What a Python worker keeps between tasks stays small: Spark uses it again for other steps."""

from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from tallyguard.llm import packing, setjoin, tokens


def texts():
    return iter([pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None], pa.string())],
                                            ["doc_id", "text"])])


class Levels:
    value = np.ones(1 << setjoin.BUCKET_BITS, np.uint8)


@pytest.mark.parametrize("module, run", [
    (packing, lambda: packing._pieces(texts(), None, 2, 1024)),
    (setjoin, lambda: setjoin._scan(texts(), partial(setjoin.line_parts, least=1), False)),
    (setjoin, lambda: setjoin._prefixes(texts(), partial(setjoin.line_parts, least=1), Levels, 0.75, 2, 0, 1, 4, 40)),
], ids=["pieces", "scan", "prefixes"])
def test_freed_memory_goes_back_to_the_system(monkeypatch, module, run):
    given = []
    monkeypatch.setattr(module, "give_back", lambda: given.append(True))
    assert sum(b.num_rows for b in run()) and given


def test_remembered_stretches_take_few_megabytes():
    own = tokens.Encoder(tokens.default_tokenizer(), 2)
    rng = np.random.default_rng(1)
    for lo in range(0, tokens.MOST_KNOWN, 50_000):              # five ids in each, as in made-up words
        own._learn(rng.integers(0, 1 << 63, 50_000, np.uint64) * np.uint64(2), np.zeros(250_000, np.uint32),
                   np.full(50_000, 5))
    assert own.known > tokens.MOST_KNOWN
    assert sum(x.nbytes for x in (own.slot, own.hash, own.at, own.ids)) < 100e6 and len(own.more) < 200_000
