"""Tokens of a byte-level vocabulary: counts, ids and cuts of whole texts, in Arrow batches.

Merges never reach from one pre-token (a word with the space before it, a number, a run of signs or
of white space) into the next, so a text's ids are those of its pre-tokens. A worker loads the
vocabulary once and remembers the pre-tokens it has met; the library's encoder sees each of them once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how text is split before the merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 1 << 18
"""Characters split at once."""
MOST_KNOWN, LONGEST_KNOWN = 200_000, 64
"""Pre-tokens one worker remembers, and their characters; then it starts afresh, with the same results."""
PART = 256
"""Texts that are Python strings at once."""


def default_vocabulary() -> str:
    """Path of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder(dict):
    """Ids by pre-token, encoded when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # Spark deals out the work
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True            # their strings are ordinary text
        self.pattern = regex.compile(PRE_TOKEN)
        self.sizes: dict[int, int] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = tuple(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST_KNOWN:
            if len(self) >= MOST_KNOWN:
                self.clear()
            self[piece] = found
        return found

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, a window of it at a time."""
        start, size = 0, WINDOW
        while len(text) - start > size:
            found = list(self.pattern.finditer(text, start, start + size))
            if len(found) < 3:                                 # one pre-token longer than the window
                size *= 2
                continue
            cut = found[-2].start()                            # the last ones may go on behind the window
            yield [m.group() for m in found[:-2]]
            start, size = cut, WINDOW
        yield self.pattern.findall(text, start)

    def count(self, text: str | None) -> int:
        return sum(len(self[p]) for part in self.pieces(text) for p in part) if text else 0

    def ids(self, text: str | None, limit: int | None = None) -> list[int]:
        """The first ``limit`` ids, or all."""
        out: list[int] = []
        for part in self.pieces(text or ""):
            for piece in part:
                out.extend(self[piece])
                if limit is not None and len(out) >= limit:
                    return out[:limit]
        return out

    def bytes_of(self, ids: list[int]) -> int:
        """Bytes of text that the ids stand for; every sign of a byte-level token is one byte."""
        for i in ids:
            if i not in self.sizes:
                self.sizes[i] = len(self.tokenizer.id_to_token(i))
        return sum(self.sizes[i] for i in ids)

    def head(self, text: str | None, limit: int) -> str:
        """The whole characters of a text that lie in its first ``limit`` tokens."""
        if not text:
            return ""
        ids = self.ids(text, limit + 1)
        if len(ids) <= limit:
            return text
        size = self.bytes_of(ids[:limit])
        return text[:size].encode()[:size].decode("utf-8", "ignore")


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """This worker's encoder."""
    path = path or default_vocabulary()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _column(text: str | Column) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _each(path: str | None, kind: str, type: pa.DataType, fn):
    """A column function that gives ``fn(encoder, text)`` of every text, PART texts at a time."""
    def found(texts):
        own = encoder(path)
        for batch in texts:
            parts = [pa.array([fn(own, t) for t in batch.slice(lo, PART).to_pylist()], type) for lo in range(0, len(batch), PART)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type)

    found.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(found, kind)


def token_counter(path: str | None = None):
    """A function from a text column to its number of tokens, for ``length_audit`` and ``throughput_summary``.

    ``path`` is a vocabulary file that every executor can read; null and empty texts have none.
    """
    counted = _each(path, "long", pa.int64(), lambda own, t: own.count(t))
    return lambda text: counted(_column(text))


def token_ids(text: str | Column, path: str | None = None, limit: int | None = None) -> Column:
    """The ids of a text, or its first ``limit`` ones; null and empty texts have none."""
    return _each(path, "array<int>", pa.list_(pa.int32()), lambda own, t: own.ids(t, limit))(_column(text))


def token_head(text: str | Column, limit: int, path: str | None = None) -> Column:
    """A text cut to what lies in its first ``limit`` tokens, whole characters only; null stays null."""
    return _each(path, "string", pa.string(), lambda own, t: None if t is None else own.head(t, limit))(_column(text))


def completion_tokens(text: str | Column, header: str, path: str | None = None) -> Column:
    """Struct {prompt_ids, completion_ids}: ids of a training text up to and after its last ``header``.

    The loss is on the second part; a text without the header has all its ids there. The header's
    end is a pre-token's end, so both parts encode as they do in the whole text when the character
    after it starts a new one, as a line end does.
    """
    @F.pandas_udf("prompt_ids int, completion_ids int")
    def parts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for part in texts:
            cut = [t.rfind(header) + len(header) if t and header in t else 0 for t in part]
            yield pd.DataFrame({"prompt_ids": [own.count(t[:c]) if c else 0 for t, c in zip(part, cut)],
                                "completion_ids": [own.count(t[c:]) if t else 0 for t, c in zip(part, cut)]}, dtype="int32")

    return parts(_column(text))
