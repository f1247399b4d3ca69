"""Stretches of texts: the library meets each once, plain ones as lines of one text, and the ids are the library's."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyguard.llm import tokens
from tallyguard.llm.textscan import slices

END = 2
BITS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", " ", "'", "''", "'s", "'ll", "’s", "!", "$$$", "&&&", ".", ",",
        "(", "5", "42", "²", "é", "É", "×", "÷", "ñ", "ß", "é", "́", "日本", "🙂", "a", "don", "The", "ATER", "s", "t", "re",
        "<|endoftext|>", "_", "-", "\x00", "\x7f", "\x85"]


@pytest.fixture
def own(monkeypatch):
    monkeypatch.setattr(tokens, "JOINED", 7)
    return tokens.Encoder(tokens.default_tokenizer(), END)


def ids_of(own, texts):
    (_, _, raw, at), = slices(pa.array(texts, pa.string()), 1 << 24)
    ids, first = own.encode(raw, at)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


@pytest.mark.parametrize("seed", range(4))
def test_ids_are_those_of_whole_texts(own, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 12))) for _ in range(4000)]
    whole = [x.ids + [END] for x in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert ids_of(own, texts) == whole
    assert ids_of(own, texts[::-1]) == whole[::-1]              # all remembered by now


def test_a_word_with_other_signs_behind_it_is_not_encoded_again(own):
    words = [f" w{a}{b}x" for a in "abcdefg" for b in "hijklmn"]
    texts = ["".join(w + tail for w in words) for tail in ("", "!!", "&&&", "###", ".\nOn", "42")]
    ids_of(own, texts)
    assert own.known <= len(words) + 12


def test_few_calls_for_plain_words(own, monkeypatch):
    met = []
    real = own._encoded
    monkeypatch.setattr(own, "_encoded", lambda texts: (met.append(len(texts)), real(texts))[1])
    ids_of(own, [" ".join(f"w{i}" for i in "abcdefghijklmnopqrstu")])
    assert met == [1, 1, 1]                                     # 21 stretches, seven in one text


def test_no_text(own):
    assert ids_of(own, ["", None, ""]) == [[END]] * 3 and np.all(own.slot < 0)


def test_starting_afresh_changes_nothing(own, monkeypatch):
    texts = [f"word{i} and more{i}!!" for i in range(50)]
    first = ids_of(own, texts)
    monkeypatch.setattr(tokens, "MOST_KNOWN", 3)
    assert ids_of(own, texts) == first and ids_of(own, texts) == first
