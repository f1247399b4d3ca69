"""Token counts by a compiled finite-state transducer over the merges of a subword vocabulary.

A state holds what the tokens of the next characters can depend on: which token ends at each of the
last places where a longer token may still begin. A transition emits by how much the number of
tokens grows (or, where tokens join, shrinks), so the emissions of a text add up to its count.
Transitions are compiled when a text first takes them. A text is cut into chunks; a chunk is a map
from the state it is entered in to the state it is left in and what it emits on the way, and the
maps of a text's chunks are composed by a parallel prefix scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.textscan import SLICE_BYTES, mix, slices

CHUNK = 256
"""Characters after which a new chunk begins, at the next safe place if there is one."""
MOST_TRANSITIONS = 4_000_000
"""Compiled transitions one worker keeps; then it compiles afresh, with the same results."""
LIMIT = 4096

SPACE_SIGN = "▁"
FEW = 16                                     # pieces that are tried at once to tell states apart no further than needed
NEVER = -float("inf")
UNKNOWN = 4                                  # classes 0..3: characters outside the vocabulary, of 1..4 bytes
FREE = 0                                     # the state in which nothing read before matters


def default_model() -> str:
    """Path of the public piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces and their scores, read from the model file, and the merges they allow."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        shape, trained = model.normalizer_spec, model.trainer_spec
        plain = shape.add_dummy_prefix and not shape.remove_extra_whitespaces and not shape.precompiled_charsmap
        if trained.model_type != trained.BPE or not trained.byte_fallback or not plain:
            raise ValueError("the transducer is for merge models with byte fallback that leave texts as they are")
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
            raise ValueError("pieces of a user or out of use are not compiled")
        self.score = {p.piece: p.score for p in model.pieces if p.type == p.NORMAL}
        self.longer: dict[str, list[str]] = {}
        for p in self.score:
            for i in range(1, len(p)):
                self.longer.setdefault(p[:i], []).append(p)
        self.adjacent = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        signs = sorted({c for p in self.score for c in p})
        self.class_of = np.zeros(0x110000, np.int32)
        for size, (lo, hi) in enumerate(((0, 0x80), (0x80, 0x800), (0x800, 0x10000), (0x10000, 0x110000))):
            self.class_of[lo:hi] = size
        self.sign = [None] * UNKNOWN
        for c in signs:
            if c in self.score:
                self.class_of[ord(c)] = len(self.sign)
                self.sign.append(c)
        self.space = int(self.class_of[ord(SPACE_SIGN)])
        if self.space < UNKNOWN:
            raise ValueError("the vocabulary has no sign for a space")
        self.class_of[32] = self.space
        self._fits: dict[tuple[str, str], bool] = {}

    def fits(self, left: str, right: str) -> bool:
        """Whether the merges of ``left + right`` make these two tokens (``left`` '' for what cannot be joined).

        The best pair is merged, of equal ones the first, until none is left.
        """
        key = (left, right)
        if key not in self._fits:
            self._fits[key] = self._merged(left, right)
        return self._fits[key]

    def _merged(self, left: str, right: str) -> bool:
        parts, score, border = [*left, *right], self.score.get, len(left) - 1
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            if i == border:
                return False
            border -= i < border
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NEVER)
        return len(parts) == 1 + bool(left)

    def fitting(self, left: str, begun: str) -> str | None:
        """``left``, '' if every piece that begins with ``begun`` fits after it, None if no piece does."""
        if not left:
            return left
        if left[-1] + begun[0] not in self.adjacent:
            return ""
        if len(self.longer[begun]) > FEW:
            return left
        fits = [self.fits(left, p) for p in self.longer[begun]]
        return "" if all(fits) else left if any(fits) else None


class Transducer:
    """States and transitions as far as they are compiled.

    A state is a tuple of (length, token, difference): where the last ``length`` characters may begin
    a longer token, the token that ends before them and the number of tokens up to there less that of
    the whole. The tokens of a text are those whose neighbours fit, so the token that ends at a new
    character is the only one that fits the token before it.
    """

    def __init__(self, path: str):
        self.words = Vocabulary(path)
        self.classes = len(self.words.sign)
        self._fresh()

    def _fresh(self) -> None:
        self.tails, self.states = [""], [((0, "", 0),)]
        self.number = {("", self.states[0]): FREE}
        self.bits, self.used = 16, 0
        self._room()
        self.words._fits.clear()
        self.begin, self.begin_count = self._step(FREE, self.words.space)

    def _room(self) -> None:
        """An empty table of transitions: open addressing, at most half full."""
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nexts, self.emits = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, emitted tokens) of one transition."""
        if symbol < UNKNOWN:
            return FREE, symbol + 1
        sign, words = self.words.sign[symbol], self.words
        tail, places = self.tails[state], self.states[state]
        if tail and tail[-1] + sign not in words.adjacent:
            tail, places = "", ((0, "", 0),)
        for length, before, difference in places:
            token = tail[len(tail) - length:] + sign
            if token in words.score and words.fits(before, token):
                break
        else:
            raise ValueError(f"no token can end after {tail + sign!r}")
        emitted, text = difference + 1, tail + sign
        kept = []
        for length, before, difference in places:
            begun = text[len(text) - length - 1:]
            if begun in words.longer:
                fitting = words.fitting(before, begun)
                if fitting is not None:
                    kept.append((length + 1, fitting, difference - emitted))
        if not kept:                                          # nothing that follows can join the last sign
            return FREE, emitted
        key = (text[len(text) - kept[0][0]:], (*kept, (0, token, 0)))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.tails.append(key[0])
            self.states.append(key[1])
        return self.number[key], emitted

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot of every key or of the free one it would take, whether it is there)."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (mix(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[slot]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            held[open_] = self.keys[slot[open_]]
            open_ = open_[(held[open_] != keys[open_]) & (held[open_] >= 0)]
        return slot, held == keys

    def _put(self, keys: np.ndarray, nexts: np.ndarray, emits: np.ndarray) -> None:
        while len(keys):
            slot, _ = self._places(keys)
            _, first = np.unique(slot, return_index=True)     # of keys that would take one slot, one does
            self.keys[slot[first]], self.nexts[slot[first]], self.emits[slot[first]] = keys[first], nexts[first], emits[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, nexts, emits = keys[left], nexts[left], emits[left]

    def _compile(self, keys: np.ndarray) -> None:
        new = np.unique(keys)
        steps = np.array([self._step(*divmod(k, self.classes)) for k in new.tolist()], np.int32)
        self.used += len(new)
        if 2 * self.used > 1 << self.bits:
            full = self.keys >= 0
            old = self.keys[full], self.nexts[full], self.emits[full]
            while 2 * self.used > 1 << self.bits:
                self.bits += 1
            self._room()
            self._put(*old)
        self._put(new, steps[:, 0], steps[:, 1])

    def run(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state left in, tokens emitted) of every range of ``symbols`` entered in ``state``, all ranges side by side."""
        order = np.argsort(start - end, kind="stable")
        at, size = start[order], (end - start)[order]
        now, count = state[order].astype(np.int64), np.zeros(len(order), np.int64)
        live = len(order)
        for i in range(int(size[0]) if live else 0):
            while size[live - 1] <= i:
                live -= 1
            keys = now[:live] * self.classes + symbols[at[:live] + i]
            slot, there = self._places(keys)
            if not there.all():
                self._compile(keys[~there])
                slot, _ = self._places(keys)
            now[:live] = self.nexts[slot]
            count[:live] += self.emits[slot]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return now[back], count[back]

    def symbols(self, raw: np.ndarray) -> np.ndarray:
        """Class of every character of valid UTF-8 ``raw``."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        first = raw[at].astype(np.int32)
        size = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        point = np.where(size == 1, first, first & (0x7F >> size))
        for i in range(1, 4):
            longer = np.flatnonzero(size > i)
            point[longer] = point[longer] << 6 | raw[at[longer] + i] & 0x3F
        return self.words.class_of[point]

    def chunks(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, first chunk of each text and the end, whether it is entered free) of all chunks.

        A chunk of more than CHUNK characters ends at the next sign of a space that follows another
        character, from where no token reaches back, or CHUNK characters later where there is none.
        """
        size = np.diff(at)
        count = -(-size // CHUNK)
        first = np.r_[0, np.cumsum(count)]
        start = at[:-1].repeat(count) + (np.arange(first[-1]) - first[:-1].repeat(count)) * CHUNK
        safe = np.flatnonzero((symbols[1:] == self.words.space) & (symbols[:-1] != self.words.space)) + 1
        next_safe = np.r_[safe, len(symbols) + CHUNK][np.searchsorted(safe, start)]
        end = np.minimum(start + CHUNK, at[1:].repeat(count))
        inner = np.ones(len(start), bool)
        inner[first[:-1][count > 0]] = False                  # a text's first chunk stays where it is
        free = inner & (next_safe < end)
        return np.where(free, next_safe, start), first, free

    def totals(self, symbols: np.ndarray, at: np.ndarray, entry: int) -> tuple[np.ndarray, np.ndarray]:
        """(state left in, tokens emitted) of every text ``symbols[at[i]:at[i + 1]]`` entered in ``entry``.

        The map of a chunk that begins inside a word is wanted for the states in which the chunk
        before it may be left. Which they are is found by running it from the free state first and
        then from every state in which its predecessor was left, until no new one comes up: a few,
        as tokens fall into step again after a few characters. Then the maps are composed.
        """
        start, first, free = self.chunks(symbols, at)
        n, count = len(start), np.diff(first)
        end = np.r_[start[1:], len(symbols)] if n else start
        inner = np.ones(n, bool)
        inner[first[:-1][count > 0]] = False
        domain = np.where(inner, FREE, entry)[:, None]        # state of chunk and place, -1 where there is none
        exits, emits = (x[:, None] for x in self.run(symbols, start, end, domain[:, 0]))
        bound = np.flatnonzero(inner & ~free)                 # chunks whose map depends on the state they are entered in
        todo = bound
        while len(todo):
            came = exits[todo - 1]
            new = np.where((came >= 0) & ~(came[:, :, None] == domain[todo][:, None, :]).any(2), came, -1)
            new = np.sort(new, axis=1)[:, ::-1]
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            which, place = np.nonzero(new >= 0)
            if not len(which):
                break
            room = np.full((n, new.shape[1]), -1, np.int64)
            room[todo[which], place] = new[which, place]
            chunk, place = np.nonzero(room >= 0)
            left, more = self.run(symbols, start[chunk], end[chunk], room[chunk, place])
            out, total = np.full_like(room, -1), np.zeros_like(room)
            out[chunk, place], total[chunk, place] = left, more
            domain, exits, emits = np.hstack([domain, room]), np.hstack([exits, out]), np.hstack([emits, total])
            used = (domain >= 0).any(0)
            domain, exits, emits = domain[:, used], exits[:, used], emits[:, used]
            after = np.unique(chunk) + 1
            todo = after[np.isin(after, bound)]
        return self._composed(domain, exits, emits, first, free, entry)

    def _composed(self, domain, exits, emits, first, free, entry) -> tuple[np.ndarray, np.ndarray]:
        """Prefix scan: in each round every chunk's map takes that of the span before it, which doubles."""
        n, width = domain.shape
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        place = np.arange(n) - first[:-1][owner]
        # The place that a chunk's exit state has in the domain of the next chunk; any will do where that is free.
        going = np.zeros((n, width), np.int64)
        if n > 1:
            match = exits[:-1, :, None] == domain[1:, None, :]
            going[:-1] = np.where(free[1:, None], 0, match.argmax(2))
        emits, last = emits.copy(), exits
        emits[free], last = emits[free][:, :1], np.where(free[:, None], exits[:, :1], exits)
        going[free] = going[free][:, :1]
        step = 1
        while step < (np.diff(first).max() if n else 0):
            far = np.flatnonzero(place >= step)
            via = going[far - step]
            emits[far], going[far], last[far] = (
                emits[far - step] + np.take_along_axis(emits[far], via, 1),
                np.take_along_axis(going[far], via, 1), np.take_along_axis(last[far], via, 1))
            step *= 2
        full = np.diff(first) > 0
        states, counts = np.full(len(full), entry, np.int64), np.zeros(len(full), np.int64)
        states[full], counts[full] = last[first[1:][full] - 1, 0], emits[first[1:][full] - 1, 0]
        return states, counts

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text; a text of many bytes is read in windows, one after another."""
        found = np.zeros(len(texts), np.int64)
        for lo, hi, raw, at in slices(texts):
            if self.used > MOST_TRANSITIONS:
                self._fresh()
            if hi - lo > 1:
                place = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][at]
                _, total = self.totals(self.symbols(raw), place, self.begin)
                found[lo:hi] = np.where(np.diff(at) > 0, total + self.begin_count, 0)
            elif len(raw):
                state, found[lo] = self.begin, self.begin_count
                for a, b in windows(raw):
                    symbols = self.symbols(raw[a:b])
                    left, total = self.totals(symbols, np.array([0, len(symbols)]), state)
                    state, found[lo] = left[0], found[lo] + total[0]
        return found


def windows(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most SLICE_BYTES bytes that begin and end with whole characters."""
    a = 0
    while a < len(raw):
        b = min(a + SLICE_BYTES, len(raw))
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        yield a, b
        a = b


_compiled: dict[str, Transducer] = {}


def transducer(path: str | None) -> Transducer:
    """This worker's transducer."""
    path = path or default_model()
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def _counted(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    machine = transducer(path)
    for batch in batches:
        texts = batch.column(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64()),
             pa.array(machine.counts(texts))], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``, one pass without a shuffle.

    ``path`` is a piece model that every executor can read (default: the public one). Tokens are the
    model's, without begin or end; strings of special tokens are ordinary text. Null and empty texts
    have none. Repeated rows are counted each, a null doc_id stays, other columns are not looked at;
    an empty table gives no rows. A text of any length is counted whole, a window of it at a time.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(partial(_counted, path=path),
                                                       f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document of the whole table."""
    return token_counts(table(spark, sf_dir, "documents"))
