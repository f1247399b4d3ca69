"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of a vector for its hash and one for its first bytes. Filters of
several widths run over the words, the greatest answer of each goes into a logistic output. All
labelled rows are learned from: up to AT_ONCE in one go, more in shards that are trained side by
side and averaged by an aggregation after every round over the data. The language is guessed from function words of the text alone; each language has its own threshold,
moved to a score of 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.labelled import fold, known_labels
from tallyguard.llm.textscan import Scan, give_back, owners, ranges, slices

WORD_BITS, STEM_BITS, STEM_BYTES = 17, 14, 4
DIM, FILTERS, WIDTHS = 8, 6, (1, 2, 3)
EPOCHS, BATCH, RATE, SEED = 3, 32, 0.08, 7
LEAST_STEPS, LEAST_TEXTS, LEAST_LOSS = 1000, 3, 0.01
CALIBRATION_FOLDS = 5
OTHERS, TRUST = 0.2, 0.5
NOTHING_KNOWN = -np.inf
AT_ONCE, BUFFER_BYTES = 8_000, 1 << 25
"""Labelled rows that one process learns from at once, and bytes of their words; a shard has twice as many rows."""
STEP = 2
"""Decimals of the logits that a calibration over several shards counts by."""

# Function words of the languages whose thresholds are calibrated.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "was", "for", "with"],
    "fr": ["le", "la", "les", "des", "et", "une", "dans", "est", "pour", "qui"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "den", "von", "mit", "ein"],
    "es": ["el", "los", "las", "que", "del", "por", "con", "una", "se", "y"],
}
LANGUAGES = [*FUNCTION_WORDS, "other"]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
PAD = max(WIDTHS) - 1


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    words = [(w, i) for i, ws in enumerate(FUNCTION_WORDS.values()) for w in ws]
    raw = np.frombuffer(" ".join(w for w, _ in words).encode(), np.uint8)
    scan = Scan(raw, np.array([0, len(raw)]))
    start, end, _ = scan.words()
    hashes = scan.word_hashes(start, end)
    order = np.argsort(hashes)
    return hashes[order], np.array([i for _, i in words])[order]


_KNOWN, _KNOWN_LANGUAGE = _function_hashes()


@dataclass
class Words:
    """Words of consecutive texts, each text followed by PAD empty places; a text without words is one such place."""
    word: np.ndarray
    stem: np.ndarray
    start: np.ndarray
    end: np.ndarray
    language: np.ndarray


def words_of(raw: np.ndarray, at: np.ndarray) -> Words:
    """Hashed words (runs of letters and digits, A-Z as a-z) of every text and its guessed language."""
    scan = Scan(raw, at, lower=True)
    start, end = scan.edges(scan.at[:-1], scan.at[1:], _LETTER[scan.raw])
    hashes = scan.word_hashes(start, end)
    stems = scan.word_hashes(start, np.minimum(end, start + STEM_BYTES))
    first = np.searchsorted(start, scan.at)
    count = np.diff(first)
    texts = len(count)
    place = np.minimum(np.searchsorted(_KNOWN, hashes), len(_KNOWN) - 1)
    known = _KNOWN[place] == hashes
    seen = np.bincount(owners(first)[known] * len(FUNCTION_WORDS) + _KNOWN_LANGUAGE[place[known]],
                       minlength=texts * len(FUNCTION_WORDS)).reshape(texts, -1)
    language = np.where(seen.any(1), seen.argmax(1), len(FUNCTION_WORDS))
    room = np.maximum(count, 1)
    begin = np.cumsum(room + PAD) - room - PAD
    word = np.full(int((room + PAD).sum()), 1 << WORD_BITS, np.int32)
    stem = np.full(len(word), 1 << STEM_BITS, np.int32)
    here = ranges(begin, count)
    word[here] = hashes >> np.uint64(64 - WORD_BITS)
    stem[here] = stems >> np.uint64(64 - STEM_BITS)
    return Words(word, stem, begin, begin + room, language)


def coded(words: Words) -> pa.Array:
    """Every text's words as 32-bit codes of word and stem, one compressed binary value a text."""
    codes = (words.word << STEM_BITS | words.stem & (1 << STEM_BITS) - 1).astype("<i4")
    some = words.word[words.start] >> WORD_BITS == 0
    return pa.array([zlib.compress(codes[lo:hi if any_word else lo].tobytes(), 1)
                     for lo, hi, any_word in zip(words.start, words.end, some)], pa.binary())


def decoded(codes: bytes, language: int) -> Words:
    """The ``Words`` of one text."""
    code = np.frombuffer(zlib.decompress(codes), "<i4")
    word, stem = np.full(max(1, len(code)) + PAD, 1 << WORD_BITS, np.int32), np.full(max(1, len(code)) + PAD, 1 << STEM_BITS, np.int32)
    word[:len(code)], stem[:len(code)] = code >> STEM_BITS, code & (1 << STEM_BITS) - 1
    return Words(word, stem, np.array([0]), np.array([len(word) - PAD]), np.array([language]))


@dataclass
class Model:
    words: np.ndarray
    stems: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: np.ndarray
    prior: float = 0.0

    def _answers(self, vectors: np.ndarray) -> np.ndarray:
        """Filter answers (filter, place): what each filter's places give, added up over its width."""
        n = len(vectors)
        parts = np.concatenate([w for f in self.filters for w in f], axis=1).T @ vectors.T
        out, at = np.empty((FILTERS * len(WIDTHS), n), vectors.dtype), 0
        for i, width in enumerate(WIDTHS):
            own = out[i * FILTERS:(i + 1) * FILTERS]
            own[:] = parts[at * FILTERS:(at + 1) * FILTERS]
            for j in range(1, width):
                own[:, :n - j] += parts[(at + j) * FILTERS:(at + j + 1) * FILTERS, j:]
            at += width
        return out

    def pooled(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(the greatest answer of every filter in every text, at least 0; whether the text has a word with a vector)."""
        vectors = self.words[words.word] + self.stems[words.stem]
        cuts = np.stack([words.start, words.end], 1).ravel()
        known = np.maximum.reduceat(vectors.any(1), cuts)[::2]
        answers = self._answers(vectors.astype(np.float64))
        return np.maximum(np.maximum.reduceat(answers, cuts, axis=1)[:, ::2].T + self.bias, 0), known

    def logits(self, words: Words) -> np.ndarray:
        """Rounded far above what the order of a sum can change, so equal texts have equal scores in any company.

        A text of which nothing was seen in training gets the least of all answers.
        """
        pooled, known = self.pooled(words)
        return np.where(known, np.round(pooled @ self.out.astype(np.float64) + self.out_bias, 6), NOTHING_KNOWN)

    def scores(self, words: Words) -> np.ndarray:
        """Calibrated: 0.5 at the threshold of the text's language, the share of toxic rows where nothing is known."""
        x = self.logits(words)
        x = np.where(x == NOTHING_KNOWN, min(self.prior, -0.1), x - self.thresholds[words.language])
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _fresh_model(rng: np.random.Generator) -> Model:
    def draw(*shape):
        return rng.normal(0, 0.1, shape).astype(np.float32)

    words, stems = draw((1 << WORD_BITS) + 1, DIM), draw((1 << STEM_BITS) + 1, DIM)
    words[-1], stems[-1] = 0, 0
    return Model(words, stems, [draw(w, DIM, FILTERS) * 3 for w in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32),
                 draw(FILTERS * len(WIDTHS)) * 5, 0.0, np.zeros(len(LANGUAGES)))


def _texts_with(texts: list[Words]) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have each word, texts that have each stem."""
    words, stems = np.zeros((1 << WORD_BITS) + 1, np.int64), np.zeros((1 << STEM_BITS) + 1, np.int64)
    for text in texts:
        words[np.unique(text.word)] += 1
        stems[np.unique(text.stem)] += 1
    return words, stems


def _forget_rare(model: Model, words: np.ndarray, stems: np.ndarray) -> None:
    """Words and stems of fewer than LEAST_TEXTS training texts have no vector: nothing is learned by heart."""
    model.words[words < LEAST_TEXTS] = 0
    model.stems[stems < LEAST_TEXTS] = 0


def _adagrad(value: np.ndarray, memory: np.ndarray, slope: np.ndarray, rate: float) -> None:
    memory += slope * slope
    value -= rate * slope / np.sqrt(memory + 1e-8)


def _memory(model: Model) -> list:
    """Sums of squared slopes, as yet 0."""
    return [np.zeros_like(model.words), np.zeros_like(model.stems), [np.zeros_like(f) for f in model.filters],
            np.zeros_like(model.bias), np.zeros_like(model.out)]


def _class_weights(rows: int, toxic: int) -> tuple[float, float]:
    """Weights of a clean and of a toxic row with which both classes count alike."""
    toxic = max(1, toxic)
    return rows / (2 * max(1, rows - toxic)), rows / (2 * toxic)


def train(texts: list[Words], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Fit on one ``Words`` a text; classes count alike. Seeded, so the same rows give the same model."""
    rng = np.random.default_rng(seed)
    model = _fresh_model(rng)
    _forget_rare(model, *_texts_with(texts))
    weights, memory = _class_weights(len(labels), int(labels.sum())), _memory(model)
    for _ in range(max(epochs, -(-LEAST_STEPS * BATCH // max(1, len(labels))))):
        if _learn(model, memory, texts, labels, weights, rng, rate) < LEAST_LOSS * len(labels):
            break
    return model


def _learn(model: Model, memory: list, texts: list[Words], labels: np.ndarray, weights: tuple[float, float],
           rng: np.random.Generator, rate: float = RATE) -> float:
    """One round over the texts; the sum of the errors."""
    weight = np.where(labels == 1, weights[1], weights[0])
    order, loss = rng.permutation(len(labels)), 0.0
    for lo in range(0, len(order), BATCH):
        some = order[lo:lo + BATCH]
        word = np.concatenate([texts[i].word for i in some])
        stem = np.concatenate([texts[i].stem for i in some])
        size = np.array([len(texts[i].word) for i in some])
        begin = np.cumsum(size) - size
        vectors = model.words[word] + model.stems[stem]
        answers = model._answers(vectors)
        best = np.stack([a + answers[:, a:a + n - PAD].argmax(1) for a, n in zip(begin, size)])
        raw = answers[np.arange(len(answers)), best] + model.bias
        pooled = np.maximum(raw, 0)
        p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.out_bias, -60, 60)))
        wrong = p - labels[some]
        loss += float(np.abs(wrong).sum())
        d_logit = (np.where(np.abs(wrong) < 1e-3, 0, wrong) * weight[some] / len(some)).astype(np.float32)
        d_pool = d_logit[:, None] * model.out * (raw > 0)
        d_out = pooled.T @ d_logit
        places, slopes = [], []
        for i, width in enumerate(WIDTHS):
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            at, d = best[:, cols].ravel(), d_pool[:, cols]
            live = np.flatnonzero(d.ravel())
            which = live % FILTERS
            for j in range(width):
                places.append(at[live] + j)
                slopes.append(d.ravel()[live, None] * model.filters[i][j][:, which].T)
                grown = np.zeros((FILTERS, DIM), np.float32)
                np.add.at(grown, which, d.ravel()[live, None] * vectors[at[live] + j])
                _adagrad(model.filters[i][j], memory[2][i][j], grown.T, rate)
        places, slopes = np.concatenate(places), np.concatenate(slopes)
        for value, kept, index in ((model.words, memory[0], word), (model.stems, memory[1], stem)):
            rows, back = np.unique(index[places], return_inverse=True)
            total = np.zeros((len(rows), DIM), np.float32)
            np.add.at(total, back, slopes)
            total[~value[rows].any(1)] = 0                  # padding and rare words stay 0
            kept[rows] += total * total
            value[rows] -= rate * total / np.sqrt(kept[rows] + 1e-8)
        _adagrad(model.bias, memory[3], d_pool.sum(0), rate)
        _adagrad(model.out, memory[4], d_out, rate)
        model.out_bias -= rate * float(d_logit.sum())
    return loss


def threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray, expected: float) -> float:
    """The cut nearest to ``expected`` of those whose wrong answers are within TRUST standard errors of the fewest.

    Without rows it is the expected cut, with rows of one class the nearest that has them all right.
    """
    x, which = np.unique(logits, return_inverse=True)
    if not len(x):
        return expected
    toxic = np.bincount(which, np.where(labels == 1, weights, 0.0), len(x))
    clean = np.bincount(which, np.where(labels == 0, weights, 0.0), len(x))
    right = np.r_[0, np.cumsum(clean)] + np.r_[np.cumsum(toxic[::-1])[::-1], 0]      # with the cut below x[0], x[1], ..., above all
    low, high = np.r_[-np.inf, x], np.r_[x, np.inf]
    fewest = weights.sum() - right.max()
    best = right >= right.max() - TRUST * np.sqrt(max(0.0, fewest)) - 1e-9
    low, high = low[best], high[best]
    inside = np.clip(expected, low + 1e-3, high - 1e-3)
    cuts = np.where(high - low > 2e-3, inside, (low + high) / 2)
    return float(cuts[np.abs(cuts - expected).argmin()])


def calibrate(model: Model, texts: list[Words], labels: np.ndarray, share: float) -> None:
    """Set each language's threshold on rows kept from training.

    Training counts both classes alike; ``share`` of all labelled rows are toxic, which tells the
    expected cut. A language's own rows count in full, those of others with the weight OTHERS, so
    the more rows it has the more its cut is its own.
    """
    logits = np.array([model.logits(t)[0] for t in texts])
    language = np.array([t.language[0] for t in texts], np.int64)
    place_cuts(model, logits, language, labels, np.ones(len(logits)), share)


def place_cuts(model: Model, logits: np.ndarray, language: np.ndarray, labels: np.ndarray, rows: np.ndarray, share: float) -> None:
    """``calibrate`` from the logits; ``rows`` tells how many rows each stands for."""
    model.prior = float(np.log(share / (1 - share)))
    seen = logits != NOTHING_KNOWN
    for i in range(len(LANGUAGES)):
        weights = np.where(language == i, 1.0, OTHERS) * rows
        model.thresholds[i] = threshold(logits[seen], labels[seen], weights[seen], -model.prior)


def _held(rows: int) -> np.ndarray:
    """Which rows calibrate: a fifth, but a single row is for training."""
    held = np.random.default_rng(SEED).permutation(rows) % CALIBRATION_FOLDS == 0
    return held & (not held.all())


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, at in slices(batch.column(1)):
            words = words_of(raw, at)
            yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:1], *batch.slice(lo, hi - lo).columns[2:],
                                              coded(words), pa.array(words.language.astype(np.int32))],
                                             ["doc_id", *batch.schema.names[2:], "codes", "language"])


def fit(docs: DataFrame, labels: DataFrame, keep, at_once: int = AT_ONCE) -> Model | None:
    """Train on all labelled rows for which ``keep`` holds; a fifth of them calibrates. None where there are no labels.

    Up to ``at_once`` labels are learned from in one go, more in shards of twice as many.
    """
    known = known_labels(labels, "toxic", keep)
    n = known.count()
    kind = docs.schema["doc_id"].dataType.simpleString()
    if n > at_once:
        return _fit_in_shards(docs.where(keep).select("doc_id", "text"), known, kind, -(-n // (2 * at_once)), at_once)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").mapInArrow(
        _features, f"doc_id {kind}, label int, codes binary, language int").toPandas()
    if not len(rows):
        return None
    rows["text"] = [decoded(c, i) for c, i in zip(rows["codes"], rows["language"])]
    rows["word"] = [t.word.tobytes() for t in rows["text"]]
    rows = rows.sort_values(["doc_id", "word", "label"]).reset_index(drop=True)
    truth, rest = rows["label"].to_numpy(np.int64), _held(len(rows))
    model = train([t for t, r in zip(rows["text"], rest) if not r], truth[~rest])
    share = (truth.sum() + 1) / (len(truth) + 2)
    calibrate(model, [t for t, r in zip(rows["text"], rest) if r], truth[rest], share)
    return model


# --- training in shards ---------------------------------------------------------------------------

STATE = ", ".join(["at int", *(f"v{i} float" for i in range(2 * DIM))])
MARKS = 1 << 26
EXACT = 1 << 30
"""Parameters are added up in whole parts of this size, so that a sum has no order."""
TAIL = (1 << WORD_BITS) + (1 << STEM_BITS) + 2
"""Places of the counts of rows and of toxic rows, behind those of all words and stems."""


def _state(model: Model, memory: list) -> np.ndarray:
    """Parameters and their memory side by side, in rows of 2 * DIM numbers."""
    def flat(words, stems, filters, bias, out, last):
        values = np.concatenate([words.ravel(), stems.ravel(), *(f.ravel() for f in filters), bias, out, [last]])
        return np.pad(values.astype(np.float32), (0, -len(values) % DIM)).reshape(-1, DIM)

    return np.hstack([flat(model.words, model.stems, model.filters, model.bias, model.out, model.out_bias),
                      flat(*memory, 0.0)])


def _restored(state: np.ndarray) -> tuple[Model, list]:
    """The model and its memory, from copies of the rows."""
    blank = _fresh_model(np.random.default_rng(SEED))

    def parts(values):
        at = 0
        for like in (blank.words, blank.stems, *blank.filters, blank.bias, blank.out, np.zeros(1)):
            yield values[at:at + like.size].reshape(like.shape).copy()
            at += like.size

    (words, stems, *filters, bias, out, last) = parts(state[:, :DIM].ravel())
    (m_words, m_stems, *m_filters, m_bias, m_out, _) = parts(state[:, DIM:].ravel())
    return (Model(words, stems, filters, bias, out, float(last[0]), np.zeros(len(LANGUAGES))),
            [m_words, m_stems, m_filters, m_bias, m_out])


def _buffers(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple[list[Words], np.ndarray]]:
    """A shard's texts and labels, as many at a time as are learned from at once."""
    texts, labels, size = [], [], 0
    for batch in batches:
        for codes, language, label in zip(batch.column("codes"), batch.column("language"), batch.column("label")):
            codes = codes.as_py()
            texts.append(decoded(codes, language.as_py()))
            labels.append(label.as_py())
            size += len(texts[-1].word) * 8
            if len(texts) >= at_once or size >= BUFFER_BYTES:
                yield texts, np.array(labels, np.int64)
                texts, labels, size = [], [], 0
    if texts:
        yield texts, np.array(labels, np.int64)


def _counted(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(TAIL + 2, np.int64)
    for texts, labels in _buffers(batches, at_once):
        seen[:TAIL] += np.concatenate(_texts_with([t for t, h in zip(texts, _held(len(texts))) if not h]))
        seen[TAIL:] += len(labels), labels.sum()
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["at", "n"])


def _learned(batches: Iterator[pa.RecordBatch], state, weights: tuple[float, float], turn: int,
             at_once: int) -> Iterator[pa.RecordBatch]:
    """The rows of the state that one round over a shard changes."""
    model, memory = _restored(state.value)
    rng = np.random.default_rng([SEED, turn])
    for texts, labels in _buffers(batches, at_once):
        held = _held(len(labels))
        _learn(model, memory, [t for t, h in zip(texts, held) if not h], labels[~held], weights, rng)
    after = _state(model, memory)
    at = np.flatnonzero((after != state.value).any(1))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c) for c in after[at].T.copy())],
                                     ["at", *(f"v{i}" for i in range(2 * DIM))])
    del model, memory, after
    give_back()


def _logits(batches: Iterator[pa.RecordBatch], state, at_once: int) -> Iterator[pa.RecordBatch]:
    """How many held rows of a shard have each logit."""
    model, _ = _restored(state.value)
    for texts, labels in _buffers(batches, at_once):
        held = np.flatnonzero(_held(len(labels)))
        logits = np.array([model.logits(texts[i])[0] for i in held])
        language = np.array([texts[i].language[0] for i in held])
        (logit, language, label), n = np.unique(np.stack([np.round(logits, STEP), language, labels[held]]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(logit), pa.array(language.astype(np.int32)), pa.array(label.astype(np.int32)),
                                          pa.array(n)], ["logit", "language", "label", "n"])


def _marked(known: DataFrame) -> np.ndarray:
    """A bitmap of MARKS hash classes that have a known id: 8 MB, whatever the corpus."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)) + 1
    parts = known.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    marks = np.zeros(MARKS // 8, np.uint8)
    for part in parts:
        marks[(part["at"] - 1) * 4096:part["at"] * 4096] = np.frombuffer(part["bits"], np.uint8)
    return marks


def _marked_features(batches: Iterator[pa.RecordBatch], marks) -> Iterator[pa.RecordBatch]:
    """``_features`` without most of the rows that have no label, which a join would only move and drop."""
    for batch in batches:
        place = batch.column(2).to_numpy()
        kept = pa.array((marks.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool))
        yield from _features(iter([batch.select(["doc_id", "text"]).filter(kept)]))


def _fit_in_shards(docs: DataFrame, known: DataFrame, kind: str, shards: int, at_once: int) -> Model | None:
    """Iterative parameter mixing: a parameter's next value is the mean of those shards that changed it.

    Shards are hash classes of doc_id in hash order, so the same rows give the same shards. The
    driver holds the state, one row a word, and the counts by logit.
    """
    spark = docs.sparkSession
    known = known.withColumn("doc_id", F.col("doc_id").cast(kind))
    marks = spark.sparkContext.broadcast(_marked(known))
    rows = (docs.where("doc_id IS NOT NULL").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)))
            .mapInArrow(partial(_marked_features, marks=marks), f"doc_id {kind}, codes binary, language int")
            .join(known.hint("merge"), "doc_id").repartition(shards, "doc_id")
            .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "codes", "label")
            .select("label", "codes", "language").persist(StorageLevel.DISK_ONLY))
    try:
        counted = (rows.mapInArrow(partial(_counted, at_once=at_once), "at int, n long").groupBy("at")
                   .agg(F.sum("n").alias("n")).where((F.col("n") >= LEAST_TEXTS) | (F.col("at") >= TAIL)).toArrow())
        seen = np.zeros(TAIL + 2, np.int64)
        seen[counted["at"].to_numpy()] = counted["n"].to_numpy()
        n, toxic = seen[TAIL:].tolist()
        if not n:
            return None
        model = _fresh_model(np.random.default_rng(SEED))
        _forget_rare(model, seen[:1 + (1 << WORD_BITS)], seen[1 + (1 << WORD_BITS):TAIL])
        state = _state(model, _memory(model))
        for turn in range(max(EPOCHS, -(-LEAST_STEPS * BATCH * shards // n))):
            sent = spark.sparkContext.broadcast(state)
            mean = (rows.mapInArrow(partial(_learned, state=sent, weights=_class_weights(n, toxic), turn=turn, at_once=at_once), STATE)
                    .groupBy("at").agg(*(F.sum((F.col(f"v{i}").cast("double") * EXACT).cast("long")).alias(f"v{i}")
                                         for i in range(2 * DIM)), F.count("*").alias("n")).toArrow())
            state = state.copy()
            state[mean["at"].to_numpy()] = np.stack([mean[f"v{i}"].to_numpy() for i in range(2 * DIM)], 1) / (
                mean["n"].to_numpy()[:, None] * float(EXACT))
            sent.destroy()
        sent = spark.sparkContext.broadcast(state)
        cuts = (rows.mapInArrow(partial(_logits, state=sent, at_once=at_once), "logit double, language int, label int, n long")
                .groupBy("logit", "language", "label").agg(F.sum("n").alias("n")).toArrow())
        sent.destroy()
    finally:
        rows.unpersist()
    model, _ = _restored(state)
    place_cuts(model, *(cuts[c].to_numpy() for c in ("logit", "language", "label", "n")), (toxic + 1) / (n + 2))
    return model


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores, languages = [], []
        for _, _, raw, at in slices(batch.column(batch.num_columns - 1)):
            words = words_of(raw, at)
            scores.append(model.value.scores(words) if model.value else np.zeros(len(at) - 1))
            languages.append(words.language)
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(scores)),
                 pa.array([LANGUAGES[i] for i in np.concatenate(languages)])],
                [*batch.schema.names[:-1], "score", "language"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, language) of every row: calibrated toxicity from 0 to 1 and the guessed language.

    Null and empty texts get the score of a text without words; without a model every score is 0.
    Repeated rows are scored alike; other columns are not looked at; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)              # about 8 MB, whatever the corpus
    return docs.select("doc_id", "text").mapInArrow(partial(_scored, model=sent),
                                                    f"doc_id {kind}, score double, language string")


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, language), fitted on the rows that are not held out."""
    model = fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return score(docs, model).select("doc_id", (F.coalesce(fold(F.col("doc_id"), 5), F.lit(1)) == 0).alias("held_out"),
                                     "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language")


def _clean(batches: Iterator[pa.RecordBatch], model, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, at in slices(batch.column(text)):
            if model.value:
                yield batch.slice(lo, hi - lo).filter(pa.array(model.value.scores(words_of(raw, at)) < 0.5))
            else:
                yield batch.slice(lo, hi - lo)
    give_back()


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    model = fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return docs.mapInArrow(partial(_clean, model=spark.sparkContext.broadcast(model),
                                   text=docs.columns.index("text")), docs.schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document of the whole table."""
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
