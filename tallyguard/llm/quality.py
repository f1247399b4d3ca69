"""Quality classifier: learned vectors of hashed words and character n-grams, averaged, softmax output.

Trained by stochastic gradient descent in numpy. As the output is linear in the average, a text's
score needs one number a feature: the difference of the two classes' products with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.labelled import fold, training_sample
from tallyguard.llm.textscan import SPACE, Scan, slices

BITS, DIM = 17, 8
GRAMS = (2, 3, 4)
MOST_ROWS = 4_000
EPOCHS, LEAST_STEPS, RATE, SEED = 8, 8_000, 4.0, 11
LEAST_TEXTS = 3
CUT = 0.7
CALIBRATION_FOLDS = 5
_SCALE = np.uint64(0x9E3779B97F4A7C15)
AGAIN = np.uint64(0x51ED270B51ED270B)
"""What a word that repeats the one before it counts as."""


def features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, text) of all words and character n-grams; an n-gram has white space at its ends only.

    Characters are bytes. A word equal to the one before it is the feature AGAIN.
    """
    scan = Scan(raw, at)
    start, end, first = scan.words()
    hashes = scan.word_hashes(start, end)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = False
    hashes[again] = AGAIN
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    buckets, texts = [(hashes >> np.uint64(64 - BITS)).astype(np.int32)], [owner[start]]
    n = len(raw)
    space = SPACE[raw]
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = np.where(space, 32, raw)
    eight = np.ndarray((n,), "<u8", padded, strides=(1,)).copy() if n else np.zeros(0, np.uint64)
    fine = np.ones(n, bool)
    for k in GRAMS:
        if k > 2:
            fine[:n - k + 2] &= ~space[k - 2:]
        late = at[1:] - (k - 1)
        for j in range(k - 1):
            fine[np.minimum(np.maximum(late + j, at[:-1]), n - 1)[at[1:] > at[:-1]]] = False
        pos = np.flatnonzero(fine)
        gram = (eight[pos] & np.uint64((1 << 8 * k) - 1)) + np.uint64(k)
        buckets.append((gram * _SCALE >> np.uint64(64 - BITS)).astype(np.int32))
        texts.append(owner[pos])
    return np.concatenate(buckets), np.concatenate(texts)


@dataclass
class Model:
    slopes: np.ndarray
    bias: float

    def scores(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every text; without features that of the bias."""
        buckets, text = features(raw, at)
        count = np.bincount(text, minlength=len(at) - 1)
        total = np.bincount(text, self.slopes[buckets], minlength=len(at) - 1)
        x = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Model:
    """Fit on (buckets, counts) a text by gradient descent, one text a step, classes counting alike."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    seen = np.zeros(1 << BITS, np.int64)
    for bucket, _ in texts:
        seen[bucket] += 1
    vectors[seen < LEAST_TEXTS] = 0
    known = seen >= LEAST_TEXTS
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2)
    ones = int(labels.sum())
    weight = np.array([len(labels) / (2 * max(1, len(labels) - ones)), len(labels) / (2 * max(1, ones))])
    weight = np.minimum(weight, 4.0)
    shares = [(b[known[b]], (c / c.sum()).astype(np.float32)[known[b]]) for b, c in texts]
    steps = max(epochs * len(labels), LEAST_STEPS)
    order = np.concatenate([rng.permutation(len(labels)) for _ in range(-(-steps // len(labels)))])[:steps]
    for step, i in enumerate(order):
        bucket, share = shares[i]
        mean = share @ vectors[bucket]
        logits = mean @ out + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[labels[i]] -= 1
        slope = (p * weight[labels[i]] * rate * (1 - step / steps)).astype(np.float32)
        grown = out @ slope
        out -= np.outer(mean, slope)
        bias -= slope * 0.05
        vectors[bucket] -= share[:, None] * grown
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit cut with the most right answers, midway in its gap; 0 where only one class is seen."""
    if not len(labels) or labels.min() == labels.max():
        return 0.0
    order = np.argsort(logits)
    x, y = logits[order], labels[order]
    right = np.r_[0, np.cumsum(y == 0)] + np.r_[np.cumsum((y == 1)[::-1])[::-1], 0]
    right[1:-1][x[1:] == x[:-1]] = -1
    best = np.flatnonzero(right == right.max())
    k = int(best[len(best) // 2])
    return float(x[0] - 1 if k == 0 else x[-1] + 1 if k == len(x) else (x[k - 1] + x[k]) / 2)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets, counts = [], []
        for i in range(batch.num_rows):
            for _, _, raw, at in slices(batch.column(1).slice(i, 1)):
                bucket, count = np.unique(features(raw, at)[0], return_counts=True)
                buckets.append(bucket.astype(np.int32).tobytes())
                counts.append(np.minimum(count, 65535).astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(buckets, pa.binary()),
                                          pa.array(counts, pa.binary())], ["doc_id", "label", "buckets", "counts"])


def fit(docs: DataFrame, labels: DataFrame, keep, most: int = MOST_ROWS) -> Model | None:
    """Train on at most ``most`` labelled rows, a fifth of which place the cut. None where there are no labels."""
    sample = training_sample(docs, labels, "quality", keep, most)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(_features, f"doc_id {kind}, label int, buckets binary, counts binary").toPandas()
    rows = rows[rows["buckets"].map(len) > 0]
    if not len(rows):
        return None
    rows = rows.sort_values(["doc_id", "buckets", "label"]).reset_index(drop=True)
    texts = [(np.frombuffer(b, np.int32), np.frombuffer(c, np.uint16).astype(np.float64))
             for b, c in zip(rows["buckets"], rows["counts"])]
    truth = rows["label"].to_numpy(np.int64)
    rest = np.random.default_rng(SEED).permutation(len(truth)) % CALIBRATION_FOLDS == 0
    rest &= not rest.all()                                    # a single row is for training
    model = train([t for t, r in zip(texts, rest) if not r], truth[~rest])
    logits = np.array([model.slopes[b] @ c / c.sum() + model.bias for (b, c), r in zip(texts, rest) if r])
    model.bias += np.log(CUT / (1 - CUT)) - best_threshold(logits, truth[rest])
    return model


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, at in slices(batch.column(1)):
            found = model.value.scores(raw, at) if model.value else np.zeros(hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found)], ["doc_id", "score"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row: the chance of good quality, with the best cut at CUT.

    Null and empty texts have no features and get the bias; without a model every score is 0.
    Repeated rows are scored alike; other columns are not looked at; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)              # 1 MB, whatever the corpus
    return docs.select("doc_id", "text").mapInArrow(partial(_scored, model=sent), f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), fitted on the rows that are not held out."""
    model = fit(docs, labels, fold(F.col("doc_id"), 4) != 2)
    return score(docs, model).select("doc_id", (F.coalesce(fold(F.col("doc_id"), 4), F.lit(0)) == 2).alias("held_out"),
                                     "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document of the whole table."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
