"""Quality classifier: hashed word n-gram logistic regression, fitted by follow-the-regularised-leader updates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, blocks, fold_of, labelled_sample, mix, others, picked, scratch, tune

#: log2 of the number of hash buckets, labelled documents and bytes of their texts that are learnt from at most, passes over them.
BITS, FIT_ROWS, FIT_BYTES, PASSES = 20, 12_000, 60_000_000, 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1

_CAPS, _LOWS, _DIGITS, _HIGHS = re.compile(rb"[A-Z]+"), re.compile(rb"[a-z]+"), re.compile(rb"[0-9]+"), re.compile(rb"[\x80-\xff]+")


def shape(word: bytes) -> bytes:
    """The word with its runs of capitals, small letters, digits and other letters each made one sign; punctuation stays."""
    s = _DIGITS.sub(b"0", _HIGHS.sub(b"u", _LOWS.sub(b"a", _CAPS.sub(b"A", word))))
    return re.sub(rb"[au]{2,}", b"a", s)[:24]


class Signs(dict):
    """word -> its hash (upper 32 bits) and that of its shape (lower 32)."""

    def __missing__(self, word: bytes) -> int:
        import zlib

        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = h = zlib.crc32(word) << 32 | zlib.crc32(shape(word))
        return h


def features(text: bytes | None, memo: Signs) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of a text: 1-grams and 2-grams of words, 1- to 3-grams of word shapes, log counts scaled to length 1."""
    words = (text or b"").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float64)
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    w, s = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
    p = np.uint64(0x100000001B3)
    s2 = s[:-1] * p + s[1:]
    grams = [mix(w, 1), mix(w[:-1] * p + w[1:], 2), mix(s, 3), mix(s2, 4), mix(s2[:-1] * p + s[2:], 5)]
    repeated = 1 - len(np.unique(grams[1])) / max(1, len(grams[1]))  # a gram of its own for how much repeats
    b, c = np.unique((np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    x = np.log1p(c)
    x /= np.sqrt(np.dot(x, x))
    return np.append(b, (1 << BITS) + int(repeated * 9.99)), np.append(x, 0.5)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = PASSES) -> np.ndarray:
    """Weights after FTRL-proximal updates over the rows in the given order."""
    size = (1 << BITS) + 10
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(passes):
        for b, x, y in rows:
            g = (1 / (1 + np.exp(-np.clip(np.dot(w[b], x), -30, 30))) - y) * x
            m = n[b] + g * g
            z[b] += g - (np.sqrt(m) - np.sqrt(n[b])) / ALPHA * w[b]
            n[b] = m
            zb = z[b]
            w[b] = np.where(np.abs(zb) <= L1, 0, -(zb - np.sign(zb) * L1) / ((BETA + np.sqrt(m)) / ALPHA + L2))
    return w


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Signs()
    for batch in batches:
        for part, texts in blocks(batch):
            f = [features(t, memo) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array([b.astype(np.int32) for b, _ in f], pa.list_(pa.int32())), pa.array([x.astype(np.float32) for _, x in f], pa.list_(pa.float32()))], names=["doc_id", "label", "b", "x"]
            )


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias of P(quality = 1), from about `rows` labelled documents at most; all-zero weights without labels.

    Both bounds hold what reaches the driver: a vector has less than twice as many entries as its text has bytes. Null texts
    and rows without an id or a label teach nothing, empty texts have no entry. Rows are learnt from in an order drawn by a
    fixed seed over (doc_id, label, vector), so repeated rows and ties don't make the result depend on partitioning.
    """
    tune(docs.sparkSession)
    with scratch(docs.sparkSession):
        sample = labelled_sample(docs, labels, "quality", rows, FIT_BYTES)
        kind = sample.schema["doc_id"].dataType.simpleString()
        got = sample.mapInArrow(_vectors, f"doc_id {kind}, label int, b array<int>, x array<float>").toArrow().sort_by("doc_id")
    return _learnt([(np.asarray(b.values), np.asarray(x.values, dtype=np.float64), y) for b, x, y in zip(got["b"], got["x"], got["label"].to_pylist(), strict=True)])


def _learnt(data: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    if not data:
        return np.zeros((1 << BITS) + 10, np.float32), 0.0
    order = np.random.default_rng(7).permutation(len(data))
    w = ftrl([data[i] for i in order])
    # The hashed sum has no constant: move the cut to the point between the classes that errs least on the rows it was fitted on.
    s, y = np.array([np.dot(w[b], x) for b, x, _ in data]), np.array([r[2] for r in data])
    cuts = np.quantile(s, np.linspace(0.002, 0.998, 499))
    bad = [((s >= c) & (y == 0)).sum() / max(1, (y == 0).sum()) + 2 * ((s < c) & (y == 1)).sum() / max(1, (y == 1).sum()) for c in cuts]
    best = np.flatnonzero(np.asarray(bad) == min(bad))
    return w.astype(np.float32), float(cuts[best[len(best) // 2]])


def score(docs: DataFrame, weights: np.ndarray, cut: float) -> DataFrame:
    """Every row of docs (any columns but quality_score) with quality_score, the probability of quality 1 (0 to 1).

    Null and empty texts have no n-gram and so the score of the cut alone. Repeated rows give repeated results; an empty table none.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((weights, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, (w, at) = Signs(), shared.value
        for batch in batches:
            for part, texts in blocks(batch):
                out = []
                for t in texts:
                    b, x = features(t, memo)
                    out.append(1 / (1 + np.exp(-np.clip((np.dot(w[b], x) if len(b) else 0.0) - at, -30, 30))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.float64())], names=[*part.schema.names, "quality_score"])

    own = others(docs, "quality_score")
    return picked(docs, own).mapInArrow(run, StructType([*own, StructField("quality_score", DoubleType())]))


def op10_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by fit() and score(); null ids are not held out."""
    w, cut = fit(docs, labels)
    out = score(docs.select("doc_id", "text"), w, cut)
    return out.select("doc_id", F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
