"""Toxicity by maximum-scoring segments.

Words and their first four to six letters get log-odds of toxic against other documents under an informative Dirichlet prior;
those that don't stand out count a small loss. A linear-time scan finds all maximal-scoring segments of a text. Their scores
are put on the scale of the extreme-value law of chance segments (Karlin-Altschul), which a logistic curve turns into a
probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MEMO_WORDS, Shared, blocks, durable, fold_of, labelled_sample, mix, others, picked, scratch, tune
from .minhash import shingle_sets

#: Labelled documents, and bytes of their texts, learnt from at most, prior mass (in documents, a sixteenth of all at most), least documents of a unit, loss of a plain word.
FIT_ROWS, FIT_BYTES, PRIOR, LEAST_DOCS, LOSS = 12_000, 200_000_000, 500.0, 4, 0.15
#: Quantiles by which the scores met in toxic documents stand in for what background text was too short to show.
UNSEEN = 50
#: Least score of a segment over the chance level to count.
CHANCE = 0.0
#: Hash functions of the sketch by which copies among the learnt documents are told.
SKETCH = 16

_LETTERS = re.compile(r"[^\W\d_]+")


def units(word: bytes) -> list[int]:
    """Hashes of the words in a blank-parted token, in small letters, and of their first 4, 5 and 6 letters."""
    out = []
    for w in _LETTERS.findall(word.decode().lower()):
        out.append(xxhash.xxh3_64_intdigest(w, 1) >> 1)
        out += [xxhash.xxh3_64_intdigest(w[:k], k) >> 1 for k in (4, 5, 6) if len(w) >= k]
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a unit."""
    memo: dict[bytes, list[int]] = {}
    held: dict[int, list[int]] = {}

    def out() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *(pa.array([v[y] for v in held.values()], pa.int64()) for y in (0, 1))], names=["unit", "n0", "n1"])
        held.clear()
        return got

    for batch in batches:
        for part, texts in blocks(batch):
            for text, y in zip(texts, part.column("label").to_pylist(), strict=True):
                seen: set[int] = set()
                for w in set((text or b"").split()):
                    u = memo.get(w)
                    if u is None:
                        if len(memo) > MEMO_WORDS // 4:
                            memo.clear()
                        u = memo[w] = units(w)
                    seen.update(u)
                for u in seen:
                    held.setdefault(u, [0, 0])[y] += 1
            if len(held) > 200_000:
                yield out()
    yield out()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least values of SKETCH hash functions over a text's shingles of five words."""
    for batch in batches:
        for part, texts in blocks(batch):
            out = []
            for s in shingle_sets(texts, 5):
                out.append([int(mix(s, 200 + i).min() >> np.uint64(1)) for i in range(SKETCH)] if len(s) else [])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "sketch"])


def _distinct(sample: DataFrame) -> DataFrame:
    """The sample without copies: a unit must not stand out because one text that holds it was copied often."""
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "text").mapInArrow(_sketched, f"doc_id {kind}, sketch array<long>").collect()
    held: dict[tuple[int, int], list[int]] = {}
    kept = []
    for doc, sketch in sorted((r[0], r[1]) for r in rows):
        met = Counter(d for key in enumerate(sketch) for d in held.get(key, ()))
        if sketch and met and max(met.values()) >= SKETCH // 4:
            continue
        kept.append((doc,))
        for key in enumerate(sketch):
            held.setdefault(key, []).append(doc)
    ids = sample.sparkSession.createDataFrame(kept, f"doc_id {kind}")
    return sample.join(F.broadcast(ids), "doc_id")


class Scores(dict):
    """Token -> the highest score of its units, less than 0 if none stands out."""

    def __init__(self, known: dict[int, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> float:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = s = max((self.known.get(u, -LOSS) for u in units(word)), default=-LOSS)
        return s


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, last + 1) of a score sequence, in linear time (Ruzzo and Tompa).

    Only positive scores are visited: sums of what lies between come from a running total.
    """
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    out: list[tuple[float, int, int]] = []
    stack: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, last + 1, nearest to the left with a lower total before
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, a, b = float(total[i]), float(total[i + 1]), i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0:  # nothing to the left can grow any more
                out += [(r - le, x, y) for le, r, x, y, _ in stack]
                stack = [(left, right, a, b, -1)]
                break
            if stack[j][1] >= right:
                stack.append((left, right, a, b, j))
                break
            left, a = stack[j][0], stack[j][2]
            del stack[j:]
    return out + [(r - le, x, y) for le, r, x, y, _ in stack]


def _found(batches: Iterator[pa.RecordBatch], shared: object) -> Iterator[pa.RecordBatch]:
    """For fitting: label, tokens, segment scores, and the positive scores themselves."""
    memo = Scores(shared.value)
    for batch in batches:
        for part, texts in blocks(batch):
            n, segs, plus = [], [], []
            for t in texts:
                words = (t or b"").split()
                s = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
                n.append(len(words))
                segs.append([x[0] for x in segments(s)])
                plus.append(s[s > 0].tolist())
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(n, pa.int64()), pa.array(segs, pa.list_(pa.float64())), pa.array(plus, pa.list_(pa.float64()))], names=["label", "n", "segs", "plus"])


class Law:
    """Scale of chance segments (lam, log of K), and the logistic curve over what exceeds it."""

    def __init__(self, lam: float, log_k: float, slope: float, base: float):
        self.lam, self.log_k, self.slope, self.base = lam, log_k, slope, base

    def excess(self, score: float, n: int) -> float:
        """How far a segment's score lies above the level that chance reaches once in a text of n tokens, in natural log units."""
        return self.lam * score - self.log_k - np.log(max(1, n))

    def statistic(self, scores: list[float], n: int) -> float:
        return float(sum(max(0.0, self.excess(s, n) - CHANCE) for s in scores))

    def probability(self, stat: float | np.ndarray) -> float | np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * np.log1p(stat), -30, 30)))


def _law(rows: list[tuple[int, int, list[float], list[float]]]) -> Law:
    plain = [r for r in rows if r[0] == 0]
    tokens = sum(r[1] for r in plain) + 2
    toxic = np.array([v for r in rows if r[0] == 1 for v in r[3]])
    unseen = np.quantile(toxic, (np.arange(UNSEEN) + 0.5) / UNSEEN) if len(toxic) else np.array([1.0])
    values = np.concatenate((np.array([v for r in plain for v in r[3]]), unseen))
    weight = 1.0 / tokens  # of each value among background tokens
    lo, hi = 1e-3, 20.0
    for _ in range(60):  # sum of p(s) exp(lam s) = 1
        lam = (lo + hi) / 2
        at = (1 - weight * len(values)) * np.exp(-lam * LOSS) + weight * np.exp(np.minimum(700, lam * values)).sum()
        lo, hi = (lam, hi) if at < 1 else (lo, lam)
    tops = [lam * max(r[2]) - np.log(max(1, r[1])) for r in plain if r[2]]
    log_k = float(np.mean(tops) - 0.5772) if len(tops) >= 20 else -2.0
    law = Law(lam, min(log_k, 0.0), 0.0, 0.0)
    x, y = np.log1p(np.array([law.statistic(r[2], r[1]) for r in rows])), np.array([r[0] for r in rows], float)
    if not len(rows) or y.min() == y.max():
        law.base = -3.0 if not len(rows) or y[0] == 0 else 3.0
        return law
    a, b, ridge = 0.0, float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), 1e-2
    for _ in range(100):  # Newton's steps, the slope held back a little
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * x).sum() - ridge * a, (y - p).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    law.slope, law.base = max(0.0, float(a)), float(b)
    return law


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[dict[int, float], Law]:
    """Scores of all units that stand out and the law, from about `rows` labelled documents at most (and FIT_BYTES of text).

    Null texts and rows without an id or a label teach nothing; empty ones count as documents without units; of documents
    that are near copies one is learnt from. Without labels of both kinds no unit stands out. Ties in unit counts have no effect.
    """
    spark = docs.sparkSession
    tune(spark)
    with scratch(spark):
        return _fitted(spark, durable(_distinct(labelled_sample(docs, labels, "toxic", rows, FIT_BYTES))))


def _fitted(spark: SparkSession, sample: DataFrame) -> tuple[dict[int, float], Law]:
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    d0, d1 = size.get(0, 0), size.get(1, 0)
    known: dict[int, float] = {}
    if d0 and d1:
        n = sample.mapInArrow(_counted, "unit long, n0 long, n1 long").groupBy("unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= LEAST_DOCS)
        n = durable(n)
        tests = np.log(max(50, n.count()))
        least = float(np.sqrt(2 * tests - np.log(4 * np.pi * tests)))  # what the largest of as many chance values comes to
        mass = min(PRIOR, (d0 + d1) / 16)
        share = mass * (F.col("n0") + F.col("n1")) / (d0 + d1) / (d0 + d1)  # the prior holds every unit as often in either class as in both
        y0, y1 = F.col("n0") + share * d0, F.col("n1") + share * d1
        rest0, rest1 = d0 * (1 + mass / (d0 + d1)) - y0 + 1, d1 * (1 + mass / (d0 + d1)) - y1 + 1
        odds = F.log(y1 / rest1) - F.log(y0 / rest0)
        best = n.select("unit", odds.alias("s"), (odds / F.sqrt(1 / y0 + 1 / y1 + 1 / rest0 + 1 / rest1)).alias("z")).where(F.col("z") >= least)
        known = {r["unit"]: r["s"] for r in best.collect()}  # no more than there are units in the bounded sample
    shared = Shared(spark, known)
    found = sample.mapInArrow(lambda it: _found(it, shared), "label int, n long, segs array<double>, plus array<double>").collect()
    return known, _law([(r[0], r[1], r[2], r[3]) for r in found])


def score(docs: DataFrame, known: dict[int, float], law: Law) -> DataFrame:
    """Every row of docs (any columns but toxicity and passages) with toxicity (0 to 1) and passages: the segments above chance,
    as (first token, number of tokens, excess). Null and empty texts have none and get the curve's value for none. Time is
    linear in the text. Repeated rows repeat results; an empty table gives none."""
    from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

    tune(docs.sparkSession)
    own_fields = others(docs, "toxicity", "passages")
    shared = Shared(docs.sparkSession, (known, law))
    passage = StructType([StructField("start", IntegerType()), StructField("n", IntegerType()), StructField("excess", DoubleType())])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("excess", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, rule = shared.value
        memo = Scores(of)
        for batch in batches:
            for part, texts in blocks(batch):
                stats, spans = [], []
                for t in texts:
                    words = (t or b"").split()
                    segs = segments(np.fromiter(map(memo.__getitem__, words), np.float64, len(words)))
                    own = [{"start": a, "n": b - a, "excess": float(x)} for s, a, b in segs if (x := rule.excess(s, len(words))) > CHANCE]
                    spans.append(own)
                    stats.append(sum(x["excess"] - CHANCE for x in own))
                p = rule.probability(np.array(stats, float)) if stats else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64()), pa.array(spans, arrow)], names=[*part.schema.names, "toxicity", "passages"])

    return picked(docs, own_fields).mapInArrow(run, StructType([*own_fields, StructField("toxicity", DoubleType()), StructField("passages", ArrayType(passage))]))


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of every document, by fit() and score(); null ids are not held out."""
    known, law = fit(docs, labels)
    out = score(docs.select("doc_id", "text"), known, law)
    return out.select("doc_id", F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
