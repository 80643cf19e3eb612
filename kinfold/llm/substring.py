"""Substring dedup: words covered by a run of `window` words that also starts elsewhere are removed.

Every window holds a least gram of GRAM words (its anchor), picked by content alone, so equal windows meet at equal anchors.
The windows of a document that share an anchor form one segment. A segment whose anchor is nowhere else needs no look, and all
windows of one that is met twice or more repeat. What is left are segments that are alone among unequal ones of their anchor:
each distinct segment of such an anchor is cut from one of its places and dealt by anchor into shards; each shard gets a
compressed FM-index (a wavelet matrix over the BWT), against which the segments that are alone are streamed by backward search.
An anchor whose distinct segments have more words than a shard takes (HOT) has the windows of these counted by 128-bit hash
instead, which adds up before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, blocks, durable, hashes, mix, release, row_key, scratch, tune
from .fmindex import FMIndex

WINDOW, GRAM = 50, 7
#: Words of a shard's index, words of an anchor's distinct segments above which its windows are counted by hash, words of a piece of a text.
SHARD_WORDS, PIECE = 150_000, 4_000_000
HOT = SHARD_WORDS
_B = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSE = tuple(np.uint64(pow(int(b), -1, 2**64)) for b in _B)


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))


class Powers:
    """Powers of both bases and of their inverses modulo 2^64, longer when needed."""

    def __init__(self) -> None:
        self.up: list[np.ndarray] = [np.ones(1, np.uint64)] * 2
        self.down: list[np.ndarray] = [np.ones(1, np.uint64)] * 2

    def grow(self, n: int) -> None:
        if len(self.up[0]) < n:
            n = 2 * n
            for i in (0, 1):
                self.up[i] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _B[i]))))
                self.down[i] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _INVERSE[i]))))


def spans(h: np.ndarray, start: np.ndarray, stop: np.ndarray, powers: Powers, which: int) -> np.ndarray:
    """Hashes of the word runs h[start:stop]: sums of the words times powers of a base, shifted to start at power 0."""
    powers.grow(len(h) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum(h * powers.up[which][: len(h)])))
    return mix((total[stop] - total[start]) * powers.down[which][start] + (stop - start).astype(np.uint64), 5 + which)


def segments(h: np.ndarray, ends: np.ndarray, window: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each segment of texts whose word hashes stand one after another.

    ends: the place after each text's last word. No window reaches over an end.
    """
    gram = min(GRAM, window)
    until = np.repeat(ends, np.diff(ends, prepend=0))  # of each word: the end of its text
    found = []
    for at in range(0, max(1, len(h) - window + 1), PIECE):
        piece = h[at : at + PIECE + window - 1]
        if len(piece) < window:
            break
        n = len(piece) - gram + 1
        g = spans(piece, np.arange(n), np.arange(n) + gram, powers, 0)
        least, width, wide = ((g >> np.uint64(24)) << np.uint64(24)) | np.arange(n, dtype=np.uint64), 1, window - gram + 1
        while width < wide:  # the least of `width` neighbours, doubled until it spans a window
            more = min(width, wide - width)
            least, width = np.minimum(least[: len(least) - more], least[more:]), width + more
        whole = np.flatnonzero(np.arange(at, at + len(least)) + window <= until[at : at + len(least)])
        if len(whole):
            place = (least[whole] & np.uint64(0xFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            found.append((g[place[first]], whole[first] + at, np.diff(np.append(first, len(place)))))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _marks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Every segment: anchor, two hashes, and place (row key, first window, number of windows). The texts of a block are worked on as one."""
    memo, powers = WordHashes(), Powers()
    for batch in batches:
        for part, texts in blocks(batch):
            split = [w if len(w) >= window else [] for w in ((t or b"").split() for t in texts)]
            ends = np.cumsum([len(w) for w in split])
            h = hashes([x for w in split for x in w], memo)
            a, at, n = segments(h, ends, window, powers)
            if not len(a):
                continue
            row = np.searchsorted(ends, at, side="right")
            start = at - np.concatenate(([0], ends))[row]
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [_signed(a), *(_signed(spans(h, at, at + n + window - 1, powers, i)) for i in (1, 0)), part.column("did").take(own), part.column("th").take(own), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["a", "s", "s2", "did", "th", "start", "n"],
            )


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The segments to cut from each text, with their words and place."""
    for batch in batches:
        for part, texts in blocks(batch):
            segs = part.column("segs")
            flat = segs.flatten()
            own = pa.array(np.repeat(np.arange(len(texts)), segs.value_lengths().to_numpy(zero_copy_only=False)))
            start, n = (flat.field(c).to_numpy() for c in ("start", "n"))
            cut, last, words = [], -1, []
            for row, at, size in zip(own.to_pylist(), start.tolist(), n.tolist(), strict=True):
                if row != last:
                    last, words = row, (texts[row] or b"").split()
                cut.append(b" ".join(words[at : at + size + window - 1]))
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(c) for c in ("a", "s", "s2", "hot", "once", "start")), part.column("did").take(own), part.column("th").take(own), pa.array(cut, pa.binary())],
                names=["a", "s", "s2", "hot", "once", "start", "did", "th", "words"],
            )


def repeated_windows(rows: list[bytes], once: list[bool], window: int) -> list[np.ndarray]:
    """For each distinct segment (words joined by blanks) of a shard, which of its windows occur twice or more among the segments.

    A segment that was met several times (not `once`) repeats whole; the others are streamed against the index of all.
    """
    ids: dict[bytes, int] = {}
    codes = [np.array([ids.setdefault(w, len(ids) + 1) for w in r.split(b" ")], np.int64) for r in rows]
    text = np.concatenate([x for c in codes for x in (c, [0])])
    base = np.concatenate(([0], np.cumsum([len(c) + 1 for c in codes])))
    alone = [k for k in range(len(codes)) if once[k]]
    found = [np.ones(len(c) - window + 1, bool) for c in codes]
    if alone:
        ends = [base[k] + np.arange(window, len(codes[k]) + 1) for k in alone]
        length = FMIndex(text, 2 * window).matching(text, np.concatenate(ends), window)
        for k, got in zip(alone, np.split(length >= window, np.cumsum([len(e) for e in ends])[:-1]), strict=True):
            found[k] = got
    return found


def _runs(hit: np.ndarray, first: int) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"start": first + s, "n": e - s} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _indexed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Segments come sorted by anchor and hashes: shards of bounded size, cut between anchors; yields the repeated windows of those that are alone as runs of their text."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([r[6] for r in rows], [r[2] for r in rows], window)
        some = [(r[4], r[5], _runs(x, r[3])) for r, x in zip(rows, found, strict=True) if r[2] and x.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], kind) for i, kind in enumerate((pa.int64(), pa.int64(), _RUNS))], names=["did", "th", "runs"])

    held, words, last = [], 0, None
    for batch in batches:
        for part, texts in blocks(batch, "words"):
            anchors = part.column("a").to_pylist()
            for a, *row in zip(anchors, *(part.column(c).to_pylist() for c in ("s", "s2", "once", "start", "did", "th")), texts, strict=True):
                if a != last and words >= SHARD_WORDS:
                    yield shard(held)
                    held, words = [], 0
                if a == last and held[-1][:2] == row[:2]:
                    continue  # cut twice, from repeated rows of one id
                last = a
                held.append(row)
                words += row[6].count(b" ") + 1
    if held:
        yield shard(held)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The window hashes of segments of hot anchors."""
    memo, powers = WordHashes(), Powers()
    for batch in batches:
        for part, texts in blocks(batch, "words"):
            got = []
            for text in texts:
                h = hashes(text.split(b" "), memo)
                at = np.arange(len(h) - window + 1)
                got.append((spans(h, at, at + window, powers, 0), spans(h, at, at + window, powers, 1), at.astype(np.int32)))
            row = pa.array(np.repeat(np.arange(len(texts)), [len(g[2]) for g in got]))
            one, two, at = (np.concatenate([g[i] for g in got]) for i in range(3))
            names = ("once", "start", "did", "th")
            yield pa.RecordBatch.from_arrays([_signed(one), _signed(two), pa.array(at), *(part.column(c).take(row) for c in names)], names=["w1", "w2", "i", *names])


def _islands(starts: Column) -> Column:
    """Sorted window numbers as runs (start, n) of consecutive ones."""
    none = F.array().cast("array<struct<start: int, n: int>>")

    def add(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.concat(F.slice(acc, 1, F.greatest(F.lit(0), F.size(acc) - 1)), F.array(F.struct(last["start"].alias("start"), (last["n"] + 1).alias("n"))))
        fresh = F.concat(acc, F.array(F.struct(x.alias("start"), F.lit(1).alias("n"))))
        return F.when(last["start"] + last["n"] == x, longer).otherwise(fresh).cast("array<struct<start: int, n: int>>")

    return F.aggregate(starts, none, add)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(did, th, runs): for each document (see row_key) with repeated windows, runs of (first window, number of windows).

    Joins with texts always shuffle by the same keys (the hint), so that small inputs are worked on as large ones are.
    A passage that very many documents share costs each of them a narrow row and its words are cut once.
    """
    with scratch(docs.sparkSession) as made:
        return made.keep(_repeats(docs, window))


def _repeats(docs: DataFrame, window: int) -> DataFrame:
    spark = docs.sparkSession
    tune(spark)
    keyed = row_key(docs.select("doc_id", "text")).select("did", "th", "text")
    marks = durable(keyed.mapInArrow(lambda it: _marks(it, window), "a long, s long, s2 long, did long, th long, start int, n int"))
    shared = durable(marks.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a"))
    release(spark)
    near = durable(marks.join(shared.hint("merge"), "a", "left_semi").withColumn("place", F.xxhash64("did", "th", "start")))
    release(spark)
    kinds = durable(near.groupBy("a", "s", "s2").agg(F.count("*").alias("c"), F.min("place").alias("first"), (F.first("n") + (window - 1)).alias("size")))
    unlike = kinds.groupBy("a").agg(F.count("*").alias("d"), F.min("c").alias("least"), F.sum("size").alias("words")).select("a", "words", ((F.col("d") > 1) & (F.col("least") == 1)).alias("look"))
    met = durable(kinds.join(unlike.hint("merge"), "a"))
    release(spark)
    cut_here = F.col("look") & (F.col("place") == F.col("first"))
    whole = F.when(F.col("c") > 1, F.struct("start", "n"))
    named = F.when(cut_here, F.struct("start", "n", "a", "s", "s2", (F.col("words") > HOT).alias("hot"), (F.col("c") == 1).alias("once")))
    joined = near.join(met.hint("merge"), ["a", "s", "s2"]).select("did", "th", whole.alias("whole"), named.alias("named"))
    found = durable(joined.groupBy("did", "th").agg(F.collect_set("whole").alias("whole"), F.collect_set("named").alias("segs")))
    release(spark)
    wanted = found.where(F.size("segs") > 0).select("did", "th", F.sort_array("segs").alias("segs"))
    kind = "a long, s long, s2 long, hot boolean, once boolean, start int, did long, th long, words binary"
    cut = durable(keyed.join(wanted.hint("merge"), ["did", "th"]).mapInArrow(lambda it: _cut(it, window), kind))
    release(spark)
    runs = "array<struct<start: int, n: int>>"
    shards = cut.where("not hot").drop("hot").repartition("a").sortWithinPartitions("a", "s", "s2")
    indexed = shards.mapInArrow(lambda it: _indexed(it, window), f"did long, th long, runs {runs}")
    every = durable(cut.where("hot").select("once", "start", "did", "th", "words").mapInArrow(lambda it: _windows(it, window), "w1 long, w2 long, i int, once boolean, start int, did long, th long"))
    often = every.groupBy("w1", "w2").agg(F.count("*").alias("all")).where(F.col("all") > 1).select("w1", "w2")
    starts = F.sort_array(F.collect_set(F.col("start") + F.col("i")))
    hashed = every.where("once").join(often, ["w1", "w2"]).groupBy("did", "th", "start").agg(starts.alias("i")).select("did", "th", _islands(F.col("i")).alias("runs"))
    equal = found.where(F.size("whole") > 0).select("did", "th", F.col("whole").alias("runs"))
    return durable(indexed.unionByName(hashed).unionByName(equal).groupBy("did", "th").agg(F.flatten(F.collect_set("runs")).alias("runs")))


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in blocks(batch):
            total, gone, kept = [], [], []
            for text, runs in zip(texts, part.column("runs").to_pylist(), strict=True):
                words = (text or b"").split()
                total.append(len(words))
                if runs:
                    mark = np.zeros(len(words) + 1, np.int64)
                    start = np.array([r["start"] for r in runs])
                    np.add.at(mark, start, 1)
                    np.add.at(mark, start + np.array([r["n"] for r in runs]) + window - 1, -1)
                    stay = np.cumsum(mark)[:-1] == 0
                    gone.append(len(words) - int(stay.sum()))
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
            keep = [n for n in part.schema.names if n not in ("runs", "did", "th")]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[*keep, "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of docs (any columns but n_words, n_removed and kept_text) with the words counted, removed and kept.

    Words are runs of anything but ASCII blanks, unchanged; a window is `window` consecutive words of one document and all
    windows are judged on the input. Null and empty texts have no words and keep the empty text. Repeated rows repeat each
    other's windows. A row with a null doc_id takes part like any other; ids may be of any type. Ties have no effect; an empty
    table gives no row.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    own = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed", "kept_text", "runs", "did", "th")]
    base = docs.select(*(F.col(f"`{f.name}`") for f in own))
    joined = row_key(base).join(repeats(base, window).hint("merge"), ["did", "th"], "left")
    kind = StructType([*own, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    return joined.select(*(F.col(f"`{f.name}`") for f in own), "runs").mapInArrow(lambda it: _kept(it, window), kind)


def op7_substring(docs: DataFrame) -> DataFrame:
    """remove_repeats() at 35 words: doc_id, n_words, n_removed, kept_sha256 of every document; edges as there."""
    out = remove_repeats(docs.select("doc_id", "text"), 35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
