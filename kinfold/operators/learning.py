"""Learning signature k-mers from lists of windows: what a task has of a k-mer is put together before it is sent.

Windows are those of sequences.window_lists(), with a k-mer as a number: (id, function, len, pos, kmers, and more columns of the
sequence). The results are those of operators.signatures over a row a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.sequences import K, window_lists

from . import signatures
from .graph import cut_lineage

#: Windows that a task puts together at a time.
TOGETHER = 2_000_000
#: Windows of a sequence that are looked up first.
FIRST = 4


def windows(seqs: DataFrame, k: int = K, *more: str) -> DataFrame:
    """The windows of annotated sequences (id, function, seq, and `more`)."""
    named = seqs.where(F.col("function").isNotNull() & (F.col("function") != ""))
    return window_lists(named.select("id", "function", "seq", F.length("seq").alias("len"), *more), "seq", k)


def _blocks(batches: Iterator[pa.RecordBatch], column: str, together: int) -> Iterator[pa.Table]:
    """Batches of lists put together to about so many values."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch.column(column).flatten())
        if n >= together:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _lists(block: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, their number in each row) of a column of lists."""
    lists = pa.concat_arrays(block.column(name).chunks)
    return lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _kinds(block: pa.Table, by: list[str]) -> np.ndarray:
    """A number for each row, equal where all columns of `by` are (nulls too)."""
    kind = np.zeros(len(block), np.int64)
    for c in by:
        own = pc.dictionary_encode(pa.concat_arrays(block.column(c).chunks), null_encoding="encode")
        kind = np.unique(kind * len(own.dictionary) + own.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return kind


def _grouped(block: pa.Table, by: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows ordered by k-mer and kind: (order, first place of each group, windows of each, k-mer of each, a row of each)."""
    kmers, n = _lists(block, "kmers")
    row = np.repeat(np.arange(len(n)), n)
    kind = _kinds(block, by)
    distinct, at = np.unique(kmers, return_inverse=True)
    key = at * (int(kind.max()) + 1) + kind[row]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return order, first, np.diff(np.append(first, len(key))), kmers[order[first]], row[order[first]]


def counts(lists: DataFrame, *by: str, together: int = TOGETHER) -> DataFrame:
    """(kmer, `by`, n) of the windows: each task counts its own first."""
    by = by or ("function",)
    kinds = ", ".join(f"`{c}` {lists.schema[c].dataType.simpleString()}" for c in by)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "kmers", together):
            _, _, n, kmer, row = _grouped(block, list(by))
            yield pa.RecordBatch.from_arrays([pa.array(kmer), *(pa.concat_arrays(block.column(c).chunks).take(pa.array(row)) for c in by), pa.array(n)], names=["kmer", *by, "n"])

    each = lists.select("kmers", *by).where(F.size("kmers") > 0).mapInArrow(count, f"kmer long, {kinds}, n long")
    return each.groupBy("kmer", *by).agg(F.sum("n").alias("n"))


def holders(sigs: DataFrame, lists: DataFrame, first: int = FIRST) -> Column:
    """How many sequences (distinct ids) hold a signature. Both tables should be written.

    The first few windows of a sequence are looked up; all of them only if none of those is a signature. Few sequences are left by then, so
    that hardly more than these windows is dealt by k-mer.
    """
    named = lists.where("id is not null")

    def held(rows: DataFrame, kmers: Column) -> DataFrame:
        return rows.select("id", F.explode(F.array_distinct(kmers)).alias("kmer")).join(sigs.select("kmer"), "kmer", "left_semi").select("id").distinct()

    some = cut_lineage(held(named, F.slice("kmers", 1, first)))
    rest = cut_lineage(named.select("id").distinct().join(some, "id", "left_anti"))
    more = held(named.join(rest, "id", "left_semi"), F.col("kmers"))
    return some.agg(F.count("*")).scalar() + more.agg(F.count("*")).scalar()


def weigh(sigs: DataFrame, lists: DataFrame, seqs: DataFrame) -> DataFrame:
    """Signatures with their log-odds weight, as signatures.weigh()."""
    return signatures.weighted(sigs, holders(sigs, lists), seqs)


def commonest(lists: DataFrame, column: str) -> DataFrame:
    """(kmer, function, `column`): the commonest value of a column among a function's windows of a k-mer (ties: the least)."""
    per = counts(lists, "function", column).groupBy("kmer", "function").agg(F.min(F.struct((-F.col("n")).alias("m"), column)).alias("x"))
    return per.select("kmer", "function", F.col(f"x.{column}").alias(column))


def _statistics(g: np.ndarray, v: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-number mean, median and population variance of the values v (not negative) of each of the groups, none of which is empty."""
    v = np.sort((g << 32) | v) & 0xFFFFFFFF
    n = np.bincount(g, minlength=groups)
    first = np.cumsum(n) - n
    least = v[first]
    off = v - np.repeat(least, n)
    wide = int(off.max()) ** 2 * int(n.max()) >= 2**63  # sums of squares stay exact
    one = np.add.reduceat(off, first)
    two = np.add.reduceat(off.astype(object) ** 2 if wide else off * off, first)
    var = np.array([(c * b - a * a) / (c * c) for a, b, c in zip(one.tolist(), two.tolist(), n.tolist(), strict=True)], np.float64)
    mean = (one + n * least) / n
    median = (v[first + (n - 1) // 2] + v[first + n // 2]) / 2
    return tuple(np.floor(x + 1e-6).astype(np.int64) for x in (mean, median, var))


def told(lists: DataFrame, share: float = 0.8, lengths: bool = True, ends: bool = True, together: int = TOGETHER) -> DataFrame:
    """Signatures (kmer, function, n_function, n_total) with what is told of them: mean, median and var (whole numbers) of the lengths of their
    function's sequences, if `lengths`, and avg_from_end, the upper median of the distance from the end over all rows, if `ends`.

    A task sends a k-mer's values as one list for each function; rows then come in order of k-mers and are told as they stream.
    """
    sent = [c for c, wanted in (("lens", lengths), ("offs", ends)) if wanted]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "kmers", together):
            order, first, n, kmer, row = _grouped(block, ["function"])
            bounds = pa.array(np.append(first, len(order)).astype(np.int32))
            pos, size = _lists(block, "pos")
            lens = np.repeat(block.column("len").to_numpy().astype(np.int32), size)
            values = {"lens": lens, "offs": lens - pos}
            columns = [pa.ListArray.from_arrays(bounds, pa.array(values[c][order])) for c in sent]
            out = pa.RecordBatch.from_arrays([pa.array(kmer), pa.concat_arrays(block.column("function").chunks).take(pa.array(row)), pa.array(n), *columns], names=["kmer", "function", "n", *sent])
            for i in range(0, len(out), 50_000):
                yield out.slice(i, 50_000)

    def tell(rows: pa.Table) -> pa.RecordBatch:
        """What is told of all k-mers of rows in their order."""
        kmer, n = rows.column("kmer").to_numpy(), rows.column("n").to_numpy()
        start = np.append(True, kmer[1:] != kmer[:-1])
        at = np.cumsum(start) - 1  # number of the k-mer of each row
        names, own = np.unique(rows.column("function").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
        pair, place = np.unique(at * len(names) + own, return_inverse=True)
        size = np.bincount(place, n).astype(np.int64)
        total = np.bincount(pair // len(names), size).astype(np.int64)
        order = np.lexsort((pair % len(names), -size, pair // len(names)))
        best = order[np.append(True, np.diff(pair[order] // len(names)) != 0)]  # of each k-mer
        kept = size[best] >= share * total
        number = np.cumsum(kept) - 1
        columns = {"kmer": kmer[start][kept], "function": names[pair[best] % len(names)][kept], "n_function": size[best][kept], "n_total": total[kept]}
        for c in sent:
            value, times = _lists(rows, c)
            mine = kept[at] & (place == best[at]) if c == "lens" else kept[at]
            v, g = value[np.repeat(mine, times)].astype(np.int64), np.repeat(number[at][mine], times[mine])
            if c == "lens":
                columns |= dict(zip(("mean", "median", "var"), _statistics(g, v, int(kept.sum())) if len(v) else [np.zeros(0, np.int64)] * 3, strict=True))
            else:
                n_all = np.bincount(g, minlength=int(kept.sum()))
                columns["avg_from_end"] = (np.sort((g << 32) | v) & 0xFFFFFFFF)[np.cumsum(n_all) - n_all + n_all // 2].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c == "function" else None) for c, v in columns.items()], names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last k-mer may go on
        for batch in batches:
            if not len(batch):
                continue
            kmer = batch.column("kmer").to_numpy()
            cut = int(np.searchsorted(kmer, kmer[-1]))
            if held and held[-1].column("kmer")[-1].as_py() != kmer[-1] or cut:
                yield tell(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks())
                held = []
            held.append(batch.slice(cut))
        if held:
            yield tell(pa.Table.from_batches(held).combine_chunks())

    lists_of = ", ".join(f"{c} array<int>" for c in sent)
    each = lists.select("kmers", "function", "len", "pos").where(F.size("kmers") > 0).mapInArrow(gather, f"kmer long, function string, n long, {lists_of}")
    kind = "kmer long, function string, n_function long, n_total long" + (", mean long, median long, var long" if lengths else "") + (", avg_from_end int" if ends else "")
    return each.repartition("kmer").sortWithinPartitions("kmer").mapInArrow(run, kind)


def call_hits(seqs: DataFrame, lookup: DataFrame, k: int = K) -> DataFrame:
    """signatures.call_hits() for a lookup table with k-mers as numbers."""
    at = window_lists(seqs.select("id", "seq"), "seq", k, calling=True).select("id", "pos", F.posexplode("kmers").alias("_i", "kmer"))
    rows = at.select("id", F.get("pos", F.col("_i")).alias("pos"), "kmer").join(lookup, "kmer")
    return rows.select("id", "pos", "function", "weight", F.col("mean").cast("double").alias("mean"), F.col("avg_from_end").alias("from_end"), "otu")
