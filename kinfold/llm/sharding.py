"""Sharding along a Hilbert curve: metadata are quantised, rows sorted by their place on the curve and cut into equal runs.

Rows near each other in several dimensions land in the same files, so least and greatest values of each dimension let a
reader skip files whichever of the dimensions it filters on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, scratch

DIMENSIONS, BITS = 3, 4


def hilbert_index(coords: list[int], bits: int) -> int:
    """Place of a cell on the Hilbert curve, by turning the axes from the highest bit to the lowest."""
    x, n = list(coords), len(coords)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ t) >> b & 1)
    return out


def curve(dimensions: int = DIMENSIONS, bits: int = BITS) -> list[int]:
    """Curve index of every cell, by cell number (first dimension highest)."""
    mask = (1 << bits) - 1
    return [hilbert_index([c >> bits * (dimensions - 1 - i) & mask for i in range(dimensions)], bits) for c in range(1 << dimensions * bits)]


def _ordered(c: Column) -> Column:
    """The first seven bytes of a text as a number, in the order of the texts."""
    return F.conv(F.rpad(F.hex(F.substring(F.coalesce(c.cast("string"), F.lit("")).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def _cell(rows: DataFrame, dimensions: list[str]) -> Column:
    """Cell number of a row: each dimension (a number) cut at 2**BITS - 1 quantiles of its own, so that cells are ranges and evenly filled.

    The quantiles, some dozens of numbers, are all that reaches the driver.
    """
    side = 1 << BITS
    cuts = rows.agg(*(F.percentile_approx(d, [i / side for i in range(1, side)], 10_000).alias(d) for d in dimensions)).first()
    cell = F.lit(0).cast("long")
    for d in dimensions:
        cell = cell * side + sum((F.when(F.col(d) > c, 1).otherwise(0) for c in cuts[d] or []), F.lit(0))
    return cell


def placed(docs: DataFrame, shards: int, by: str, whole: bool) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, curve of each row, with the row itself (as a struct) if `whole`."""
    spark = docs.sparkSession
    with scratch(spark) as made:
        size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
        named = lambda c: _ordered(F.col(c)) if c in docs.columns else F.lit(0).cast("long")
        facts = [F.col("doc_id"), size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), named("lang").alias("_lang"), named("source").alias("_source")]
        rows = docs.select(*facts, *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []))
        index = F.element_at(F.array(*map(F.lit, curve())), (_cell(rows, ["_lang", "_source", "size"]) + 1).cast("int"))
        keep = ["doc_id", "size", "text_crc32", *(["row"] if whole else [])]
        keyed = durable(rows.select(*keep, index.cast("int").alias("curve")))
        order = ["curve", "text_crc32", "doc_id"]
        ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
        # The places must not change any more: the sorted rows are written before they are counted.
        written = made.keep(durable(ranged.select("*", F.shiftright("_id", 33).cast("int").alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))))
    weight = F.lit(1) if by == "rows" else F.col("size")
    counts = written.groupBy("_part").agg(F.count("*").alias("n"), F.sum(weight).alias("w")).orderBy("_part").collect()
    total, weights, starts, before, seen = sum(r["n"] for r in counts), sum(r["w"] for r in counts), {}, 0, 0
    for r in counts:
        starts[r["_part"]] = (seen, before)
        seen, before = seen + r["n"], before + r["w"]
    if not counts:
        return written.select(*keep, F.lit(by).alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), "curve")
    offsets = F.broadcast(spark.createDataFrame([(p, *s) for p, s in starts.items()], "_part int, _seen long, _before long"))
    ranked = written.join(offsets, "_part").withColumn("_rank", F.col("_seen") + F.col("_at"))
    if by == "rows":
        exact = ranked.withColumn("shard", F.expr(f"(_rank * {shards}) div {total}").cast("int"))
        return exact.select(*keep, F.lit(by).alias("law"), "shard", F.expr(f"_rank - (shard * bigint({total}) + {shards - 1}) div {shards}").alias("slot"), "curve")
    from pyspark.sql import Window

    running = F.sum("size").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    mid = F.col("_before") + F.coalesce(running, F.lit(0)) + F.expr("size div 2")
    cutted = durable(ranked.withColumn("shard", F.least(F.lit(shards - 1), (mid * shards / weights).cast("int"))))
    firsts = F.broadcast(cutted.groupBy("shard").agg(F.min("_rank").alias("_first")))
    return cutted.join(firsts, "shard").select(*keep, F.lit(by).alias("law"), "shard", (F.col("_rank") - F.col("_first")).alias("slot"), "curve")


def shard(docs: DataFrame, shards: int = 40, by: str = "rows") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, curve: each row's place.

    size: UTF-8 bytes of the text (null: none) plus 16. Rows are sorted by (curve, text_crc32, doc_id), so equal texts of the
    same metadata stand next to each other, and cut into runs: law `rows` makes counts at most one apart, law `bytes` cuts at
    equal sums of size. The dimensions are language, source and size, each cut into ranges at its quantiles, so that least and
    greatest values of a file prune ranges as well as single values. Nulls in lang or source count as empty (so do the columns
    if they aren't there), a null doc_id sorts first, rows that repeat are neighbours in any order. An empty table gives no
    row. Quantiles and the count of each sorted partition are all that reaches the driver.
    """
    return placed(docs, shards, by, whole=False)


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """The rows of docs (columns of any name but `shard`) as one folder of files per shard, each file sorted along the curve.

    Every row is carried through the sort with its place, so rows that repeat, or have no doc_id, are dealt like any others:
    counts are at most one apart. A shard goes to as many tasks and files as the session's range partitions cut it into. An
    empty table writes a folder without shards.
    """
    rows = placed(docs, shards, "rows", whole=True).select("row", "shard", "slot")
    out = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    own = [c for c in docs.columns if c != "shard"]
    out.select(*(F.col("row")[c].alias(c) for c in own), "shard").write.partitionBy("shard").mode("overwrite").parquet(path)


def op5_hilbert(docs: DataFrame) -> DataFrame:
    """shard() into 40 shards by law `rows`, of every document; edges as there."""
    return shard(docs, 40, "rows").select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("curve").alias("curve_index"))

