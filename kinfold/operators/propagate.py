"""Carrying family names from one release to the next through shared members."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut_lineage


def _singles(members: DataFrame) -> DataFrame:
    """(fam) of families with one row, written: where they are few, they are broadcast and members needn't be dealt by family."""
    return cut_lineage(members.groupBy("fam").agg(F.count("*").alias("_n")).where("_n = 1 and fam is not null").select("fam"))


def _tallied(old: DataFrame, new: DataFrame) -> DataFrame:
    """(new_fam, old_fam, existed, n): members of new families by their old family (null: none of two rows or more) and by whether the old
    release had them. Written once: all phases follow from it, and it grows with the pairs of families.

    A member's family is its first (the least) in each release, of families with two rows or more. Both releases meet in one
    aggregate by md5; a null md5 meets nothing.
    """
    kinds = old.schema["fam"].dataType, new.schema["fam"].dataType
    alone = _singles(old).select(F.col("fam").alias("_s"))
    was = old.select("md5", "fam").join(alone, F.col("fam") == F.col("_s"), "left").select("md5", F.when(F.col("_s").isNull(), F.col("fam")).alias("old_fam"), F.lit(None).cast(kinds[1]).alias("new_fam"), F.lit(1).alias("existed"))
    now = new.select("md5", "fam").where("fam is not null").join(_singles(new), "fam", "left_anti").select("md5", F.lit(None).cast(kinds[0]).alias("old_fam"), F.col("fam").alias("new_fam"), F.lit(0).alias("existed"))
    each = was.where("md5 is not null").unionByName(now).groupBy("md5").agg(F.min("old_fam").alias("old_fam"), F.min("new_fam").alias("new_fam"), F.max("existed").alias("existed"))
    return cut_lineage(each.where("new_fam is not null").groupBy("new_fam", "old_fam", "existed").agg(F.count("*").alias("n")))


def _pairs(tally: DataFrame) -> DataFrame:
    return tally.where("old_fam is not null").select("old_fam", "new_fam", "n")


def overlap(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_fam, new_fam, n): members that both releases have, by their family in each."""
    return _pairs(_tallied(old, new))


def _phase1(tally: DataFrame) -> DataFrame:
    owners = tally.where("existed = 1").groupBy("new_fam").agg(F.count("old_fam").alias("k"), F.count_if(F.col("old_fam").isNull()).alias("lost"))
    pairs = _pairs(tally).join(owners, "new_fam")
    w = Window.partitionBy("old_fam")
    clean = pairs.withColumn("bad", F.max(((F.col("k") > 1) | (F.col("lost") > 0)).cast("int")).over(w)).where("bad = 0")
    parts = F.count("*").over(w)
    rank = F.row_number().over(w.orderBy(F.col("n").desc(), "new_fam"))
    return clean.withColumn("kind", F.when(parts == 1, "NOW").otherwise("SPLIT")).withColumn("rank", rank).select("old_fam", "new_fam", "n", "kind", "rank")


def phase1(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_fam, new_fam, n, kind, rank): old families whose new families hold no member of another old one (or of none).

    One new family: NOW. Several: SPLIT, ranked by members (most first, then the least id); the first keeps the name.
    """
    return _phase1(_tallied(old, new))


def _phase2(tally: DataFrame) -> DataFrame:
    done = _phase1(tally).select("new_fam").distinct()
    known = tally.join(done, "new_fam", "left_anti").groupBy("new_fam").agg(F.max("existed").alias("any"))
    fresh = known.where("any = 0").select("new_fam", F.lit("NEW").alias("kind"), F.lit(None).cast(tally.schema["old_fam"].dataType).alias("old_fam"), F.lit(0).cast("long").alias("n_old"))
    to = _pairs(tally)
    spread = to.groupBy("old_fam").agg(F.count("*").alias("w"))
    per = to.join(done, "new_fam", "left_anti").join(spread, "old_fam")
    joined = per.groupBy("new_fam").agg(F.max("w").alias("w"), F.count("*").alias("n_old"), F.min(F.struct((-F.col("n")).alias("m"), "old_fam")).alias("x")).where("w = 1")
    return fresh.unionByName(joined.select("new_fam", F.lit("JOIN").alias("kind"), "x.old_fam", "n_old"))


def phase2(old: DataFrame, new: DataFrame) -> DataFrame:
    """(new_fam, kind, old_fam, n_old): new families that phase 1 leaves: NEW if no member existed, JOIN if all that their old
    families became is this one (the name is that of most members, ties the least)."""
    return _phase2(_tallied(old, new))


def phase3(old: DataFrame, new: DataFrame, share: float = 0.75) -> DataFrame:
    """(new_fam, old_fam, weight): unnamed new families with more than `share` of the surviving members of an unused old one.

    Each old family has one candidate (most members, ties the least id); of several old families for one new the one with
    the larger share, then the least, has it.
    """
    tally = _tallied(old, new)
    one, two = _phase1(tally), _phase2(tally)
    named = one.select("new_fam").union(two.select("new_fam")).distinct()
    used = one.select("old_fam").union(two.where("old_fam is not null").select("old_fam")).distinct()
    to = _pairs(tally)
    total = to.groupBy("old_fam").agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("m"), "new_fam")).alias("x"))
    best = total.select("old_fam", F.col("x.new_fam").alias("new_fam"), (-F.col("x.m") / F.col("all")).alias("weight")).where(F.col("weight") > share)
    free = best.join(used, "old_fam", "left_anti").join(named, "new_fam", "left_anti")
    return free.withColumn("r", F.row_number().over(Window.partitionBy("new_fam").orderBy(F.col("weight").desc(), "old_fam"))).where("r = 1").select("new_fam", "old_fam", "weight")


def rename(families: DataFrame, local_map: DataFrame, global_map: DataFrame) -> DataFrame:
    """Rows (gfam, genus, lfam, ...) with new_gfam and new_lfam; without a global name a row is unmapped, without a local one it keeps its own."""
    out = families.join(global_map, "gfam", "left").join(local_map, ["genus", "lfam"], "left")
    return out.withColumn("mapped", F.col("new_gfam").isNotNull()).withColumn("new_lfam", F.coalesce("new_lfam", "lfam"))


def number_new(names: DataFrame, max_ids: DataFrame) -> DataFrame:
    """(scope, k) names NEW_k as numbers: the scope's next number (its largest plus 1) plus k."""
    return names.join(max_ids, "scope").withColumn("new_id", F.col("max_id") + 1 + F.col("k"))
