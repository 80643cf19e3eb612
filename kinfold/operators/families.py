"""Families: sets of members numbered, described and joined across sources, genera and functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.annotations import family_id, is_hypothetical

from .graph import components, cut_lineage
from .numbering import numbered


def consensus(members: DataFrame, *by: str) -> DataFrame:
    """One name per cluster: that of its members if they have exactly one between them (nulls and empty names aside), else empty."""
    name = F.nullif(F.col("gene"), F.lit(""))
    return members.groupBy(*by).agg(F.count("*").alias("n"), F.when(F.countDistinct(name) == 1, F.min(name)).otherwise(F.lit("")).alias("gene"))


def number(sets: DataFrame) -> DataFrame:
    """Sets (function, source, idx, size) with a family number from 1, by size down, then function, source and idx."""
    return numbered(sets, "fam", F.col("size").desc(), F.col("function"), F.col("source"), F.col("idx"))


def describe(members: DataFrame) -> DataFrame:
    """(fam, n, mean, sd): lengths of a family's members; sd is that of a sample, null for one member."""
    return members.groupBy("fam").agg(F.count("*").alias("n"), F.avg("len").alias("mean"), F.stddev_samp("len").alias("sd"))


def z_scores(members: DataFrame) -> DataFrame:
    """Members with the z-score of their length in the family: three decimals, an undefined sd counts as 0."""
    defs = describe(members)
    return members.join(defs, "fam").withColumn("z", F.round((F.col("len") - F.col("mean")) / (F.coalesce("sd", F.lit(0.0)) + 1e-9), 3)).drop("n", "mean", "sd")


def within(members: DataFrame, sds: float = 2.0) -> DataFrame:
    """Members whose length is within so many standard deviations of the family's mean (ends included; one member always is)."""
    d = describe(members)
    ok = F.col("sd").isNull() | F.col("len").between(F.col("mean") - sds * F.col("sd"), F.col("mean") + sds * F.col("sd"))
    return members.join(d, "fam").where(ok).drop("n", "mean", "sd")


def singletons(refs: DataFrame, clustered: DataFrame, called: DataFrame, last: DataFrame) -> DataFrame:
    """References in no cluster, as families of one: (function, sub, id). Without a call the function is hypothetical; numbers go on
    from `last` (function, sub) in order of id. Rows are numbered over all functions by ranges, and each function's start at its
    least number, so that a function which most of them share is no task of its own."""
    left = refs.select("id").distinct().join(clustered.select("id"), "id", "left_anti").join(called, "id", "left").select("id", F.coalesce("function", F.lit("hypothetical protein")).alias("function"))
    at = cut_lineage(numbered(left, "_nth", F.col("function"), F.col("id")))
    start = at.groupBy("function").agg(F.min("_nth").alias("_start")).join(last.groupBy("function").agg(F.max("sub").alias("top")), "function", "left")
    return at.join(start, "function").select("function", (F.coalesce("top", F.lit(0)) + F.col("_nth") - F.col("_start") + 1).cast("long").alias("sub"), "id")


def united(**sources: DataFrame) -> DataFrame:
    """Cluster sets of several sources as one, tagged."""
    out = None
    for tag, df in sources.items():
        one = df.withColumn("source", F.lit(tag))
        out = one if out is None else out.unionByName(one)
    return out


def split_definitions(members: DataFrame) -> DataFrame:
    """(fam, n_members, n_genera, genera, single): genera sorted and comma-joined; families of one are told apart."""
    return members.groupBy("fam").agg(F.count("*").alias("n_members"), F.countDistinct("genus").alias("n_genera"), F.array_join(F.sort_array(F.collect_set("genus")), ",").alias("genera"), (F.count("*") == 1).alias("single"))


def summary(members: DataFrame, *by: str) -> DataFrame:
    """Distinct genera, genomes, local families and members of each cluster."""
    n = lambda c: F.countDistinct(c)
    return members.groupBy(*by).agg(n("genus").alias("n_genera"), n("genome").alias("n_genomes"), n("lfam").alias("n_lfams"), n("id").alias("n_members"))


def max_ids(members: DataFrame) -> DataFrame:
    """(scope, max_id): the largest local number of each genus, and the largest of the global ones as GLOBAL."""
    return members.groupBy(F.col("genus").alias("scope")).agg(F.max("lfam").alias("max_id")).unionByName(members.agg(F.max("gfam").alias("max_id")).select(F.lit("GLOBAL").alias("scope"), "max_id"))


def merge_global(clusters: DataFrame, locals_: DataFrame, prefix: str = "PGF_") -> DataFrame:
    """(gfam, function, genus, lfam, n_lfams, n_genera) of local families (function, genus, lfam) joined by clusters.

    clusters (function, cluster, genus, lfam): each of two or more members links its local families in a path, within a function;
    what a component links is one global family, a local family without links is one of its own. Numbers go by function as
    text and the least node; families of joined ones come first.
    """
    order = Window.partitionBy("function", "cluster").orderBy("genus", "lfam")
    nodes = cut_lineage(locals_.where((F.col("function") != "") & F.col("function").isNotNull()).select("function", "genus", "lfam").distinct().withColumn("node", F.concat_ws("\x01", "function", "genus", F.lpad(F.col("lfam").cast("string"), 20, "0"))))
    linked = clusters.join(nodes, ["function", "genus", "lfam"]).select("function", "cluster", "genus", "lfam", "node").distinct()
    edges = linked.withColumn("a", F.lag("node").over(order)).where("a is not null").select("a", F.col("node").alias("b"))
    comp = components(edges)
    placed = nodes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stats = placed.groupBy("component", "function").agg(F.count("*").alias("n_lfams"), F.countDistinct("genus").alias("n_genera"))
    order = (F.col("n_lfams") == 1, F.col("function"), F.col("component"))
    named = numbered(stats, "gfam", *order, first=0).withColumn("gfam", family_id(F.col("gfam"), prefix))
    return placed.join(named.drop("function"), "component").select("gfam", "function", "genus", "lfam", "n_lfams", "n_genera")


def relabelled(defs: DataFrame, members: DataFrame, deleted: DataFrame, least: int = 20, most_z: float = 1.0, prefix: str = "hyp-") -> DataFrame:
    """(id, fam, name): new names for the hypothetical families of `least` members or more.

    defs (fam, function, size), members (fam, id, z), deleted (id). Members within `most_z` of the mean that aren't deleted take
    the name, if more than `least` of them are left; names are numbered from 0 in order of fam.
    """
    of = defs.where(is_hypothetical(F.col("function")) & (F.col("size") >= least)).select("fam")
    kept = members.where(F.abs("z") <= most_z).join(of, "fam").join(deleted.select("id"), "id", "left_anti").select("fam", "id")
    enough = kept.groupBy("fam").agg(F.count("*").alias("n")).where(F.col("n") > least).select("fam")
    names = numbered(enough, "_i", F.col("fam"), first=0).select("fam", family_id(F.col("_i"), prefix, 6).alias("name"))
    return kept.join(names, "fam").select("id", "fam", "name")
