"""Genome and feature operators: truncation, quality, lineage, choice of genomes, containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truncated(start: Column, end: Column, length: Column, margin: int = 10) -> Column:
    """A feature that lies within `margin` of either end of its contig."""
    return (start < margin) | (end < margin) | (start > length - margin) | (end > length - margin)


def good_quality(quality: Column, kingdom: Column, flags: Column) -> Column:
    return (quality == "Good") | (kingdom == "Viruses") | (flags == F.array(F.lit("Genome too short")))


def first_ancestor(lineages: DataFrame, taxa: DataFrame, rank: str) -> DataFrame:
    """(id, taxon) of the first ancestor of a rank, in lineage order. lineages (id, lineage array); taxa (taxon, rank)."""
    at = lineages.select("id", F.posexplode("lineage").alias("pos", "taxon"))
    return at.join(taxa.where(F.col("rank") == rank).select("taxon"), "taxon").groupBy("id").agg(F.min_by("taxon", "pos").alias("taxon"))


def round_robin(genomes: DataFrame, most: int) -> DataFrame:
    """Up to `most` genomes (id, species, contigs): one of each species a round, those of fewest contigs first."""
    nth = F.row_number().over(Window.partitionBy("species").orderBy("contigs", "id"))
    return genomes.withColumn("round", nth).orderBy("round", "species").limit(most)


def best_hits(ani: DataFrame, least: float = 97.0) -> DataFrame:
    """The best other reference of each query (ties: the least), and whether it is above `least`."""
    other = ani.where(F.col("query") != F.col("ref"))
    best = other.groupBy("query").agg(F.max(F.struct("ani", (-F.col("ref")).alias("m"))).alias("x"))
    return best.select("query", (-F.col("x.m")).alias("ref"), F.col("x.ani").alias("ani"), (F.col("x.ani") > least).alias("good"))


def active(refs: DataFrame, everything: DataFrame, seen: DataFrame, good: DataFrame) -> DataFrame:
    """Ids that stay in use: references, ids that were not compared, and those without a good hit (all but the good ones)."""
    missing = seen.select("id").join(good.select("id"), "id", "left_anti")
    unseen = everything.select("id").join(seen.select("id"), "id", "left_anti").join(refs.select("id"), "id", "left_anti")
    return refs.select("id").union(unseen).union(missing).distinct()


def contained(features: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """(key, feature, region): features that lie inside a region of the same key.

    An equi-join on key and slice of `width`: a region stands in every slice it touches, a feature in that of its start alone.
    """
    f = features.withColumn("slice", F.floor(F.col("start") / width))
    r = regions.withColumn("slice", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    return f.join(r, ["key", "slice"]).where((F.col("start") >= F.col("lo")) & (F.col("end") <= F.col("hi"))).select("key", "feature", "region")


def overlapping(features: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """(key, feature, region): features that share at least one place with a region of the same key (ends included).

    Both sides stand in every slice they touch; a pair counts in the first slice that both have, so it comes once.
    """
    slices = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
    f = features.withColumn("slice", slices("start", "end"))
    r = regions.withColumn("slice", slices("lo", "hi"))
    both = f.join(r, ["key", "slice"]).where((F.col("start") <= F.col("hi")) & (F.col("end") >= F.col("lo")))
    return both.where(F.col("slice") == F.floor(F.greatest("start", "lo") / width)).drop("slice", "start", "end", "lo", "hi")


def split_by_reference(genomes: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(references, others) of genomes (id, ...) by a list of ids."""
    return genomes.join(refs.select("id"), "id", "left_semi"), genomes.join(refs.select("id"), "id", "left_anti")


def names(ids: DataFrame, *sources: DataFrame) -> DataFrame:
    """(id, name): the name in the first source (id, name) that has one, nulls and empty names aside."""
    out, found = ids.select("id"), []
    for i, s in enumerate(sources):
        one = s.groupBy("id").agg(F.min(F.nullif("name", F.lit(""))).alias(f"_{i}"))
        out, found = out.join(one, "id", "left"), [*found, f"_{i}"]
    return out.select("id", F.coalesce(*found).alias("name"))


def matched(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Features and predictions by (accession, strand, end): both, only annotated, or only predicted."""
    key = ["accession", "strand", "end"]
    both = features.select(*key, F.col("id").alias("feature")).join(predictions.select(*key, F.col("id").alias("prediction")), key, "full_outer")
    return both.withColumn("kind", F.when(F.col("prediction").isNull(), "annotated").when(F.col("feature").isNull(), "predicted").otherwise("both"))
