"""Selections and work lists: which members, families, genomes and sequences a later step gets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.sequences import ascii_upper

from .numbering import numbered


def members_of(members: DataFrame, fams: DataFrame, deleted: DataFrame) -> DataFrame:
    """Members (fam, id, ...) of the listed families (fam), less the deleted (id)."""
    return members.join(fams.select("fam"), "fam", "left_semi").join(deleted.select("id"), "id", "left_anti")


def of_genus(release: DataFrame, genus: str) -> DataFrame:
    """A release's rows of one genus; on a table partitioned by genus a pruned read."""
    return release.where(F.col("genus") == genus)


def alignment_work(seqs: DataFrame) -> DataFrame:
    """(fam, n, n_distinct, protein, dna) of (fam, id, seq): a protein family is aligned if it has two sequences, a DNA family if two that differ."""
    md5 = F.md5(ascii_upper(F.col("seq")).cast("binary"))
    n = seqs.groupBy("fam").agg(F.count("seq").alias("n"), F.countDistinct(md5).alias("n_distinct"))
    return n.withColumn("protein", F.col("n") > 1).withColumn("dna", F.col("n_distinct") > 1)


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """(fam, md5, id, n): of a family's equal sequences (but for case) the one of the least id stays."""
    return seqs.where("seq is not null").groupBy("fam", F.md5(ascii_upper(F.col("seq")).cast("binary")).alias("md5")).agg(F.min("id").alias("id"), F.count("*").alias("n"))


def core_sets(members: DataFrame, least_size: int = 3, least_len: int = 150) -> DataFrame:
    """(fam, size, idx): sets of least_size members or more, every one of least_len or more, numbered by size down and fam. Sets left out use up no number."""
    size = members.groupBy("fam").agg(F.count("*").alias("size"), F.min("len").alias("_least"))
    return numbered(size.where((F.col("size") >= least_size) & (F.col("_least") >= least_len)).drop("_least"), "idx", F.col("size").desc(), F.col("fam"))


def with_taxon(rows: DataFrame, genera: DataFrame) -> DataFrame:
    """rows (genus, ...) with `Genus-taxon` from genera (genus, taxon); a genus that isn't listed keeps its own name."""
    return rows.join(genera.select("genus", "taxon"), "genus", "left").withColumn("genus_taxon", F.coalesce(F.concat_ws("-", "genus", F.nullif(F.col("taxon").cast("string"), F.lit(""))), F.col("genus"))).drop("taxon")


def first_of_each(refs: DataFrame, seqs: DataFrame, order: str = "ord") -> DataFrame:
    """Sequences (id, seq, `order`) of the listed ids, of several under one id the first."""
    return seqs.join(refs.select("id"), "id", "left_semi").groupBy("id").agg(F.min_by("seq", order).alias("seq"))


def families_holding(members: DataFrame, ids: DataFrame, defs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all members of the families that hold a listed id, mapping of the listed ids: id, fam, function)."""
    mine = members.join(ids.select("id").distinct(), "id", "left_semi")
    return members.join(mine.select("fam").distinct(), "fam", "left_semi"), mine.select("id", "fam").join(defs.select("fam", "function"), "fam", "left")


def unclassified(everything: DataFrame, classified: DataFrame, seqs: DataFrame) -> DataFrame:
    """(genome, id, seq) of ids (genome, id) in no class, each once. On sequences partitioned by genome only the genomes asked for are read."""
    left = everything.select("genome", "id").distinct().join(classified.select("id"), "id", "left_anti")
    return seqs.join(left, ["genome", "id"], "left_semi").groupBy("genome", "id").agg(F.min("seq").alias("seq"))


def function_totals(seqs: DataFrame) -> DataFrame:
    """(function, n, residues): how many sequences a function has, and their length together."""
    return seqs.groupBy("function").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("seq").cast("long")), F.lit(0)).alias("residues"))


def listed(*lists: DataFrame) -> DataFrame:
    """The distinct values of several lists."""
    out = lists[0].select("value")
    for one in lists[1:]:
        out = out.union(one.select("value"))
    return out.where("value is not null and value <> ''").distinct()
