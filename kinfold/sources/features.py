"""What a genome's files say: which genome a file is of, and lists of its features that later steps need."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.annotations import definition, genome_of, strip_comment


def file_genomes(records: DataFrame) -> DataFrame:
    """(file, genome) of FASTA records (id, def, file, offset): what the first record of a file says holds for all of it.

    That is the name in brackets that ends its definition line; without a definition line the genome that its id names; else
    the file's own name. The first record is the one of least offset, however many tasks read the file.
    """
    first = records.where(F.col("id").isNotNull()).groupBy("file").agg(F.min_by(F.struct("id", "def"), "offset").alias("r"))
    bare = F.trim(F.coalesce("r.def", F.lit(""))) == ""
    told = F.when(bare, genome_of(F.col("r.id"))).otherwise(definition(F.col("r.def"))["genome"])
    return first.select("file", F.coalesce(F.nullif(told, F.lit("")), F.element_at(F.split("file", "/"), -1)).alias("genome"))


def file_evidence(records: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """(id, function, genome) of FASTA records: evidence for kept_functions().

    The function is the assigned one (id, function), where there is one, else that of the definition line without its comment;
    records with neither are left out. The genome is the file's.
    """
    own = records.where(F.col("id").isNotNull()).select("id", "file", definition(F.col("def"))["function"].alias("_own"))
    if assignments is not None:
        own = own.join(assignments.select("id", F.col("function").alias("_given")), "id", "left")
    else:
        own = own.withColumn("_given", F.lit(None).cast("string"))
    named = own.withColumn("function", strip_comment(F.coalesce("_given", "_own"))).where(F.col("function") != "")
    return named.join(file_genomes(records), "file").select("id", "function", "genome")


@dataclass
class FeatureLists:
    """gene_names (genome, id, gene); truncated (genome, id, start, end, len); bad (genome, id, reason); sequences (genome, id, seq, len)."""

    gene_names: DataFrame
    truncated: DataFrame
    bad: DataFrame
    sequences: DataFrame


def feature_lists(features: DataFrame, proteins: DataFrame, contigs: DataFrame) -> FeatureLists:
    """The lists of genomes, from one reading of their features.

    features (genome, patric_id, feature_type, accession, gene, start, end, na_length): rows of type `source` give the lengths of
    contigs; contigs (genome, accession, len) those that they don't. A coding feature is truncated if an end is within ten
    letters of an end of its contig; one whose contig's length isn't known isn't. proteins (genome, id, seq): ids are cut after
    `fig|...`; a protein with ten X in a row or of a truncated feature is bad, one without such an id is left out of all lists.
    """
    names = features.where(F.col("gene").isNotNull() & (F.col("gene") != "")).select("genome", F.col("patric_id").alias("id"), "gene")
    own = features.where("feature_type = 'source'").select("genome", "accession", F.col("na_length").cast("long").alias("len"))
    known = own.withColumn("_r", F.lit(0)).unionByName(contigs.select("genome", "accession", F.col("len").cast("long").alias("len")).withColumn("_r", F.lit(1)))
    length = known.where("len > 0").groupBy("genome", "accession").agg(F.min_by("len", "_r").alias("len"))
    cds = features.where("feature_type = 'CDS'").select("genome", "accession", F.col("patric_id").alias("id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    lo, hi = F.least("start", "end"), F.greatest("start", "end")
    truncated = cds.join(length, ["genome", "accession"]).where((lo < 10) | (hi > F.col("len") - 10)).select("genome", "id", "start", "end", "len")
    fid = F.regexp_extract("id", r"^(fig\|[^|]+)", 1)
    cut = truncated.select("genome", "id").distinct().withColumn("_cut", F.lit(True))
    each = proteins.select("genome", fid.alias("id"), "seq").where("id <> ''").join(cut, ["genome", "id"], "left")
    reason = F.when(F.col("seq").contains("X" * 10), "bad sequence").when(F.col("_cut"), "truncated")
    told = each.withColumn("reason", reason)
    bad = told.where("reason is not null").select("genome", "id", "reason")
    return FeatureLists(names, truncated, bad, told.where("reason is null").select("genome", "id", "seq", F.length("seq").alias("len")))
