"""Sequence files: FASTA and FASTQ read and written as DataFrames of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fasta_record(id_: str, definition: str, seq: str, width: int = 60) -> Column:
    """A record without its leading >: the definition line and the sequence in lines of `width` letters."""
    lines = F.regexp_replace(F.col(seq), f"(.{{{width}}})(?=.)", "$1\n")
    return F.concat(F.col(id_), F.coalesce(F.col(definition), F.lit("")), F.lit("\n"), lines)


def parse_fasta(records: DataFrame) -> DataFrame:
    """(id, def, seq) of raw records (value: a record with or without its leading >).

    def keeps its leading blank; of the data only letters and * count, a * that opens a line not; records without an id are
    left out. Carriage returns are dropped.
    """
    raw = F.regexp_replace(F.translate("value", "\r", ""), r"^>?", "")
    at = records.select(raw.alias("v"))
    head = F.regexp_extract("v", r"^([^\n]*)", 1)
    data = F.regexp_replace(F.col("v"), r"^[^\n]*\n?", "")
    seq = F.regexp_replace(F.regexp_replace(data, r"(?m)^\*+", ""), r"[^A-Za-z*]", "")
    return at.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.regexp_replace(head, r"^\S*", "").alias("def"), seq.alias("seq")).where("id <> ''")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTA files, split on the record mark, so that files are read in parts."""
    return parse_fasta(spark.read.text(path, lineSep="\n>"))


def write_fasta(df: DataFrame, path: str, by: str | None = None) -> None:
    """FASTA files of (id, def, seq); with `by`, a folder for each value, rows of one value kept together."""
    line = F.concat(F.lit(">"), fasta_record("id", "def", "seq")).alias("value")
    if by:
        df.select(by, line).repartition(by).sortWithinPartitions(by).write.partitionBy(by).text(path)
    else:
        df.select(line).write.text(path)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(id, def, seq) of FASTQ files with four lines a record; qualities are dropped.

    Files are split on a line that opens with @. Where that is a quality line, the record before it has its three other lines
    and stays, and what follows has no third line and goes.
    """
    parts = F.split(F.regexp_replace(F.translate("value", "\r", ""), "^@", ""), "\n")
    ok = spark.read.text(path, lineSep="\n@").select(parts.alias("p")).where((F.size("p") >= 3) & F.get("p", F.lit(2)).startswith("+"))
    return ok.select(F.regexp_extract(F.col("p")[0], r"^(\S*)", 1).alias("id"), F.regexp_replace(F.col("p")[0], r"^\S*", "").alias("def"), F.col("p")[1].alias("seq")).where("id <> ''")
