"""A keyed store of signatures: a table bucketed and sorted by k-mer, written once and joined without moving it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.sequences import K

from .signatures import call_windows


class SignatureStore:
    """Signatures (kmer and any columns) under a name in the session's catalog.

    Buckets are by hash of the k-mer, so sequences that are looked up are dealt to the buckets and the store stays where it is,
    whatever is looked up and how often; a lookup of some k-mers reads their buckets alone. Any table written so is a store,
    whoever made it. The number of buckets should keep one within an executor's memory.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    @staticmethod
    def write(signatures: DataFrame, name: str, buckets: int = 64, path: str | None = None) -> SignatureStore:
        """Writes signatures, each k-mer once, as a store of that name (which must be new), in the warehouse or at a path.

        Rows are dealt to the buckets first, so that each bucket is one sorted file.
        """
        out = signatures.repartition(buckets, "kmer").write.bucketBy(buckets, "kmer").sortBy("kmer").format("parquet")
        (out.option("path", path) if path else out).saveAsTable(name)
        return SignatureStore(signatures.sparkSession, name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def fetch(self, kmers: list[str]) -> DataFrame:
        """The signatures among some k-mers: only their buckets are read."""
        return self.table().where(F.col("kmer").isin(kmers))

    def hits(self, seqs: DataFrame, k: int = K, amino: bool = False) -> DataFrame:
        """(id, pos, and the store's columns but the k-mer) of each window of seqs (id, seq) that calling looks at and the store has.

        `amino`: the store has k-mers of amino acid letters alone.
        """
        rows = call_windows(seqs, k, amino)
        return rows.join(self.table().hint("merge"), "kmer").drop("kmer")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
