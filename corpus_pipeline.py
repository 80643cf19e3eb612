"""The corpus pipeline: quality filter, near-dedup, substring dedup, decontamination, BPE. Counted as part of kinfold.llm.

Every stage takes all that the one before kept, as a table of the columns of `documents`; its decisions take effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import bpe, decontam, minhash, quality, substring
from kinfold.llm.common import durable, scratch, table

#: Words of a window that counts as a repeated passage.
PASSAGE_WORDS = 50


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score 0.5 or more)."""
    weights, cut = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.withColumnsRenamed({"quality_score": "__own_score"}), weights, cut).where("quality_score >= 0.5").drop("quality_score")
    return scored.withColumnsRenamed({"__own_score": "quality_score"}).select(*(F.col(f"`{c}`") for c in docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start elsewhere; untouched texts stay as they are."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in rest), F.lit(0).alias("__one")).alias("__rest"))
    out = substring.remove_repeats(rows, PASSAGE_WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    new = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col("__rest")[c] for c in rest}
    if "n_chars" in rest:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return out.select(*(new[c].alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    import public_tokenizers

    return bpe.op1_bpe(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("substring_dedup", drop_passages),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over `documents`, each result written before it is read again, and deleted once the next is written.

    The last stage's rows are read from the table of the stage before, which goes with the driver."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark) as made:
            kept = made.keep(durable(stage(spark, docs, sf_dir)))
            made.drop(docs)
            docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier and the tokenizer can't be put in SQL: run() is tested against a brute-force version.
ORACLE_SQL: str | None = None
