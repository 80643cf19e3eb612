"""The queries of the training-data operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, divergence, language, license, lines, minhash, quality, sharding, spelling, substring, topk, toxicity
from .common import table


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": lambda spark, d: bpe.op1_bpe(table(spark, d, "documents"), _tokenizer()),
    "op2_toxicity": lambda spark, d: toxicity.op2_toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op3_language": lambda spark, d: language.op3_language(table(spark, d, "documents")),
    "op4_decontaminate": lambda spark, d: decontam.op4_decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_hilbert": lambda spark, d: sharding.op5_hilbert(table(spark, d, "documents")),
    "op6_minhash": lambda spark, d: minhash.op6_minhash(table(spark, d, "documents")),
    "op7_substring": lambda spark, d: substring.op7_substring(table(spark, d, "documents")),
    "op8_topk": lambda spark, d: topk.op8_topk(table(spark, d, "embeddings")),
    "op9_license": lambda spark, d: license.op9_license(table(spark, d, "documents")),
    "op10_quality": lambda spark, d: quality.op10_quality(table(spark, d, "documents"), table(spark, d, "labels")),
    "op11_divergence": lambda spark, d: divergence.op11_divergence(table(spark, d, "documents")),
    "op12_spelling": lambda spark, d: spelling.op12_spelling(table(spark, d, "documents")),
    "op13_lines": lambda spark, d: lines.op13_lines(table(spark, d, "documents")),
}
ORACLES: dict[str, str] = {"op4_decontaminate": decontam.OP4_SQL, "op8_topk": topk.OP8_SQL, "op9_license": license.OP9_SQL, "op11_divergence": divergence.OP11_SQL, "op13_lines": lines.OP13_SQL}
