"""Folds along an order over whole documents: no SQL, each row's place depends on all before it; tested against plain Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import folds

from .registry import Tables, query


def _sized(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("item"), F.length("text").cast("long").alias("size"))


@query()
def document_pages(t: Tables) -> DataFrame:
    """Every document on a page of 10,000 characters at most, longest first; null texts count as 0."""
    return folds.paginate(_sized(t), 10_000)


@query()
def document_bins(t: Tables) -> DataFrame:
    """Every document in the least loaded of 64 bins, longest first; null texts count as 0."""
    return folds.lpt_bins(_sized(t), 64)
