"""Report operators: orders, pages, ranges, histograms, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered


def last_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the order given: an aggregate, so rows add up before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_x")).select(key, "_x.*")


def top_k(rows: DataFrame, k: int, by: list[str], *order) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def id_ranges(rows: DataFrame, by: str, number: str) -> DataFrame:
    """(by, first, last, n): runs of consecutive numbers."""
    one = rows.select(by, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(by).orderBy(number))
    return one.withColumn("_i", island).groupBy(by, "_i").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("n")).drop("_i")


def neighbours(rows: DataFrame, key: str, order: list) -> DataFrame:
    """Rows with the keys before and after them; at the ends they wrap around to the other end."""
    at = numbered(rows, "_i", *order)
    n = at.agg(F.count("*")).scalar()
    prev = at.select((F.col("_i") % n + 1).alias("_i"), F.col(key).alias("prev"))
    after = at.select(((F.col("_i") + n - 2) % n + 1).alias("_i"), F.col(key).alias("next"))
    return at.join(prev, "_i").join(after, "_i").drop("_i")


def histogram(rows: DataFrame, *by: str) -> DataFrame:
    """(size, n): how many groups have how many rows."""
    return rows.groupBy(*by).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n"))


def lookup(wanted: DataFrame, facts: DataFrame, key: str, order: str) -> DataFrame:
    """Facts of the wanted keys in their own order; keys without any stay, with blanks."""
    return wanted.join(facts, key, "left").orderBy(order)


def validation(calls: DataFrame, truth: DataFrame) -> DataFrame:
    """(correct, incorrect, missing) of calls against the truth, both (id, function)."""
    both = truth.withColumnRenamed("function", "want").join(calls, "id", "left")
    return both.agg(F.count_if(F.col("function") == F.col("want")).alias("correct"), F.count_if(F.col("function") != F.col("want")).alias("incorrect"), F.count_if(F.col("function").isNull()).alias("missing"))


def spread(rows: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """(by, n, mean, var_pop, var_samp, r2, deviation): running-moment statistics of y, its fit on x, and its mean deviation."""
    stats = rows.groupBy(by).agg(F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var_pop"), F.var_samp(y).alias("var_samp"), F.regr_r2(y, x).alias("r2"))
    off = rows.join(stats.select(by, "mean"), by).groupBy(by).agg(F.avg(F.abs(F.col(y) - F.col("mean"))).alias("deviation"))
    return stats.join(off, by)


def job_stats(bins: DataFrame, accounting: DataFrame) -> DataFrame:
    """Bins (bin, elements array of (size, files)) joined with accounting (bin, elapsed): counts, largest and minutes of each."""
    from kinfold.functions.annotations import minutes

    each = bins.select("bin", F.explode_outer("elements").alias("e")).groupBy("bin").agg(F.count("e").alias("elements"), F.max("e.size").alias("largest"), F.max("e.files").alias("files"))
    return each.join(accounting.select("bin", minutes(F.col("elapsed")).alias("minutes")), "bin", "left")


def named_calls(calls: DataFrame, names: DataFrame, recall: DataFrame, least: float = 100.0) -> DataFrame:
    """Calls of core families with a score above `least`, their names gathered, and how many recall rows have the function."""
    strong = calls.where(F.col("function").contains("core_cid") & (F.col("score") > least))
    per = strong.join(names, "id", "left").groupBy("function").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("name")).alias("names"))
    hits = recall.groupBy("function").agg(F.count("*").alias("recalled"))
    return per.join(hits, "function", "left").withColumn("recalled", F.coalesce("recalled", F.lit(0)))


def split_singletons(a: DataFrame, b: DataFrame) -> DataFrame:
    """Members that are alone in clustering a (cluster, member) and in a cluster of more than two in b."""
    alone = a.groupBy("cluster").agg(F.count("*").alias("n"), F.min("member").alias("member")).where("n = 1").select("member")
    large = b.groupBy("cluster").agg(F.count("*").alias("n")).where("n > 2").select("cluster")
    return b.join(large, "cluster").join(alone, "member", "left_semi").select("cluster", "member")
