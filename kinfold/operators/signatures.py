"""Signature k-mers: learning them from annotated sequences and looking sequences up in them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.sequences import K, call_kmers, valid_windows


@dataclass(frozen=True)
class Options:
    """Parameters of learning and calling."""

    share: float = 0.8
    min_hits: int = 5
    min_weighted: float = 0.0
    max_gap: int = 200
    order_constraint: bool = False


def occurrences(seqs: DataFrame, k: int = K, *more: str) -> DataFrame:
    """(id, function, kmer, pos, len, and `more` columns of the sequence) of every valid window of annotated sequences (id, function, seq)."""
    named = seqs.where(F.col("function").isNotNull() & (F.col("function") != ""))
    return valid_windows(named.select("id", "function", "seq", F.length("seq").alias("len"), *more), "seq", k).select("id", "function", "kmer", "pos", "len", *more)


def kmer_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kmer", "function").agg(F.count("*").alias("n"))


def indexed(seqs: DataFrame, assignments: DataFrame, index: DataFrame) -> DataFrame:
    """(id, idx, function, seq) of the sequences (id, seq) that have an assigned function (id, function) of the index (idx, function).

    Sequences without an assignment, with an empty one or with a function that isn't in the index are left out. The index is
    joined without a hint, so that Spark broadcasts it only where its size allows.
    """
    own = assignments.where(F.col("function").isNotNull() & (F.col("function") != "")).select("id", "function")
    return seqs.select("id", "seq").join(own, "id").join(index.select("idx", "function"), "function").select("id", "idx", "function", "seq")


def two_best(rows: DataFrame) -> DataFrame:
    """(kmer, n_total, function, n_function, second, n_second): the two functions with most occurrences of each k-mer (ties: the
    least by name); the second is null for k-mers of one function."""
    counts = kmer_counts(rows)
    of = Window.partitionBy("kmer")
    placed = counts.withColumn("_r", F.row_number().over(of.orderBy(F.col("n").desc(), "function"))).withColumn("n_total", F.sum("n").over(of)).where("_r <= 2")
    at = lambda i, c: F.max(F.when(F.col("_r") == i, F.col(c)))
    return placed.groupBy("kmer").agg(F.max("n_total").alias("n_total"), at(1, "function").alias("function"), at(1, "n").alias("n_function"), at(2, "function").alias("second"), at(2, "n").alias("n_second"))


def signatures(rows: DataFrame, share: float = 0.8) -> DataFrame:
    """(kmer, function, n_function, n_total) of the k-mers of which one function has at least `share` of the occurrences."""
    return shared(kmer_counts(rows), share)


def shared(counts: DataFrame, share: float = 0.8) -> DataFrame:
    """signatures() from the counts (kmer, function, n) of occurrences.

    Counts add up before the shuffle; the best function is the one with most occurrences, then the least by name.
    """
    per = counts.groupBy("kmer").agg(F.sum("n").alias("n_total"), F.min(F.struct((-F.col("n")).alias("m"), "function")).alias("b"))
    return per.select("kmer", F.col("b.function").alias("function"), (-F.col("b.m")).alias("n_function"), "n_total").where(F.col("n_function") >= share * F.col("n_total"))


def weigh(sigs: DataFrame, rows: DataFrame, seqs: DataFrame) -> DataFrame:
    """Signatures with their log-odds weight.

    Totals are scalar subqueries and one small table: kept k-mers, sequences that hold one (distinct), sequences of each function (all).
    """
    return weighted(sigs, rows.select("id", "kmer").join(sigs.select("kmer"), "kmer", "left_semi").agg(F.countDistinct("id")).scalar(), seqs)


def weighted(sigs: DataFrame, nsf: Column, seqs: DataFrame) -> DataFrame:
    """weigh() where the number of sequences that hold a signature is known."""
    ks = sigs.agg(F.count("*")).scalar()
    of = seqs.where(F.col("function").isNotNull() & (F.col("function") != "")).groupBy("function").agg(F.count("*").alias("nfj"))
    n, f = F.col("n_total"), F.col("n_function")
    weight = F.log((f + 1) / (n - f + 1)) + F.log((nsf - F.col("nfj") + ks) / (F.col("nfj") + ks))
    more = [c for c in sigs.columns if c not in ("kmer", "function", "n_function", "n_total")]
    return sigs.join(of, "function").select("kmer", "function", "n_function", "n_total", weight.alias("weight"), *more)


def offset_median(rows: DataFrame, sigs: DataFrame) -> DataFrame:
    """Upper median of the distance from the end over all rows of a kept k-mer."""
    off = rows.select("kmer", (F.col("len") - F.col("pos")).alias("off"))
    per = off.groupBy("kmer", "off").agg(F.count("*").alias("n")).join(sigs.select("kmer"), "kmer", "left_semi")  # equal offsets add up first
    run = Window.partitionBy("kmer").orderBy("off")
    placed = per.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(Window.partitionBy("kmer")))
    return placed.where((F.col("upto") > F.floor(F.col("all") / 2)) & (F.col("upto") - F.col("n") <= F.floor(F.col("all") / 2))).select("kmer", F.col("off").alias("avg_from_end"))


def length_stats(rows: DataFrame, sigs: DataFrame) -> DataFrame:
    """Whole-number mean, median and population variance of sequence length over a k-mer's best-function rows."""
    down = lambda c: F.floor(c + 1e-6).cast("long")
    each = rows.groupBy("kmer", "function").agg(F.avg("len").alias("a"), F.percentile("len", 0.5).alias("m"), F.var_pop("len").alias("v"))  # rows add up before they meet the signatures
    return each.join(sigs.select("kmer", "function"), ["kmer", "function"], "left_semi").select("kmer", down(F.col("a")).alias("mean"), down(F.col("m")).alias("median"), down(F.col("v")).alias("var"))


def kept_functions(evidence: DataFrame, good_functions: DataFrame, good_roles: DataFrame, roles: DataFrame, ignored: DataFrame, min_reps: int = 3) -> DataFrame:
    """Functions seen in at least min_reps genomes, or named good, or with a good role; less the ignored.

    evidence (function, genome); roles (function, role); the others have one column, value.
    """
    seen = evidence.groupBy("function").agg(F.countDistinct("genome").alias("n_genomes"))
    by_role = roles.join(good_roles.select(F.col("value").alias("role")), "role", "left_semi").select("function").distinct().withColumn("role_ok", F.lit(True))
    named = good_functions.select(F.col("value").alias("function")).distinct().withColumn("name_ok", F.lit(True))
    out = seen.join(named, "function", "left").join(by_role, "function", "left").where((F.col("n_genomes") >= min_reps) | F.coalesce("name_ok", F.lit(False)) | F.coalesce("role_ok", F.lit(False)))
    return out.join(ignored.select(F.col("value").alias("function")), "function", "left_anti").select("function", "n_genomes")


def function_index(functions: DataFrame) -> DataFrame:
    """Dense numbers from 0 by byte order of the distinct functions (a small dimension: one ordered window)."""
    return functions.select("function").distinct().withColumn("idx", (F.row_number().over(Window.orderBy("function")) - 1).cast("int"))


def hits(seqs: DataFrame, sigs: DataFrame, k: int = K) -> DataFrame:
    """(id, pos, len, kmer, function, weight) of each window that is a signature: an equi-join on the k-mer."""
    rows = valid_windows(seqs.select("id", "seq", F.length("seq").alias("len")), "seq", k).select("id", "pos", "len", "kmer")
    return rows.join(sigs, "kmer")


def table(rows: DataFrame, sigs: DataFrame, otus: DataFrame | None = None) -> DataFrame:
    """Signatures (kmer, function, weight, ...) as a lookup table: with the mean length, the distance from the end and the otu.

    otus (id, otu), unless rows have an otu already: a k-mer's otu is the commonest among its function's rows (ties: the least). All
    that is told of a k-mer adds up over the rows first and meets the signatures then.
    """
    own = rows if otus is None else rows.join(otus, "id")
    per = own.groupBy("kmer", "function", "otu").agg(F.count("*").alias("n")).groupBy("kmer", "function").agg(F.min(F.struct((-F.col("n")).alias("m"), "otu")).alias("x"))
    return sigs.join(length_stats(rows, sigs), "kmer").join(offset_median(rows, sigs), "kmer").join(per.select("kmer", "function", F.col("x.otu").alias("otu")), ["kmer", "function"], "left")


def call_windows(seqs: DataFrame, k: int = K, amino: bool = False) -> DataFrame:
    """(id, pos, kmer) of the windows of seqs (id, seq) that calling looks at; if `amino`, of those that amino acid letters make up alone."""
    seqs = seqs.select("id", "seq")
    return (valid_windows(seqs, "seq", k, calling=True) if amino else call_kmers(seqs, "seq", k)).select("id", "pos", "kmer")


def call_hits(seqs: DataFrame, lookup: DataFrame, k: int = K, amino: bool = False) -> DataFrame:
    """(id, pos, function, weight, mean, from_end, otu): hits of the windows that calling looks at.

    lookup is any table of k-mers with the columns of table(): what it comes from makes no difference. What was learnt from
    occurrences() has amino acid letters alone; `amino` says so, and no other window is then put together.
    """
    rows = call_windows(seqs, k, amino)
    return rows.join(lookup, "kmer").select("id", "pos", "function", "weight", F.col("mean").cast("double").alias("mean"), F.col("avg_from_end").alias("from_end"), "otu")


def options(**named: str | float) -> Options:
    """Options by name, from numbers or text; a name that isn't one is an error."""
    kinds = {f.name: type(f.default) for f in fields(Options)}
    if unknown := named.keys() - kinds.keys():
        raise ValueError(f"no such option: {', '.join(sorted(unknown))}")
    true = lambda v: str(v).lower() in ("1", "true", "yes")
    return Options(**{k: true(v) if kinds[k] is bool else kinds[k](v) for k, v in named.items()})
