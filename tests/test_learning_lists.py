"""Learning from lists of windows, and the fold by stretches, against the rows of single windows and hits."""

import random

import duckdb
from pyspark.sql import functions as F

from kinfold.functions import sequences as S
from kinfold.operators import calling
from kinfold.operators import learning as L
from kinfold.operators import signatures as G
from kinfold.operators.graph import cut_lineage
from kinfold.plans import registry


def sequences(spark, n=60):
    r = random.Random(4)
    words = ["".join(r.choices(S.AMINO, k=9)) for _ in range(12)]
    rows = []
    for i in range(n):
        at = r.randrange(6)  # mostly words of the function
        text = " ".join(r.choices(["ö", "X", *words, *words[2 * at : 2 * at + 2] * 30], k=r.randint(0, 30)))
        rows.append((i % 50, ["f", "g", "h", "é", "", None][at], text, r.choice(["a", "b", None])))
    return spark.createDataFrame([*rows, (99, "f", None, "a")], "id long, function string, seq string, otu string").repartition(3)


def pick(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def spelt(df):
    return df.withColumn("kmer", S.letters(F.col("kmer")))


def test_lists_hold_the_windows(spark):
    df = sequences(spark)
    for k, calling_, most in ((8, False, 100_000), (8, True, 3), (3, False, 1)):
        lists = S.window_lists(df, "seq", k, calling_, most)
        each = lists.select("id", "function", F.explode(F.arrays_zip("pos", "kmers")).alias("w")).select("id", "function", "w.pos", S.letters(F.col("w.kmers")).alias("kmer"))
        assert pick(each, "id", "function", "pos", "kmer") == pick(S.valid_windows(df, "seq", k, calling_), "id", "function", "pos", "kmer")
        assert lists.agg(F.max(F.size("pos"))).first()[0] <= most


def test_what_is_told_of_signatures_streams(spark):
    """medians and variances from streamed lists, whatever batches cut a k-mer's rows; no aggregate sorts rows of windows."""
    seqs = sequences(spark)
    rows, lists = G.occurrences(seqs), L.windows(seqs, S.K, "otu")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for share in (0.2, 0.8):
            sigs = G.signatures(rows, share)
            for together in (1, 50, L.TOGETHER):
                told = spelt(L.told(lists, share, together=together))
                assert pick(told, "kmer", "function", "n_function", "n_total") == pick(sigs, "kmer", "function", "n_function", "n_total") != []
                assert pick(told, "kmer", "mean", "median", "var") == pick(G.length_stats(rows, sigs), "kmer", "mean", "median", "var")
                assert pick(told, "kmer", "avg_from_end") == pick(G.offset_median(rows, sigs), "kmer", "avg_from_end")
                assert pick(spelt(L.counts(lists, together=together)), "kmer", "function", "n") == pick(G.kmer_counts(rows), "kmer", "function", "n")
        assert L.told(lists, 2.0).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name in ("signature_length_stats", "signature_offset_median"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "Window" not in plan and "Join" not in plan


def test_lookup_table_from_lists(spark):
    """F8: the table that calling looks at is that of single windows."""
    seqs = sequences(spark, 50)
    rows, lists = G.occurrences(seqs), L.windows(seqs, S.K, "otu")
    want = G.table(rows, G.weigh(G.signatures(rows), rows, seqs), seqs.select("id", "otu"))
    got = L.weigh(L.told(lists), lists, seqs).join(L.commonest(lists, "otu"), ["kmer", "function"], "left")
    columns = ["kmer", "function", "n_function", "n_total", F.round("weight", 9), "mean", "median", "var", "avg_from_end", "otu"]
    assert pick(spelt(got), *columns) == pick(want, *columns)
    hits = ["id", "pos", "function", F.round("weight", 9), "mean", "from_end", "otu"]
    assert pick(L.call_hits(seqs, got), *hits) == pick(G.call_hits(seqs, want, amino=True), *hits) != []


def test_weights_and_hits_of_repeated_ids(spark, tmp_path):
    """sequences of one id with different functions stay apart, as in the SQL; k-mers travel as numbers and are written once, as lists."""
    seqs = sequences(spark).select(F.col("id").alias("doc_id"), F.col("seq").alias("text"), F.col("function").alias("lang"), F.col("otu").alias("source"))
    seqs.where("text is not null").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = registry.QUERIES["hit_lookup"](spark, str(tmp_path))
    rows = {}
    for x in got.collect():
        rows.setdefault(x["id"], set()).add(x["own"])
    assert max(map(len, rows.values())) > 1
    # The SQL numbers pieces by id, so that it can't be run with repeated ids: hits of each row by themselves.
    table = {x["kmer"]: (x["function"], x["weight"]) for x in registry.QUERIES["signature_weights"](spark, str(tmp_path)).collect()}
    want = {}
    for x in G.occurrences(seqs.where("text is not null").select(F.col("doc_id").alias("id"), F.col("lang").alias("function"), F.col("text").alias("seq"))).collect():
        if x["kmer"] in table:
            function, weight = table[x["kmer"]]
            n = want.setdefault((x["id"], x["function"], function), [0, 0.0])
            n[0], n[1] = n[0] + 1, n[1] + weight
    assert {(x["id"], x["own"], x["function"]): x["hits"] for x in got.collect()} == {k: n for k, (n, _) in want.items()}
    assert all(abs(x["weight"] - want[x["id"], x["own"], x["function"]][1]) < 0.001 for x in got.collect())


def test_few_windows_tell_who_holds_a_signature(spark):
    """the count of sequences with a signature is that over all windows, however few are looked up first; only sequences that those leave deal out all."""
    seqs = sequences(spark).unionByName(spark.createDataFrame([(None, "f", "ACDEFGHIKL", None), (200, "g", "WWWWWWWWWWWW", None)], "id long, function string, seq string, otu string"))
    lists = cut_lineage(L.windows(seqs))
    rows = lists.select("id", F.explode("kmers").alias("kmer"))
    count = lambda c: spark.range(1).select(c.alias("n")).first()["n"]
    sigs = cut_lineage(G.shared(L.counts(lists)))
    for sigs, firsts in ((sigs, (1, 1000)), (sigs.where("n_total <= 2"), (1,)), (sigs.where("n_total < 0"), (4,))):
        want = rows.join(sigs, "kmer", "left_semi").agg(F.countDistinct("id")).first()[0]
        for first in firsts:
            assert count(L.holders(sigs, lists, first)) == want
    plan = spark.range(1).select(L.holders(sigs, lists))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(array_distinct(kmers") == 1 and plan.index("Generate explode") < plan.index("Join LeftSemi, (id#")


def test_stretches_of_one_function_are_taken_whole(spark, monkeypatch):
    """F8: the same regions, calls and otus as hit by hit, wherever batches end; few hits take a step of their own."""
    r = random.Random(3)
    rows = []
    for i in range(60):
        at = 0
        for _ in range(r.randint(1, 80)):
            at += r.choice([1, 1, 2, 30, 201, 200] if i % 2 else [1, 2, 3])
            rows.append((f"s{i:02}", at, r.choice("ab") if r.random() < (0.3, 0, 0.1)[i % 3] else "a", r.random(), float(r.randint(30, 90)), r.randint(1, 50), r.choice(["x", "y", None])))
    df = spark.createDataFrame(rows, "id string, pos int, function string, weight double, mean double, from_end int, otu string")
    for o in (calling.Options(), calling.Options(min_hits=1, min_weighted=2.0), calling.Options(min_hits=2, max_gap=2), calling.Options(order_constraint=True)):
        want = {}
        for i in sorted({x[0] for x in rows}):
            f = calling.Folder(o)
            for h in sorted(x[1:] for x in rows if x[0] == i):
                f.add(h)
            want[i] = (f.end(), sorted(f.otus.items(), key=lambda x: (-x[1], x[0]))[:5])
        for size in ("10000", "50", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = {x["id"]: ([g.asDict() for g in x["regions"]], [tuple(u) for u in x["otus"]]) for x in calling.folded(df, o).collect()}
            assert got == want
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
