"""The streaming forms over a table read as a stream."""

import random
import time

import pytest

from kinfold.operators.calling import fold
from kinfold.operators.signatures import Options, call_hits
from kinfold.streaming.calling import stream_folded, stream_hits, stream_regions


def test_stream_hits(spark, tmp_path):
    spark.createDataFrame([("p", "ACDEFGHIK")], "id string, seq string").write.parquet(str(tmp_path / "s"))
    sigs = spark.createDataFrame([("ACDEFGHI", "f", 1.0)], "kmer string, function string, weight double")
    src = spark.readStream.schema("id string, seq string").parquet(str(tmp_path / "s"))
    q = stream_hits(src, sigs).writeStream.format("memory").queryName("hits_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["id"], r["pos"], r["function"]) for r in spark.table("hits_out").collect()] == [("p", 0, "f")]


def test_stream_regions(spark, tmp_path):
    rows = spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:00', 1.0), ('a', timestamp'2024-01-01 00:00:30', 2.0), ('b', timestamp'2024-01-02 00:00:00', 5.0) as t(id, ts, weight)")
    rows.selectExpr("id", "ts", "double(weight) weight").write.parquet(str(tmp_path / "e"))
    src = spark.readStream.schema("id string, ts timestamp, weight double").parquet(str(tmp_path / "e"))
    q = stream_regions(src, "1 minute", "1 minute", 2).writeStream.format("memory").queryName("regions_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["id"], r["n"], r["weight"]) for r in spark.table("regions_out").collect()] == [("a", 2, 3.0)]


def drained(q, rows):
    """Waits until a query has taken so many rows, then stops it (with timers, batches without data never end)."""
    until = time.time() + 90
    while time.time() < until and sum(p["numInputRows"] for p in q.recentProgress) < rows:
        time.sleep(0.3)
    q.stop()


def hits_of(r, n):
    pos, rows = 0, []
    for _ in range(n):
        pos += r.choice([1, 1, 2, 5, 30, 250])
        rows.append((pos, r.choice("FFFFGGH"), r.choice([0.5, 1.0, 2.0]), float(r.choice([80, 100, 120])), 500 - pos))
    return rows


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_regions_are_those_of_the_batch_fold_for_any_cut(spark, tmp_path, cuts):
    r = random.Random(cuts)
    o = Options(min_hits=3)
    seqs = {f"s{i}": hits_of(r, r.choice([0, 3, 40, 90])) for i in range(6)}
    schema = "id string, pos long, function string, weight double, mean double, from_end int"
    edges = {s: sorted(r.randrange(len(h) + 1) for _ in range(cuts - 1)) for s, h in seqs.items()}
    for b in range(cuts):
        rows = []
        for s, h in seqs.items():
            at = [0, *edges[s], len(h)]
            rows += [(s, *x) for x in h[at[b] : at[b + 1]]]
        r.shuffle(rows)
        if b == cuts - 1:
            rows += [(s, None, None, None, None, None) for s in seqs]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "h"))
        time.sleep(1.1)  # files are taken in order of their times
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "h"))
    name = f"folded_{cuts}"
    q = stream_folded(src, o).writeStream.format("memory").queryName(name).outputMode("append").start()
    drained(q, sum(map(len, seqs.values())) + len(seqs))
    got = sorted((x["id"], x["start"], x["stop"], x["n"], x["function"], x["weight"], x["med_len"], x["mad"]) for x in spark.table(name).collect())
    want = sorted((s, g["start"], g["stop"], g["n"], g["function"], g["weight"], g["med_len"], g["mad"]) for s, h in seqs.items() for g in fold(h, o))
    assert got == want and len(want) > 5


def test_an_idle_sequence_ends_by_its_timer(spark, tmp_path):
    schema = "id string, pos long, function string, weight double, mean double, from_end int"
    spark.createDataFrame([("s", 5 * i, "F", 1.0, 100.0, 9) for i in range(6)], schema).write.parquet(str(tmp_path / "h"))
    src = spark.readStream.schema(schema).parquet(str(tmp_path / "h"))
    q = stream_folded(src, idle_seconds=0.5).writeStream.format("memory").queryName("folded_idle").outputMode("append").trigger(processingTime="1 second").start()
    until = time.time() + 60
    while time.time() < until and not spark.table("folded_idle").count():
        time.sleep(0.5)
    q.stop()
    assert [(x["id"], x["start"], x["stop"], x["n"]) for x in spark.table("folded_idle").collect()] == [("s", 0, 32, 6)]


def test_streamed_hits_are_those_of_calling(spark, tmp_path):
    seqs = spark.createDataFrame([("p", "ACDEFGHIXACDEFGHIK"), ("q", "ACDEFGHI")], "id string, seq string")
    sigs = spark.createDataFrame([("ACDEFGHI", "f", 1.0, 9, 3, "o")], "kmer string, function string, weight double, mean int, avg_from_end int, otu string")
    seqs.write.parquet(str(tmp_path / "s"))
    src = spark.readStream.schema("id string, seq string").parquet(str(tmp_path / "s"))
    q = stream_hits(src, sigs).writeStream.format("memory").queryName("called_hits").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    pick = lambda df: sorted((x["id"], x["pos"], x["function"]) for x in df.collect())
    assert pick(spark.table("called_hits")) == pick(call_hits(seqs, sigs)) == [("p", 9, "f"), ("q", 0, "f")]
