"""Stored signatures, stretches of equal keys, and sketches against exact similarity."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from kinfold.operators import sketches
from kinfold.operators import signatures as G
from kinfold.operators.numbering import consecutive
from kinfold.operators.store import SignatureStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_stays_where_it_is(spark, tmp_path):
    r = random.Random(1)
    seqs = spark.createDataFrame([(i, "".join(r.choice("ACDEFGHIKL" * 4 + "X*") for _ in range(60))) for i in range(50)], "id long, seq string")
    kmers = seqs.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(50), F.lit(2)), lambda i: F.substring("seq", i, F.lit(8)))).alias("kmer")).distinct()
    sigs = kmers.select("kmer", F.lit("f").alias("function"), F.lit(1.5).alias("weight"), F.lit(60).alias("mean"), F.lit(9).alias("avg_from_end"), F.lit("o").alias("otu"))
    name = f"store_{uuid.uuid4().hex}"
    store = SignatureStore.write(sigs, name, 6, str(tmp_path / "store"))
    try:
        got = store.hits(seqs)
        want = G.call_hits(seqs, sigs).withColumnRenamed("from_end", "avg_from_end")
        columns = ["id", "pos", "function", "weight", "avg_from_end", "otu"]
        assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect()) and got.count() > 100
        old = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = plan_of(store.hits(seqs))
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
            assert ", 6), ENSURE" in plan  # dealt to the store's buckets
            some = [x[0] for x in sigs.select("kmer").limit(2).collect()]
            picked = store.fetch(some)
            assert sorted(x["kmer"] for x in picked.collect()) == sorted(some)
            spark.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))  # a task a file
            assert store.table().where("function <> ''").rdd.getNumPartitions() == 6
            assert store.fetch(some).rdd.getNumPartitions() <= 2
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        with pytest.raises(Exception, match="already exists"):
            SignatureStore.write(sigs, name, 6)
    finally:
        store.drop()


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_stretches_of_equal_keys(spark, parts):
    r = random.Random(parts)
    keys, run = [], 0
    for _ in range(60):
        keys += [r.choice(["a", "b", None])] * r.choice([1, 1, 2, 9])
    want = []
    for i, k in enumerate(keys):
        run += i == 0 or k != keys[i - 1]
        want.append((i, run))
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i // 3, i, k) for i, k in enumerate(keys)], "t long, id long, k string").repartition(4)
        got = consecutive(df, "k", "t", "id")
        assert got.columns == ["t", "id", "k", "run"]
        assert sorted((x["id"], x["run"]) for x in got.collect()) == want
        one = consecutive(df.withColumn("k", F.lit("same")), "k", "t", "id")
        assert {x["run"] for x in one.collect()} == {1}
        assert consecutive(df.where("false"), "k", "t", "id").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def exact(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def test_sketches_find_what_exact_similarity_finds(spark):
    r = random.Random(2)
    base = ["".join(r.choice("abcdefgh") for _ in range(r.choice([30, 300, 2000]))) for _ in range(25)]
    texts = []
    for b in base:
        for rate in (0.0, 0.005, 0.02, 0.05):
            texts.append("".join(r.choice("abcdefgh") if r.random() < rate else c for c in b) + "the common tail of all of them")
    k = 12
    sets = [{t[i : i + k] for i in range(len(t) - k + 1)} for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "genome long, seq string")
    own = sketches.bottom(sketches.hashed(df, k), 200)
    assert all(len(x["sketch"]) == min(200, len(sets[x["genome"]])) for x in own.collect())
    halves = sketches.hashed(df, k).withColumn("part", F.pmod("h", F.lit(3)))
    parted = [sketches.bottom(halves.where(F.col("part") == i).drop("part"), 200) for i in range(3)]
    whole = sketches.merged(parted[0].unionByName(parted[1]).unionByName(parted[2]), 200)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, own.collect()))
    refs = own.where("genome % 3 = 0")
    got = {(x["genome"], x["ref"]): x for x in sketches.similar(own, refs, k, 0.3, 200).collect()}
    want = {(i, j): exact(sets[i], sets[j]) for i in range(len(sets)) for j in range(0, len(sets), 3) if i != j}
    sure = [p for p, s in want.items() if s >= 0.4]
    assert len(sure) > 50 and sum(p in got for p in sure) >= 0.95 * len(sure)
    assert all(abs(x["jaccard"] - want[p]) < 0.15 for p, x in got.items())
    contained = {p: len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]]) for p in got}
    assert all(abs(x["containment"] - contained[p]) < 0.2 for p, x in got.items())
    # every pair whose sketches reach the bound is there, although all genomes share hashes
    mine = {x["genome"]: set(x["sketch"]) for x in own.collect()}
    for p in want:
        u = set(sorted(mine[p[0]] | mine[p[1]])[:200])
        assert (len(u & mine[p[0]] & mine[p[1]]) >= 0.3 * len(u)) == (p in got)


def test_sketch_search_recall_over_documents(spark):
    from kinfold.plans import registry, scans

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null").select("doc_id", "text").collect()
    k = scans.LETTERS
    sets = {x["doc_id"]: {x["text"][i : i + k] for i in range(len(x["text"]) - k + 1)} for x in rows}
    sure = [(a, b) for b in sets if b % 20 == 0 for a in sets if a != b and exact(sets[a], sets[b]) >= scans.LEAST + 0.1]
    got = {(x["genome"], x["ref"]) for x in registry.QUERIES["sketch_search"](spark, folder).collect()}
    assert sum(p in got for p in sure) >= 0.95 * len(sure)


def test_sketches_are_cut_where_texts_are_read(spark, monkeypatch):
    texts = ["größe und länge der Wörter " * 9, "plain letters only, and many of them " * 5, "中\U0001f600" * 40, "short", "", None]
    df = spark.createDataFrame([(i % 4, t) for i, t in enumerate(texts)] + [(1, texts[0])], "genome long, seq string")
    for k, at_once, held in ((3, 7, 20), (12, 10, 1), (16, 1 << 20, 10**6), (35, 50, 10**6)):
        monkeypatch.setattr(sketches, "LETTERS_AT_ONCE", at_once)
        monkeypatch.setattr(sketches, "HELD", held)
        got = sketches.sketched(df, k, 30)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sketches.bottom(sketches.hashed(df, k), 30).collect()))
        assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_occurrences_are_written_once(spark):
    from kinfold.plans import learning, registry

    rows, sigs = learning.learnt(registry.Tables(spark, "/root/testdata/sf0.001"))
    assert rows._scratch_path and sigs._scratch_path
