"""Numbering, selections, the way from sequences to calls, loaders and paged sources."""

import json
import math
import random
from collections import Counter, defaultdict
from statistics import median

from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.operators import calling, families, genomes, reports
from kinfold.operators import selections as Q
from kinfold.operators import signatures as G
from kinfold.operators.numbering import numbered
from kinfold.sources import services, tables


def test_numbers_are_dense_and_in_order(spark):
    rows = [(random.Random(i).randint(0, 50), i) for i in range(500)]
    got = numbered(spark.createDataFrame(rows, "a long, b long"), "n", F.col("a").desc(), F.col("b"), first=0).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows, key=lambda x: (-x[0], x[1]))
    assert sorted(r["n"] for r in got) == list(range(500))
    none = spark.createDataFrame([], "f string")
    assert numbered(none, "n", F.col("f")).collect() == [] == reports.neighbours(none, "f", [F.col("f")]).collect()
    one = reports.neighbours(spark.createDataFrame([("x",)], "f string"), "f", [F.col("f")]).collect()
    assert [tuple(r) for r in one] == [("x", "x", "x")]


def test_core_sets_skip_without_a_number(spark):
    rows = [("a", 200), ("a", 150), ("a", 151), ("b", 200), ("b", 149), ("b", 200), ("b", 300), ("c", 900), ("c", 900), *[("d", 150)] * 4]
    got = Q.core_sets(spark.createDataFrame(rows, "fam string, len long")).collect()
    assert sorted((r["idx"], r["fam"], r["size"]) for r in got) == [(1, "d", 4), (2, "a", 3)]


def test_work_lists_and_distinct_sequences(spark):
    rows = [("a", 2, "acGT"), ("a", 1, "ACGT"), ("b", 3, "AC"), ("b", 4, "AG"), ("c", 5, "A"), ("d", 6, None)]
    seqs = spark.createDataFrame(rows, "fam string, id long, seq string")
    got = {r["fam"]: (r["n"], r["n_distinct"], r["protein"], r["dna"]) for r in Q.alignment_work(seqs).collect()}
    assert got == {"a": (2, 1, True, False), "b": (2, 2, True, True), "c": (1, 1, False, False), "d": (0, 0, False, False)}
    assert sorted((r["fam"], r["id"], r["n"]) for r in Q.distinct_sequences(seqs).collect()) == [("a", 1, 2), ("b", 3, 1), ("b", 4, 1), ("c", 5, 1)]
    assert {(r["function"], r["n"], r["residues"]) for r in Q.function_totals(seqs.withColumnRenamed("fam", "function")).collect()} == {("a", 2, 8), ("b", 2, 4), ("c", 1, 1), ("d", 1, 0)}


def test_members_genera_and_first_sequences(spark):
    members = spark.createDataFrame([("f1", "p1"), ("f1", "p2"), ("f2", "p3"), ("f3", "p4")], "fam string, id string")
    ids = spark.createDataFrame([("p2",), ("p2",), ("p9",)], "id string")
    every, mapping = Q.families_holding(members, ids, spark.createDataFrame([("f1", "X")], "fam string, function string"))
    assert sorted(r["id"] for r in every.collect()) == ["p1", "p2"] and [tuple(r) for r in mapping.collect()] == [("f1", "p2", "X")]
    fams = spark.createDataFrame([("f1",), ("f2",)], "fam string")
    assert sorted(r["id"] for r in Q.members_of(members, fams, ids).collect()) == ["p1", "p3"]
    genera = spark.createDataFrame([("G1", 5)], "genus string, taxon int")
    got = Q.with_taxon(spark.createDataFrame([("G1",), ("G2",)], "genus string"), genera).collect()
    assert {r["genus"]: r["genus_taxon"] for r in got} == {"G1": "G1-5", "G2": "G2"}
    assert [r["genus"] for r in Q.of_genus(genera, "G1").collect()] == ["G1"]
    seqs = spark.createDataFrame([("p2", "second", 2), ("p2", "first", 1), ("p5", "x", 1)], "id string, seq string, ord int")
    assert [tuple(r) for r in Q.first_of_each(ids, seqs).collect()] == [("p2", "first")]
    every = spark.createDataFrame([("g", "a"), ("g", "a"), ("g", "b"), ("h", "c")], "genome string, id string")
    left = Q.unclassified(every, spark.createDataFrame([("b",)], "id string"), every.withColumn("seq", F.lit("S")))
    assert sorted(tuple(r) for r in left.collect()) == [("g", "a", "S"), ("h", "c", "S")]
    one = spark.createDataFrame([("x",), ("",), (None,)], "value string")
    assert sorted(r["value"] for r in Q.listed(one, spark.createDataFrame([("x",), ("y",)], "value string")).collect()) == ["x", "y"]


def test_overlaps_once_at_every_edge(spark):
    f = [("k", i, s, s + n) for i, (s, n) in enumerate([(0, 5), (5, 0), (95, 10), (0, 400), (399, 1), (201, 3)])]
    r = [("k", "a", 5, 99), ("k", "b", 100, 200), ("k", "c", 400, 400), ("other", "d", 0, 999)]
    got = genomes.overlapping(spark.createDataFrame(f, "key string, feature long, start long, end long"), spark.createDataFrame(r, "key string, region string, lo long, hi long"), 50).collect()
    assert sorted((x["feature"], x["region"]) for x in got) == sorted((i, n) for k, i, s, e in f for q, n, lo, hi in r if k == q and s <= hi and e >= lo)


def test_natural_order_and_hypothetical(spark):
    ids = ["fig|83333.10.peg.2", "fig|83333.9.peg.10", "fig|83333.9.peg.9", "fig|9.1.rna.1", "zzz", "fig|9.1.peg.11"]
    df = spark.createDataFrame([(i,) for i in ids], "fid string")
    assert [r["fid"] for r in df.orderBy(A.natural_key(F.col("fid"))).collect()] == ["zzz", "fig|9.1.peg.11", "fig|9.1.rna.1", "fig|83333.9.peg.9", "fig|83333.9.peg.10", "fig|83333.10.peg.2"]


def test_calls_from_sequences_by_plain_python(spark):
    r = random.Random(5)
    letters = "ACDEFGHIKLMNPQRSTVWY"
    cores = {f: "".join(r.choice(letters) for _ in range(60)) for f in ("one", "two", "three")}
    rows = []
    for i in range(40):
        f = r.choice(list(cores))
        s = list(cores[f][r.randint(0, 10) : r.randint(40, 60)] + "".join(r.choice(letters) for _ in range(12)))
        if i % 3 == 0:
            s[r.randrange(len(s))] = "X"
        if i % 5 == 0:
            s += "*" + cores[r.choice(list(cores))][:30]
        rows.append((f"s{i:02}", f, "".join(s), f"o{i % 4}"))
    docs = spark.createDataFrame(rows, "id string, function string, seq string, otu string")
    occ = G.occurrences(docs)
    table = G.table(occ, G.weigh(G.signatures(occ), occ, docs), docs.select("id", "otu"))
    got = {x["id"]: x for x in calling.folded(G.call_hits(docs, table)).collect()}

    windows = [(i, f, s[p : p + 8], p, len(s), o) for i, f, s, o in rows for p in range(len(s) - 7) if set(s[p : p + 8]) <= set(letters)]
    per = defaultdict(Counter)
    for _, f, k, *_ in windows:
        per[k][f] += 1
    best = {k: min(c, key=lambda f: (-c[f], f)) for k, c in per.items()}
    kept = {k for k, f in best.items() if per[k][f] >= 0.8 * sum(per[k].values())}
    nsf, nfj = len({i for i, _, k, *_ in windows if k in kept}), Counter(f for _, f, *_ in rows)
    look = {}
    for k in kept:
        f, n = best[k], sum(per[k].values())
        own = [w for w in windows if w[2] == k and w[1] == f]
        offs = sorted(w[4] - w[3] for w in windows if w[2] == k)
        otus = Counter(w[5] for w in own)
        weight = math.log((per[k][f] + 1) / (n - per[k][f] + 1)) + math.log((nsf - nfj[f] + len(kept)) / (nfj[f] + len(kept)))
        look[k] = (f, weight, float(int(sum(w[4] for w in own) / len(own) + 1e-6)), offs[len(offs) // 2], min(otus, key=lambda o: (-otus[o], o)))
    for i, _, s, _ in rows:
        at = [p for p in range(len(s) - 7) if not set("X*") & set(s[p : p + 9])]
        f = calling.Folder(G.Options())
        for p in at:
            if s[p : p + 8] in look:
                f.add((p, *look[s[p : p + 8]]))
        regions = f.end()
        mine = got.get(i)
        assert [(x["start"], x["stop"], x["n"], x["function"]) for x in regions] == [(x["start"], x["stop"], x["n"], x["function"]) for x in (mine["regions"] if mine else [])]
        want = calling.scored_call(regions)
        assert (want is None) == (mine is None or mine["call"] is None)
        if want:
            assert want[0] == mine["call"]["function"] and abs(want[1] - mine["call"]["score"]) + abs(want[3] - mine["call"]["weighted"]) < 1e-6
            assert all(x["med_len"] == float(int(median(h[2] for h in [look[s[p : p + 8]] for p in at if s[p : p + 8] in look and x["start"] <= p <= x["stop"] - 7 and look[s[p : p + 8]][0] == x["function"]]))) for x in regions)
            assert [(o["otu"], o["n"]) for o in mine["otus"]] == sorted(f.otus.items(), key=lambda y: (-y[1], y[0]))[:5]


def test_pages_and_batches(spark):
    def fetch(request):
        import re

        if m := re.search(r"limit\((\d+),(\d+)\)", request):
            assert request.startswith("genome/?and(eq(genus,X),ge(n,1),le(n,9))&")
            return [{"id": i, "name": f"n{i}"} for i in range(int(m[2]), min(int(m[2]) + int(m[1]), 23))]
        return [{"id": int(i), "name": "seq"} for i in re.search(r"\(id,\((.*?)\)\)", request)[1].split(",")]

    where = services.condition({"genus": "X"}, {"n": (1, 9)})
    got = services.read_pages(spark, fetch, "genome", where, 23, "id long, name string", page=5)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [(i, f"n{i}") for i in range(23)]
    ids = spark.range(50).union(spark.range(10))
    assert sorted(r["id"] for r in services.read_by_ids(ids, fetch, "seq", "id", "id long, name string", batch=7).collect()) == list(range(50))
    assert services.condition({"a": "b"}) == "eq(a,b)" and services.condition() == ""


def test_loaders(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "d" / "a.txt").write_text("x\ny\n\nx\n")
    (tmp_path / "d" / "sub" / "b.txt").write_text("no")
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in tables.list_files(spark, str(tmp_path / "d")).collect()] == [("a.txt", 7)]
    assert sorted(r["value"] for r in tables.read_lines(spark, str(tmp_path / "d" / "a.txt")).collect()) == ["x", "y"]
    (tmp_path / "fams").write_text("GF1\t2\t1\tp1\t242\tF (x)\t7\tGen 53985\t7\nGF1\t2\t1\tp2\t240\tF (x)\t8\tGen 53985\t8\n")
    assert [tuple(r) for r in tables.read_families(spark, str(tmp_path / "fams")).orderBy("id").collect()] == [("GF1", "p1", "F (x)", 7, "Gen 53985"), ("GF1", "p2", "F (x)", 8, "Gen 53985")]
    (tmp_path / "map").write_text("r1\tG\t1\t16\told\tg\nr2\tG\t2\t16\tf\tg\nr1\tG\t3\t16\tnew\tg\n")
    assert sorted((r["rep"], r["fam"], r["function"]) for r in tables.read_pegmap(spark, str(tmp_path / "map")).collect()) == [("r1", 3, "new"), ("r2", 2, "f")]
    (tmp_path / "feat").write_text("patric_id\taccession\tfeature_type\tstart\tend\tna_length\tgene\tstrand\tproduct\n\tc1\tsource\t1\t500\t500\t\t+\t\nfig|1.2.peg.1\tc1\tCDS\t9\t80\t72\tabcD\t+\tP\nfig|1.2.peg.2\tc2\tCDS\t9\t80\t72\t\t-\tQ\n")
    cds, contigs = tables.read_features(spark, str(tmp_path / "feat"))
    assert sorted((r["patric_id"], r["start"], r["contig_len"]) for r in cds.collect()) == [("fig|1.2.peg.1", 9, 500), ("fig|1.2.peg.2", 9, None)] and contigs.count() == 1
    seqs = spark.createDataFrame([("g1", "a", " kinase [Gen one]", "M" * 30), ("g1", "b", "", "m" * 30), ("g2", "c", " x [Gen two]", "M" * 5)], "genome string, id string, def string, seq string")
    made = tables.genus_tables(seqs)
    assert sorted(r["function"] for r in made["names"].collect()) == ["kinase", "x"] and [r["ids"] for r in made["nr"].collect()] == [["a", "b"]]
    assert made["genomes"].count() == 2 and {r["id"]: r["len"] for r in made["seq_len"].collect()} == {"a": 30, "b": 30, "c": 5}
    assert json.loads(json.dumps(tables.genus_index(spark.createDataFrame([("A", 1), ("B", 1), ("B", 2)], "genus string, genome int")).orderBy("idx").first().asDict())) == {"genus": "B", "n": 2, "idx": 1}


def test_cluster_summary(spark):
    rows = [("c", "G1", "g1", 1, "p1"), ("c", "G1", "g2", 1, "p2"), ("c", "G2", "g3", 2, "p3"), ("c", "G2", "g3", 2, "p3")]
    assert [tuple(r) for r in families.summary(spark.createDataFrame(rows, "cluster string, genus string, genome string, lfam int, id string"), "cluster").collect()] == [("c", 2, 3, 2, 3)]
