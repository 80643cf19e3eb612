"""Operators on hand-made tables and against plain Python on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import calling, families, folds, genomes, graph, nr, propagate, reports
from kinfold.operators import signatures as G
from kinfold.operators.signatures import Options
from kinfold.sources import sequences as io
from kinfold.sources import tables


def hit(pos, fn, mean=100):
    return (pos, fn, 1.0, mean, 0)


def spans(regions):
    return [(r["start"], r["function"], r["n"]) for r in regions]


def test_gap_of_200_holds_and_201_breaks():
    o = Options(min_hits=2)
    assert spans(calling.fold([hit(0, "a"), hit(200, "a")], o)) == [(0, "a", 2)]
    assert spans(calling.fold([hit(0, "a"), hit(201, "a")], o)) == []


def test_one_stray_hit_ends_nothing_two_do():
    o = Options(min_hits=2)
    assert spans(calling.fold([hit(1, "a"), hit(2, "b"), hit(3, "a")], o)) == [(1, "a", 2)]
    assert spans(calling.fold([hit(1, "a"), hit(2, "a"), hit(3, "b"), hit(4, "b")], o)) == [(1, "a", 2), (3, "b", 2)]


def region(fn, n, length=100.0):
    return {"start": 0, "stop": 1, "n": n, "function": fn, "weight": float(n), "med_len": length, "mad": 0.0}


def test_merge_over_a_weak_middle():
    assert [r["n"] for r in calling.joined([region("x", 6), region("y", 4), region("x", 4)])] == [10]
    assert len(calling.joined([region("x", 6), region("y", 5), region("x", 4)])) == 3


def test_call_needs_a_lead_of_five():
    assert calling.best_call([region("x", 10), region("y", 5)]) == ("x", 10.0, 5.0)
    assert calling.best_call([region("x", 10), region("y", 6)]) is None
    assert calling.best_call([region("x", 10), region("y", 6)], ambiguous=True)[0] == "y ?? x"
    assert calling.best_call([]) is None


def test_fusion():
    rows = [region("A", 5, 100), region("A / B", 6, 205), region("B", 5, 100)]
    assert calling.best_call(rows)[0] == "A / B"
    rows[1] = region("A / B", 6, 300)
    assert calling.best_call(rows) is None


def test_signature_share(spark):
    rows = [(i, "f", "ACDEFGHI", 0, 8) for i in range(8)] + [(9, "g", "ACDEFGHI", 0, 8), (10, "g", "ACDEFGHI", 0, 8)]
    rows += [(i, "f", "CDEFGHIK", 0, 8) for i in range(7)] + [(i, "g", "CDEFGHIK", 0, 8) for i in range(3)]
    got = G.signatures(spark.createDataFrame(rows, "id int, function string, kmer string, pos int, len int")).collect()
    assert [tuple(r) for r in got] == [("ACDEFGHI", "f", 8, 10)]


def test_offset_median_is_the_upper_one(spark):
    rows = spark.createDataFrame([(i, "f", "K", 0, n) for i, n in enumerate((8, 9, 12, 20))], "id int, function string, kmer string, pos int, len int")
    assert G.offset_median(rows, rows.select("kmer").distinct()).first()["avg_from_end"] == 12


def components_brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs_and_a_chain(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(1000, 1060)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == components_brute(edges)


def test_components_of_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mcl_parts_two_cliques_on_a_weak_link(spark):
    e = [("g", a, b, 1.0) for c in (range(4), range(10, 14)) for a in c for b in c if a < b] + [("g", 3, 10, 0.05)]
    got = graph.markov_clusters(spark.createDataFrame(e, "group string, a long, b long, weight double")).collect()
    assert {(r["cluster"], r["member"]) for r in got} == {(c[0], x) for c in (range(4), range(10, 14)) for x in c}


def test_mcl_of_a_component_over_the_limit(spark):
    e = [("g", a, b, 1.0) for c in (range(4), range(10, 14)) for a in c for b in c if a < b] + [("g", 3, 10, 0.05)]
    got = graph.markov_clusters(spark.createDataFrame(e, "group string, a long, b long, weight double"), largest=5).collect()
    assert {r["member"] for r in got} == {*range(4), *range(10, 14)}


def test_representatives(spark):
    nodes = spark.createDataFrame([(1, 10), (2, 9), (3, 8), (4, 7)], "id long, size int")
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.9)], "a long, b long, score double")
    assert sorted(map(tuple, graph.representatives(pairs, nodes).collect())) == [(1, 1), (1, 2), (3, 3), (3, 4)]


def test_lpt_and_pages(spark):
    items = spark.createDataFrame([("a", 7), ("b", 6), ("c", 5), ("d", 4), ("e", 3)], "item string, size long")
    bins = {r["item"]: r["bin"] for r in folds.lpt_bins(items, 2).collect()}
    load = [sum(s for i, s in (("a", 7), ("b", 6), ("c", 5), ("d", 4), ("e", 3)) if bins[i] == b) for b in (0, 1)]
    assert sorted(load) == [11, 14]
    assert [r["page"] for r in folds.paginate(items, 12).orderBy("item").collect()] == [1, 2, 2, 3, 3]


def test_nr_and_inflate_keep_membership(spark):
    seqs = spark.createDataFrame([(1, "AAA"), (2, "aaa"), (3, "CCC")], "id long, seq string")
    g = nr.groups(seqs)
    refs = nr.references(g, lambda c: c.isNotNull())
    members = spark.createDataFrame([("f", 1, "x"), ("f", 3, None)], "fam string, id long, gene string")
    got = sorted(map(tuple, nr.inflate(members, refs).collect()), key=str)
    assert got == [("f", 1, True, "x"), ("f", 2, False, "x"), ("f", 3, True, None)]


def test_family_of_one_and_consensus(spark):
    m = spark.createDataFrame([(1, 10, 100), (2, 11, 90), (2, 12, 110)], "fam int, id int, len int")
    assert families.describe(m).where("fam = 1").first()["sd"] is None
    assert {r["id"]: r["z"] for r in families.z_scores(m).collect()} == {10: 0.0, 11: -0.707, 12: 0.707}
    g = spark.createDataFrame([(1, "a"), (1, "a"), (1, ""), (2, "a"), (2, "b"), (3, None)], "c int, gene string")
    assert {r["c"]: r["gene"] for r in families.consensus(g, "c").collect()} == {1: "a", 2: "", 3: ""}


def release(spark, fams):
    return spark.createDataFrame([(m, f) for f, ms in fams.items() for m in ms], "md5 string, fam string")


def test_propagation(spark):
    old = release(spark, {"o1": "ab", "o2": "cdef", "o3": "gh", "o4": "ij", "o5": "klmn"})
    new = release(spark, {"n1": "ab", "n2": "cd", "n3": "ef", "n4": "ghij", "n5": "xy", "n6": "klm", "n7": "nz"})
    one = {(r["old_fam"], r["new_fam"], r["kind"], r["rank"]) for r in propagate.phase1(old, new).collect()}
    assert one == {("o1", "n1", "NOW", 1), ("o2", "n2", "SPLIT", 1), ("o2", "n3", "SPLIT", 2), ("o5", "n6", "SPLIT", 1), ("o5", "n7", "SPLIT", 2)}
    two = {(r["new_fam"], r["kind"], r["old_fam"]) for r in propagate.phase2(old, new).collect()}
    assert two == {("n4", "JOIN", "o3"), ("n5", "NEW", None)}


@pytest.mark.parametrize(("kept", "named"), [(76, True), (75, False)])
def test_dominant_share_is_strict(spark, kept, named):
    ids = [f"m{i}" for i in range(100)]
    other = [f"p{i}" for i in range(40)]
    old = release(spark, {"o1": ids, "o2": other})
    new = release(spark, {"n1": ids[:kept] + other[:20], "n2": ids[kept:] + other[20:]})
    assert [r["old_fam"] for r in propagate.phase3(old, new).where("new_fam = 'n1'").collect()] == (["o1"] if named else [])


def test_new_numbers(spark):
    got = propagate.number_new(spark.createDataFrame([("g", 1)], "scope string, k int"), spark.createDataFrame([("g", 7)], "scope string, max_id int"))
    assert got.first()["new_id"] == 9


def test_truncation_and_best_hits(spark):
    df = spark.createDataFrame([(9, 50, 100), (10, 50, 100), (20, 90, 100), (20, 91, 100)], "s int, e int, n int")
    assert [r[0] for r in df.select(genomes.truncated(F.col("s"), F.col("e"), F.col("n"))).collect()] == [True, False, False, True]
    ani = spark.createDataFrame([(1, 1, 100.0), (1, 2, 97.0), (3, 2, 97.5), (3, 4, 97.5)], "query long, ref long, ani double")
    assert sorted(map(tuple, genomes.best_hits(ani).collect())) == [(1, 2, 97.0, False), (3, 2, 97.5, True)]


def test_ranges_and_neighbours(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 3, 5, 5)], "k string, n long")
    assert sorted(map(tuple, reports.id_ranges(df, "k", "n").collect())) == [("a", 1, 3, 3), ("a", 5, 5, 1)]
    three = spark.createDataFrame([("x",), ("y",), ("z",)], "f string")
    assert [tuple(r) for r in reports.neighbours(three, "f", [F.col("f")]).orderBy("f").collect()] == [("x", "z", "y"), ("y", "x", "z"), ("z", "y", "x")]


def test_global_merge(spark):
    loc = spark.createDataFrame([("f", "A", 1), ("f", "B", 1), ("f", "C", 1), ("", "D", 1)], "function string, genus string, lfam int")
    clu = spark.createDataFrame([("f", "k1", "A", 1), ("f", "k1", "B", 1), ("f", "k2", "C", 1)], "function string, cluster string, genus string, lfam int")
    got = sorted((r["gfam"], r["genus"], r["n_lfams"], r["n_genera"]) for r in families.merge_global(clu, loc).collect())
    assert got == [("PGF_00000000", "A", 2, 2), ("PGF_00000000", "B", 2, 2), ("PGF_00000001", "C", 1, 1)]


def test_fasta_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one two\nACDE\r\nFG*H\n>y\n*AC-D\n\n>\nAAA\n")
    got = sorted(map(tuple, io.read_fasta(spark, str(tmp_path / "a.fa")).collect()))
    assert got == [("x", " one two", "ACDEFG*H"), ("y", "", "ACD")]
    rows = spark.createDataFrame([("p", " d", "ACDEFGHIKL" * 13), ("q", "", "A")], "id string, def string, seq string")
    io.write_fasta(rows, str(tmp_path / "out"))
    assert sorted(map(tuple, io.read_fasta(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, rows.collect()))
    (tmp_path / "a.fq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    assert sorted(map(tuple, io.read_fastq(spark, str(tmp_path / "a.fq")).collect())) == [("r1", " x", "ACGT"), ("r2", "", "GG")]


def test_table_files(spark, tmp_path):
    (tmp_path / "assign").write_text("a\tX\nno tab\na\tX # frag\nb\tY\tz\nb\tZ\n")
    assert sorted(map(tuple, tables.read_assignments(spark, str(tmp_path / "assign")).collect())) == [("a", "X"), ("b", "Z")]
    (tmp_path / "syn").write_text("gnl|md5|8eea9950bc1e0f99f75a4a976304d636,169\tfig|438.15.peg.2419,169;fig|940265.3.peg.655,169\nbroken\n")
    got = tables.read_synonyms(spark, str(tmp_path / "syn")).collect()
    assert [(r["id"], r["id_len"]) for r in got] == [("fig|438.15.peg.2419", 169), ("fig|940265.3.peg.655", 169)]
    (tmp_path / "clu").write_text("a\tb\tc\nd\n")
    assert tables.read_ragged(spark, str(tmp_path / "clu")).groupBy("cluster").count().count() == 2
    df = spark.createDataFrame([("g1", 1), ("g2", 2)], "genus string, fam int")
    tables.write_keyed(df, str(tmp_path / "keyed"), "genus")
    tables.replace_partition(spark.createDataFrame([("g1", 9)], "genus string, fam int").select("fam", "genus"), str(tmp_path / "keyed"), "genus")
    assert sorted((r["genus"], r["fam"]) for r in spark.read.parquet(str(tmp_path / "keyed")).collect()) == [("g1", 9), ("g2", 2)]
    table = spark.createDataFrame([("a", "new"), ("b", "new")], "fam string, status string")
    change = spark.createDataFrame([("a", "running", 1), ("a", "done", 2), ("c", "new", 1)], "fam string, status string, seq int")
    assert sorted(map(tuple, tables.upsert(table, change, "fam").collect())) == [("a", "done"), ("b", "new"), ("c", "new")]


def test_report_counters(spark):
    calls = spark.createDataFrame([(1, "a"), (2, "b")], "id int, function string")
    truth = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "id int, function string")
    assert tuple(reports.validation(calls, truth).first()) == (1, 1, 1)
    rows = spark.createDataFrame([("g", 1.0, 2.0), ("g", 2.0, 4.0), ("g", 3.0, 6.0)], "k string, x double, y double")
    s = reports.spread(rows, "k", "x", "y").first()
    assert (s["n"], s["mean"], round(s["r2"], 9), round(s["deviation"], 6)) == (3, 4.0, 1.0, round(4 / 3, 6))
    bins = spark.createDataFrame([(0, [(5, 2), (9, 1)]), (1, [])], "bin int, elements array<struct<size:int,files:int>>")
    acc = spark.createDataFrame([(0, "00:11:46")], "bin int, elapsed string")
    assert sorted(map(tuple, reports.job_stats(bins, acc).collect())) == [(0, 2, 9, 2, 11 + 46 / 60), (1, 0, None, None, None)]


def test_uniprot_report_and_cluster_difference(spark):
    calls = spark.createDataFrame([(1, "x core_cid:1", 101.0), (2, "x core_cid:1", 100.0), (3, "other", 500.0)], "id int, function string, score double")
    got = reports.named_calls(calls, spark.createDataFrame([(1, "N")], "id int, name string"), spark.createDataFrame([("x core_cid:1",)], "function string")).collect()
    assert [tuple(r) for r in got] == [("x core_cid:1", 1, ["N"], 1)]
    a = spark.createDataFrame([(1, "p"), (2, "q"), (2, "r")], "cluster int, member string")
    b = spark.createDataFrame([(7, "p"), (7, "q"), (7, "s"), (8, "r")], "cluster int, member string")
    assert [tuple(r) for r in reports.split_singletons(a, b).collect()] == [(7, "p")]


def test_names_and_matches(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    one, two = spark.createDataFrame([(1, "a"), (2, "")], "id int, name string"), spark.createDataFrame([(1, "z"), (2, "b")], "id int, name string")
    assert sorted(map(tuple, genomes.names(ids, one, two).collect())) == [(1, "a"), (2, "b"), (3, None)]
    f = spark.createDataFrame([("f1", "c", "+", 9), ("f2", "c", "-", 9)], "id string, accession string, strand string, end int")
    p = spark.createDataFrame([("p1", "c", "+", 9), ("p2", "c", "+", 12)], "id string, accession string, strand string, end int")
    assert sorted((r["feature"] or "", r["prediction"] or "", r["kind"]) for r in genomes.matched(f, p).collect()) == [("", "p2", "predicted"), ("f1", "p1", "both"), ("f2", "", "annotated")]
