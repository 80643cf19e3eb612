"""Similarity and clusterings over whole documents against plain Python."""

import random
import re

import numpy as np
import pytest

from kinfold.functions import sequences as S
from kinfold.operators import graph, nr
from kinfold.plans import registry


def documents():
    r = random.Random(4)
    pieces = ["".join(r.choices(S.AMINO, k=12)) for _ in range(12)]
    rows = [(i, " ".join(["HQTKWYVACDEF", *r.choices(pieces, k=r.randint(1, 4))]), r.choice(("en", "de")), "s") for i in range(40)]
    return rows + [(50, rows[3][1], rows[3][2], "s"), (51, None, "en", "s"), (52, "nothing like it", "en", "s"), (53, "copies", "de", "s"), (54, "copies", "de", "t")]


@pytest.fixture(scope="module")
def told(spark, tmp_path_factory):
    """Folder, the least id of each document's text, and all pairs of distinct texts by brute force."""
    folder = f"{tmp_path_factory.mktemp('documents')}"
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    first, own = {}, {}
    for i, t, lang, _ in documents():
        if t is not None:
            at = min(j for j, u, k, _ in documents() if (u, k) == (t, lang))
            first[i] = at
            own[at] = (lang, {t[p : p + 8] for p in range(len(t) - 7) if re.fullmatch(f"[{S.AMINO}{S.AMINO.lower()}]{{8}}", t[p : p + 8])}, len(t))
    pairs = {(a, b): len(own[a][1] & own[b][1]) for a in own for b in own if a < b and own[a][0] == own[b][0]}
    return folder, first, own, {k: (own[k[0]][0], n, n / min(len(own[k[0]][1]), len(own[k[1]][1]))) for k, n in pairs.items() if n >= 5}


def test_pairs_of_documents_with_hot_kmers(spark, told, monkeypatch):
    monkeypatch.setattr(nr, "HOT", 2)
    got = {(r["id1"], r["id2"]): (r["function"], r["n_common"], r["score"]) for r in registry.QUERIES["pairwise_shared_kmers_documents"](spark, told[0]).collect()}
    assert got == {k: (f, n, round(s, 6)) for k, (f, n, s) in told[3].items()} and len({x[0] for x in got.values()}) == 2


def test_mcl_of_documents(spark, told):
    folder, first, own, pairs = told
    want = set()
    for lang in ("en", "de"):
        e = [(a, b, s) for (a, b), (f, _, s) in pairs.items() if f == lang]
        a, b, w = map(np.array, zip(*e, strict=True))
        for c in graph.mcl(a, b, w, 3.0):
            members = [i for i, t in first.items() if t in c]
            want |= {(lang, min(c), i) for i in members} if len(members) > 1 else set()
    want |= {("de", 53, 53), ("de", 53, 54)}
    assert set(map(tuple, registry.QUERIES["mcl_clusters_documents"](spark, folder).collect())) == want


def test_representatives_of_documents(spark, told):
    folder, first, own, pairs = told
    rep = {}
    for i in sorted(own, key=lambda i: (-own[i][2], i)):
        near = [j for j in rep if rep[j] == j and (k := (min(i, j), max(i, j))) in pairs and pairs[k][2] >= 0.5]
        rep[i] = min(near, key=lambda j: (-own[j][2], j), default=i)
    got = {r["member"]: r["rep"] for r in registry.QUERIES["representative_clusters_documents"](spark, folder).collect()}
    assert got == {i: rep[t] for i, t in first.items()}


def test_meetings_are_counted_in_blocks(spark, told, monkeypatch):
    """No join on k-mers and no rows of meetings in the plan; blocks, and parts of blocks, of any size give the same pairs."""
    from kinfold.plans.clustering import distinct_documents

    texts = distinct_documents(registry.Tables(spark, told[0]))
    for hot, kmers, cells in ((3, 10**6, 50), (10**6, 40, 7), (10**6, 10**6, 1)):
        for name, value in (("HOT", hot), ("BLOCK_KMERS", kmers), ("CELLS", cells)):
            monkeypatch.setattr(nr, name, value)
        got = nr.shared_kmers(texts, least_score=0.5)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "kmer#" not in plan and plan.count("Join") == 1  # that of a function's number of blocks
        assert {(r["id1"], r["id2"]): (r["function"], r["n_common"], r["score"]) for r in got.collect()} == {k: v for k, v in told[3].items() if v[2] >= 0.5}


def test_representatives_of_a_clique_take_few_rounds(spark, monkeypatch):
    """A node with a representative holds back nobody, so all of a clique are decided at once."""
    r = random.Random(5)
    size = {i: r.randint(1, 9) for i in range(90)}
    pairs = [(a, b, 1.0) for a in range(30) for b in range(a)] + [(a, b, 1.0) for a in range(30, 90) for b in range(30, a) if r.random() < 0.05]
    near = {frozenset(p[:2]) for p in pairs}
    want = {}
    for i in sorted(size, key=lambda i: (-size[i], i)):
        want[i] = next((j for j in want if want[j] == j and frozenset((i, j)) in near), i)
    cut, written = graph.cut_lineage, []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(1) or cut(df))
    nodes = spark.createDataFrame(list(size.items()), "id long, size int")
    got = graph.representatives(spark.createDataFrame(pairs, "a long, b long, score double"), nodes)
    assert {x["member"]: x["rep"] for x in got.collect()} == want and len(written) <= 15
