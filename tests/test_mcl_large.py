"""Markov clustering of components above the limit of one task, and of large cliques."""

import random

from kinfold.operators import graph

KIND = "group string, a long, b long, weight double"


def clusters(df):
    return sorted(map(tuple, df.collect()))


def test_links_of_a_component_over_the_limit_all_count(spark):
    """Pairs tied by their best link, but all linked nearly as well: one cluster, not a cluster a pair."""
    e = [("g", a, b, 1.0 if a // 2 == b // 2 else 0.9) for a in range(12) for b in range(a + 1, 12)]
    assert clusters(graph.markov_clusters(spark.createDataFrame(e, KIND), largest=5)) == [("g", 0, x) for x in range(12)]


def test_same_clusters_below_and_above_the_limit(spark):
    r, e = random.Random(2), []
    for g, first in (("g", 0), ("h", 100), (None, 200)):
        for a in range(first, first + 40):
            for b in range(a + 1, first + 40):
                if r.random() < (0.8 if (a - first) // 10 == (b - first) // 10 else 0.03):
                    e.append((g, a, b, r.uniform(0.2, 1)))
    df = spark.createDataFrame(e, KIND)
    got = [sorted(map(tuple, graph.markov_clusters(df, largest=n).collect()), key=str) for n in (1000, 5)]
    assert got[0] == got[1] and len({(x[0], x[1]) for x in got[0]}) > 3


def test_a_large_clique_is_a_cluster():
    import numpy as np

    e = [(a, b) for c in (range(30), range(30, 60)) for a in c for b in c if a < b] + [(29, 30)]
    a, b = np.array(e).T
    assert sorted(map(sorted, graph.mcl(a, b, np.r_[np.ones(len(e) - 1), 0.05], 3.0))) == [list(range(30)), list(range(30, 60))]


def test_rounds_over_blocks_of_columns_write_the_flow_alone(spark, monkeypatch):
    """Several blocks of columns; a round writes one table of flow, and neither squares nor sums of it by joins."""
    e = [("g", c + a, c + b, 1.0) for c in (0, 200, 400) for a in range(200) for b in range(a + 1, 200)] + [("g", 199, 200, 0.05), ("g", 399, 400, 0.05)]
    cut, written = graph.cut_lineage, []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(1) or cut(df))
    got = clusters(graph.markov_clusters(spark.createDataFrame(e, KIND), largest=5))
    assert got == [("g", x // 200 * 200, x) for x in range(600)] and len(written) <= 16
