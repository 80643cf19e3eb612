"""Thinning of alignments, folds by ranges, each against a plain version."""

import random
import re

import pytest

from kinfold.operators import alignments, folds
from kinfold.plans import registry


def alike(a, b):
    n = max(len(a), len(b))
    x, y = a.ljust(n, "-"), b.ljust(n, "-")
    either = [p for p in zip(x, y) if p != ("-", "-")]
    return sum(p == q for p, q in either) / len(either) if either else 0.0


def plain(rows, most):
    """{(family, id): (rep, identity)} by a single pass in order."""
    out, kept = {}, {}
    for family, id_, text in sorted((r for r in rows if r[2] is not None), key=lambda r: (-len(r[2].replace("-", "")), r[1])):
        found = next(((k, alike(text, t)) for k, t in kept.setdefault(family, []) if alike(text, t) > most), None)
        if found is None:
            kept[family].append((id_, text))
        out[family, id_] = found or (id_, 1.0)
    return out


def family_rows(n, seed):
    """A hot family of copies with changes, some others, nulls, gaps alone and no letters."""
    r = random.Random(seed)
    roots = ["".join(r.choice("ACDEé-") for _ in range(60)) for _ in range(12)]
    rows = []
    for i in range(n):
        text = list(r.choice(roots))
        for _ in range(r.randrange(9)):
            text[r.randrange(len(text))] = r.choice("ACDE-")
        rows.append((("hot" if i % 3 else f"f{i % 7}") if i % 11 else None, i, "".join(text)[: r.choice([60, 60, 55])]))
    return rows + [("hot", n, None), ("hot", n + 1, "---"), ("hot", n + 2, ""), ("hot", n + 3, "----")]


@pytest.mark.parametrize("block, group_bytes", [(16, 400), (256, 1 << 23)])
def test_thinning_equals_plain_pass(spark, block, group_bytes):
    rows = family_rows(160, block)
    df = spark.createDataFrame(rows, "family string, id long, aligned string")
    got = {(r["family"], r["id"]): (r["rep"], r["identity"]) for r in alignments.representatives(df, 0.9, block, group_bytes).collect()}
    assert got == plain(rows, 0.9)
    assert 10 < sum(rep == i for (_, i), (rep, _) in got.items()) < len(rows) - 20


def test_thinning_of_nothing(spark):
    none = spark.createDataFrame([], "family string, id long, aligned string")
    assert alignments.representatives(none).collect() == []


def test_thinning_of_documents(spark):
    folder = "/root/testdata/sf0.001"


    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null").select("doc_id", "text").collect()
    rows = [((m.group(1).lower() if (m := re.match("([A-Za-z]+ [A-Za-z]+ [A-Za-z]+)", d["text"])) else ""), d["doc_id"], d["text"]) for d in docs]
    got = {(r["family"], r["id"]): (r["rep"], r["identity"]) for r in registry.QUERIES["alignment_representatives"](spark, folder).collect()}
    assert got == plain(rows, 0.9)


def test_whole_genes_and_sizes(spark):
    seqs = spark.createDataFrame([("a", "ATGAAATAA"), ("a", "gtgtag"), ("a", "AAATAA"), ("a", "ATGAAA"), ("a", None), ("b", "CCC"), ("c", "ATGTGA")], "family string, seq string")
    rows = seqs.select("family", "seq", alignments.F.length("seq").alias("length"), alignments.whole_gene(alignments.F.col("seq")).alias("whole"))
    assert sorted(r["seq"] for r in rows.where("whole").collect()) == ["ATGAAATAA", "ATGTGA", "gtgtag"]
    by = {r["family"]: r for r in alignments.sized_families(rows).collect()}
    assert (by["a"]["raw_size"], by["a"]["frags_trimmed_size"], by["a"]["frags_trimmed_mean"]) == (4, 2, 7.5)
    assert (by["b"]["frags_trimmed_size"], by["b"]["frags_trimmed_mean"], by["b"]["frags_trimmed_sd"], by["c"]["frags_trimmed_sd"]) == (0, None, None, 0.0)
    assert sorted(r["seq"] for r in alignments.trimmed(rows, 0.5).collect()) == ["ATGTGA"]
    aligned = spark.createDataFrame([("a", 1, "AC-D"), ("a", 2, "AC-D"), ("a", 3, "GGGG")], "family string, id int, aligned string")
    assert [tuple(r)[1:3] for r in alignments.clean_sizes(aligned, alignments.representatives(aligned)).collect()] == [(2, 3.5)]


def pages(sizes, most):
    page, held, out = 1, 0, []
    for s in sizes:
        if held and held + s > most:
            page, held = page + 1, 0
        held += s
        out.append(page)
    return out


def packed(sizes, bins):
    load, out = [0] * bins, []
    for s in sizes:
        b = load.index(min(load))
        load[b] += s
        out.append(b)
    return out


@pytest.mark.parametrize("largest, most, bins", [(3, 7, 3), (30, 12, 5), (400, 1000, 4), (0, 5, 2)])
def test_folds_equal_one_stream(spark, largest, most, bins):
    r = random.Random(largest)
    rows = sorted(((f"i{i:03}", int(r.random() ** 3 * (largest + 1))) for i in range(300)), key=lambda x: (-x[1], x[0]))
    df = spark.createDataFrame(rows, "item string, size long").repartition(5)
    sizes = [s for _, s in rows]
    got = {x["item"]: (x["size"], x["page"]) for x in folds.paginate(df, most).collect()}
    assert got == {i: (s, p) for (i, s), p in zip(rows, pages(sizes, most))}
    got = {x["item"]: x["bin"] for x in folds.lpt_bins(df, bins).collect()}
    assert got == dict(zip([i for i, _ in rows], packed(sizes, bins)))


def test_folds_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 3), (7, None), (2**60 + 1, 2)], "item long, size long")
    assert sorted(map(tuple, folds.paginate(df, 3).collect()), key=str) == sorted([(None, 3, 1), (2**60 + 1, 2, 2), (7, 0, 2)], key=str)
    assert {(x["item"], x["bin"]) for x in folds.lpt_bins(df, 2).collect()} == {(None, 0), (2**60 + 1, 1), (7, 1)}
    assert folds.paginate(df.limit(0), 3).collect() == [] == folds.lpt_bins(df.limit(0), 3).collect()


def test_folds_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((d["doc_id"], len(d["text"] or "")) for d in docs), key=lambda x: (-x[1], x[0]))
    sizes = [s for _, s in rows]
    got = {x["item"]: (x["size"], x["page"]) for x in registry.QUERIES["document_pages"](spark, folder).collect()}
    assert got == {i: (s, p) for (i, s), p in zip(rows, pages(sizes, 10_000))}
    got = {x["item"]: x["bin"] for x in registry.QUERIES["document_bins"](spark, folder).collect()}
    assert got == dict(zip([i for i, _ in rows], packed(sizes, 64)))


def test_many_unlike_rows_are_thinned_in_one_round(spark, monkeypatch):
    """A family of unlike rows, some alike ones among them, of lengths about the width of a head and below a word."""
    r = random.Random(8)
    rows = []
    for i in range(700):
        text = "".join(r.choice("abcdefghijkl -é中") for _ in range(r.choice([3, 7, 8, 15, 40, 41])))
        rows.append(("f", i, text))
        if i % 7 == 0:
            rows.append(("f", 1000 + i, text[:-1] + "z"))
    cut, written = alignments.cut_lineage, []
    monkeypatch.setattr(alignments, "cut_lineage", lambda df: written.append(1) or cut(df))
    got = {(x["family"], x["id"]): (x["rep"], x["identity"]) for x in alignments.representatives(spark.createDataFrame(rows, "family string, id long, aligned string")).collect()}
    assert got == plain(rows, 0.9) and 0 < sum(k[1] != v[0] for k, v in got.items()) < 300
    assert len(written) <= 7
