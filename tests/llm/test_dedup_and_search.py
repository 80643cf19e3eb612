"""Near-duplicates, repeated passages and top-k search against brute force; the pipeline as a whole."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import fmindex, minhash, substring, topk

EDGES = [(900_001, ""), (900_002, None), (900_003, " \n "), (900_004, "one"), (900_005, "one"), (None, "null id with some words"), (None, "null id with some words"), (900_006, "a b"), (900_007, "A\tB")]


def corpus(seed, docs=60, vocab=300):
    r = random.Random(seed)
    word = lambda: f"w{min(r.randrange(vocab), r.randrange(vocab))}"
    rows = [(i, " ".join(word() for _ in range(r.randint(1, 120)))) for i in range(docs)]
    for i in range(docs, 3 * docs):  # copies with none to many edits, and passages of others
        w = r.choice(rows)[1].split()
        for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            o = r.choice(rows)[1].split()
            w = w[: r.randrange(len(w) + 1)] + o + w[len(w) // 2 :]
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    return rows


def groups_brute(rows, size, percent):
    sets = []
    for d, t in rows:
        w = (t or "").encode().lower().split()
        s = frozenset(zip(*(w[k:] for k in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)]) if w else None
        sets.append((d, s))
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        find(a)
        for b, o in sets[:i]:
            if s and o and 100 * len(s & o) >= percent * len(s | o):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {a: (len(s or ()), find(a)) for a, s in sets}


@pytest.mark.parametrize(("size", "seed"), [(2, 1), (5, 2)])
def test_near_duplicates(spark, size, seed):
    rows = corpus(seed) + [e for e in EDGES if e[0] is not None]
    df = spark.createDataFrame(rows + [rows[0]], "doc_id long, text string").withColumn("n_shingles", F.lit("mine"))
    got = minhash.near_duplicates(df, size=size, percent=80).collect()
    assert len(got) == len(rows) + 1
    want = groups_brute(rows, size, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicate_edges(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    got = minhash.op6_minhash(df).collect()
    at = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert at[900_005]["component_id"] == 900_004 and at[900_007]["component_id"] == 900_006
    assert at[900_001]["n_shingles"] == at[900_002]["n_shingles"] == at[900_003]["n_shingles"] == 0
    assert [r["kept"] for r in got if r["doc_id"] is None] == [False, False]
    assert minhash.op6_minhash(df.where("false")).count() == 0
    assert sorted(r["doc_id"] for r in minhash.keep_one(df).where("doc_id is not null").collect()) == [900_001, 900_002, 900_003, 900_004, 900_006]


def test_rows_of_one_id_and_ids_of_text(spark):
    words = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [("b", words), ("b", other), ("a", words + " more"), ("c", other), ("c", other), (None, other), (None, "alone here"), ("d", None), ("d", None), ("e", " ")]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("rid", F.lit(1)).withColumn("__kinfold_did", F.lit("mine")).withColumn("_rank", F.lit(2))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, size=2).collect()), key=str)
    want = [("b", 39, "a", False), ("b", 39, "b", True), ("a", 40, "a", True), ("c", 39, "b", False), ("c", 39, "b", False), (None, 39, "b", False), (None, 1, None, False)]
    want += [("d", 0, "d", True)] * 2 + [("e", 0, "e", True)]
    assert got == sorted(want, key=str)
    kept = minhash.keep_one(df, size=2)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([("a", words + " more"), ("b", other), (None, "alone here"), ("d", None), ("d", None), ("e", " ")], key=str)


def test_links_of_pairs_that_share_one_band_only(spark, monkeypatch):
    """With few wide bands nearly all links at the threshold meet in a single band; every pair that meets is still tried."""
    r = random.Random(5)
    rows = []
    for k in range(12):
        base = [f"b{k}x{i}" for i in range(80)]
        for j in range(8):
            w = list(base)
            for _ in range(r.choice([0, 3, 4])):
                w[r.randrange(80)] = f"e{r.randrange(10_000)}"
            rows.append((100 * k + j, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {d: set(zip(t.split(), t.split()[1:], strict=False)) for d, t in rows}
    band = {}
    for x in minhash._signed(iter([df.withColumn("did", F.col("doc_id")).withColumn("th", F.lit(0).cast("long")).select("doc_id", "did", "th", "text").toArrow().combine_chunks().to_batches()[0]]), 2, 40, 1):
        band |= dict(zip(x.column("doc_id").to_pylist(), x.column("bands").to_pylist(), strict=True))
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and set(band[a]) & set(band[b]) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(df, 2, 80, bands=40, rows=1).collect()}
    assert got == {d: find(d) for d in sets}


def test_sets_are_confirmed_where_their_hashes_are_equal(spark, monkeypatch):
    """With hashes that tell nothing all sets look equal: links must come from the sets themselves."""
    real = minhash.mix
    monkeypatch.setattr(minhash, "mix", lambda x, seed=0: np.zeros_like(x) if seed in (11, 12) else real(x, seed))
    rows = corpus(4, docs=6)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == groups_brute(rows, 2, 80)


def test_cells_bound_the_intersection():
    r = np.random.default_rng(1)
    for _ in range(200):
        n, m, k = r.integers(1, 400, 3)
        both = r.integers(0, 2**63, k, dtype=np.uint64)
        a, b = (np.unique(np.concatenate((both, r.integers(0, 2**63, x, dtype=np.uint64)))) for x in (n, m))
        at = [np.minimum(255, np.bincount((x >> np.uint64(58)).astype(int), minlength=64)).astype(np.uint8) for x in (a, b)]
        linked = 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        assert not linked or minhash.possible(at[0][None], np.array([len(a)]), at[1], len(b), 80)[0]
    full = np.full((1, 64), 255, np.uint8)
    assert minhash.possible(full, np.array([50_000]), full[0], 60_000, 80)[0]


def test_a_large_group_takes_further_hubs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUBS", 2)
    monkeypatch.setattr(minhash, "STAR", 5)
    monkeypatch.setattr(minhash, "SPREAD", 7)
    r = random.Random(7)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(r.choice([3, 4, 5, 6])):
            w[r.randrange(60)] = f"e{r.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == groups_brute(rows, 2, 80)


def test_superminhash_estimates_jaccard_with_less_variance():
    r = np.random.default_rng(3)
    m, errors = 64, []
    for _ in range(120):
        a = r.integers(0, 2**63, 30, dtype=np.uint64)
        b = np.concatenate((a[:20], r.integers(0, 2**63, 10, dtype=np.uint64)))
        sig = minhash.superminhash(np.concatenate((a, b)), np.repeat([0, 1], 30), 2, m)
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.25 / m * 1.1  # not above plain MinHash


def test_superminhash_levels_are_permutations():
    one = minhash.superminhash(np.array([12345], np.uint64), np.array([0]), 1, 50)[0]
    assert sorted((one >> np.uint64(32)).tolist()) == list(range(50))  # a single element holds each place, at a level of its own


def test_components_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, x) for x in range(501, 560)] + [(900, 901), (901, 902), (902, 900)]
    random.Random(1).shuffle(edges)
    got = {x["node"]: x["component"] for x in minhash.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{i: 500 for i in range(501, 560)}, 901: 900, 902: 900}


def repeats_brute(rows, window):
    where = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for k, (_, w) in enumerate(split):
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i : i + window]), []).append((k, i))
    gone = [set() for _ in split]
    for places in where.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + window))
    return sorted(((d, len(w), len(g), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in g)).hexdigest()) for (d, w), g in zip(split, gone, strict=True)), key=str)


@pytest.mark.parametrize(("window", "hot"), [(8, 256), (8, 2), (12, 3), (35, 256), (8, 150_000)])
def test_repeated_passages(spark, monkeypatch, window, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    rows = corpus(window) + EDGES + [(800_000, "x y " * 40), (800_001, "lone words of a text " * 1)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)), window).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got), key=str) == repeats_brute(rows, window)


def test_repeats_of_an_empty_table(spark):
    assert substring.op7_substring(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fm_index_counts_and_statistics():
    r = np.random.default_rng(1)
    text = r.integers(1, 5, 400)
    text[[50, 51, 200]] = 0
    index = fmindex.FMIndex(text, 32)

    def count(p):
        return sum(text[i : i + len(p)].tolist() == list(p) for i in range(len(text) - len(p) + 1))

    for _ in range(100):
        i, n = r.integers(0, 380), r.integers(1, 8)
        p = text[i : i + n]
        if (p == 0).any():
            continue
        lo, hi = np.array([0]), np.array([index.n])
        for c in p[::-1]:
            lo, hi = index.step(np.array([c]), lo, hi)
        assert hi[0] - lo[0] == count(p)
    ends = np.arange(1, 401)
    got = index.matching(text, ends, 12)
    for e in ends:
        n = 0
        while n < 12 and e - n - 1 >= 0 and text[e - n - 1] != 0 and count(text[e - n - 1 : e]) >= 2:
            n += 1
        assert got[e - 1] == n


def topk_brute(rows, k):
    ok = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("n", [3, 15, 200])
def test_topk(spark, monkeypatch, n):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 300)
    monkeypatch.setattr(topk, "TURN", 3)
    monkeypatch.setattr(topk, "CHUNK", 16)
    r = random.Random(n)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)] if r.random() < 0.7 else [0.5] * 6) for i in range(n)]
    rows += [(1000, None), (1001, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (1020, [float("nan")] * 6), (1040, [float("inf")] * 6), (None, [0.2] * 6), (1060, [0.3, 0.3]), (1080, [])]
    got = topk.op8_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)).collect()
    want = topk_brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 20)
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got) == want


def test_topk_of_large_components_and_no_rows(spark):
    rows = [(0, [3e9, -1.0]), (1, [2e9, 5.0]), (2, [-2e9, 1.0])]
    got = sorted(map(tuple, topk.op8_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("query_id", "rank", "vec_id", "score").collect()))
    assert [(q, k, v) for q, k, v, _ in got] == [(0, 1, 1), (0, 2, 2)]
    assert topk.op8_topk(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_against_plain_python(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as p

    r = random.Random(11)
    good = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.choice(['lo', 'mi', 'ra', 'te'])}{r.choice(['n', 's', 'd', ''])}{r.randrange(40)}" for _ in range(n))
    rows = [(i, good(90)) for i in range(120)] + [(200 + i, good(40).upper().replace(" ", "!! ")) for i in range(60)]
    rows += [(300 + i, rows[i][1]) for i in range(8)]  # copies
    passage, item = good(60), good(25)
    rows += [(400 + i, good(50) + " " + passage + " " + good(50)) for i in range(3)]
    rows += [(500, good(50) + " " + item + " " + good(40)), (600, ""), (601, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, int(not 200 <= d < 300)) for d, _ in rows if d < 300], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = docs, {}
    for name, stage in p.STAGES:
        now = p.durable(stage(spark, now, str(tmp_path)))
        seen[name] = {x["doc_id"] for x in now.collect()}
        if name != p.STAGES[-1][0]:
            assert now.columns == docs.columns
    assert not seen["quality"] & set(range(200, 260)) and set(range(120)) <= seen["quality"]
    assert seen["quality"] - seen["near_dedup"] == set(range(300, 308))
    assert seen["substring_dedup"] == seen["near_dedup"]
    assert seen["substring_dedup"] - seen["decontaminate"] == {500}
    got = {x["doc_id"]: x["n_tokens"] for x in now.collect()}
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = dict(rows)
    for d in got:
        want = text[d] or ""
        if 400 <= d < 403:
            want = want.replace(passage + " ", "")
        assert got[d] == len(t.encode(want, add_special_tokens=False).ids)
    assert p.run(spark, str(tmp_path)).count() == len(got)
