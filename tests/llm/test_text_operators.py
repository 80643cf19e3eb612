"""Operators on whole texts: edge rows for each, and results against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kinfold.llm import bpe, decontam, language, license, quality, sharding, toxicity

EDGES = [(1, ""), (2, None), (3, "   \n\t "), (4, "one"), (None, "null id text here"), (5, "word " * 30_000), (6, "same text"), (6, "same text"), (7, "12345 !!! ..."), (8, "İ ß ﬁ 中文 Σ\x1c x <|endoftext|> é")]


def edges(spark):
    """Nulls, blanks, a very long text, repeated rows, and a column that clashes with what operators add."""
    return spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("lang", F.when(F.col("doc_id") == 4, None).otherwise("en")).withColumn("source", F.lit(None).cast("string"))


def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 1), (3, None, None), (4, 0, 0), (4, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def empty(df):
    return df.where("false")


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_bpe_equals_the_tokenizer_on_whole_texts(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    t = Tokenizer.from_file(path)
    r = random.Random(3)
    signs = ["a", "É", "é", " ", "\n", "\t", "\x1c", "\xa0", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "!", "!!", "1", "ß", "中文", "́", "İ", " the", "\r\n", "\x85", "x" * 50, "\U0001f600", "ﬁ", "가"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 300))) for _ in range(300)] + ["word and more " * 2000, "x" * 200_000, "no" + " blank" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(spark.createDataFrame(EDGES, "doc_id long, text string"))
    for row in bpe.encode(df, path).collect():
        want = t.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == b"".join(i.to_bytes(4, "little") for i in want)
        assert row["decoded"] == t.decode(want, skip_special_tokens=False)
    back = bpe.decode(bpe.encode(df, path).drop("decoded"), path)
    assert back.where(F.col("decoded").isNull()).count() == 0


def test_bpe_digests_and_small_chunks(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    t = Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "CUT_BITS", 3)
    monkeypatch.setattr(bpe, "LONGEST", 40)
    coder = bpe.Coder(open(path, encoding="utf-8").read())
    texts = ["the quick brown fox's " * 20, "y" * 500, "", " ", "ünïcödé wörds änd möre " * 9]
    assert [x.tolist() for x in coder.encode([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    row = bpe.op1_bpe(spark.createDataFrame([(1, None)], "doc_id long, text string"), path).first()
    none = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, none, none)


def test_classifiers_take_edges_and_empty_tables(spark):
    docs, lab = edges(spark), labels(spark)
    for out in (quality.op10_quality(docs, lab), toxicity.op2_toxicity(docs, lab)):
        rows = out.collect()
        assert len(rows) == len(EDGES)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert quality.op10_quality(empty(docs), lab).count() == toxicity.op2_toxicity(empty(docs), lab).count() == 0
    assert quality.op10_quality(docs, empty(lab)).count() == toxicity.op2_toxicity(docs, empty(lab)).count() == len(EDGES)


def prose(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


def test_quality_held_out(spark):
    r = random.Random(5)
    rows = [(i, prose(r, 60) if i % 2 else prose(r, 30).upper().replace(" ", "!! "), i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = quality.op10_quality(docs.drop("quality"), docs.select("doc_id", "quality")).join(docs.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(out) > 50
    assert sum(x["predicted"] == x["quality"] for x in out) >= 0.97 * len(out)


def test_toxicity_held_out_and_passages(spark):
    r = random.Random(6)
    rows = []
    for i in range(900):
        w = prose(r, 80).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(["vileword", "nastiest", "rottenly"]))
        rows.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.op2_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic")).join(docs.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(x["predicted"] == x["toxic"] for x in out) >= 0.97 * len(out)


def test_segments_are_all_maximal_ones():
    import numpy as np

    def brute(s):
        """By definition: repeatedly the segment of greatest sum (least length), then the rest on both sides."""
        best = max(((sum(s[i:j]), -(j - i), -i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return [*brute(s[:i]), (best[0], i, j), *((v, a + j, b + j) for v, a, b in brute(s[j:]))]

    r = random.Random(1)
    for _ in range(300):
        s = [r.choice([-3, -2, -1, 1, 2, 4]) for _ in range(r.randint(0, 14))]
        got = sorted((round(v), a, b) for v, a, b in toxicity.segments(np.array(s, float)))
        assert sum(v for v, _, _ in got) == sum(v for v, _, _ in brute(s))
        assert all(sum(s[a:b]) == v for v, a, b in got)


def test_language_code_lengths_are_those_of_ppm(spark):
    import math

    texts = {"aa": [b"abracadabra abracadabra"], "bb": [b"the cat sat on the mat"]}
    m = language.Model(texts)

    def tree(lang):
        out = {}
        for t in texts[lang]:
            t = language.START + t
            for i in range(language.ORDER, len(t)):
                for k in range(language.ORDER + 1):
                    c = out.setdefault(t[i - k : i], {})
                    c[t[i]] = c.get(t[i], 0) + 1
        return out

    for j, lang in enumerate(m.langs):
        known = tree(lang)
        for text in (b"abra", b"the cat", b"zebra", b"\xc3\xa9 at"):
            t, bits = language.START + text, 0.0
            for i in range(language.ORDER, len(t)):
                for k in range(language.ORDER, -1, -1):
                    c = known.get(t[i - k : i])
                    if c is None:
                        continue
                    total = sum(c.values()) + len(c)
                    if t[i] in c:
                        bits += math.log2(total / c[t[i]])
                        break
                    bits += math.log2(total / len(c))
                else:
                    bits += 8
            assert abs(m.bits([text])[0, j] - bits) < 1e-3


def test_language_edges(spark):
    docs = edges(spark)
    rows = language.op3_language(docs).collect()
    assert len(rows) == len(EDGES)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert language.op3_language(empty(docs)).count() == 0
    assert all(r["lang_pred"] == "und" for r in language.op3_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect())


def test_language_held_out(spark):
    r = random.Random(8)
    words = {"xx": ["lorem", "ipsum", "dolor", "amet"], "yy": ["brown", "house", "green", "mouse"]}
    rows = [(i, " ".join(r.choice(words[g]) for _ in range(20)), g) for i in range(200) for g in ["xx" if i % 2 else "yy"]]
    out = language.op3_language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    assert len(out) > 20 and all(x["lang_pred"] == ("xx" if x["doc_id"] % 2 else "yy") for x in out)


def decontaminate_brute(text, items, window=10):
    import re

    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, names = words(text), set(), set()
    for item, t in items:
        b = words(t)
        k = min(window, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                names.add("" if item is None else str(item))
    return len(w), len(hit), sorted(names)


def test_decontamination(spark, monkeypatch):
    r = random.Random(2)
    vocab = ["Ab", "cd", "É", "x1", "zz", "the", "OF"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((14, 30, 3, 1, 10))] + [(10, ""), (11, None), (None, "secret null id item of more than ten words in all of it")]
    docs = [(i, text(40)) for i in range(40)] + [(100 + i, text(5) + (t or "") + text(5)) for i, (_, t) in enumerate(items)] + EDGES
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((d, *decontaminate_brute(t, items)[:2], ",".join(decontaminate_brute(t, items)[2])) for d, t in docs), key=str)
    for limit in (decontam.BROADCAST_BYTES, 0):  # by broadcast, and by the way beyond its bound
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
        got = decontam.contamination(df, bench).collect()
        assert sorted(((x["doc_id"], x["n_words"], x["n_hit"], ",".join(x["items"])) for x in got), key=str) == want
    assert decontam.drop_contaminated(df, bench).count() == sum(w[2] == 0 for w in want)
    assert decontam.op4_decontaminate(df, empty(bench)).where("contaminated").count() == 0
    assert decontam.op4_decontaminate(empty(df), bench).count() == 0


@pytest.mark.parametrize("by", ["rows", "bytes"])
def test_sharding_laws(spark, by):
    r = random.Random(4)
    rows = [(i, "t" * r.randint(0, 300), r.choice(["en", "de", None]), r.choice(["s1", "s2"])) for i in range(501)] + [(None, None, "en", "s1"), (3, "ttt", "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sharding.shard(df, 40, by).collect()
    assert sorted(((x["doc_id"], x["size"], x["text_crc32"]) for x in got), key=str) == sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _, _ in rows), key=str)
    shards = {}
    for x in got:
        shards.setdefault(x["shard"], []).append(x)
    assert all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in shards.values())
    order = [x["curve"] for s in sorted(shards) for x in sorted(shards[s], key=lambda x: x["slot"])]
    assert order == sorted(order)
    if by == "rows":
        plain = sorted(got, key=lambda x: (x["curve"], x["text_crc32"], x["doc_id"] is not None, x["doc_id"] or 0))
        assert [x["shard"] for x in plain] == [i * 40 // len(plain) for i in range(len(plain))]
        sizes = [len(shards.get(s, [])) for s in range(40)]
        assert max(sizes) - min(sizes) <= 1
    else:
        sums = [sum(x["size"] for x in v) for v in shards.values()]
        assert max(sums) - min(sums) <= 2 * 316
    assert sharding.shard(empty(df), 40, by).count() == 0


def test_curve_visits_neighbours():
    place = {i: c for c, i in enumerate(sharding.curve(3, 3))}
    assert sorted(place) == list(range(512))
    cells = [[place[i] >> 3 * d & 7 for d in range(3)] for i in range(512)]
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in zip(cells, cells[1:], strict=False))


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * i, "en", "s") for i in range(80)], "doc_id long, text string, lang string, source string")
    sharding.write_shards(df, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 80 and {r["count"] for r in back.groupBy("shard").count().collect()} == {10}


def test_write_shards_of_repeated_rows_and_empty_tables(spark, tmp_path):
    rows = [(1, "same", "en", "s", "x", 7)] * 20 + [(None, None, None, None, "y", 7)] * 2 + [(i, "x" * i, "en", "s", "z", 7) for i in range(18)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `row` string, `slot` int")
    sharding.write_shards(df, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {5}
    assert sorted(map(tuple, back.select(*df.columns).collect()), key=str) == sorted(rows, key=str)
    sharding.write_shards(empty(df), str(tmp_path / "none"), 8)


def test_shards_prune_by_every_dimension(spark):
    """Of the shards by rows as they come nearly all can hold a language, a source or a size; along the curve far fewer."""
    r = random.Random(3)
    rows = [(i, "t" * r.randint(1, 4000), r.choice(["de", "en", "es", "fr"]), f"src{r.randrange(20)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    at = {x["doc_id"]: x["shard"] for x in sharding.shard(df, 40).collect()}
    for value in (lambda x: x[2], lambda x: x[3], lambda x: len(x[1]) // 500):
        for place, most in ((lambda x: at[x[0]], 0.5), (lambda x: x[0] * 40 // len(rows), None)):
            held = {}
            for x in rows:
                held.setdefault(place(x), []).append(value(x))
            left = sum(sum(min(h) <= v <= max(h) for h in held.values()) for v in set(map(value, rows))) / 40 / len(set(map(value, rows)))
            assert left < most if most else left > 0.85


def test_licenses(spark):
    rows = [(100, "Some text.\nReleased under the MIT License.\nMore."), (101, "licensed under CC BY-NC 4.0"), (102, "Nothing is licensed here at all."), (103, "This work is licensed\nunder the GNU General Public License, version 3.")]
    got = {r["doc_id"]: (r["n_matches"], r["licenses"]) for r in license.op9_license(spark.createDataFrame(rows + EDGES, "doc_id long, text string")).collect()}
    assert got[100] == (1, "MIT") and got[101] == (1, "CC-BY-NC-4.0") and got[102] == (0, "") and "GPL-3.0" in got[103][1]
    assert all(got[d] == (0, "") for d, _ in EDGES)
    assert license.op9_license(empty(edges(spark))).count() == 0
