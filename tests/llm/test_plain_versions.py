"""Learnt operators against plain Python versions of their formulas; columns that clash; the tables that operators leave behind."""

import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import common, decontam, language, license, minhash, quality, sharding, substring, toxicity

NAMES = ["quality_score", "toxicity", "passages", "lang_pred", "score", "_letters", "did", "th", "row", "rid", "c", "n", "_did", "_th", "_rank", "_crc", "_doc", "runs", "kept_text", "n_matches", "dice", "ids", "label", "__kinfold_did"]


def clashing(spark):
    rows = [(i, f"word{i % 3} and some more words of text number {i} " * 3) for i in range(8)] + [(None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *(F.lit("mine").alias(n) for n in NAMES), F.lit("en").alias("lang"), F.lit("s").alias("source"))


def test_columns_that_clash(spark, tmp_path):
    df = clashing(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "word1 and some more words of text number 4 word1")], "item_id long, text string")
    w, cut = quality.fit(df, labels)
    known, law = toxicity.fit(df, labels)
    for out, own in (
        (quality.score(df, w, cut), {"quality_score"}),
        (toxicity.score(df, known, law), {"toxicity", "passages"}),
        (language.identify(df, language.fit(df)), {"lang_pred", "score", "_letters"}),
        (substring.remove_repeats(df, 5), {"n_words", "n_removed", "kept_text", "runs", "did", "th"}),
        (license.scan(df), {"n_matches", "licenses", "dice"}),
        (minhash.keep_one(df), set()),
        (decontam.drop_contaminated(df, bench), set()),
    ):
        rows = out.collect()
        assert rows and all(r[n] == "mine" for r in rows for n in NAMES if n not in own)
    assert decontam.drop_contaminated(df, bench).count() == 9
    sharding.write_shards(df.withColumn("shard", F.lit("gone")), str(tmp_path / "s"), 2)
    assert spark.read.parquet(str(tmp_path / "s")).where("did = 'mine' and row = 'mine'").count() == 10


def test_segments_by_definition_and_in_linear_time():
    def brute(s, first=0):
        best = max(((s[i:j].sum(), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        _, i, j = best
        return [*brute(s[:i], first), (first + i, first + j), *brute(s[j:], first + j)]

    r = np.random.default_rng(2)
    for _ in range(300):
        s = r.normal(-0.2, 1, r.integers(0, 25))
        assert sorted((a, b) for _, a, b in toxicity.segments(s)) == brute(s)
    for n in (200_000, 400_000):  # [1, -2] again and again, and ever lower starts in front of ever higher ones
        began = time.process_time()
        assert len(toxicity.segments(np.tile([1.0, -2.0], n))) == n
        assert len(toxicity.segments(np.tile([1.0, -0.5, 1.0, -3.0], n // 2))) == n // 2
        assert time.process_time() - began < 20


def test_toxic_units_and_law_by_plain_python(spark, monkeypatch):
    r = random.Random(9)
    plain = [f"plain{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(300):
        w = [r.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            w[5:7] = r.sample(["vileone", "nastyone", "rottenone"], 2)
        rows.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    monkeypatch.setattr(toxicity, "_distinct", lambda sample: sample)
    known, law = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    import zlib

    used = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 3 != 1]
    size, n = [sum(x[2] == y for x in used) for y in (0, 1)], {}
    for _, t, y in used:
        for u in {u for w in t.encode().split() for u in toxicity.units(w)}:
            n.setdefault(u, [0, 0])[y] += 1
    n = {u: c for u, c in n.items() if sum(c) >= toxicity.LEAST_DOCS}
    tests, all_ = math.log(max(50, len(n))), sum(size)
    least, mass, want = math.sqrt(2 * tests - math.log(4 * math.pi * tests)), min(toxicity.PRIOR, all_ / 16), {}
    for u, (a, b) in n.items():
        prior = mass * (a + b) / all_ / all_
        y0, y1 = a + prior * size[0], b + prior * size[1]
        r0, r1 = size[0] * (1 + mass / all_) - y0 + 1, size[1] * (1 + mass / all_) - y1 + 1
        odds = math.log(y1 / r1) - math.log(y0 / r0)
        if odds / math.sqrt(1 / y0 + 1 / y1 + 1 / r0 + 1 / r1) >= least:
            want[u] = odds
    assert known.keys() == want.keys() and all(abs(known[u] - want[u]) < 1e-9 for u in want) and known
    for x in toxicity.score(docs, known, law).collect():
        words = x["text"].encode().split()
        s = np.array([max((want.get(u, -toxicity.LOSS) for u in toxicity.units(w)), default=-toxicity.LOSS) for w in words])
        stat = sum(max(0.0, law.lam * v - law.log_k - math.log(len(words))) for v, _, _ in toxicity.segments(s))
        assert abs(x["toxicity"] - 1 / (1 + math.exp(-min(30, max(-30, law.base + law.slope * math.log1p(stat)))))) < 1e-9


def test_ftrl_by_plain_python():
    r = random.Random(4)
    rows = []
    for _ in range(60):
        b = sorted(r.sample(range(40), r.randint(1, 8)))
        rows.append((np.array(b), np.array([r.uniform(0.1, 1) for _ in b]), r.randint(0, 1)))
    z, n, w = ({} for _ in range(3))
    for _ in range(2):
        for b, x, y in rows:
            p = 1 / (1 + math.exp(-sum(w.get(i, 0.0) * v for i, v in zip(b.tolist(), x.tolist(), strict=True))))
            for i, v in zip(b.tolist(), x.tolist(), strict=True):
                g, old = (p - y) * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / quality.ALPHA * w.get(i, 0.0)
                n[i] = old + g * g
            for i in b.tolist():
                w[i] = 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
    got = quality.ftrl(rows, 2)
    assert all(abs(got[i] - w.get(i, 0.0)) < 1e-9 for i in range(40))


def test_quality_scores_are_dot_products(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["Good", "bad!", "x1", "fine"]) for _ in range(20)), i % 2) for i in range(60)] + [(90, "", 0), (91, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    w, cut = quality.fit(docs.drop("quality"), docs.select("doc_id", "quality"))
    for x in quality.score(docs, w, cut).collect():
        b, v = quality.features((x["text"] or "").encode(), quality.Signs())
        assert abs(x["quality_score"] - 1 / (1 + math.exp(-(sum(float(w[i]) * k for i, k in zip(b.tolist(), v.tolist(), strict=True)) - cut)))) < 1e-6


def test_language_choice_and_score(spark):
    texts = {"aa": [b"abracadabra abracadabra"], "bb": [b"the cat sat on the mat"], "cc": [b"zig zag zoo"]}
    m = language.Model(texts)
    rows = [(0, "abra cad"), (1, "the mat"), (2, "zoo zag"), (3, "qqq"), (4, "12 3"), (5, None)]
    for x in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), m).collect():
        if x["doc_id"] > 3:
            assert (x["lang_pred"], x["score"]) == ("und", 0.0)
            continue
        bits = m.bits([x["text"].encode()])[0].tolist()
        assert x["lang_pred"] == m.langs[bits.index(min(bits))]
        assert abs(x["score"] - 1 / sum(2 ** (-(v - min(bits)) / 4) for v in bits)) < 1e-6


def test_bounds_of_what_is_learnt_from(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * 50, "en") for i in range(400)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    with common.scratch(spark):
        held = common.labelled_sample(docs, labels, "quality", 100_000, 40_000).agg(F.sum(F.length("text"))).first()[0]
    assert 10_000 < held < 80_000
    monkeypatch.setattr(language, "FIT_BYTES", 20_000)
    assert language.fit(docs).langs == ["en"]


def test_tables_are_deleted_with_their_block(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    docs = spark.createDataFrame([(i, "a b c d e f g " * (1 + i % 3)) for i in range(30)], "doc_id long, text string")
    out = minhash.near_duplicates(docs)
    assert out.count() == 30 and len(set(os.listdir(folder)) - before) == 1  # what the result reads
    with common.scratch(spark):
        common.durable(docs)
    assert len(set(os.listdir(folder)) - before) == 1


def test_a_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, other="": other)

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.folder_of(Session())


def test_word_hashes_tell_words_apart():
    r = random.Random(3)
    texts = ["".join(r.choice("ab \n\t\v\f\rcé") for _ in range(r.randint(0, 60))).encode() for _ in range(300)] + [b"", b" ", b"x" * 3_000_000 + b" y", b"a" * 1_048_570 + b" bc de"]
    h, n = common.word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert n.tolist() == [len(t.split()) for t in texts] and len(h) == len(words)
    held = {}
    assert all(held.setdefault(w, x) == x for w, x in zip(words, h.tolist(), strict=True)) and len(set(held.values())) == len(held)
    assert len(common.word_hashes([])[0]) == 0
