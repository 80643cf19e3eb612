"""Source divergence, spelling variants and line dedup against plain Python on small tables with edges."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinfold.llm import divergence, lines, spelling

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit_plain(rows, ranks, least):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(A_TO_Z)), la or "", s or "") for t, la, s in rows]
    held = defaultdict(Counter)
    for words, la, _ in docs:
        held[la].update(set(words))
    keep = {la: sorted(t for t, n in c.items() if n >= least) for la, c in held.items()}
    groups, langs = defaultdict(Counter), defaultdict(Counter)
    for words, la, s in docs:
        own = [w for w in words if w in set(keep[la])]
        groups[la, s].update(own)
        langs[la].update(own)
    share = lambda c, t, v: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v)
    out = []
    for (la, s), c in groups.items():
        terms, v = keep[la], len(keep[la])
        f = lambda p, q: (p - q) ** 2 // q
        pairs = [(o, sum(f(share(c, t, v), share(groups[la, o], t, v)) for t in terms)) for (lb, o) in list(groups) if lb == la and o != s]
        own = [(t, f(share(c, t, v), share(langs[la], t, v))) for t in terms if c[t] > 0 and share(c, t, v) > share(langs[la], t, v)]
        for part, items in (("pair", pairs), ("term", own)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out += [(la, s, part, i, n, r) for r, (i, n) in enumerate(ranked, 1) if part == "pair" or r <= ranks]
    return sorted(out)


@pytest.mark.parametrize(("slice_", "seats"), [(100_000, 8), (40, 2), (25, 3)])
def test_source_divergence(spark, monkeypatch, slice_, seats):
    monkeypatch.setattr(divergence, "SLICE", slice_)
    monkeypatch.setattr(divergence, "RESIDENTS", seats)
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 70)
    r = random.Random(slice_)
    word = lambda: r.choice(["Ab", "ab", "straße", "ÀB", "x-y", "a1b", "漢字"]) if r.random() < 0.2 else f"w{chr(97 + min(r.randrange(26), r.randrange(26)))}{chr(97 + r.randrange(3))}"
    rows = [(" ".join(word() for _ in range(r.choice([0, 3, 30, 200]))), r.choice(["en", "en", "de", None, ""]), r.choice(["s1", "s2", "s3", "é", "z", None])) for _ in range(90)]
    rows += [(None, "en", "only-null"), ("", "fr", "a"), ("rare words here", "fr", "b"), ("12 34", "xx", "alone"), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("value", F.lit(1)).withColumn("item", F.lit("mine")).repartition(5)
    got = sorted(tuple(x) for x in divergence.audit(df, ranks=5).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audit_plain(rows, 5, 3)
    assert divergence.op11_divergence(df.where("false")).count() == 0


@pytest.mark.parametrize("seats", range(1, 9))
def test_every_two_seats_meet_once_and_none_meets_two_in_a_round(spark, seats):
    pairs = spark.range(seats).crossJoin(spark.range(seats).withColumnRenamed("id", "other")).where("id < other")
    at = pairs.select("id", "other", *(c.alias(n) for c, n in zip(divergence.meeting(F.col("id"), F.col("other"), F.lit(seats)), ("round", "host"), strict=True))).collect()
    assert all(x["host"] in (x["id"], x["other"]) for x in at)
    busy = Counter((x["round"], s) for x in at for s in (x["id"], x["other"]))
    assert all(n == 1 for n in busy.values())
    visits = spark.range(seats).select(F.explode(divergence._visits(F.col("id").cast("int"), F.lit(seats))).alias("v"), "id").select("id", "v.*").collect()
    met = Counter(frozenset((x["id"], x["seat"])) for x in visits)
    assert len(met) == seats * (seats + 1) // 2 and set(met.values()) == {1}


def test_shares_stay_exact_beyond_64_bits(spark):
    n, total, kept = 5 * 10**17, 9 * 10**17, 12345
    got = spark.range(1).select(divergence._share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (total + kept)


def variants_plain(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(around[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(around[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def test_spelling_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 50)
    r = random.Random(3)
    base = ["spelling", "Variants", "grouping", "aaaaaaaa", "abababab", "éclairée", "aäöüßñçé", "anagrams", "gramsana", "longestwordofall"]
    letter = "abcdeéß"

    def bent(w):
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            k = r.randrange(len(w))
            w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letter) + w[k:], w[:k] + r.choice(letter) + w[k + 1 :]])
        return w

    rows = [(i, " ".join(base[min(r.randrange(10), r.randrange(10))] if r.random() < 0.6 else bent(r.choice(base)) for _ in range(150))) for i in range(40)]
    chain = [("chainone", 300), ("chaintwo", 2)] + [(w, n) for w, n in (("rootword", 2500), ("rootwort", 220), ("rootwart", 21), ("rootwarm", 2))]
    rows += [(100 + i, ";".join([w] * n)) for i, (w, n) in enumerate(chain)]
    rows += [(None, "spelling spelling"), (7, None), (8, ""), (9, "ÀÉÎÕÜÞß ÀÉÎÕÜÞß àéîõüþß àéîõüþß x÷y×zabc x÷y×zabc"), rows[0], (200, "b" * 3000 + " " + "b" * 3000 + " " + "b" * 2999 + "7" + "b" * 2999)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("mine")).withColumn("key", F.lit(1)).repartition(3)
    got = sorted((x["word"], x["form"] or "", x["root"], x["n"], x["n_near"], -1 if x["form_n"] is None else x["form_n"]) for x in spelling.op12_spelling(df).collect())
    want = variants_plain(rows)
    assert got == want
    assert any(x[2] not in (x[0], x[1]) for x in want)  # a chain of forms is among them
    assert spelling.op12_spelling(df.where("false")).count() == 0


def lines_plain(rows, least, docs):
    blanks, order = " \t\n\v\f\r", lambda d: (d is not None, d)
    held = defaultdict(set)
    key = lambda x: x.strip(blanks).translate(A_TO_Z)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held[key(x)].add(order(d))
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        keep = [x for x in all_ if len(held.get(key(x), ())) < docs or max(held[key(x)]) == order(d)]
        out.append((str(d), len(all_), len(all_) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("parts", "kind"), [(1, "long"), (4, "long"), (16, "long"), (7, "string")])
def test_line_dedup(spark, parts, kind):
    r = random.Random(parts)
    pool = [f"line number {i} with a few words" for i in range(25)] + ["é" * 19, "é" * 20, "x" * 19, "  Padded and Mixed CASE line \t", "padded and mixed case line", " no ascii blank stripped here "]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.8 else f"own line {i} of some length {r.random()}" for _ in range(r.choice([1, 2, 10, 40])))) for i in range(60)]
    rows += [(100 + i, "the one very common line of all\n" + r.choice(pool)) for i in range(80)]
    rows += [(i, "the line of two documents only") for i in (500, 501)]
    rows += [(None, pool[0]), (None, pool[1] + "\n" + pool[0]), (600, None), (601, ""), (602, "\n"), (603, "\r\n" + pool[2] + "\r\n"), rows[5], rows[5], (7, "another row of id 7\n" + pool[3])]
    rows.append((700, "\n".join(pool * 40)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        if kind == "string":
            rows = [(None if d is None else f"d{d}", t) for d, t in rows]
        df = spark.createDataFrame(rows, f"doc_id {kind}, text string").withColumn("n_lines", F.lit("mine")).withColumn("__keep", F.lit(1)).withColumn("h1", F.lit(2)).repartition(3)
        got = sorted((str(x["doc_id"]), x["n_lines"], x["n_dropped"], x["kept_sha256"]) for x in lines.op13_lines(df).collect())
        assert got == lines_plain(rows, 20, 3)
        assert lines.op13_lines(df.where("false")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_line_dedup_passes_columns_on_and_gives_bitmaps(spark):
    rows = [(i, f"repeated line of thirty letters\nown {i}", f"s{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x["doc_id"]: x for x in lines.drop_repeated_lines(df).collect()}
    assert out[0].asDict() == {"doc_id": 0, "text": rows[0][1], "source": "s0", "n_lines": 2, "n_dropped": 1, "kept_text": "own 0"}
    assert out[4]["kept_text"] == rows[4][1]
    marks = {x["did"]: zlib.decompress(x["keep"]) for x in lines.keep_bitmaps(df).collect()}
    assert marks == {i: b"\xfe" for i in range(4)}
