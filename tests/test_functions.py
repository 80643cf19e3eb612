"""Scalar functions on hand-made rows, one row a trap."""

from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.functions import sequences as S


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("x")).first()["x"]


def test_kmers_of_short_null_and_long(spark):
    df = spark.createDataFrame([(1, "ACDEFGH"), (2, None), (3, "ACDEFGHIK"), (4, "")], "id int, seq string")
    got = S.explode_kmers(df, "seq").select("id", "pos", "kmer").collect()
    assert sorted(map(tuple, got)) == [(3, 0, "ACDEFGHI"), (3, 1, "CDEFGHIK")]


def test_valid_kmer_keeps_both_cases(spark):
    for kmer, ok in (("ACDEFGHI", True), ("acdefghi", True), ("ACDEFGHX", False), ("ACDE GHI", False)):
        assert one(spark, kmer, S.valid_kmer) is ok


def test_callable_windows_skip_the_one_before_an_ambiguous_letter(spark):
    def brute(s):
        return sum(1 for p in range(len(s) - 7) if not set(s[p : p + 8]) & set("*X") and (p + 8 == len(s) or s[p + 8] not in "*X"))

    for s in ("ACDEFGHIX", "ACDEFGHIKX", "ACDEFGHI", "ACDEFGHIKL", "X" * 20, "ACDEFGHIK*ACDEFGHIKLM", "", "ACDEFGHIKLMX"):
        assert one(spark, s, S.callable_windows) == brute(s), s


def test_encoding(spark):
    assert one(spark, "AAAAAAAA", S.encode20) == 0
    assert one(spark, "YYYYYYYY", S.encode20) == 20**8 - 1
    assert one(spark, "AAAAAAAX", S.encode20) is None
    assert one(spark, "PHSQRWTN", lambda c: S.decode20(S.encode20(c))) == "PHSQRWTN"


def test_dna(spark):
    assert one(spark, "ACGTN", S.reverse_complement) == "NACGT"
    assert one(spark, "ATGGCCTAA", S.translate_dna) == "MA*"
    assert one(spark, "atgnnn", S.translate_dna) == "Mx"
    assert one(spark, "AT", S.translate_dna) == ""
    assert one(spark, "ATGGCC", lambda c: F.array_join(S.six_frames(c), "|")) == "MA|W|G|GH|A|P"
    assert one(spark, "TTGAAATAG", S.starts_and_stops) is True
    assert one(spark, "AAAAAATAG", S.starts_and_stops) is False


def test_checksum_folds_ascii_alone(spark):
    assert one(spark, "straße", S.md5_id) == one(spark, "STRAßE", S.md5_id) != one(spark, "STRASSE", S.md5_id)


def test_good_sequence_edges(spark):
    assert one(spark, "A" * 25, S.is_good_sequence) is False
    assert one(spark, "A" * 26, S.is_good_sequence) is True
    assert one(spark, "A" * 40 + "X" * 10, S.is_good_sequence) is False


def test_comments(spark):
    assert tuple(one(spark, "kinase # fragment", A.split_comment)) == ("kinase", "#", "fragment")
    assert tuple(one(spark, "kinase", A.split_comment)) == ("kinase", "", "")
    assert one(spark, "X # frag", A.is_truncated) is True
    assert one(spark, "X ## frag", A.is_truncated) is False
    assert one(spark, "FIG001234: kinase # note", A.strip_function) == "kinase"
    assert one(spark, "A / B; C @ D # x", A.roles) == ["A", "B", "C", "D"]
    for text in ("kinase #note", "kinase#note", "kinase ## a # b", "FIG001234 (x): kinase   #"):
        assert one(spark, text, A.strip_function) == "kinase"
    assert one(spark, "A / B #note", A.roles) == one(spark, "A / B#note", A.roles) == ["A", "B"]


def test_ids_and_formats(spark):
    assert tuple(one(spark, " some kinase [Escherichia coli]", A.definition)) == ("some kinase", "Escherichia coli")
    assert one(spark, "fig|83333.1.peg.7", A.genome_of) == "83333.1"
    assert one(spark, "gnl|md5|aa", A.genome_of) is None
    assert one(spark, "gi|12|ref|NP_1\x01gi|13", A.nr_id) == "gi|12"
    assert one(spark, "a b,c:d", A.escape_id) == "a%20b%2Cc%3Ad"
    assert one(spark, "a b,c:d", lambda c: A.unescape_id(A.escape_id(c))) == "a b,c:d"
    assert one(spark, "00:11:46", A.minutes) == 11 + 46 / 60
    assert tuple(one(spark, "b123,dnaA,x|y", A.names_of)) == ("dnaA", "dnaA")
    assert tuple(one(spark, "abcD,b123,LocusTag:ECs1,wxyz,last", A.names_of)) == ("abcD", "ECs1")
    assert tuple(one(spark, "locus|L1,dnaA", A.names_of)) == (None, "L1")
    assert tuple(one(spark, "gi:1,x|y", A.names_of)) == (None, None)
    assert one(spark, "ID=1;Name=x", A.attributes) == {"ID": "1", "Name": "x"}
    assert one(spark, "624.1127", lambda c: A.cache_path("/c", c)) == "/c/624/624.1127"
    assert one(spark, "7.1", lambda c: A.cache_path("/c", c)) == "/c/007/7.1"


def test_recall_classes(spark):
    rows = [("a", "a", "unchanged"), ("hypothetical protein", "a", "added"), ("a", "", "lost"), ("a", "b", "changed"), ("hypothetical protein", "", "unchanged")]
    df = spark.createDataFrame(rows, "o string, n string, want string")
    assert all(r[0] == r[1] for r in df.select(A.recall_class(F.col("o"), F.col("n")), "want").collect())


def test_windows_of_runs_are_those_of_letters(spark):
    texts = ["ACDEFGHIKL", "acdefghiX", "ACDEFGHI*", "ACDEFGHIx", "größe ACDEFGHIKLM ÄÖ", "中\U0001f600ACDEFGHIKXACDEFGHIK", "BACDEFGHIKLMNB", "", "ACDEFGH", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string")
    pick = lambda x: sorted(map(tuple, x.select("id", "pos", "kmer").collect()))
    plain = S.explode_kmers(df, "seq")
    assert pick(S.valid_windows(df, "seq", most=2)) == pick(plain.where(S.valid_kmer(plain["kmer"])))
    called = S.call_kmers(df, "seq")
    got = pick(S.valid_windows(df, "seq", calling=True))
    assert got == pick(called.where(S.valid_kmer(called["kmer"]))) and len(got) > 10


def test_learning_takes_windows_from_runs(spark):
    """A row for each window of letters alone: no plan splits a text into all its letters and windows."""
    from kinfold.operators import signatures as G

    seqs = spark.createDataFrame([(1, "f", "ACDEFGHIK and ACDEFGHIK")], "id int, function string, seq string")
    sigs = spark.createDataFrame([("ACDEFGHI", "f", 1.0, 2, 3, "o")], "kmer string, function string, weight double, mean long, avg_from_end int, otu string")
    for rows in (G.occurrences(seqs), G.hits(seqs, sigs), G.call_hits(seqs, sigs, amino=True)):
        assert "posexplode" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["pos"] for r in G.call_hits(seqs, sigs, amino=True).collect()) == [0, 14]
