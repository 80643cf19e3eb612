"""Windows from bytes of many texts at once against plain Python."""

import random
import re

from kinfold.functions import sequences as S

LETTERS = f"[{S.AMINO}{S.AMINO.lower()}]"


def plain(text, k, calling):
    for p in range(len(text or "") - k + 1):
        if re.fullmatch(f"{LETTERS}{{{k}}}", text[p : p + k]) and not (calling and text[p + k : p + k + 1] in ("X", "*")):
            yield p, text[p : p + k]


def test_windows_are_found_in_bytes_of_many_texts(spark):
    """Runs that end where a text ends, letters of two to four bytes in front, nulls and empty texts; blocks of any size; no step in Python a window."""
    r = random.Random(8)
    texts = [None, "", "ACDEFGHI", "ACDEFGH", "ACDEFGHIX", "ACDEFGHIK*", "éACDEFGHIK", "\U0001f600ö acdefghiklX", "X", "*"] + ["".join(r.choices(S.AMINO + "xX* é\U0001f600b", weights=[9] * 20 + [1] * 7, k=r.randint(0, 90))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, seq string").coalesce(1)
    for k in (3, 8):
        for calling in (False, True):
            want = sorted((i, p, w) for i, t in enumerate(texts) for p, w in plain(t, k, calling))
            for most, together in ((100_000, 2_000_000), (7, 50), (1, 1)):
                assert sorted(map(tuple, S.valid_windows(df, "seq", k, calling, most, together).collect())) == want


def test_windows_carry_other_columns(spark):
    df = spark.createDataFrame([(1, None, "ACDEFGHIK"), (2, "f", "no windows b"), (3, "g", "ACDEFGHI")], "id long, function string, seq string")
    assert sorted(map(tuple, S.valid_windows(df, "seq").collect())) == [(1, None, 0, "ACDEFGHI"), (1, None, 1, "CDEFGHIK"), (3, "g", 0, "ACDEFGHI")]


def test_rows_that_carry_their_otu_make_the_same_table(spark):
    """Rows that carry their otu need no join with it, and make the same lookup table."""
    from kinfold.operators import signatures as G

    seqs = spark.createDataFrame([(i, "fg"[i % 3 == 0], "ACDEFGHIKL" * (1 + i % 4), f"o{i % 2}") for i in range(12)], "id long, function string, seq string, otu string")
    rows = G.occurrences(seqs, S.K, "otu")
    sigs = G.signatures(rows, 0.5)
    table = G.table(rows, sigs)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, G.table(rows.drop("otu"), sigs, seqs.select("id", "otu")).collect()))
