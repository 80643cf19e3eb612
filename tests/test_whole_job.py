"""Queries over whole tables where the SQL beside them takes fewer rows, against plain Python."""

import hashlib

from kinfold.functions import sequences as S
from kinfold.plans import registry

TEXTS = [(1, "ACGTnn"), (2, "größe ACGU"), (3, None), (4, ""), (5, "éa"), (6, "中文 \U0001f600\nR")]


def write(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_reverse_complement_of_texts_beyond_ascii(spark, tmp_path):
    folder = write(spark, tmp_path, [(i, t, "en", "s") for i, t in TEXTS])
    got = {r["doc_id"]: r["digest"] for r in registry.QUERIES["reverse_complement_all"](spark, folder).collect()}
    table = str.maketrans(S.IUPAC, S.COMPLEMENT)
    assert got == {i: hashlib.md5(t.translate(table)[::-1].encode()).hexdigest() for i, t in TEXTS if t is not None}


def test_references_of_all_groups(spark, tmp_path):
    folder = write(spark, tmp_path, [(7, "MKV", "en", "a"), (8, "mkv", "en", "b"), (9, "AAA", "en", "c"), (10, None, "en", "d")])
    got = {r["ref"]: (r["genome"], r["n_dups"], r["is_feature"]) for r in registry.QUERIES["nr_reps_all"](spark, folder).collect()}
    assert got == {7: ("a", 1, False), 9: ("c", 0, True)}
