"""Versioned tables and report pages: what readers see before, between and after, and what failures leave."""

import json
import os

import pytest
from pyspark.sql import functions as F

from kinfold.sources import reports
from kinfold.sources.versions import Overtaken, VersionedTable

SCHEMA = "genus string, id long, name string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_parts_are_replaced_merged_and_cleared(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "genus", SCHEMA)
    assert rows_of(t.read()) == [] and t.versions() == []
    one = [("Vibrio", 1, "a"), ("Vibrio", 2, "b"), ("Buch nera/1=x", 3, "c"), (None, 4, "d")]
    assert t.replace(spark.createDataFrame(one, SCHEMA)) == 1
    assert rows_of(t.read()) == sorted(one, key=str)
    assert rows_of(t.read(["Buch nera/1=x"])) == [one[2]] and rows_of(t.read([None])) == [one[3]] and rows_of(t.read(["none"])) == []
    first = t.read()
    assert t.replace(spark.createDataFrame([("Vibrio", 9, "z")], SCHEMA), clear=["Buch nera/1=x", "none"]) == 2
    assert rows_of(t.read()) == sorted([("Vibrio", 9, "z"), one[3]], key=str)
    assert rows_of(first) == sorted(one, key=str) == rows_of(t.read(version=1))  # who began to read before goes on as before
    assert t.merge(spark.createDataFrame([("Vibrio", 9, "new"), ("Vibrio", 10, "added"), (None, 4, None), ("Fresh", 1, "f")], SCHEMA), "id") == 3
    assert rows_of(t.read()) == sorted([("Vibrio", 9, "new"), ("Vibrio", 10, "added"), (None, 4, None), ("Fresh", 1, "f")], key=str)
    assert t.clear("Vibrio", None) == 4
    assert rows_of(t.read()) == [("Fresh", 1, "f")]
    t.vacuum()
    assert t.versions() == [4] and rows_of(t.read()) == [("Fresh", 1, "f")]
    assert len([f for f in os.listdir(tmp_path / "t") if f.startswith("data-")]) == 1


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "genus", SCHEMA)
    t.replace(spark.createDataFrame([("Vibrio", 1, "a")], SCHEMA))
    broken = spark.range(100).select(F.lit("Vibrio").alias("genus"), "id", F.when(F.col("id") == 70, F.raise_error(F.lit("a task fails"))).otherwise("x").alias("name"))
    with pytest.raises(Exception, match="a task fails"):
        t.replace(broken)
    assert t.versions() == [1] and rows_of(t.read()) == [("Vibrio", 1, "a")]
    assert len([f for f in os.listdir(tmp_path / "t") if f.startswith("data-")]) == 1


def test_a_writer_that_was_overtaken_is_told(spark, tmp_path):
    a, b = (VersionedTable(spark, str(tmp_path / "t"), "genus", SCHEMA) for _ in range(2))
    a.replace(spark.createDataFrame([("Vibrio", 1, "a")], SCHEMA))
    written = b._written

    def slow(rows):
        out = written(rows)
        a.replace(spark.createDataFrame([("Other", 2, "b")], SCHEMA))
        return out

    b._written = slow
    with pytest.raises(Overtaken):
        b.replace(spark.createDataFrame([("Vibrio", 3, "c")], SCHEMA))
    assert rows_of(a.read()) == [("Other", 2, "b"), ("Vibrio", 1, "a")] and a.versions() == [1, 2]


def test_report_pages_and_index(spark, tmp_path):
    reports.register(spark)
    folder = tmp_path / "report"
    fams = spark.range(1, 24).select("id", F.concat(F.lit("F"), F.col("id").cast("string")).alias("fam"), F.array(F.lit("x"), F.lit('q"')).alias("members"))

    def write(df, mode="overwrite"):
        reports.paged(df, "id", "fam", 10).repartition(3).write.format("report_pages").option("path", str(folder)).option("base", "families").mode(mode).save()

    write(fams)
    index = json.loads((folder / "families-index.json").read_text())
    assert index["pages"] == [{"page": n, "file": f"families-000{n}.json", "first": a, "last": b} for n, a, b in ((1, "F1", "F10"), (2, "F11", "F20"), (3, "F21", "F23"))]
    page = json.loads((folder / "families-0002.json").read_text())
    assert (page["page"], page["num_pages"], page["prev"], page["next"]) == (2, 3, "families-0001.json", "families-0003.json")
    assert [r["fam"] for r in page["rows"]] == [f"F{i}" for i in range(11, 21)] and page["rows"][0]["members"] == ["x", 'q"']
    assert sorted(os.listdir(folder)) == ["families-0001.json", "families-0002.json", "families-0003.json", "families-index.json"]
    write(fams.where("id <= 10"))
    assert sorted(os.listdir(folder)) == ["families-0001.json", "families-index.json"]
    before = (folder / "families-0001.json").read_text()
    with pytest.raises(Exception, match="a task fails"):
        write(fams.withColumn("fam", F.when(F.col("id") == 15, F.raise_error(F.lit("a task fails"))).otherwise(F.col("fam"))))
    assert sorted(os.listdir(folder)) == ["families-0001.json", "families-index.json"] and (folder / "families-0001.json").read_text() == before
    with pytest.raises(Exception, match="FileExistsError"):
        write(fams, "append")
    assert sorted(os.listdir(folder)) == ["families-0001.json", "families-index.json"]


def test_retried_tasks_count_once(tmp_path):
    writer = reports.ReportWriter({"path": str(tmp_path), "base": "p"}, True)
    row = {"page": 1, "first": "a", "last": "b", "body": "[1]"}
    writer.write(iter([row]))  # an attempt whose task was lost
    writer.commit([writer.write(iter([row])), None])
    assert sorted(os.listdir(tmp_path)) == ["p-0001.json", "p-index.json"]
    assert json.loads((tmp_path / "p-0001.json").read_text())["rows"] == [1]
