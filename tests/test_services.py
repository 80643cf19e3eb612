"""A paged service read as a data source: what reaches it, what it sends, and that rows are those of the plan without pushing."""

import json
import re
import sys
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kinfold.sources import services

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SCHEMA = "genome_id string, genus string, contigs int, quality double, flags array<string>, public boolean"
ROWS = [
    {"genome_id": f"{i}.1", "genus": ["Buchnera", "Vibrio", "O'Neil, (x)", None][i % 4], "contigs": str(i % 50), "quality": i / 3, "flags": "one" if i % 2 else ["a", "b"], "public": i % 5 != 0} for i in range(230)
]


def fake(folder: str):
    """A service over ROWS that writes down each request and, with folder/fail there, fails each one once."""

    def ask(request: str) -> services.Reply:
        mark = re.sub(r"\W", "_", request)
        if Path(folder, "fail").exists() and not Path(folder, f"tried-{mark}").exists():
            Path(folder, f"tried-{mark}").write_text("")
            raise OSError("try later")
        n, start = map(int, re.search(r"limit\((\d+),(\d+)\)$", request).groups())
        found = [r for r in ROWS if all(holds(r, *c) for c in re.findall(r"\b(eq|ge|gt|le|lt|in)\((\w+),(\([^()]*\)|[^()]*)\)", request) if "not(" not in request)]
        some = found[start : start + n]
        with open(Path(folder, "log"), "a") as log:
            log.write(json.dumps([request, len(some)]) + "\n")
        return services.Reply(some, f"items {start}-{start + len(some)}/{len(found)}")

    return ask


def holds(row, op, name, value):
    own = row.get(name)
    if own is None:
        return False
    if op == "in":
        return str(own) in [unquote(v) for v in value[1:-1].split(",")]
    if name in ("contigs", "quality"):
        own, value = float(own), float(value)
    return {"eq": str(own) == unquote(str(value)) or own == value, "ge": own >= value, "gt": own > value, "le": own <= value, "lt": own < value}[op]


def log_of(folder):
    return [json.loads(x) for x in Path(folder, "log").read_text().splitlines()]


@pytest.mark.parametrize(("name", "where", "terms"), [
    ("all", "true", ""),
    ("eq", "genus = 'Vibrio' and contigs >= 10 and contigs < 40", "and(eq(genus,Vibrio),ge(contigs,10),lt(contigs,40))"),
    ("odd", "genus = \"O'Neil, (x)\"", "eq(genus,O%27Neil%2C%20%28x%29)"),
    ("list", "genome_id in ('3.1', '7.1', 'none') and quality > 1", "and(gt(quality,1.0),in(genome_id,(3.1,7.1,none)))"),
    ("mixed", "genus = 'Vibrio' and (contigs = 1 or contigs = 5) and genus like '%b%' and public", "eq(genus,Vibrio)"),
])
def test_only_matching_rows_are_asked_for(spark, tmp_path, name, where, terms):
    services.register_service(spark, f"fake_{name}", fake(str(tmp_path)), SCHEMA)
    df = spark.read.format(f"fake_{name}").option("table", "genome").option("page", 20).option("tasks", 3).load()
    got = sorted(map(str, df.where(where).collect()))
    asked = log_of(tmp_path)
    assert all((f"/?{terms}&limit" if terms else "/?limit") in request for request, _ in asked)
    plain = spark.createDataFrame([services_row(r) for r in ROWS], SCHEMA).where(where)
    assert got == sorted(map(str, plain.collect()))
    if name not in ("mixed",):  # no row was sent that isn't in the result (but for the one that tells the number)
        assert sum(n for request, n in asked if "limit(20," in request) == len(got)


def services_row(r):
    return (r["genome_id"], r["genus"], int(r["contigs"]), r["quality"], r["flags"] if isinstance(r["flags"], list) else [r["flags"]], r["public"])


def test_failures_are_tried_again_and_then_told(spark, tmp_path):
    (tmp_path / "fail").write_text("")
    services.register_service(spark, "fake_fail", fake(str(tmp_path)), SCHEMA)
    df = spark.read.format("fake_fail").option("table", "genome").option("page", 100).option("wait", 0.01).load()
    assert df.where("contigs < 3").count() == sum(int(r["contigs"]) < 3 for r in ROWS)

    def broken(request):
        raise OSError("gone for good")

    services.register_service(spark, "fake_broken", broken, SCHEMA)
    with pytest.raises(Exception, match="gone for good"):
        spark.read.format("fake_broken").option("table", "genome").option("wait", 0.01).load().collect()


def test_content_range():
    assert services.total_of("items 0-24999/61234") == 61234
    with pytest.raises(ValueError):
        services.total_of("nothing")


def test_good_genomes(spark):
    base = {f.split()[0]: None for f in services.GENOMES.split(", ")} | {"genus": "Vibrio", "superkingdom": "Bacteria", "genome_quality": "Good", "genome_status": "WGS", "public": True, "checkm_completeness": 80.0, "checkm_contamination": 1.0, "fine_consistency": 85.0}
    changes = [{}, {"checkm_completeness": 79.9}, {"checkm_completeness": 79.9, "reference_genome": "Reference"}, {"checkm_contamination": 1.1}, {"fine_consistency": None}, {"genus": ""}, {"genus": None}, {"public": False}, {"genome_quality": "Poor"}, {"superkingdom": "Viruses"}, {"genome_status": "Complete"}, {"genome_status": "Partial"}]
    df = spark.createDataFrame([tuple((base | c | {"genome_id": str(i)}).values()) for i, c in enumerate(changes)], services.GENOMES)
    assert sorted(r["genome_id"] for r in services.good_genomes(df).select(F.col("genome_id")).collect()) == ["0", "10", "2"]
