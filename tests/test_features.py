"""File-scoped genomes of FASTA records read in ranges, feature lists, and what rounds of graph operators leave behind."""

import os

from kinfold.operators import graph
from kinfold.operators import signatures as G
from kinfold.sources import fasta, features


def test_the_first_record_names_the_genome_of_its_file(spark, tmp_path):
    files = {
        "one.fa": ">fig|1.1.peg.1 kinase [Genome one]\nMK\n>fig|9.9.peg.2 ligase # frag [Other]\nMK\n>x\nMK\n",
        "two.fa": ">fig|2.5.peg.1\nMK\n>b kinase [Third]\nMK\n",
        "83333.1": ">c no brackets here\nMK\n>d kinase [Fourth]\nMK\n",
        "empty.fa": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    fasta.register(spark)
    for size in ("5", "1000"):
        records = spark.read.format("fasta_records").option("path", str(tmp_path)).option("rangeBytes", size).load()
        got = {r["file"].rsplit("/", 1)[1]: r["genome"] for r in features.file_genomes(records).collect()}
        assert got == {"one.fa": "Genome one", "two.fa": "2.5", "83333.1": "83333.1"}
        given = spark.createDataFrame([("x", "kinase"), ("c", "ligase # comment"), ("d", "")], "id string, function string")
        rows = sorted(tuple(r) for r in features.file_evidence(records, given).collect())
        assert rows == [("b", "kinase", "2.5"), ("c", "ligase", "83333.1"), ("fig|1.1.peg.1", "kinase", "Genome one"), ("fig|9.9.peg.2", "ligase # frag".split(" #")[0], "Genome one"), ("x", "kinase", "Genome one")]
        none = spark.createDataFrame([], "value string")
        kept = G.kept_functions(features.file_evidence(records, given), none, none, spark.createDataFrame([], "function string, role string"), none, 2)
        assert sorted(map(tuple, kept.collect())) == [("kinase", 2), ("ligase", 2)]


def test_feature_lists(spark):
    rows = [("g", "s", "source", "c1", None, 1, 100, 100), ("g", "a", "CDS", "c1", "abcA", 10, 90, 0), ("g", "b", "CDS", "c1", "", 9, 50, 0), ("g", "c", "CDS", "c1", None, 91, 20, 0), ("g", "d", "CDS", "c2", "x", 20, 191, 0), ("g", "e", "CDS", "c3", "y", 1, 5, 0), ("g", "r", "rna", "c1", "rrn", 1, 5, 0)]
    df = spark.createDataFrame([(g, f"fig|{i}", *r) for g, i, *r in rows], "genome string, patric_id string, feature_type string, accession string, gene string, start int, end int, na_length int")
    proteins = spark.createDataFrame([("g", f"fig|{i}|more", s) for i, s in (("a", "MK"), ("b", "MKL"), ("d", "M" + "X" * 10), ("e", "MX"))] + [("g", "odd", "MK")], "genome string, id string, seq string")
    contigs = spark.createDataFrame([("g", "c2", 200), ("g", "c1", 5)], "genome string, accession string, len int")
    out = features.feature_lists(df, proteins, contigs)
    pick = lambda d, *c: sorted(tuple(r) for r in d.select(*c).collect())
    assert pick(out.gene_names, "id", "gene") == [("fig|a", "abcA"), ("fig|d", "x"), ("fig|e", "y"), ("fig|r", "rrn")]
    assert pick(out.truncated, "id", "start", "end", "len") == [("fig|b", 9, 50, 100), ("fig|c", 91, 20, 100), ("fig|d", 20, 191, 200)]
    assert pick(out.bad, "id", "reason") == [("fig|b", "truncated"), ("fig|d", "bad sequence")]
    assert pick(out.sequences, "id", "seq", "len") == [("fig|a", "MK", 2), ("fig|e", "MX", 2)]


def test_rounds_leave_only_what_the_result_reads(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    there = lambda: {f for f in os.listdir(folder) if f.startswith("kinfold-")}
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 3), (45, 101)], "a long, b long")
    before = there()
    got = {r["node"]: r["component"] for r in graph.components(chain).collect()}
    assert got[59] == 40 and got[101] == 40 and got[100] == 0 and got[39] == 20
    assert len(there() - before) <= 2
    assert graph.components(chain.where("false")).count() == 0
    pairs = spark.createDataFrame([(i, i + 1, 0.9) for i in range(12)], "a long, b long, score double")
    nodes = spark.createDataFrame([(i, 100 - i) for i in range(13)], "id long, size int")
    before = there()
    reps = {r["member"]: r["rep"] for r in graph.representatives(pairs, nodes).collect()}
    assert reps[0] == reps[1] == 0 and reps[2] == reps[3] == 2
    assert len(there() - before) <= 1
