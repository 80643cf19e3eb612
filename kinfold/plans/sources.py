"""Queries that read what a source of this engine has written or serves. Documents stand for sequences, customers and orders for genomes and their features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.graph import scratch_path
from kinfold.operators.numbering import numbered
from kinfold.sources import fasta, features, reports
from kinfold.sources.versions import VersionedTable

from .registry import Tables, query


@query("""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, lang, l, array_to_string(list_transform(l, lambda x, i: regexp_replace(CASE WHEN i = 1 THEN x ELSE regexp_replace(x, '^[^A-Za-z>]*', '') END, '[^A-Za-z*]', '', 'g')), '') AS seq FROM d)
SELECT doc_id::VARCHAR AS id, ' ' || lang AS def, md5(seq) AS digest, length(seq)::INTEGER AS len, (strlen(array_to_string(l, '')) - strlen(seq))::BIGINT AS n_errors, contains(lang || array_to_string(l, ''), '>') AS embedded FROM x""")
def fasta_records(t: Tables) -> DataFrame:
    """Documents written as FASTA files as they are, read back by byte ranges: what isn't a letter is counted as wrong, byte by byte."""
    spark = t.documents.sparkSession
    path = scratch_path(spark)
    text = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" "), F.coalesce("lang", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    t.documents.select(text.alias("value")).write.text(path)
    fasta.register(spark)
    rows = spark.read.format("fasta_records").option("path", path).option("rangeBytes", 16_000_000).load()
    return rows.select("id", "def", F.md5(F.col("seq").cast("binary")).alias("digest"), F.length("seq").alias("len"), "n_errors", "embedded")


@query("""WITH base AS (SELECT coalesce(lang, '') AS genus, doc_id AS id, source AS name FROM documents),
one AS (SELECT * FROM base WHERE genus <> 'fr'), changed AS (SELECT genus, id, 'renamed ' || name AS name FROM base WHERE id % 3 = 0 AND genus <> 'fr')
SELECT genus, id, coalesce(c.name, one.name) AS name FROM one LEFT JOIN changed c USING (genus, id) WHERE genus <> 'es'""")
def versioned_members(t: Tables) -> DataFrame:
    """Documents by language in a versioned table: one language cleared as another commit writes, changes merged, a second language cleared."""
    spark = t.documents.sparkSession
    table = VersionedTable(spark, scratch_path(spark), "genus", "genus string, id long, name string")
    rows = t.documents.select(F.coalesce("lang", F.lit("")).alias("genus"), F.col("doc_id").alias("id"), F.col("source").alias("name"))
    table.replace(rows)
    table.replace(rows.where("genus = 'de'"), clear=["fr"])
    table.merge(rows.where("id % 3 = 0 and genus <> 'fr'").withColumn("name", F.concat(F.lit("renamed "), "name")), "id")
    table.clear("es")
    return table.read()


@query("""WITH n AS (SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS nth, c_custkey, c_name FROM customer), p AS (SELECT (nth - 1) // 25 + 1 AS page, nth, c_name FROM n)
SELECT page::INTEGER AS page, (SELECT max(page) FROM p)::INTEGER AS num_pages, count(*) AS n, arg_min(c_name, nth) AS first, arg_max(c_name, nth) AS last FROM p GROUP BY page""")
def report_pages(t: Tables) -> DataFrame:
    """Customers by balance as a report of 25 a page, written as files of JSON and read back from them."""
    spark = t.customer.sparkSession
    path = scratch_path(spark)
    reports.register(spark)
    rows = numbered(t.customer.select("c_custkey", "c_name", "c_acctbal"), "nth", F.col("c_acctbal").desc(), F.col("c_custkey")).select("nth", "c_custkey", "c_name")
    reports.paged(rows, "nth", "c_name", 25).write.format("report_pages").option("path", path).option("base", "customers").mode("overwrite").save()
    page = "page int, num_pages int, rows array<struct<nth: long, c_custkey: long, c_name: string>>"
    read = spark.read.schema(page).json(path, multiLine=True, pathGlobFilter="customers-[0-9]*.json")
    at = lambda i: F.element_at("rows", i)["c_name"]
    return read.select("page", "num_pages", F.size("rows").cast("long").alias("n"), at(1).alias("first"), at(-1).alias("last"))


_FEATURES = """f AS (SELECT l_suppkey AS genome, l_orderkey * 10 + l_linenumber AS id, l_partkey % 7 AS accession, CASE WHEN l_returnflag = 'R' THEN l_linestatus || l_linenumber ELSE '' END AS gene, (l_partkey * 13 % 2000)::BIGINT AS b, (l_partkey * 13 % 2000 + l_quantity * 3)::BIGINT AS e, l_linestatus FROM lineitem),
c AS (SELECT s.s_suppkey AS genome, a.accession, 900 + (s.s_suppkey + a.accession) % 5 * 250 AS len FROM supplier s, (SELECT unnest(range(0, 6)) AS accession) a),
t AS (SELECT f.genome, id, b, e, len FROM f JOIN c USING (genome, accession) WHERE least(b, e) < 10 OR greatest(b, e) > len - 10)"""


@query(f"""WITH {_FEATURES}, p AS (SELECT genome, id, CASE WHEN b % 11 = 0 THEN 'MKXXXXXXXXXXL' ELSE 'MK' || gene END AS seq FROM f), j AS (SELECT p.*, CASE WHEN contains(seq, 'XXXXXXXXXX') THEN 'bad sequence' WHEN t.id IS NOT NULL THEN 'truncated' END AS reason FROM p LEFT JOIN (SELECT DISTINCT genome, id FROM t) t USING (genome, id))
SELECT 'fig|' || id AS id, genome::BIGINT AS genome, 'name' AS list, gene AS value FROM f WHERE gene <> '' UNION ALL SELECT 'fig|' || id, genome, 'truncated', b || '-' || e || '/' || len FROM t
UNION ALL SELECT 'fig|' || id, genome, 'bad', reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT 'fig|' || id, genome, 'kept', seq FROM j WHERE reason IS NULL""")
def genome_features(t: Tables) -> DataFrame:
    """Lines of orders as features of their suppliers as genomes: gene names, truncated and bad ones, and the proteins that are left. One contig in seven has no known length."""
    s = lambda c: c.cast("string")
    fid = F.concat(F.lit("fig|"), s(F.col("l_orderkey") * 10 + F.col("l_linenumber")))
    start = F.col("l_partkey") * 13 % 2000
    gene = F.when(F.col("l_returnflag") == "R", F.concat("l_linestatus", s(F.col("l_linenumber")))).otherwise("")
    rows = t.lineitem.select(F.col("l_suppkey").alias("genome"), fid.alias("patric_id"), F.lit("CDS").alias("feature_type"), (F.col("l_partkey") % 7).alias("accession"), gene.alias("gene"), start.alias("start"), (start + F.col("l_quantity") * 3).cast("long").alias("end"), F.lit(None).cast("long").alias("na_length"))
    known = t.supplier.select(F.col("s_suppkey").alias("genome"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("accession"))
    known = known.withColumn("len", 900 + (F.col("genome") + F.col("accession")) % 5 * 250)
    nothing = F.lit(None).cast("string")
    marks = known.where("accession < 3").select("genome", nothing.alias("patric_id"), F.lit("source").alias("feature_type"), "accession", nothing.alias("gene"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.col("len").alias("na_length"))
    proteins = rows.select("genome", F.concat("patric_id", F.lit("|x")).alias("id"), F.when(F.col("start") % 11 == 0, "MKXXXXXXXXXXL").otherwise(F.concat(F.lit("MK"), "gene")).alias("seq"))
    found = features.feature_lists(rows.unionByName(marks), proteins, known)
    told = lambda df, name, value: df.select("id", "genome", F.lit(name).alias("list"), value.alias("value"))
    cut = F.concat(s(F.col("start")), F.lit("-"), s(F.col("end")), F.lit("/"), s(F.col("len")))
    return told(found.gene_names, "name", F.col("gene")).unionByName(told(found.truncated, "truncated", cut)).unionByName(told(found.bad, "bad", F.col("reason"))).unionByName(told(found.sequences, "kept", F.col("seq")))
