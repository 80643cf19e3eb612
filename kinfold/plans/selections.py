"""Queries on selections and work lists. Documents stand for members, their source for the genus or genome, lines of orders for features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.functions import sequences as S
from kinfold.operators import families, genomes
from kinfold.operators import selections as Q

from .registry import Tables, query

_MD5 = f"md5(translate(text, '{S.LOWER}', '{S.UPPER}'))"


def members(t: Tables) -> DataFrame:
    """Documents as members of families by source and language."""
    return t.documents.select(F.concat_ws("/", "source", "lang").alias("fam"), F.col("doc_id").alias("id"), F.col("text").alias("seq"), F.col("n_chars").alias("len"))


_FAMS = "m AS (SELECT concat_ws('/', source, lang) AS fam, doc_id AS id, text AS seq, n_chars AS len FROM documents)"


@query("SELECT l_partkey AS fam, l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7) AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def family_members(t: Tables) -> DataFrame:
    """Lines of parts of one size, without those of finished orders."""
    id_ = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    rows = t.lineitem.select(F.col("l_partkey").alias("fam"), id_)
    gone = t.lineitem.join(t.orders.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(id_)
    return Q.members_of(rows, t.part.where("p_size = 7").select(F.col("p_partkey").alias("fam")), gone)


@query(f"WITH {_FAMS} SELECT fam, count(seq) AS n, count(DISTINCT {_MD5.replace('text', 'seq')}) AS n_distinct, count(seq) > 1 AS protein, count(DISTINCT {_MD5.replace('text', 'seq')}) > 1 AS dna FROM m GROUP BY fam")
def alignment_work(t: Tables) -> DataFrame:
    return Q.alignment_work(members(t))


@query(f"WITH {_FAMS} SELECT fam, {_MD5.replace('text', 'seq')} AS md5, min(id) AS id, count(*) AS n FROM m WHERE seq IS NOT NULL GROUP BY ALL")
def distinct_in_family(t: Tables) -> DataFrame:
    return Q.distinct_sequences(members(t))


@query("""WITH s AS (SELECT p_name AS fam, count(*) AS size FROM part GROUP BY p_name HAVING count(*) > 2 AND min(p_size) >= 2) SELECT fam, size, row_number() OVER (ORDER BY size DESC, fam) AS idx FROM s""")
def core_sets(t: Tables) -> DataFrame:
    """Parts by name, all of a size of two or more, numbered; sets left out use up no number."""
    return Q.core_sets(t.part.select(F.col("p_name").alias("fam"), F.col("p_size").alias("len")), 3, 2)


@query("""SELECT c_custkey AS id, n_name AS genus, CASE WHEN n_regionkey <> 2 THEN n_name || '-' || n_nationkey ELSE n_name END AS genus_taxon FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def genus_taxa(t: Tables) -> DataFrame:
    """Customers under their nation's name and number; nations of one region aren't on the list."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("genus"))
    return Q.with_taxon(rows, t.nation.where("n_regionkey <> 2").select(F.col("n_name").alias("genus"), F.col("n_nationkey").alias("taxon"))).select("id", "genus", "genus_taxon")


@query(f"""WITH r AS (SELECT min(doc_id) AS id FROM documents WHERE text IS NOT NULL GROUP BY {_MD5}) SELECT id, md5(arg_min(content, turn)) AS digest FROM (SELECT conv_id AS id, turn, text AS content FROM conversations) JOIN r USING (id) GROUP BY id""")
def reference_first_rows(t: Tables) -> DataFrame:
    """The first row of each reference id in a second table (conversations by number)."""
    refs = t.documents.where("text is not null").groupBy(S.md5_id(F.col("text"))).agg(F.min("doc_id").alias("id"))
    rows = t.conversations.select(F.col("conv_id").alias("id"), F.col("turn").alias("ord"), F.col("text").alias("seq"))
    return Q.first_of_each(refs, rows).select("id", F.md5(F.col("seq").cast("binary")).alias("digest"))


_HELD = "i AS (SELECT o_orderkey * 10 + 1 AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'), m AS (SELECT l_partkey AS fam, l_orderkey * 10 + l_linenumber AS id FROM lineitem)"


def _held(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.lineitem.select(F.col("l_partkey").alias("fam"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    ids = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select((F.col("o_orderkey") * 10 + 1).alias("id"))
    return Q.families_holding(rows, ids, t.part.select(F.col("p_partkey").alias("fam"), F.col("p_name").alias("function")))


@query(f"WITH {_HELD} SELECT fam, id FROM m WHERE fam IN (SELECT fam FROM m WHERE id IN (SELECT id FROM i))")
def families_holding(t: Tables) -> DataFrame:
    """All members of the families that hold a listed id."""
    return _held(t)[0]


@query(f"WITH {_HELD} SELECT fam, id, p_name AS function FROM m LEFT JOIN part ON p_partkey = fam WHERE id IN (SELECT id FROM i)")
def family_mapping(t: Tables) -> DataFrame:
    return _held(t)[1]


@query("SELECT source AS genome, doc_id AS id, md5(text) AS digest FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND source IS NOT NULL AND text IS NOT NULL")
def unclassified_sequences(t: Tables) -> DataFrame:
    """Texts of the documents without a label, by source."""
    seqs = t.documents.where("text is not null").select(F.col("source").alias("genome"), F.col("doc_id").alias("id"), F.col("text").alias("seq"))
    got = Q.unclassified(seqs, t.labels.select(F.col("doc_id").alias("id")), seqs)
    return got.select("genome", "id", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("SELECT lang AS function, count(*) AS n, coalesce(sum(length(text)), 0)::BIGINT AS residues FROM documents GROUP BY lang")
def function_totals(t: Tables) -> DataFrame:
    return Q.function_totals(t.documents.select(F.col("lang").alias("function"), F.col("text").alias("seq")))


@query("SELECT DISTINCT p_type AS value FROM part UNION SELECT DISTINCT o_orderpriority FROM orders UNION SELECT c_mktsegment FROM customer")
def listed_values(t: Tables) -> DataFrame:
    return Q.listed(t.part.select(F.col("p_type").alias("value")), t.orders.select(F.col("o_orderpriority").alias("value")), t.customer.select(F.col("c_mktsegment").alias("value")))


@query("""SELECT l_partkey AS fam, count(DISTINCT s_nationkey) AS n_genera, count(DISTINCT l_suppkey) AS n_genomes, count(DISTINCT l_orderkey) AS n_lfams, count(DISTINCT l_orderkey * 10 + l_linenumber) AS n_members FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey""")
def cluster_summary(t: Tables) -> DataFrame:
    """Parts as clusters: nations, suppliers, orders and lines of each."""
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("fam"), F.col("s_nationkey").alias("genus"), F.col("l_suppkey").alias("genome"), F.col("l_orderkey").alias("lfam"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return families.summary(rows, "fam")


@query("""WITH f AS (SELECT l_suppkey AS key, l_returnflag AS product, l_orderkey * 10 + l_linenumber AS feature, epoch(l_shipdate)::BIGINT // 86400 AS start, epoch(l_shipdate)::BIGINT // 86400 + l_quantity::BIGINT AS stop FROM lineitem),
r AS (SELECT s_suppkey AS key, n_nationkey AS region, 8000 + n_nationkey * 200 AS lo, 8000 + n_nationkey * 200 + 30 + n_regionkey * 20 AS hi FROM supplier JOIN nation ON n_nationkey % 5 = s_nationkey % 5)
SELECT f.key, region, product, count(*) AS n FROM f JOIN r ON f.key = r.key AND start <= hi AND stop >= lo GROUP BY ALL""")
def overlap_join(t: Tables) -> DataFrame:
    """Features that touch a region, by product."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long")
    f = t.lineitem.select(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("product"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("feature"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"))
    lo = (F.lit(8000) + F.col("n_nationkey") * 200).cast("long")
    r = t.supplier.join(t.nation, F.col("n_nationkey") % 5 == F.col("s_nationkey") % 5).select(F.col("s_suppkey").alias("key"), F.col("n_nationkey").alias("region"), lo.alias("lo"), (lo + 30 + F.col("n_regionkey") * 20).alias("hi"))
    return genomes.overlapping(f, r, 100).groupBy("key", "region", "product").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS id, true AS reference FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey, false FROM orders WHERE o_orderstatus <> 'P'")
def reference_split(t: Tables) -> DataFrame:
    """Orders, those of one state as references and the rest as others."""
    refs, others = genomes.split_by_reference(t.orders.select(F.col("o_orderkey").alias("id")), t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id")))
    return refs.withColumn("reference", F.lit(True)).union(others.withColumn("reference", F.lit(False)))


@query("""WITH d AS (SELECT p_partkey AS fam, CASE WHEN p_size < 5 THEN 'hypothetical protein' WHEN p_size < 10 THEN 'protein of core_cid ' || p_partkey ELSE p_name END AS function FROM part) SELECT fam, function FROM d WHERE function = 'hypothetical protein' OR contains(function, 'core_cid')""")
def hypothetical_families(t: Tables) -> DataFrame:
    function = F.when(F.col("p_size") < 5, "hypothetical protein").when(F.col("p_size") < 10, F.concat(F.lit("protein of core_cid "), F.col("p_partkey").cast("string"))).otherwise(F.col("p_name"))
    return t.part.select(F.col("p_partkey").alias("fam"), function.alias("function")).where(A.is_hypothetical(F.col("function")))
