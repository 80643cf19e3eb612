"""Queries on genomes, reports and formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators import genomes as Q
from kinfold.operators import folds, reports
from kinfold.sources import sequences as io

from .registry import Tables, query


@query("""SELECT l_orderkey, l_linenumber, s::BIGINT AS start, e::BIGINT AS stop, n::BIGINT AS contig, (s < 10 OR e < 10 OR s > n - 10 OR e > n - 10) AS truncated FROM (
SELECT l_orderkey, l_linenumber, l_quantity AS s, l_quantity + l_suppkey % 40 AS e, coalesce(NULLIF(p_size, 50), 60) + 40 AS n FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)""")
def truncated_flags(t: Tables) -> DataFrame:
    """Features on contigs whose length comes from one table, or, where that has none, from a default."""
    f = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("start"), (F.col("l_quantity") + F.col("l_suppkey") % 40).cast("long").alias("stop"))
    size = t.part.select(F.col("p_partkey").alias("l_partkey"), F.nullif("p_size", F.lit(50)).alias("size"))
    out = f.join(size, "l_partkey", "left").withColumn("contig", (F.coalesce("size", F.lit(60)) + 40).cast("long"))
    return out.select("l_orderkey", "l_linenumber", "start", "stop", "contig", Q.truncated(F.col("start"), F.col("stop"), F.col("contig")).alias("truncated"))


@query("""SELECT c_custkey AS id, c_nationkey AS genus FROM customer WHERE (c_mktsegment = 'BUILDING' OR c_nationkey = 3 OR (c_acctbal < 0 AND c_acctbal >= -500)) AND c_nationkey IS NOT NULL AND c_acctbal BETWEEN -900 AND 9500 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000)""")
def genome_quality(t: Tables) -> DataFrame:
    """Good, or of one kingdom, or with the one flag that is let pass; with a genus, in range, not on the bad list."""
    flags = F.when((F.col("c_acctbal") < 0) & (F.col("c_acctbal") >= -500), F.array(F.lit("Genome too short"))).otherwise(F.array(F.lit("Other")))
    good = Q.good_quality(F.when(F.col("c_mktsegment") == "BUILDING", "Good").otherwise("Poor"), F.when(F.col("c_nationkey") == 3, "Viruses").otherwise("Bacteria"), flags)
    bad = t.orders.where("o_orderpriority = '1-URGENT' and o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.where(good & F.col("c_nationkey").isNotNull() & F.col("c_acctbal").between(-900, 9500)).join(bad, "c_custkey", "left_anti").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("genus"))


@query("""WITH a AS (SELECT o_custkey AS id, l_partkey AS taxon, o_orderkey AS k, l_linenumber AS pos FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT id, arg_min(taxon, (k * 10 + pos) * 100000000 + taxon) AS taxon FROM a JOIN part ON p_partkey = taxon WHERE p_type = 'STANDARD' GROUP BY id""")
def lineage_first_match(t: Tables) -> DataFrame:
    """Parts that a customer ordered, in order, as a lineage; the first of one type."""
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_partkey").alias("taxon"))
    lineages = rows.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "taxon"))), lambda x: x["taxon"]).alias("lineage"))
    return Q.first_ancestor(lineages, t.part.select(F.col("p_partkey").alias("taxon"), F.col("p_type").alias("rank")), "STANDARD")


@query("""WITH r AS (SELECT c_custkey AS id, c_nationkey AS species, c_acctbal AS contigs, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)::INTEGER AS round FROM customer) SELECT * FROM r ORDER BY round, species LIMIT 200""")
def species_round_robin(t: Tables) -> DataFrame:
    return Q.round_robin(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("species"), F.col("c_acctbal").alias("contigs")), 200)


_ANI = "ani AS (SELECT l_orderkey AS query, l_suppkey AS ref, max(100 - l_discount * 60) AS ani FROM lineitem GROUP BY ALL)"


def _ani(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("query"), F.col("l_suppkey").alias("ref")).agg(F.max(100 - F.col("l_discount") * 60).alias("ani"))


@query(f"""WITH {_ANI}, b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ani DESC, ref) AS r FROM ani WHERE query <> ref)
SELECT query, ref, round(ani, 4) AS ani, ani > 97 AS good FROM b WHERE r = 1""")
def best_hit_per_query(t: Tables) -> DataFrame:
    return Q.best_hits(_ani(t)).withColumn("ani", F.round("ani", 4))


@query(f"""WITH {_ANI}, b AS (SELECT query, max(ani) AS ani FROM ani WHERE query <> ref GROUP BY query)
SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' UNION SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT query FROM ani) UNION SELECT query FROM ani WHERE query NOT IN (SELECT query FROM b WHERE ani > 97)""")
def active_set(t: Tables) -> DataFrame:
    ani = _ani(t)
    ids = t.orders.select(F.col("o_orderkey").alias("id"))
    refs = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    good = Q.best_hits(ani).where("good").select(F.col("query").alias("id"))
    return Q.active(refs, ids, ani.select(F.col("query").alias("id")).distinct(), good)


@query("""SELECT DISTINCT l_partkey AS fam FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' EXCEPT SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O' AND o_totalprice > 450000""")
def missing_families(t: Tables) -> DataFrame:
    """Families that only inactive genomes have."""
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    now = rows.where("o_orderstatus = 'O' and o_totalprice > 450000").select(F.col("l_partkey").alias("fam"))
    return rows.where("o_orderstatus = 'F'").select(F.col("l_partkey").alias("fam")).distinct().join(now, "fam", "left_anti")


@query("""WITH f AS (SELECT l_suppkey AS key, l_orderkey * 10 + l_linenumber AS feature, epoch(l_shipdate)::BIGINT // 86400 AS start, epoch(l_shipdate)::BIGINT // 86400 + l_quantity::BIGINT AS stop FROM lineitem),
r AS (SELECT s_suppkey AS key, n_nationkey AS region, 8000 + n_nationkey * 200 AS lo, 8000 + n_nationkey * 200 + 30 + n_regionkey * 20 AS hi FROM supplier JOIN nation ON n_nationkey % 5 = s_nationkey % 5)
SELECT f.key, feature, region FROM f JOIN r ON f.key = r.key AND start >= lo AND stop <= hi""")
def containment_join(t: Tables) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long")
    f = t.lineitem.select(F.col("l_suppkey").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("feature"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"))
    lo = (F.lit(8000) + F.col("n_nationkey") * 200).cast("long")
    r = t.supplier.join(t.nation, F.col("n_nationkey") % 5 == F.col("s_nationkey") % 5).select(F.col("s_suppkey").alias("key"), F.col("n_nationkey").alias("region"), lo.alias("lo"), (lo + 30 + F.col("n_regionkey") * 20).alias("hi"))
    return Q.contained(f, r, 100)


@query("""WITH a AS (SELECT role AS fam, length(text) AS raw, length(replace(text, '-', '')) AS trimmed, length(text) BETWEEN 50 AND 400 AS clean FROM conversations),
s AS (SELECT fam, 'raw' AS stage, raw AS len FROM a UNION ALL SELECT fam, 'trimmed', trimmed FROM a UNION ALL SELECT fam, 'clean', trimmed FROM a WHERE clean)
SELECT fam, stage, count(*) AS n, round(avg(len), 4) AS mean, round(stddev_samp(len), 4) AS sd FROM s GROUP BY ALL""")
def alignment_stats(t: Tables) -> DataFrame:
    """Count, mean and deviation of lengths at each stage of cleaning."""
    a = t.conversations.select(F.col("role").alias("fam"), F.length("text").alias("raw"), F.length(F.translate("text", "-", "")).alias("trimmed"), F.length("text").between(50, 400).alias("clean"))
    stages = F.array(F.struct(F.lit("raw").alias("stage"), F.col("raw").alias("len")), F.struct(F.lit("trimmed").alias("stage"), F.col("trimmed").alias("len")), F.struct(F.lit("clean").alias("stage"), F.when(F.col("clean"), F.col("trimmed")).alias("len")))
    return a.select("fam", F.explode(stages).alias("x")).select("fam", "x.*").where("len is not null").groupBy("fam", "stage").agg(F.count("*").alias("n"), F.round(F.avg("len"), 4).alias("mean"), F.round(F.stddev_samp("len"), 4).alias("sd"))


@query("""WITH n AS (SELECT p_name AS fam, p_type AS function, count(*) AS n FROM part GROUP BY ALL), z AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY n DESC, function) AS r FROM (SELECT fam, function, n, sum(n) OVER (PARTITION BY fam) AS size FROM n) WHERE size >= 4)
SELECT fam, max(CASE WHEN r = 1 THEN function END) AS first, max(CASE WHEN r = 1 THEN n END)::BIGINT AS n_first, max(CASE WHEN r = 2 THEN function END) AS second, max(CASE WHEN r = 2 THEN n END)::BIGINT AS n_second FROM z WHERE r <= 2 GROUP BY fam""")
def modal_annotation(t: Tables) -> DataFrame:
    n = t.part.groupBy(F.col("p_name").alias("fam"), F.col("p_type").alias("function")).agg(F.count("*").alias("n"))
    big = n.withColumn("size", F.sum("n").over(Window.partitionBy("fam"))).where("size >= 4")
    top = reports.top_k(big, 2, ["fam"], F.col("n").desc(), F.col("function"))
    at = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    return top.groupBy("fam").agg(at("function", 1).alias("first"), at("n", 1).alias("n_first"), at("function", 2).alias("second"), at("n", 2).alias("n_second"))


@query("""WITH g AS (SELECT l_partkey AS fam, count(DISTINCT l_suppkey) AS n_genomes FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL) SELECT fam, n_genomes, n_genomes >= 15 AS eligible, (dense_rank() OVER (ORDER BY n_genomes DESC))::INTEGER AS rank FROM g""")
def genomes_per_family(t: Tables) -> DataFrame:
    """Distinct genomes of each family without the deleted features; ranks are of the counts, of which there are few."""
    g = t.lineitem.where("l_returnflag <> 'R'").groupBy(F.col("l_partkey").alias("fam")).agg(F.countDistinct("l_suppkey").alias("n_genomes"))
    ranks = g.select("n_genomes").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.col("n_genomes").desc())))
    return g.join(F.broadcast(ranks), "n_genomes").select("fam", "n_genomes", (F.col("n_genomes") >= 15).alias("eligible"), "rank")


@query("""WITH RECURSIVE f AS (SELECT item, size, row_number() OVER (ORDER BY size DESC, item) AS n FROM (SELECT p_name AS item, count(*) AS size FROM part GROUP BY p_name)),
r AS (SELECT item, size, n, 1 AS page, size AS held FROM f WHERE n = 1 UNION ALL SELECT f.item, f.size, f.n, CASE WHEN held + f.size > 100 THEN page + 1 ELSE page END, CASE WHEN held + f.size > 100 THEN f.size ELSE held + f.size END FROM r JOIN f ON f.n = r.n + 1)
SELECT item, size, page FROM r""")
def paginate(t: Tables) -> DataFrame:
    return folds.paginate(t.part.groupBy(F.col("p_name").alias("item")).agg(F.count("*").alias("size")), 100)


@query("""WITH f AS (SELECT p_name AS fam, count(*) AS size FROM part GROUP BY p_name), w AS (SELECT fam, size, lag(fam) OVER (ORDER BY size DESC, fam) AS p, lead(fam) OVER (ORDER BY size DESC, fam) AS n FROM f)
SELECT fam, size, coalesce(p, (SELECT fam FROM f ORDER BY size, fam DESC LIMIT 1)) AS prev, coalesce(n, (SELECT fam FROM f ORDER BY size DESC, fam LIMIT 1)) AS next FROM w""")
def prev_next(t: Tables) -> DataFrame:
    return reports.neighbours(t.part.groupBy(F.col("p_name").alias("fam")).agg(F.count("*").alias("size")), "fam", [F.col("size").desc(), F.col("fam")])


@query("""WITH d AS (SELECT DISTINCT o_custkey, o_orderkey // 4 AS k FROM orders), i AS (SELECT *, k - row_number() OVER (PARTITION BY o_custkey ORDER BY k) AS g FROM d)
SELECT o_custkey, min(k)::BIGINT AS first, max(k)::BIGINT AS last, count(*) AS n FROM i GROUP BY o_custkey, g""")
def id_ranges(t: Tables) -> DataFrame:
    return reports.id_ranges(t.orders.select("o_custkey", F.floor(F.col("o_orderkey") / 4).alias("k")), "o_custkey", "k")


@query("""SELECT l_orderkey, l_linenumber, p_partkey AS fam, p_name AS function, s_name AS genome FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey""")
def lookup_ordered(t: Tables) -> DataFrame:
    wanted = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("fam"), F.col("p_name").alias("function"))
    genomes = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("genome"))
    return wanted.join(parts, "l_partkey", "left").join(genomes, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "fam", "function", "genome").orderBy("l_orderkey", "l_linenumber")


@query("""SELECT event_type AS bin, count(*) AS elements, max(json_extract(props, '$.k')::BIGINT) AS largest, count(DISTINCT json_extract(props, '$.k')::BIGINT) AS files, round(sum(json_extract(props, '$.k')::BIGINT) / 60, 4) AS minutes FROM events GROUP BY event_type""")
def json_props(t: Tables) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return t.events.select("event_type", k.alias("k")).groupBy(F.col("event_type").alias("bin")).agg(F.count("*").alias("elements"), F.max("k").alias("largest"), F.countDistinct("k").alias("files"), F.round(F.sum("k") / 60, 4).alias("minutes"))


@query("SELECT doc_id::VARCHAR AS id, ' ' || lang || ' [' || source || ']' AS def, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents WHERE text IS NOT NULL AND regexp_replace(text, '[^A-Za-z]', '', 'g') <> ''")
def fasta_roundtrip(t: Tables) -> DataFrame:
    """Documents written in FASTA form and read again from that form."""
    docs = t.documents.where("text is not null").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit(" "), F.col("lang"), F.lit(" ["), F.col("source"), F.lit("]")).alias("def"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))
    return io.parse_fasta(docs.where("seq <> ''").select(io.fasta_record("id", "def", "seq").alias("value")))


@query("""WITH m AS (SELECT source AS fam, doc_id AS id, abs((n_chars - avg(n_chars) OVER w) / (coalesce(stddev_samp(n_chars) OVER w, 0) + 1e-9)) AS z, count(*) OVER w AS size FROM documents WINDOW w AS (PARTITION BY source)),
k AS (SELECT *, count(*) OVER (PARTITION BY fam) AS left_over FROM m WHERE size >= 20 AND z <= 1 AND id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
n AS (SELECT fam, row_number() OVER (ORDER BY fam) - 1 AS i FROM (SELECT DISTINCT fam FROM k WHERE left_over > 20))
SELECT id, 'hyp-' || lpad(i::VARCHAR, 6, '0') AS name FROM k JOIN n USING (fam)""")
def relabel_hypos(t: Tables) -> DataFrame:
    """New names for large families: of those of 20 members or more, if over 20 members near the mean and not deleted are left."""
    w = Window.partitionBy("fam")
    z = F.abs((F.col("len") - F.avg("len").over(w)) / (F.coalesce(F.stddev_samp("len").over(w), F.lit(0.0)) + 1e-9))
    m = t.documents.select(F.col("source").alias("fam"), F.col("doc_id").alias("id"), F.col("n_chars").alias("len")).withColumn("z", z).withColumn("size", F.count("*").over(w))
    gone = t.labels.where("toxic = 1").select(F.col("doc_id").alias("id"))
    kept = m.where("size >= 20 and z <= 1").join(gone, "id", "left_anti").withColumn("left_over", F.count("*").over(w)).where("left_over > 20")
    names = kept.select("fam").distinct().withColumn("name", F.concat(F.lit("hyp-"), F.lpad((F.row_number().over(Window.orderBy("fam")) - 1).cast("string"), 6, "0")))
    return kept.join(names, "fam").select("id", "name")
