"""Queries on similarity, graphs and families."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.functions.sequences import kmer_sets
from kinfold.operators import families as M
from kinfold.operators import folds, graph, nr, propagate, reports

from .registry import Tables, query

_PAIRS = """c AS (SELECT item_id AS id, string_split(text, '') AS s FROM benchmark), w AS (SELECT DISTINCT id, array_to_string(s[i:i + 4], '') AS kmer FROM (SELECT id, s, unnest(range(1, len(s) - 3)) AS i FROM c WHERE len(s) >= 5)),
v AS (SELECT * FROM w WHERE regexp_matches(kmer, '^[ACDEFGHIKLMNPQRSTVWYacdefghiklmnpqrstvwy]{5}$')), n AS (SELECT id, count(*) AS n FROM v GROUP BY id),
p AS (SELECT a.id AS id1, b.id AS id2, count(*) AS n_common FROM v a JOIN v b ON a.kmer = b.kmer AND a.id < b.id GROUP BY ALL HAVING count(*) >= 5)"""


def similar_items(t: Tables) -> DataFrame:
    return nr.shared_kmers(t.benchmark.select(F.col("item_id").alias("id"), F.lit("benchmark").alias("function"), F.col("text").alias("seq")), k=5, least=5)


@query(f"WITH {_PAIRS} SELECT 'benchmark' AS function, id1, id2, n_common, round(n_common / least(x.n, y.n), 6) AS score FROM p JOIN n x ON x.id = id1 JOIN n y ON y.id = id2")
def pairwise_shared_kmers(t: Tables) -> DataFrame:
    return similar_items(t).withColumn("score", F.round("score", 6))


@query("SELECT source AS function, CASE WHEN count(*) OVER (PARTITION BY source) <= 40 THEN 0 WHEN n_chars <= 100 THEN 1 WHEN n_chars <= 200 THEN 2 ELSE 3 END AS stratum, n_chars AS len, doc_id FROM documents")
def stratify_groups(t: Tables) -> DataFrame:
    return nr.stratify(t.documents.select("doc_id", F.col("source").alias("function"), F.col("n_chars").alias("len")), 40)


_EDGES = """e AS (SELECT lag(p_partkey) OVER (PARTITION BY p_name, p_size ORDER BY p_partkey) AS a, p_partkey AS b FROM part UNION SELECT lag(p_partkey) OVER (PARTITION BY p_brand, p_size, p_type ORDER BY p_partkey), p_partkey FROM part)"""


def part_edges(t: Tables) -> DataFrame:
    """Parts in a row by name and size, and by brand, size and type."""
    one = lambda *by: t.part.select(F.lag("p_partkey").over(Window.partitionBy(*by).orderBy("p_partkey")).alias("a"), F.col("p_partkey").alias("b")).where("a is not null")
    return one("p_name", "p_size").union(one("p_brand", "p_size", "p_type")).distinct()


@query(f"""WITH RECURSIVE {_EDGES}, u AS (SELECT a, b FROM e WHERE a IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL), r AS (SELECT a AS node, a AS other FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.other = u.a)
SELECT node, min(other) AS component FROM r GROUP BY node""")
def connected_components(t: Tables) -> DataFrame:
    return graph.components(part_edges(t))


@query()
def mcl_clusters(t: Tables) -> DataFrame:
    e = similar_items(t).select(F.col("function").alias("group"), F.col("id1").alias("a"), F.col("id2").alias("b"), F.col("score").alias("weight"))
    return graph.markov_clusters(e, 3.0)


@query()
def representative_clusters(t: Tables) -> DataFrame:
    pairs = similar_items(t).select(F.col("id1").alias("a"), F.col("id2").alias("b"), "score")
    return graph.representatives(pairs, t.benchmark.select(F.col("item_id").alias("id"), F.length("text").alias("size")), 0.1)


def distinct_documents(t: Tables) -> DataFrame:
    """(function, seq, id, ids): documents with text by language, equal texts as one under their least id."""
    return t.documents.where("text is not null").groupBy(F.col("lang").alias("function"), F.col("text").alias("seq")).agg(F.min("doc_id").alias("id"), F.array_sort(F.collect_set("doc_id")).alias("ids"))


@query()
def pairwise_shared_kmers_documents(t: Tables) -> DataFrame:
    """Pairs of distinct texts of a language that share five 8-mers or more. (No SQL: its self-join over all documents takes too long.)"""
    return nr.shared_kmers(distinct_documents(t)).withColumn("score", F.round("score", 6))


@query()
def mcl_clusters_documents(t: Tables) -> DataFrame:
    """Documents in clusters of two or more: links are those of distinct texts, and copies go with their text."""
    texts = graph.cut_lineage(distinct_documents(t))
    e = graph.cut_lineage(nr.shared_kmers(texts).select(F.col("function").alias("group"), F.col("id1").alias("a"), F.col("id2").alias("b"), F.col("score").alias("weight")))
    found = graph.markov_clusters(e, 3.0).select("cluster", F.col("member").alias("id"))
    all_ = texts.select(F.col("function").alias("group"), "id", "ids").join(found, "id", "left").where("cluster is not null or size(ids) > 1")
    named = graph.cut_lineage(all_.select("group", F.coalesce("cluster", "id").alias("cluster"), F.explode("ids").alias("member")))
    several = named.groupBy("cluster").count().where("count > 1").select("cluster")
    return named.join(several, "cluster").select("group", "cluster", "member")


@query()
def representative_clusters_documents(t: Tables) -> DataFrame:
    """Every document with its representative, at the reference's identity; copies go with their text."""
    texts = distinct_documents(t).withColumn("size", F.length("seq"))
    own = graph.cut_lineage(kmer_sets(texts, "seq"))  # texts aren't written
    found = nr.representatives(own.select("function", "id", "size", "kmers"), identity=0.5).select(F.col("function").alias("_f"), "rep", F.col("member").alias("_m"))
    named = own.select("function", "id", "ids").join(found, F.col("function").eqNullSafe(F.col("_f")) & (F.col("id") == F.col("_m")), "left")
    return named.select(F.coalesce("rep", "id").alias("rep"), F.explode("ids").alias("member"))


@query("SELECT p_brand, p_size, count(*) AS n, CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) ELSE '' END AS gene FROM part GROUP BY ALL")
def consensus_name(t: Tables) -> DataFrame:
    return M.consensus(t.part.select("p_brand", "p_size", F.col("p_type").alias("gene")), "p_brand", "p_size")


@query("SELECT c_custkey AS id, c_mktsegment AS function FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_acctbal >= 0")
def unclassified_anti(t: Tables) -> DataFrame:
    """Customers without a finished order (no cluster) and in credit (not truncated)."""
    clustered = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    short = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("function")).join(clustered, "id", "left_anti").join(short, "id", "left_anti")


@query("""WITH l AS (SELECT doc_id AS id, coalesce(q.function, 'hypothetical protein') AS function FROM documents LEFT JOIN (SELECT doc_id, 'quality ' || quality AS function FROM labels) q USING (doc_id) WHERE source <> 'src1'),
m AS (SELECT 'quality ' || quality AS function, max(toxic) AS top FROM labels GROUP BY ALL)
SELECT l.function, (coalesce(m.top, 0) + row_number() OVER (PARTITION BY l.function ORDER BY id))::BIGINT AS sub, id FROM l LEFT JOIN m USING (function)""")
def singleton_families(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("id"), "source")
    named = F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("function")
    return M.singletons(docs, docs.where("source = 'src1'"), t.labels.select(F.col("doc_id").alias("id"), named), t.labels.select(named, F.col("toxic").cast("long").alias("sub")))


_SETS = """s AS (SELECT p_name AS function, 'A' AS source, p_size AS idx, count(*) AS size FROM part WHERE p_type = 'ECONOMY' GROUP BY ALL UNION ALL SELECT p_name, 'B', p_size, count(*) FROM part WHERE p_type = 'PROMO' GROUP BY ALL),
f AS (SELECT *, row_number() OVER (ORDER BY size DESC, function, source, idx) AS fam FROM s)"""


def part_sets(t: Tables) -> DataFrame:
    one = lambda kind: t.part.where(F.col("p_type") == kind).groupBy(F.col("p_name").alias("function"), F.col("p_size").alias("idx")).agg(F.count("*").alias("size"))
    return M.number(M.united(A=one("ECONOMY"), B=one("PROMO")))


@query(f"WITH {_SETS} SELECT 'LFIG' || lpad(fam::VARCHAR, 8, '0') AS fam, function, source, idx, size FROM f")
def family_union_sources(t: Tables) -> DataFrame:
    return part_sets(t).withColumn("fam", A.family_id(F.col("fam"), "LFIG"))


_MEMBERS = f"""{_SETS}, m AS (SELECT fam, p_partkey AS id, p_retailprice AS len FROM f JOIN part ON p_name = function AND p_size = idx AND p_type = CASE source WHEN 'A' THEN 'ECONOMY' ELSE 'PROMO' END)"""


def part_members(t: Tables) -> DataFrame:
    kind = F.when(F.col("source") == "A", "ECONOMY").otherwise("PROMO")
    rows = t.part.select("p_partkey", F.col("p_name").alias("function"), F.col("p_size").alias("idx"), F.col("p_type").alias("kind"), "p_retailprice")
    return part_sets(t).withColumn("kind", kind).join(rows, ["function", "idx", "kind"]).select("fam", "function", F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("len"))


@query(f"WITH {_MEMBERS} SELECT fam::INTEGER AS fam, count(*) AS n, round(avg(len), 4) AS mean, round(stddev_samp(len), 4) AS sd FROM m GROUP BY fam")
def family_defs(t: Tables) -> DataFrame:
    return M.describe(part_members(t)).withColumn("mean", F.round("mean", 4)).withColumn("sd", F.round("sd", 4))


@query("""WITH d AS (SELECT source AS fam, avg(n_chars) AS mean, stddev_samp(n_chars) AS sd FROM documents GROUP BY source) SELECT fam, doc_id AS id, n_chars AS len, round((n_chars - mean) / (coalesce(sd, 0) + 1e-9), 3) AS z FROM documents JOIN d ON fam = source""")
def family_zscores(t: Tables) -> DataFrame:
    return M.z_scores(t.documents.select(F.col("source").alias("fam"), F.col("doc_id").alias("id"), F.col("n_chars").alias("len")))


@query("""WITH d AS (SELECT source AS fam, lang, avg(n_chars) AS mean, stddev_samp(n_chars) AS sd FROM documents GROUP BY ALL) SELECT doc_id AS id, n_chars AS len, source || '/' || documents.lang AS fam FROM documents JOIN d ON fam = source AND d.lang = documents.lang WHERE sd IS NULL OR n_chars BETWEEN mean - 2 * sd AND mean + 2 * sd""")
def length_outliers(t: Tables) -> DataFrame:
    return M.within(t.documents.select(F.concat_ws("/", "source", "lang").alias("fam"), F.col("doc_id").alias("id"), F.col("n_chars").alias("len"))).select("id", "len", "fam")


@query("""SELECT 'src' || p_brand AS fam, count(*) AS n_members, count(DISTINCT p_type) AS n_genera, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS genera, count(*) = 1 AS single FROM part GROUP BY ALL""")
def family_split_defs(t: Tables) -> DataFrame:
    return M.split_definitions(t.part.select(F.concat(F.lit("src"), F.col("p_brand")).alias("fam"), F.col("p_type").alias("genus")))


@query("""SELECT coalesce(n, 'GLOBAL') AS scope, CASE WHEN n IS NULL THEN max(s_suppkey) ELSE max(s_nationkey) END::BIGINT AS max_id FROM (SELECT *, 'N' || (s_nationkey % 5) AS n FROM supplier) GROUP BY GROUPING SETS ((n), ())""")
def max_ids(t: Tables) -> DataFrame:
    return M.max_ids(t.supplier.select(F.concat(F.lit("N"), (F.col("s_nationkey") % 5).cast("string")).alias("genus"), F.col("s_nationkey").cast("long").alias("lfam"), F.col("s_suppkey").alias("gfam")))


@query("""WITH RECURSIVE l AS (SELECT DISTINCT p_type AS function, p_brand AS genus, p_size AS lfam, p_type || chr(1) || p_brand || chr(1) || lpad(p_size::VARCHAR, 20, '0') AS node FROM part WHERE p_type <> ''),
c AS (SELECT DISTINCT p_type AS function, p_name || ':' || floor(p_retailprice / 2)::BIGINT AS cluster, p_brand AS genus, p_size AS lfam FROM part),
e AS (SELECT lag(node) OVER (PARTITION BY function, cluster ORDER BY genus, lfam) AS a, node AS b FROM c JOIN l USING (function, genus, lfam)),
u AS (SELECT a, b FROM e WHERE a IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL),
r AS (SELECT node, node AS other FROM l UNION SELECT r.node, u.b FROM r JOIN u ON r.other = u.a),
k AS (SELECT node, min(other) AS component FROM r GROUP BY node),
s AS (SELECT component, function, count(*) AS n_lfams, count(DISTINCT genus) AS n_genera FROM k JOIN l USING (node) GROUP BY ALL),
g AS (SELECT *, 'PGF_' || lpad((row_number() OVER (ORDER BY n_lfams = 1, function, component) - 1)::VARCHAR, 8, '0') AS gfam FROM s)
SELECT gfam, l.function, genus, lfam, n_lfams, n_genera FROM k JOIN l USING (node) JOIN g USING (component)""")
def global_merge(t: Tables) -> DataFrame:
    """Local families: (type, brand, size) of parts; clusters: parts of one name and price class."""
    locals_ = t.part.select(F.col("p_type").alias("function"), F.col("p_brand").alias("genus"), F.col("p_size").alias("lfam"))
    clusters = t.part.select(F.col("p_type").alias("function"), F.concat_ws(":", "p_name", F.floor(F.col("p_retailprice") / 2).cast("string")).alias("cluster"), F.col("p_brand").alias("genus"), F.col("p_size").alias("lfam"))
    return M.merge_global(clusters, locals_)


@query("""WITH RECURSIVE f AS (SELECT item, size, row_number() OVER (ORDER BY size DESC, item) AS n FROM (SELECT source || '/' || lang AS item, greatest(5000, sum(n_chars))::BIGINT AS size FROM documents GROUP BY source, lang)),
r AS (SELECT ''::VARCHAR AS item, 0::BIGINT AS size, 0::BIGINT AS n, 0 AS bin, list_value(0::BIGINT, 0, 0, 0, 0, 0, 0, 0) AS loads UNION ALL
SELECT f.item, f.size, f.n, (list_position(loads, list_min(loads)) - 1)::INTEGER, list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + f.size ELSE x END) FROM r JOIN f ON f.n = r.n + 1)
SELECT item, size, bin FROM r WHERE n > 0""")
def lpt_bins(t: Tables) -> DataFrame:
    cost = t.documents.groupBy("source", "lang").agg(F.greatest(F.lit(5000), F.sum("n_chars")).cast("long").alias("size"))
    return folds.lpt_bins(cost.select(F.concat_ws("/", "source", "lang").alias("item"), "size"), 8)


_OLD = """old AS (SELECT l_orderkey * 10 + l_linenumber AS md5, l_partkey AS fam FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01'),
new AS (SELECT l_orderkey * 10 + l_linenumber AS md5, CASE WHEN l_quantity > 40 THEN l_partkey * 2 + 1 ELSE l_partkey * 2 END AS fam FROM lineitem WHERE l_partkey % 3 = 0
UNION ALL SELECT l_orderkey * 10 + l_linenumber, -1 - l_partkey // 2 FROM lineitem WHERE l_partkey % 3 <> 0 AND l_shipdate >= TIMESTAMP '1996-01-01'),
o AS (SELECT md5, min(fam) AS old_fam FROM (SELECT md5, fam, count(*) OVER (PARTITION BY fam) AS c FROM old) WHERE c >= 2 GROUP BY md5),
n AS (SELECT md5, min(fam) AS new_fam FROM (SELECT md5, fam, count(*) OVER (PARTITION BY fam) AS c FROM new) WHERE c >= 2 GROUP BY md5),
b AS (SELECT n.new_fam, o.old_fam FROM n JOIN (SELECT DISTINCT md5 FROM old) USING (md5) LEFT JOIN o USING (md5)),
w AS (SELECT new_fam, count(DISTINCT old_fam) AS k, count(*) FILTER (old_fam IS NULL) AS lost FROM b GROUP BY new_fam),
p AS (SELECT old_fam, new_fam, count(*) AS n FROM b WHERE old_fam IS NOT NULL GROUP BY ALL),
c AS (SELECT p.*, max(CASE WHEN k > 1 OR lost > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY old_fam) AS bad FROM p JOIN w USING (new_fam)),
one AS (SELECT old_fam, new_fam, n, CASE WHEN count(*) OVER (PARTITION BY old_fam) = 1 THEN 'NOW' ELSE 'SPLIT' END AS kind, row_number() OVER (PARTITION BY old_fam ORDER BY n DESC, new_fam)::INTEGER AS rank FROM c WHERE bad = 0)"""
_TWO = f"""{_OLD}, known AS (SELECT new_fam, max(CASE WHEN x.md5 IS NULL THEN 0 ELSE 1 END) AS any_old FROM n LEFT JOIN (SELECT DISTINCT md5 FROM old) x USING (md5) WHERE new_fam NOT IN (SELECT new_fam FROM one) GROUP BY new_fam),
spread AS (SELECT old_fam, count(DISTINCT new_fam) AS w FROM p GROUP BY old_fam),
q AS (SELECT new_fam, old_fam, n, max(w) OVER (PARTITION BY new_fam) AS w, count(*) OVER (PARTITION BY new_fam) AS n_old, row_number() OVER (PARTITION BY new_fam ORDER BY n DESC, old_fam) AS r FROM p JOIN spread USING (old_fam) WHERE new_fam NOT IN (SELECT new_fam FROM one)),
two AS (SELECT new_fam, 'NEW' AS kind, NULL::BIGINT AS old_fam, 0::BIGINT AS n_old FROM known WHERE any_old = 0 UNION ALL SELECT new_fam, 'JOIN', old_fam, n_old FROM q WHERE r = 1 AND w = 1)"""


def releases(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order lines as members, parts as old families; some are split by quantity in the new release, the others joined by twos."""
    md5 = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("md5")
    old = t.lineitem.where("l_shipdate < timestamp '2001-01-01'").select(md5, F.col("l_partkey").alias("fam"))
    parted = t.lineitem.where("l_partkey % 3 = 0").select(md5, F.when(F.col("l_quantity") > 40, F.col("l_partkey") * 2 + 1).otherwise(F.col("l_partkey") * 2).alias("fam"))
    joined = t.lineitem.where("l_partkey % 3 <> 0 and l_shipdate >= timestamp '1996-01-01'").select(md5, (-1 - F.floor(F.col("l_partkey") / 2)).cast("long").alias("fam"))
    return old, parted.unionByName(joined)


@query(f"WITH {_OLD} SELECT * FROM one")
def propagate_phase1(t: Tables) -> DataFrame:
    return propagate.phase1(*releases(t))


@query(f"WITH {_TWO} SELECT * FROM two")
def propagate_join(t: Tables) -> DataFrame:
    return propagate.phase2(*releases(t))


@query(f"""WITH {_TWO}, named AS (SELECT new_fam FROM one UNION SELECT new_fam FROM two), used AS (SELECT old_fam FROM one UNION SELECT old_fam FROM two WHERE old_fam IS NOT NULL),
t AS (SELECT old_fam, new_fam, n / sum(n) OVER (PARTITION BY old_fam) AS weight, row_number() OVER (PARTITION BY old_fam ORDER BY n DESC, new_fam) AS r FROM p),
f AS (SELECT new_fam, old_fam, weight, row_number() OVER (PARTITION BY new_fam ORDER BY weight DESC, old_fam) AS r FROM t WHERE r = 1 AND weight > 0.75 AND old_fam NOT IN (SELECT old_fam FROM used) AND new_fam NOT IN (SELECT new_fam FROM named))
SELECT new_fam, old_fam, round(weight, 6) AS weight FROM f WHERE r = 1""")
def propagate_dominant(t: Tables) -> DataFrame:
    return propagate.phase3(*releases(t)).withColumn("weight", F.round("weight", 6))


@query("""WITH f AS (SELECT c_custkey AS gfam, 'N' || c_nationkey AS genus, c_custkey % 50 AS lfam FROM customer)
SELECT f.gfam, f.genus, f.lfam, g.new_gfam, coalesce(l.new_lfam, f.lfam)::BIGINT AS new_lfam, g.new_gfam IS NOT NULL AS mapped FROM f LEFT JOIN (SELECT s_suppkey * 2 AS gfam, 'GF' || lpad(s_suppkey::VARCHAR, 8, '0') AS new_gfam FROM supplier) g USING (gfam)
LEFT JOIN (SELECT 'N' || n_nationkey AS genus, n_regionkey::BIGINT AS lfam, n_nationkey + 1000 AS new_lfam FROM nation) l USING (genus, lfam)""")
def rename_apply(t: Tables) -> DataFrame:
    fams = t.customer.select(F.col("c_custkey").alias("gfam"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("genus"), (F.col("c_custkey") % 50).alias("lfam"))
    local = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("genus"), F.col("n_regionkey").cast("long").alias("lfam"), (F.col("n_nationkey") + 1000).cast("long").alias("new_lfam"))
    return propagate.rename(fams, local, t.supplier.select((F.col("s_suppkey") * 2).alias("gfam"), A.family_id(F.col("s_suppkey"), "GF").alias("new_gfam")))


@query("SELECT size::BIGINT AS size, count(*) AS n FROM (SELECT conv_id, count(*) AS size FROM conversations GROUP BY conv_id) GROUP BY size")
def cluster_histogram(t: Tables) -> DataFrame:
    return reports.histogram(t.conversations, "conv_id")


@query("""SELECT f.fam, f.size, rank() OVER (ORDER BY f.size DESC, f.fam)::INTEGER AS rank FROM (SELECT p_name AS fam, count(*) AS size, min(p_size) AS least FROM part GROUP BY p_name) f WHERE f.size > 2 AND least >= 1 QUALIFY rank <= 25""")
def size_floor_topk(t: Tables) -> DataFrame:
    """The 25 largest families of more than two members whose every member is long enough."""
    f = t.part.groupBy(F.col("p_name").alias("fam")).agg(F.count("*").alias("size"), F.min("p_size").alias("least")).where("size > 2 and least >= 1").drop("least")
    return f.orderBy(F.col("size").desc(), "fam").limit(25).withColumn("rank", F.row_number().over(Window.orderBy(F.col("size").desc(), "fam")))
