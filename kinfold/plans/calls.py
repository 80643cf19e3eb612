"""From sequences to calls: documents are looked up in the signatures that they themselves teach; their source is the otu."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.functions import sequences as S
from kinfold.operators import calling, reports
from kinfold.operators import learning as L
from kinfold.operators.graph import cut_lineage
from kinfold.operators.numbering import numbered

from .learning import _LETTERS, _WEIGHTS, proteins
from .registry import Tables, query

_LOOKUP = f"""{_WEIGHTS},
means AS (SELECT o.kmer, floor(avg(len) + 1e-6)::BIGINT AS mean FROM o JOIN sigs USING (kmer, function) GROUP BY o.kmer),
ends AS (SELECT kmer, list_sort(list(len - pos))[(count(*) // 2 + 1)::BIGINT] AS from_end FROM o WHERE kmer IN (SELECT kmer FROM sigs) GROUP BY kmer),
per AS (SELECT o.kmer, source AS otu, count(*) AS n FROM o JOIN sigs USING (kmer, function) JOIN documents ON doc_id = id GROUP BY ALL),
otus AS (SELECT kmer, otu FROM per QUALIFY row_number() OVER (PARTITION BY kmer ORDER BY n DESC, otu) = 1),
lookup AS (SELECT kmer, function, round(weight, 6) AS weight, mean, from_end, otu FROM weights JOIN means USING (kmer) JOIN ends USING (kmer) LEFT JOIN otus USING (kmer)),
cu AS (SELECT id, unnest(p) AS piece, generate_subscripts(p, 1) AS n FROM (SELECT doc_id AS id, regexp_extract_all(text, '{_LETTERS}+|[^{S.AMINO}{S.AMINO.lower()}]+') AS p FROM documents WHERE text IS NOT NULL)),
cv AS (SELECT *, lead(piece) OVER (PARTITION BY id ORDER BY n) AS behind FROM cu),
co AS (SELECT id, substr(piece, i, 8) AS kmer FROM (SELECT id, piece, behind, unnest(range(1, length(piece) - 6)) AS i FROM cv WHERE length(piece) >= 8 AND regexp_matches(piece, '^{_LETTERS}'))
  WHERE i < length(piece) - 7 OR coalesce(substr(behind, 1, 1) NOT IN ('X', '*'), true))
"""


def coded_table(t: Tables) -> DataFrame:
    """Signatures (k-mers as numbers) with weight, mean length, distance from the end and otu: learnt once, written once."""
    rows = cut_lineage(L.windows(proteins(t), S.K, "otu"))
    known = cut_lineage(L.told(rows))
    weighed = L.weigh(known, rows, proteins(t)).withColumn("weight", F.round("weight", 6))
    return cut_lineage(weighed.join(L.commonest(rows, "otu"), ["kmer", "function"], "left"))


def lookup_table(t: Tables) -> DataFrame:
    """The signatures of coded_table() in letters."""
    return coded_table(t).withColumn("kmer", S.letters(F.col("kmer")))


def document_hits(t: Tables) -> DataFrame:
    return L.call_hits(proteins(t), coded_table(t))


@query(f"""WITH {_LOOKUP} SELECT id, function, count(*) AS hits, round(sum(weight), 3) AS weight, sum(mean)::BIGINT AS means, sum(from_end)::BIGINT AS from_end, count(DISTINCT otu) AS otus FROM co JOIN lookup USING (kmer) GROUP BY ALL""")
def call_hit_lookup(t: Tables) -> DataFrame:
    """Hits of every document's calling windows, by function: with what the lookup table holds of each."""
    n = document_hits(t).groupBy("id", "function")
    return n.agg(F.count("*").alias("hits"), F.round(F.sum("weight"), 3).alias("weight"), F.sum("mean").cast("long").alias("means"), F.sum("from_end").cast("long").alias("from_end"), F.countDistinct("otu").alias("otus"))


@query()
def sequence_calls(t: Tables) -> DataFrame:
    """The call of every document, from its text: regions, the five commonest otus, function, score and offset (nulls without a call).

    No SQL: the fold of hits into regions is sequential, with strays and carried pairs. Tested against a plain fold.
    """
    found = calling.folded(document_hits(t).withColumn("id", F.col("id").cast("string")))
    otus = F.array_join(F.transform("otus", lambda o: F.concat_ws(":", o["otu"], o["n"].cast("string"))), ",")
    mine = found.select(F.col("id").cast("long").alias("id"), F.size("regions").cast("long").alias("n_regions"), otus.alias("otus"), "call.function", "call.score", "call.offset")
    return t.documents.select(F.col("doc_id").alias("id")).join(mine, "id", "left")


@query("""WITH s AS (SELECT o_custkey AS id, o_orderpriority AS function, count(*) AS score FROM orders GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, function)::INTEGER AS rank FROM s), f AS (SELECT id, function, score FROM b WHERE rank = 1 AND score >= 3)
SELECT c_custkey AS id, function, f.id IS NOT NULL AS called FROM customer LEFT JOIN f ON f.id = c_custkey""")
def called_and_uncalled(t: Tables) -> DataFrame:
    """Every customer with the priority of most orders, if it has three or more: the better of the two best."""
    s = t.orders.groupBy(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("function")).agg(F.count("*").alias("score"))
    best = reports.top_k(s, 2, ["id"], F.col("score").desc(), F.col("function")).where("rank = 1")
    return calling.split_called(best, t.customer.select(F.col("c_custkey").alias("id")), 3)


_WORDS = """x AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'FIG000123: ' ELSE '' END || p_type || CASE p_partkey % 5 WHEN 0 THEN ' # frag' WHEN 1 THEN '#note' WHEN 2 THEN ' #note' WHEN 3 THEN '' ELSE ' / ' || p_brand || ' @ x;  y #' END AS text,
' ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' [' || p_brand || ']' ELSE '' END AS def, CASE WHEN p_partkey % 3 = 0 THEN 'gi|' || p_partkey || '|x' || chr(1) || 'y' ELSE 'fig|' || p_partkey || '.' || p_size || '.peg.1' || chr(1) || 'z' END AS fid, p_name || ': ' || p_brand || ',1' AS name, p_size FROM part)"""


@query(f"""WITH {_WORDS} SELECT p_partkey, regexp_replace(text, '\\s*#.*$|^FIG\\d{{6}}[^:]*:\\s*', '', 'g') AS stripped, array_to_string(regexp_split_to_array(regexp_replace(text, '\\s*#.*$', ''), '\\s+[/@]\\s+|\\s*;\\s+'), '|') AS roles,
CASE WHEN p_partkey % 2 = 0 THEN substr(split_part(def, ' [', 1), 2) END AS function, CASE WHEN p_partkey % 2 = 0 THEN rtrim(split_part(def, '[', 2), ']') END AS source,
nullif(regexp_extract(fid, 'fig\\|(\\d+\\.\\d+)', 1), '') AS genome, regexp_replace(split_part(fid, chr(1), 1), '^(gi\\|\\d+).*$', '\\1') AS nr, replace(replace(replace(name, ' ', '%20'), ',', '%2C'), ':', '%3A') AS escaped, name AS unescaped,
round(1440.0 * (p_size % 3) + 60 * (p_size % 24) + p_size % 60 + (p_size % 7) / 60.0, 4) AS minutes FROM x""")
def annotation_text(t: Tables) -> DataFrame:
    """Comments, numbers, roles, definition lines, ids and times of parts' names; comments with and without blanks around the sign."""
    k, s = F.col("p_partkey"), lambda c: F.col(c).cast("string")
    tail = F.when(k % 5 == 0, " # frag").when(k % 5 == 1, "#note").when(k % 5 == 2, " #note").when(k % 5 == 3, "").otherwise(F.concat(F.lit(" / "), "p_brand", F.lit(" @ x;  y #")))
    two = lambda c, n: F.lpad((F.col("p_size") % n).cast("string"), 2, "0")
    x = t.part.select(
        "p_partkey",
        F.concat(F.when(k % 4 == 0, "FIG000123: ").otherwise(""), "p_type", tail).alias("text"),
        F.concat(F.lit(" "), "p_name", F.when(k % 2 == 0, F.concat(F.lit(" ["), "p_brand", F.lit("]"))).otherwise("")).alias("def"),
        F.when(k % 3 == 0, F.concat(F.lit("gi|"), s("p_partkey"), F.lit("|x\x01y"))).otherwise(F.concat(F.lit("fig|"), s("p_partkey"), F.lit("."), s("p_size"), F.lit(".peg.1\x01z"))).alias("fid"),
        F.concat("p_name", F.lit(": "), "p_brand", F.lit(",1")).alias("name"),
        F.concat((F.col("p_size") % 3).cast("string"), F.lit("-"), F.concat_ws(":", two("p_size", 24), two("p_size", 60), two("p_size", 7))).alias("time"),
    )
    d = A.definition(F.col("def"))
    escaped = A.escape_id(F.col("name"))
    return x.select("p_partkey", A.strip_function(F.col("text")).alias("stripped"), F.array_join(A.roles(F.col("text")), "|").alias("roles"), d["function"].alias("function"), d["genome"].alias("source"), A.genome_of(F.col("fid")).alias("genome"), A.nr_id(F.col("fid")).alias("nr"), escaped.alias("escaped"), A.unescape_id(escaped).alias("unescaped"), F.round(A.minutes(F.col("time")), 4).alias("minutes"))


@query("""SELECT 'fig|' || p_size || '.' || p_partkey % 12 || '.' || CASE WHEN p_partkey % 3 = 0 THEN 'rna' ELSE 'peg' END || '.' || p_partkey AS fid,
row_number() OVER (ORDER BY p_size, p_partkey % 12, CASE WHEN p_partkey % 3 = 0 THEN 'rna' ELSE 'peg' END, p_partkey) AS place FROM part""")
def natural_order(t: Tables) -> DataFrame:
    """Feature ids by taxon, version, type and number as numbers."""
    s = lambda c: c.cast("string")
    k = F.col("p_partkey")
    fid = F.concat(F.lit("fig|"), s(F.col("p_size")), F.lit("."), s(k % 12), F.lit("."), F.when(k % 3 == 0, "rna").otherwise("peg"), F.lit("."), s(k))
    return numbered(t.part.select(fid.alias("fid")).withColumn("_key", A.natural_key(F.col("fid"))), "place", F.col("_key")).drop("_key")
