"""Queries on single rules: indexed functions, the two best functions of a k-mer, coding references, new names of hypothetical families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import families, nr
from kinfold.operators import signatures as G

from .learning import _ROWS, proteins
from .registry import Tables, query


@query("""WITH a AS (SELECT doc_id AS id, nullif(source, '') || '/' || lang AS function FROM documents WHERE source <> 'src0'), n AS (SELECT function FROM a WHERE function IS NOT NULL GROUP BY function HAVING count(*) >= 3),
x AS (SELECT function, row_number() OVER (ORDER BY function) - 1 AS idx FROM n)
SELECT x.idx::INTEGER AS idx, x.function, count(*) AS n_seqs, sum(length(text))::BIGINT AS letters FROM a JOIN x USING (function) JOIN documents ON doc_id = id GROUP BY ALL""")
def indexed_sequences(t: Tables) -> DataFrame:
    """Sequences of each indexed function. Functions are source and language, src0 is unassigned, those of fewer than three sequences aren't indexed."""
    docs = t.documents
    named = docs.where("source <> 'src0'").select(F.col("doc_id").alias("id"), F.concat("source", F.lit("/"), "lang").alias("function"))
    index = G.function_index(named.where("function is not null").groupBy("function").agg(F.count("*").alias("n")).where("n >= 3"))
    rows = G.indexed(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), named, index)
    return rows.groupBy("idx", "function").agg(F.count("*").alias("n_seqs"), F.sum(F.length("seq")).alias("letters"))


@query(f"""WITH {_ROWS}, k AS (SELECT kmer, function, count(*) AS n FROM o GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY kmer ORDER BY n DESC, function) AS r, sum(n) OVER (PARTITION BY kmer) AS n_total FROM k)
SELECT kmer, any_value(n_total)::BIGINT AS n_total, max(function) FILTER (WHERE r = 1) AS function, max(n) FILTER (WHERE r = 1) AS n_function, max(function) FILTER (WHERE r = 2) AS second, max(n) FILTER (WHERE r = 2) AS n_second FROM b WHERE r <= 2 GROUP BY kmer""")
def kmer_two_best(t: Tables) -> DataFrame:
    return G.two_best(G.occurrences(proteins(t)))


_IDS = "CASE WHEN doc_id % 5 = 0 THEN 'gi|' || doc_id ELSE 'fig|' || (doc_id % 40 + 100) || '.' || (doc_id % 3) || CASE doc_id % 4 WHEN 0 THEN '.rna.' WHEN 1 THEN '.CDS.' ELSE '.peg.' END || doc_id END"


@query(f"""WITH r AS (SELECT DISTINCT {_IDS} AS id, 'gnl|md5|' || md5(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')) AS md5 FROM documents WHERE text IS NOT NULL),
f AS (SELECT md5, min(id) AS ref FROM r GROUP BY md5)
SELECT md5, ref, regexp_extract(ref, 'fig\\|(\\d+\\.\\d+)', 1) AS genome, id FROM r JOIN f USING (md5) WHERE regexp_matches(ref, '^fig\\|\\d+\\.\\d+\\.(CDS|peg)\\.\\d+$') AND regexp_matches(id, '^fig\\|\\d+\\.\\d+\\.(CDS|peg)\\.\\d+$')""")
def coding_references(t: Tables) -> DataFrame:
    """Documents under ids of several kinds: what is left of the groups whose first id is a coding feature."""
    s = lambda c: c.cast("string")
    k = F.col("doc_id")
    kind = F.when(k % 4 == 0, ".rna.").when(k % 4 == 1, ".CDS.").otherwise(".peg.")
    fid = F.when(k % 5 == 0, F.concat(F.lit("gi|"), s(k))).otherwise(F.concat(F.lit("fig|"), s(k % 40 + 100), F.lit("."), s(k % 3), kind, s(k)))
    return nr.reference_rows(t.documents.where("text is not null").select(fid.alias("id"), F.col("text").alias("seq")))


_FUNCTION = "CASE substr(source, 4)::INTEGER % 3 WHEN 0 THEN 'hypothetical protein' WHEN 1 THEN 'unknown core_cid ' || source ELSE 'named' END"


@query(f"""WITH m AS (SELECT source AS fam, doc_id AS id, n_chars AS len FROM documents), d AS (SELECT fam, count(*) AS size, avg(len) AS mean, coalesce(stddev_samp(len), 0) AS sd FROM m GROUP BY fam),
h AS (SELECT d.* FROM d JOIN (SELECT DISTINCT source AS fam, {_FUNCTION} AS f FROM documents) USING (fam) WHERE size >= 20 AND (f = 'hypothetical protein' OR contains(f, 'core_cid'))),
k AS (SELECT fam, id FROM m JOIN h USING (fam) WHERE abs(round((len - mean) / (sd + 1e-9), 3)) <= 1 AND id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
n AS (SELECT fam, row_number() OVER (ORDER BY fam) - 1 AS i FROM k GROUP BY fam HAVING count(*) > 20)
SELECT id, fam, 'hyp-' || lpad(i::VARCHAR, 6, '0') AS name FROM k JOIN n USING (fam)""")
def relabel_hypothetical(t: Tables) -> DataFrame:
    """New names for the hypothetical ones among the sources as families; a third of the sources have names."""
    members = families.z_scores(t.documents.select(F.col("source").alias("fam"), F.col("doc_id").alias("id"), F.col("n_chars").alias("len")))
    third = F.substring("fam", 4, 9).cast("int") % 3
    function = F.when(third == 0, "hypothetical protein").when(third == 1, F.concat(F.lit("unknown core_cid "), "fam")).otherwise("named")
    defs = t.documents.groupBy(F.col("source").alias("fam")).agg(F.count("*").alias("size")).withColumn("function", function)
    return families.relabelled(defs, members, t.labels.where("toxic = 1").select(F.col("doc_id").alias("id")))
