"""Queries on k-mers, signatures, annotation text and calling. Documents stand for proteins, their language for the function, their source for the genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import annotations as A
from kinfold.functions import sequences as S
from kinfold.operators import calling, nr, reports
from kinfold.operators import learning as L
from kinfold.operators import signatures as G
from kinfold.operators.graph import cut_lineage

from .registry import Tables, query

_LETTERS = f"[{S.AMINO}{S.AMINO.lower()}]"
# The SQL cuts a text into runs of letters and of others, so that windows are taken from short strings.
_ROWS = f"""
c AS (SELECT doc_id AS id, lang AS function, text, length(text) AS len FROM documents WHERE lang IS NOT NULL AND lang <> ''),
u AS (SELECT id, function, len, unnest(p) AS piece, generate_subscripts(p, 1) AS n FROM (SELECT id, function, len, regexp_extract_all(text, '{_LETTERS}+|[^{S.AMINO}{S.AMINO.lower()}]+') AS p FROM c)),
v AS (SELECT *, sum(length(piece)) OVER (PARTITION BY id ORDER BY n) - length(piece) AS first FROM u),
o AS (SELECT id, function, len, first + i - 1 AS pos, substr(piece, i, 8) AS kmer FROM (SELECT id, function, len, piece, first, unnest(range(1, length(piece) - 6)) AS i FROM v WHERE length(piece) >= 8 AND regexp_matches(piece, '^{_LETTERS}')))
"""
_SIGS = f"""{_ROWS},
k AS (SELECT kmer, function, count(*) AS n FROM o GROUP BY ALL),
b AS (SELECT kmer, function, n, sum(n) OVER (PARTITION BY kmer) AS total, row_number() OVER (PARTITION BY kmer ORDER BY n DESC, function) AS r FROM k),
sigs AS (SELECT kmer, function, n::BIGINT AS n_function, total::BIGINT AS n_total FROM b WHERE r = 1 AND n >= 0.8 * total)
"""
_WEIGHTS = f"""{_SIGS},
nsf AS (SELECT count(DISTINCT id) AS nsf FROM o WHERE kmer IN (SELECT kmer FROM sigs)),
nfj AS (SELECT lang AS function, count(*) AS nfj FROM documents WHERE lang IS NOT NULL AND lang <> '' GROUP BY lang),
ks AS (SELECT count(*) AS ks FROM sigs),
weights AS (SELECT kmer, function, n_function, n_total, ln((n_function + 1) / (n_total - n_function + 1)) + ln((nsf - nfj + ks) / (nfj + ks)) AS weight FROM sigs JOIN nfj USING (function), nsf, ks)
"""


def proteins(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("function"), F.col("text").alias("seq"), F.col("source").alias("otu"))


def learnt(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Lists of windows and the signatures among them (k-mers as numbers): both are written once, whatever reads them how often."""
    rows = cut_lineage(L.windows(proteins(t)))
    return rows, cut_lineage(G.shared(L.counts(rows)))


def _spelt(df: DataFrame) -> DataFrame:
    return df.withColumn("kmer", S.letters(F.col("kmer")))


@query(f"WITH {_ROWS} SELECT id, pos::INTEGER AS pos, kmer FROM o")
def kmer_explode(t: Tables) -> DataFrame:
    return G.occurrences(proteins(t)).select("id", "pos", "kmer")


@query(f"""WITH {_ROWS}, run AS (SELECT id, sum(greatest(0, length(r) - 8)) AS n FROM (SELECT id, unnest(regexp_extract_all(text, '[^*X]+')) AS r FROM c) GROUP BY id)
SELECT c.id, greatest(len - 7, 0)::BIGINT AS n_windows, coalesce(v.n, 0)::BIGINT AS n_valid, (coalesce(run.n, 0) + CASE WHEN regexp_matches(text, '[^*X]{{8}}$') THEN 1 ELSE 0 END)::BIGINT AS n_callable
FROM c LEFT JOIN (SELECT id, count(*) AS n FROM o GROUP BY id) v USING (id) LEFT JOIN run USING (id)""")
def kmer_valid_filter(t: Tables) -> DataFrame:
    """Windows, those that building keeps and those that calling looks at, of each sequence."""
    p = proteins(t).where("function is not null and function <> ''")
    n = G.occurrences(p).groupBy("id").agg(F.count("*").alias("n"))
    return p.select("id", F.greatest(F.length("seq") - 7, F.lit(0)).cast("long").alias("n_windows"), S.callable_windows(F.col("seq")).alias("n_callable")).join(n, "id", "left").select("id", "n_windows", F.coalesce("n", F.lit(0)).alias("n_valid"), "n_callable")


@query(f"WITH {_ROWS} SELECT kmer, function, count(*) AS n FROM o GROUP BY ALL")
def kmer_counts(t: Tables) -> DataFrame:
    return _spelt(L.counts(L.windows(proteins(t))))


@query(f"WITH {_SIGS} SELECT * FROM sigs")
def signature_kmers(t: Tables) -> DataFrame:
    return _spelt(G.shared(L.counts(L.windows(proteins(t)))))


@query(f"WITH {_WEIGHTS} SELECT kmer, function, n_function, n_total, round(weight, 6) AS weight, greatest(0, least(255, floor(30 * round(weight, 6))))::INTEGER AS byte FROM weights")
def signature_weights(t: Tables) -> DataFrame:
    rows, sigs = learnt(t)
    return _spelt(L.weigh(sigs, rows, proteins(t))).withColumn("weight", F.round("weight", 6)).withColumn("byte", A.clamp_byte(F.col("weight")))


@query(f"WITH {_SIGS} SELECT kmer, list_sort(list(len - pos))[(count(*) // 2 + 1)::BIGINT]::INTEGER AS avg_from_end FROM o WHERE kmer IN (SELECT kmer FROM sigs) GROUP BY kmer")
def signature_offset_median(t: Tables) -> DataFrame:
    return _spelt(L.told(L.windows(proteins(t)), lengths=False)).select("kmer", "avg_from_end")


@query(f"""WITH {_SIGS} SELECT o.kmer, floor(avg(len) + 1e-6)::BIGINT AS mean, floor(quantile_cont(len, 0.5) + 1e-6)::BIGINT AS median, floor(var_pop(len) + 1e-6)::BIGINT AS var
FROM o JOIN sigs USING (kmer, function) GROUP BY o.kmer""")
def signature_length_stats(t: Tables) -> DataFrame:
    return _spelt(L.told(L.windows(proteins(t)), ends=False)).select("kmer", "mean", "median", "var")


@query(f"WITH {_SIGS}, f AS (SELECT function, row_number() OVER (ORDER BY function) - 1 AS idx FROM (SELECT DISTINCT lang AS function FROM documents WHERE lang IS NOT NULL AND lang <> '')) SELECT f.idx::INTEGER AS idx, function, count(*) AS n_signatures FROM sigs JOIN f USING (function) GROUP BY ALL")
def signatures_per_function(t: Tables) -> DataFrame:
    sigs = G.shared(L.counts(L.windows(proteins(t))))
    index = G.function_index(proteins(t).where("function is not null and function <> ''"))
    return sigs.groupBy("function").agg(F.count("*").alias("n_signatures")).join(index, "function").select("idx", "function", "n_signatures")


@query(f"WITH {_WEIGHTS} SELECT id, o.function AS own, weights.function, count(*) AS hits, round(sum(round(weight, 6)), 3) AS weight FROM o JOIN weights USING (kmer) GROUP BY ALL")
def hit_lookup(t: Tables) -> DataFrame:
    """Hits of each sequence by the function that its k-mers sign for."""
    rows, sigs = learnt(t)
    each = rows.select("id", F.col("function").alias("own"), F.explode("kmers").alias("kmer"))
    found = each.join(L.weigh(sigs, rows, proteins(t)).select("kmer", "function", F.round("weight", 6).alias("weight")), "kmer")
    return found.groupBy("id", "own", "function").agg(F.count("*").alias("hits"), F.round(F.sum("weight"), 3).alias("weight"))


@query("""WITH e AS (SELECT l_partkey AS function, l_suppkey AS genome FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')), n AS (SELECT function, count(DISTINCT genome) AS n_genomes FROM e GROUP BY function)
SELECT n.function, n_genomes FROM n JOIN part ON p_partkey = function WHERE (n_genomes >= 18 OR p_size = 50 OR p_type = 'PROMO') AND p_brand <> 'Brand#1'""")
def kept_functions(t: Tables) -> DataFrame:
    """Parts as functions, suppliers as genomes, lines of finished orders as deleted features."""
    gone = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    seen = t.lineitem.join(gone, "l_orderkey", "left_anti").select(F.col("l_partkey").alias("function"), F.col("l_suppkey").alias("genome"))
    part = t.part.select(F.col("p_partkey").alias("function"), "p_size", "p_type", "p_brand")
    value = F.col("function").alias("value")
    good_roles = t.part.where("p_type = 'PROMO'").select(F.col("p_type").alias("value")).distinct()
    return G.kept_functions(seen, part.where("p_size = 50").select(value), good_roles, part.select("function", F.col("p_type").alias("role")), part.where("p_brand = 'Brand#1'").select(value), 18)


@query("SELECT (row_number() OVER (ORDER BY function) - 1)::INTEGER AS idx, function FROM (SELECT DISTINCT p_name AS function FROM part)")
def function_index(t: Tables) -> DataFrame:
    return G.function_index(t.part.select(F.col("p_name").alias("function")))


@query("""WITH a AS (SELECT o_custkey AS id, o_orderpriority AS function, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
SELECT c_custkey AS id, coalesce(a.function, c_mktsegment) AS function, a.id IS NOT NULL AS assigned FROM customer LEFT JOIN a ON a.id = c_custkey AND r = 1""")
def assignment_last_wins(t: Tables) -> DataFrame:
    """The last assignment of an id wins, and it wins over the definition line's function."""
    last = reports.last_wins(t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("function"), "o_orderdate", "o_orderkey"), "id", "o_orderdate", "o_orderkey")
    own = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("own"))
    return own.join(last.select("id", "function"), "id", "left").select("id", F.coalesce("function", "own").alias("function"), F.col("function").isNotNull().alias("assigned"))


_TEXT = "p_type || ' / ' || p_name || '; ' || p_brand || ' @ x' || p_size || CASE WHEN p_partkey % 3 = 0 THEN ' # frag' WHEN p_partkey % 3 = 1 THEN ' ## missing 1' ELSE '' END"


def _annotated(t: Tables) -> DataFrame:
    tail = F.when(F.col("p_partkey") % 3 == 0, " # frag").when(F.col("p_partkey") % 3 == 1, " ## missing 1").otherwise("")
    return t.part.select("p_partkey", F.concat("p_type", F.lit(" / "), "p_name", F.lit("; "), "p_brand", F.lit(" @ x"), F.col("p_size").cast("string"), tail).alias("text"))


@query(f"""WITH x AS (SELECT p_partkey, regexp_extract({_TEXT}, '^(.*?)(?:\\s+(#+)\\s+(.*))?$', 1) AS f FROM part)
SELECT p_partkey, (i - 1)::INTEGER AS pos, regexp_split_to_array(f, '\\s+[/@]\\s+|\\s*;\\s+')[i] AS role FROM (SELECT p_partkey, f, unnest(range(1, len(regexp_split_to_array(f, '\\s+[/@]\\s+|\\s*;\\s+')) + 1)) AS i FROM x)""")
def role_split(t: Tables) -> DataFrame:
    """Parts of the function as it stands before a comment that is set off by blanks."""
    return _annotated(t).select("p_partkey", F.posexplode(A.split_roles(A.split_comment(F.col("text"))["func"])).alias("pos", "role"))


@query(f"""WITH x AS (SELECT p_partkey, regexp_split_to_array(regexp_replace({_TEXT}, '\\s*#.*$', ''), '\\s+[/@]\\s+|\\s*;\\s+') AS p FROM part),
y AS (SELECT p_partkey, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS p FROM x)
SELECT p_partkey, (i - 1)::INTEGER AS pos, p[i] AS role FROM (SELECT p_partkey, p, unnest(range(1, len(p) + 1)) AS i FROM y)""")
def function_roles(t: Tables) -> DataFrame:
    """Roles of the function, which ends at the first # whether or not blanks set it off."""
    return _annotated(t).select("p_partkey", F.posexplode(A.roles(F.col("text"))).alias("pos", "role"))


@query(f"""WITH x AS (SELECT p_partkey, {_TEXT} AS s FROM part), y AS (SELECT p_partkey, regexp_extract(s, '^(.*?)(?:\\s+(#+)\\s+(.*))?$', 1) AS func, regexp_extract(s, '^(.*?)(?:\\s+(#+)\\s+(.*))?$', 2) AS sep, regexp_extract(s, '^(.*?)(?:\\s+(#+)\\s+(.*))?$', 3) AS comment FROM x)
SELECT p_partkey, func, sep, comment, sep = '#' AND regexp_matches(comment, '^(frag|missing|trunc)') AS truncated FROM y""")
def function_comment_split(t: Tables) -> DataFrame:
    return _annotated(t).select("p_partkey", A.split_comment(F.col("text")).alias("x"), A.is_truncated(F.col("text")).alias("truncated")).select("p_partkey", "x.func", "x.sep", "x.comment", "truncated")


_CODE = " + ".join(f"(instr('{S.AMINO}', substr(kmer, {i + 1}, 1)) - 1) * {20 ** (7 - i)}::BIGINT" for i in range(8))


@query(f"""WITH r AS (SELECT unnest(regexp_extract_all(translate(text, '{S.LOWER}', '{S.UPPER}'), '[{S.AMINO}]{{8,}}')) AS r FROM documents), w AS (SELECT substr(r, i, 8) AS kmer FROM (SELECT r.r, unnest(range(1, length(r.r) - 6)) AS i FROM r))
SELECT kmer, ({_CODE})::BIGINT AS code, kmer AS decoded, count(*) AS n FROM w GROUP BY kmer""")
def kmer_encode20(t: Tables) -> DataFrame:
    rows = S.valid_windows(t.documents.select(S.ascii_upper(F.col("text")).alias("seq")), "seq")
    one = rows.groupBy("kmer").agg(F.count("*").alias("n"))
    return one.withColumn("code", S.encode20(F.col("kmer"))).withColumn("decoded", S.decode20(F.col("code")))


@query(f"SELECT doc_id, md5(reverse(translate(text, '{S.IUPAC}', '{S.COMPLEMENT}'))) AS digest FROM documents WHERE text IS NOT NULL AND regexp_full_match(text, '[ -~\\s]*')")
def reverse_complement(t: Tables) -> DataFrame:
    """Of the ASCII texts (what reversing a text means beyond that differs between engines)."""
    return t.documents.where(F.col("text").rlike(r"^[ -~\s]*$")).select("doc_id", F.md5(S.reverse_complement(F.col("text")).cast("binary")).alias("digest"))


@query()
def reverse_complement_all(t: Tables) -> DataFrame:
    """Of every text, reversed by code points. No SQL: DuckDB's reverse() keeps letters and their combining marks together."""
    return t.documents.where("text is not null").select("doc_id", F.md5(S.reverse_complement(F.col("text")).cast("binary")).alias("digest"))


def event_hits(t: Tables) -> DataFrame:
    """Events as hits: a user's in order of time (seconds), the type as function, the value as weight."""
    return t.events.select(F.col("user_id").alias("id"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))").alias("pos"), F.col("event_id").alias("ord"), F.col("event_type").alias("function"), F.col("value").alias("weight"))


@query("""WITH h AS (SELECT user_id AS id, epoch_us(ts) AS pos, event_id AS ord, value FROM events), g AS (SELECT *, CASE WHEN pos - lag(pos) OVER w > 21600000000 THEN 1 ELSE 0 END AS new FROM h WINDOW w AS (PARTITION BY id ORDER BY pos, ord)),
r AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY pos, ord) AS region FROM g)
SELECT id, region::BIGINT AS region, min(pos) AS start, max(pos) AS stop, count(*) AS n, round(sum(value), 4) AS weight FROM r GROUP BY id, region HAVING count(*) >= 5""")
def hit_gap_regions(t: Tables) -> DataFrame:
    return calling.gap_regions(event_hits(t), 21_600_000_000, 5).withColumn("weight", F.round("weight", 4))


@query("""WITH h AS (SELECT user_id AS id, epoch_us(ts) AS pos, event_id AS ord, event_type AS function, value FROM events), g AS (SELECT *, CASE WHEN function = lag(function) OVER w THEN 0 ELSE 1 END AS c FROM h WINDOW w AS (PARTITION BY id ORDER BY ord)),
r AS (SELECT *, sum(c) OVER (PARTITION BY id ORDER BY ord) AS run FROM g) SELECT id, run::BIGINT AS run, function, count(*) AS n, round(sum(value), 4) AS weight FROM r GROUP BY id, run, function""")
def collapse_regions(t: Tables) -> DataFrame:
    return calling.collapse(event_hits(t).withColumn("n", F.lit(1).cast("long"))).withColumn("weight", F.round("weight", 4))


def _called(t: Tables) -> DataFrame:
    minute = F.floor(F.col("pos") / 60_000_000).cast("long")
    return event_hits(t).select(F.col("id").cast("string").alias("id"), minute.alias("pos"), "function", "weight", F.lit(100.0).alias("mean"), F.lit(0).alias("from_end"))


@query()
def region_call(t: Tables) -> DataFrame:
    return calling.regions(_called(t), G.Options(max_gap=720, min_hits=3))


@query()
def best_call(t: Tables) -> DataFrame:
    return calling.calls(_called(t), G.Options(max_gap=2880, min_hits=2), ambiguous=True)


@query("""WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, event_type, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type)::INTEGER AS rank FROM n QUALIFY rank <= 2""")
def otu_topk(t: Tables) -> DataFrame:
    n = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return reports.top_k(n, 2, ["user_id"], F.col("n").desc(), F.col("event_type"))


_RECALL = """r AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'hypothetical protein' ELSE o_orderpriority END AS old, CASE WHEN o_totalprice < 100000 THEN '' WHEN o_totalprice < 200000 THEN o_orderpriority ELSE '1-URGENT' END AS new FROM orders),
k AS (SELECT *, CASE WHEN old = n THEN 'unchanged' WHEN old = 'hypothetical protein' THEN 'added' WHEN n = 'hypothetical protein' THEN 'lost' ELSE 'changed' END AS class FROM (SELECT *, CASE WHEN new = '' THEN 'hypothetical protein' ELSE new END AS n FROM r))"""


def _recall(t: Tables) -> DataFrame:
    old = F.when(F.col("o_orderstatus") == "P", "hypothetical protein").otherwise(F.col("o_orderpriority"))
    new = F.when(F.col("o_totalprice") < 100_000, "").when(F.col("o_totalprice") < 200_000, F.col("o_orderpriority")).otherwise("1-URGENT")
    return t.orders.select(F.col("o_orderkey").alias("id"), old.alias("old"), new.alias("new"))


@query(f"WITH {_RECALL}, names AS (SELECT old AS function, count(*) AS n FROM r GROUP BY old) SELECT id, old, new, n FROM r JOIN names ON function = old WHERE old <> new")
def recall_diff(t: Tables) -> DataFrame:
    """Rows whose function changed, with how many had the old one."""
    r = _recall(t)
    return r.where("old <> new").join(r.groupBy("old").agg(F.count("*").alias("n")), "old").select("id", "old", "new", "n")


@query(f"WITH {_RECALL} SELECT class, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM k), 4) AS percent FROM k GROUP BY class")
def recall_classes(t: Tables) -> DataFrame:
    r = _recall(t).select(A.recall_class(F.col("old"), F.col("new")).alias("class"))
    return r.groupBy("class").agg(F.count("*").alias("n")).select("class", "n", F.round(100 * F.col("n") / r.agg(F.count("*")).scalar(), 4).alias("percent"))


_GOOD = "length(translate(text, 'Xx', '')) > 25 AND text NOT LIKE '%XXXXXXXXXX%'"


@query(f"SELECT doc_id, length(text)::INTEGER AS len, {_GOOD} AS good, {_GOOD} AND length(text) BETWEEN 150 AND 2000 AS in_range FROM documents WHERE text IS NOT NULL")
def good_seq_filter(t: Tables) -> DataFrame:
    good = S.is_good_sequence(F.col("text"))
    return t.documents.where("text is not null").select("doc_id", F.length("text").alias("len"), good.alias("good"), (good & F.length("text").between(150, 2000)).alias("in_range"))


_NR = f"g AS (SELECT 'gnl|md5|' || md5(translate(text, '{S.LOWER}', '{S.UPPER}')) AS md5, doc_id, source FROM documents WHERE text IS NOT NULL)"


def nr_groups(t: Tables) -> DataFrame:
    return nr.groups(t.documents.where("text is not null").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")))


@query(f"WITH {_NR} SELECT md5, count(DISTINCT doc_id) AS n, min(doc_id) AS first_id, string_agg(DISTINCT doc_id, ';' ORDER BY doc_id) AS ids FROM g GROUP BY md5")
def nr_md5_groups(t: Tables) -> DataFrame:
    return nr_groups(t).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ";"))


@query(f"WITH {_NR} SELECT md5, min(doc_id) AS ref, arg_min(source, doc_id) AS genome, count(DISTINCT doc_id) - 1 AS n_dups FROM g GROUP BY md5 HAVING min(doc_id) % 7 <> 0")
def nr_reps(t: Tables) -> DataFrame:
    """References: groups whose first id is no feature (here: divisible by 7) are dropped whole."""
    refs = nr.references(nr_groups(t), lambda c: c % 7 != 0)
    return refs.join(t.documents.select(F.col("doc_id").alias("ref"), F.col("source").alias("genome")), "ref").select("md5", "ref", "genome", F.size("dups").cast("long").alias("n_dups"))


@query()
def nr_reps_all(t: Tables) -> DataFrame:
    """References of all groups, flagged by nr_reps' test of the first id. (No SQL: that of nr_reps leaves groups out.)"""
    refs = nr.references(nr_groups(t), lambda c: c.isNotNull())
    genome = t.documents.select(F.col("doc_id").alias("ref"), F.col("source").alias("genome"))
    return refs.join(genome, "ref").select("md5", "ref", "genome", F.size("dups").cast("long").alias("n_dups"), (F.col("ref") % 7 != 0).alias("is_feature"))


@query(f"WITH {_NR}, r AS (SELECT md5, min(doc_id) AS ref FROM g GROUP BY md5) SELECT ref AS fam, g.doc_id AS member, g.doc_id = ref AS original, d.lang AS gene FROM r JOIN g USING (md5) JOIN documents d ON d.doc_id = ref")
def nr_inflate(t: Tables) -> DataFrame:
    refs = nr.references(nr_groups(t), lambda c: c.isNotNull())
    members = refs.select(F.col("ref").alias("fam"), F.col("ref").alias("id")).join(t.documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("gene")), "id")
    return nr.inflate(members, refs)


@query(f"WITH {_NR}, x AS (SELECT DISTINCT md5 FROM g WHERE source = 'src0') SELECT g.md5, count(DISTINCT doc_id) AS n, g.md5 NOT IN (SELECT md5 FROM x) AS in_set FROM g GROUP BY g.md5")
def nr_exclude(t: Tables) -> DataFrame:
    other = t.documents.where("source = 'src0' and text is not null").select(S.md5_id(F.col("text")).alias("md5"))
    return nr.exclude(nr_groups(t), other).select("md5", "n", "in_set")
