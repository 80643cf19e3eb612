"""Benchmark decontamination: windows of training words probed against a broadcast hash set of benchmark windows, then verified.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key

WINDOW = 10
#: Bytes of benchmark windows and their item ids that are broadcast at most; beyond that they are joined by a shuffle.
BROADCAST_BYTES = 64_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: the ASCII signs other than digits and letters.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str, folded: bool = True) -> Column:
    """The words of a text: A-Z lower-cased (if folded), then runs of digits, letters and whatever isn't ASCII. Null has none."""
    c = F.coalesce(F.col(text), F.lit(""))
    if folded:  # lower() is quick, and on plain ASCII the same as translate()
        c = F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))
    return F.array_remove(F.split(c, _BREAK), "")


def _opening(first: Column, second: Column | None, size: int) -> Column:
    """The hash of the first two words of a window, or of the only one of a window of one."""
    return F.xxhash64(first, second) if size > 1 else F.xxhash64(first)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, size, gram, items): each distinct window of the benchmark, with the items (ids as text, null: empty) it occurs in.

    A text of fewer words than `window`, but not none, is one window; texts without words have none.
    """
    w = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of("text").alias("words")).where(F.size("words") > 0)
    w = w.withColumn("size", F.least(F.size("words"), F.lit(window)))
    at = w.select("item", "size", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("i"))
    part = F.slice(F.col("words"), F.col("i"), F.col("size"))
    return at.select("item", "size", F.xxhash64(part).alias("h"), F.concat_ws(" ", part).alias("gram")).groupBy("h", "size", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(did, th, spans, items) of every document (see row_key) in which a benchmark window occurs.

    spans: array of (first word from 0, number of words) of the occurrences; items: the ids whose windows occur. Documents are
    scanned once, whatever sizes the windows have: the first two words of each place are looked up first (one word for
    windows of one), then the hash of the whole window, and at last its words are compared.
    """
    grams = benchmark_windows(benchmark, window)
    weight = F.octet_length("gram") + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + 32) + 100
    facts = grams.agg(F.sum(weight).alias("bytes"), F.collect_set("size").alias("sizes")).first()
    sizes = sorted(facts["sizes"]) or [window]
    keyed = row_key(docs.select("doc_id", "text")).select("did", "th", words_of("text").alias("words"))
    at = keyed.select("did", "th", "words", F.posexplode("words").alias("start", "word"))
    part = F.slice("words", F.col("start") + 1, F.col("size"))
    if (facts["bytes"] or 0) <= BROADCAST_BYTES:
        # Most places end at the set of opening words. The words stay in the row for the comparison, which is free as long as nothing is shuffled.
        opening = F.when(F.col("size") > 1, _opening(F.split_part("gram", F.lit(" "), F.lit(1)), F.split_part("gram", F.lit(" "), F.lit(2)), 2)).otherwise(_opening(F.split_part("gram", F.lit(" "), F.lit(1)), None, 1))
        heads = grams.select(opening.alias("f"), F.col("size")).distinct()
        pair, single = _opening(F.col("word"), F.get("words", F.col("start") + 1), 2), _opening(F.col("word"), None, 1)
        own = F.explode(F.array(pair, single)) if sizes[0] == 1 and sizes[-1] > 1 else single if sizes[-1] == 1 else pair
        met = at.withColumn("f", own).join(F.broadcast(heads), "f").where(F.col("start") <= F.size("words") - F.col("size"))
        met = met.withColumn("h", F.xxhash64(part)).join(F.broadcast(grams), ["h", "size"]).where(F.concat_ws(" ", part) == F.col("gram"))
    else:  # rows that are shuffled hold hashes in place of words: a text's size times its own would go over the wire
        places = at.withColumn("size", F.explode(F.array(*map(F.lit, sizes)))).where(F.col("start") <= F.size("words") - F.col("size"))
        twice = grams.select("h", "size", F.xxhash64(F.lit(1), F.split("gram", " ")).alias("h2"), "gram", "items")
        like = places.select("did", "th", "start", "size", F.xxhash64(part).alias("h"), F.xxhash64(F.lit(1), part).alias("h2")).join(twice, ["h", "h2", "size"])
        # The words of the few documents that are left are compared with each window that was met.
        met = like.groupBy("did", "th").agg(F.collect_set(F.struct("start", "size", "gram", "items")).alias("x")).join(keyed, ["did", "th"])
        met = met.select("did", "th", "words", F.explode("x").alias("x")).select("did", "th", "words", "x.*").where(F.concat_ws(" ", part) == F.col("gram"))
    met = met.select("did", "th", F.struct("start", F.col("size").alias("n")).alias("span"), "items")
    return met.groupBy("did", "th").agg(F.sort_array(F.collect_set("span")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _covered(spans: Column) -> Column:
    """Words that sorted spans cover."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n"))

    def add(acc: Column, x: Column) -> Column:
        end = x["start"] + x["n"]
        return F.struct(F.greatest(acc["to"], end).alias("to"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["to"], x["start"]))).cast("bigint").alias("n"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, spans, items.

    Null and empty texts have no words and no hit. Rows that share doc_id and text get the same result; a null doc_id is a
    value like any other, and ids may be of any type. Ties have no effect; an empty benchmark hits nothing, an empty table
    gives no row; other columns, of whatever name, are ignored.
    """
    found = hits(docs, benchmark, window)
    base = row_key(docs.select("doc_id", "text")).select("doc_id", "did", "th", F.size(words_of("text", folded=False)).cast("long").alias("n_words"))
    out = base.join(found, ["did", "th"], "left")
    return out.select("doc_id", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).alias("n_hit"), "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs (all their columns, of whatever name) in which no benchmark window occurs.

    Rows with null or empty text stay; rows that repeat stay or go together; an empty benchmark drops nothing.
    """
    found = hits(docs, benchmark, window).select("did", "th")
    rows = row_key(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text"))
    return rows.select("row", "did", "th").join(found, ["did", "th"], "left_anti").select("row.*")


def op4_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """contamination() as counts and a digest, of every document; edges as there."""
    out = contamination(docs, benchmark)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, w, least(len(w), {WINDOW}) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
), g AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)
), p AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k
), m AS (
  SELECT doc_id, i, p.k, item_id FROM p JOIN g ON p.k = g.k AND array_to_string(p.w[p.i:p.i + p.k - 1], ' ') = g.gram
), c AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
