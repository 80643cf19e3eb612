"""Source divergence audit: how far the word shares of each source of a language lie from those of the others and of the language.

Systolic rotation. A language's kept terms are cut into slices by a hash of the term, so that no task ever holds a whole
vocabulary; in each slice every group (lang, source) has one compressed vector of its shares. Groups sit on seats of RESIDENTS
each and stay there, as dense vectors of one task; compressed vectors of peers circulate between seats in the rounds of a
round-robin tournament (circle method: in each round a seat meets one other, and two seats meet exactly once, at one of the
two). A meeting evaluates both directions, since divergence isn't symmetric. Sums over slices add up before the shuffle. The
terms of a group are ranked by heaps of the slices, whose few survivors are ranked once more.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, durable, scratch, stretches, tune

#: What shares are counted in, documents of a language that a kept term is in at least, ranks of terms that are reported.
SCALE, LEAST_DOCS, RANKS = 1_000_000_000, 3, 200
#: Counts of a slice (all groups together), groups of a seat, terms and documents that a task counts before it hands them on.
SLICE, RESIDENTS, FLUSH_TERMS, FLUSH_DOCS = 100_000, 8, 300_000, 1_000_000
#: A byte as it counts in terms: letters beyond ASCII and a-z as they are, A-Z in lower case, all else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LOW = (1 << 40) - 1


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the documents of a task, added up until FLUSH_TERMS are held."""
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    size = seen = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            both = np.fromiter(terms.values(), np.uint64, len(terms))
            cols = [pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array((both & np.uint64(_LOW)).astype(np.int64)), pa.array((both >> np.uint64(40)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(terms)), pa.repeat(pa.scalar(source), len(terms)), *cols], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part, texts in blocks(batch):
            for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts, strict=True):
                terms = held.setdefault((lang, source), {})
                before = len(terms)
                for term, n in Counter((text or b"").translate(_FOLD).split()).items():
                    terms[term] = terms.get(term, 0) + (n | 1 << 40)  # occurrences below, documents above
                size, seen = size + len(terms) - before, seen + 1
                if size > FLUSH_TERMS or seen >= FLUSH_DOCS:
                    yield from flush()
                    held, size, seen = {}, 0, 0
    yield from flush()


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exact however large the counts are."""
    of = total + kept
    narrow = F.call_function("div", (n + 1) * F.lit(SCALE), of)
    wide = F.call_function("div", (n + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)"), of.cast("decimal(19,0)"))
    return (1 + F.when(n < 9_000_000_000, narrow).otherwise(wide)).cast("long")


def kept_terms(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): counts of the terms that at least `least_docs` documents of their language hold.

    first: 1 in one row of each term of a language.
    """
    counts = rows.mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of = Window.partitionBy("lang", "term")  # one row a source
    spread = counts.withColumns({"lang_n": F.sum("n").over(of), "all_docs": F.sum("docs").over(of), "least": F.min("source").over(of)})
    return spread.where(F.col("all_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("least")).cast("int").alias("first"))


def group_facts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One row a group (lang, source): its number among the groups of the language, their number, totals, slices, share of an absent term."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("kept"), F.count("*").alias("held"))
    every = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(of_lang, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("total", "lang_total", "kept", "held")}
    at = Window.partitionBy("lang")
    facts = every.select("lang", "source", *(v.alias(c) for c, v in zero.items()), (F.row_number().over(at.orderBy("source")) - 1).alias("idx"), F.count("*").over(at).cast("int").alias("groups"))
    return facts.withColumns({"slices": F.greatest(F.lit(1), F.ceil(F.col("held") / SLICE)).cast("int"), "p0": F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))})


def _vector(ids: np.ndarray, p: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).astype("<u4").tobytes() + p.astype("<i8").tobytes(), 1)


def _dense(payload: bytes, width: int, absent: int) -> np.ndarray:
    out = np.full(width, absent, np.int64)
    data = zlib.decompress(payload)
    n = len(data) // 12
    out[np.cumsum(np.frombuffer(data, "<u4", n).astype(np.int64))] = np.frombuffer(data, "<i8", n, 4 * n)
    return out


def _slices(batches: Iterator[pa.RecordBatch], ranks: int) -> Iterator[pa.RecordBatch]:
    """Counts sorted by (lang, slice, term): the vector of every group in a slice, and the terms of each group that a heap keeps."""
    names = ["kind", "lang", "slice", "idx", "width", "payload", "term", "value"]
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64()]
    for table in stretches(batches, ("lang", "slice")):
        lang, number, groups = table["lang"][0].as_py(), table["slice"][0].as_py(), table["groups"][0].as_py()
        term = table["term"].combine_chunks()
        place = np.concatenate(([0], np.cumsum(pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False))))
        p, q, idx = (table[c].to_numpy() for c in ("p", "q", "idx"))
        width = int(place[-1]) + 1
        order = np.argsort(idx, kind="stable")
        edge = np.searchsorted(idx[order], np.arange(groups + 1))
        rows: list[tuple] = []
        for g in range(groups):
            own = order[edge[g] : edge[g + 1]]
            rows.append((0, lang, number, g, width, _vector(place[own], p[own]), None, None))
            over = own[p[own] > q[own]]
            value = (p[over] - q[over]) ** 2 // q[over]
            if len(over) > ranks:  # all but what may reach the last rank
                able = np.flatnonzero(value >= np.partition(value, -ranks)[-ranks])
                over, value = over[able], value[able]
            best = heapq.nsmallest(ranks, zip((-value).tolist(), term.take(pa.array(over)).cast(pa.binary()).to_pylist(), strict=True))
            rows += [(1, lang, number, g, None, None, t.decode(), -v) for v, t in best]
        for at in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 4096], strict=True), kinds, strict=True)], names=names)


def meeting(i: int | Column, j: int | Column, seats: int | Column) -> tuple[Column, Column]:
    """(round from 0, host) of the one meeting of seats i and j: the circle method, with the last of an even number of seats held fixed."""
    i, j, seats = (F.lit(x) if isinstance(x, int) else x for x in (i, j, seats))
    lo, hi, rounds = F.least(i, j), F.greatest(i, j), seats + seats % 2 - 1
    return F.when(hi == rounds, (2 * lo) % rounds).otherwise((lo + hi) % rounds), F.when((lo + hi) % 2 == 1, hi).otherwise(lo)


def _visits(seat: Column, seats: Column) -> Column:
    """Where a vector goes: its own seat first (round 0), then the hosts of its meetings by round."""
    own = F.array(F.struct(seat.alias("seat"), F.lit(0).alias("round")))
    away = F.filter(F.transform(F.sequence(F.lit(0), seats - 1), lambda j: F.struct(j.alias("seat"), (1 + meeting(seat, j, seats)[0]).cast("int").alias("round"))), lambda x: (x["seat"] != seat) & (meeting(seat, x["seat"], seats)[1] == x["seat"]))
    return F.concat(own, away)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors sorted by (lang, slice, seat, round, idx): residents first, then their peers one after another. Yields both directions of every pair."""
    seat, resident, dense, out = None, [], [], []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["lang", "idx", "other", "value"])

    for batch in batches:
        for row in batch.to_pylist():
            if seat != (row["lang"], row["slice"], row["seat"]):
                seat, resident, dense = (row["lang"], row["slice"], row["seat"]), [], []
            peer = _dense(row["payload"], row["width"], row["p0"])
            for k, own in zip(resident, dense, strict=True):
                square = (own - peer) ** 2
                out += [(row["lang"], k, row["idx"], int((square // peer).sum())), (row["lang"], row["idx"], k, int((square // own).sum()))]
            if row["round"] == 0:
                resident.append(row["idx"])
                dense.append(peer)
            if len(out) > 4096:
                yield batch_of(out)
                out = []
    yield batch_of(out)


def audit(docs: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: how each group (lang, source) differs from its peers and which terms make it differ.

    Terms are runs of ASCII letters and of whatever isn't ASCII, with A-Z in lower case; a language keeps those that at least
    `least_docs` of its rows hold (repeated rows count each). p = 1 + floor(10^9 * (n + 1) / (total + kept terms)) is a group's
    share of a term, q that of a peer (part `pair`) or of the language (part `term`), and floor((p - q)^2 / q) the value: summed
    over the kept terms for each other source of the language, and by term where the group holds it and p > q, to rank `ranks`.
    Ties go to the item that comes first by its bytes. Null text, lang and source count as empty; a group without terms has its
    pairs like any other, in a language without kept terms all of value 0. Texts of any length are streamed; an empty table
    gives no row; columns other than text, lang and source are ignored. Shares and values fit 64 bits and are exact.
    """
    spark = docs.sparkSession
    tune(spark)
    with scratch(spark) as made:
        rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
        kept = durable(kept_terms(rows, least_docs))
        facts = durable(group_facts(rows, kept))
        # Joins with facts carry no hint: Spark broadcasts the table where its size on disk allows, and shuffles it (splitting hot groups) beyond.
        own = kept.join(facts, ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice"), "term", "idx", "groups",
            _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
        ordered = own.repartition("lang", "slice").sortWithinPartitions("lang", "slice", "term")
        cut = durable(ordered.mapInArrow(lambda it: _slices(it, ranks), "kind int, lang string, slice int, idx int, width int, payload binary, term string, value long"))
        number = facts.select("lang", "idx", "source")
        vectors = cut.where("kind = 0").select("lang", "slice", "idx", "width", "payload").join(facts.select("lang", "idx", "groups", "p0"), ["lang", "idx"])
        seat, seats = F.expr(f"idx div {RESIDENTS}").cast("int"), F.expr(f"(groups + {RESIDENTS - 1}) div {RESIDENTS}").cast("int")
        sent = vectors.select("lang", "slice", "idx", "width", "p0", "payload", F.explode(_visits(seat, seats)).alias("v")).select("lang", "slice", "v.seat", "v.round", "idx", "width", "p0", "payload")
        met = sent.repartition("lang", "slice", "seat").sortWithinPartitions("lang", "slice", "seat", "round", "idx").mapInArrow(_meet, "lang string, idx int, other int, value long")
        sums = met.groupBy("lang", "idx", "other").agg(F.sum("value").alias("value"))
        named = sums.join(number, ["lang", "idx"]).join(number.select("lang", F.col("idx").alias("other"), F.col("source").alias("item")), ["lang", "other"]).select("lang", "source", "item", "value")
        bare = facts.where("kept = 0").select("lang", "source")
        none = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
        pairs = named.unionByName(none).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        by_group = Window.partitionBy("lang", "idx").orderBy(F.col("value").desc(), F.col("term"))
        best = cut.where("kind = 1").withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= ranks)
        terms = best.join(number, ["lang", "idx"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
        return made.keep(durable(pairs.unionByName(terms)))


def op11_divergence(docs: DataFrame) -> DataFrame:
    """audit() with the first 200 terms of each group, over all documents; edges as there."""
    return audit(docs)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM o GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
x AS (SELECT c.lang, c.source, c.term, c.n FROM c JOIN k USING (lang, term)),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM x GROUP BY ALL) USING (lang, source)),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(x.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(x.n, 0) + 1)) // (g.total + l.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM s WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""
