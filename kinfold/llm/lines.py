"""Line dedup: lines that many documents hold are dropped from all but the last of them.

Each document gives one row for each of its distinct long lines: a 128-bit hash and the places. Rows are dealt by ranges of
(hash, document) and sorted, so a line that a third of all documents hold is spread over many tasks. Every task streams its
rows: the first document of a hash stays, the second waits until a third is met. Only the first and the last hash of a task can
reach beyond it: their rows are told apart, and judged by what the tasks know together. What comes back is not text but one
compressed bitmap a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import blocks, durable, others, row_key, scratch, tune

#: Code points of a line that counts at least, documents that hold it at least.
LEAST_LENGTH, LEAST_DOCS = 20, 3
_BLANKS = b" \t\n\v\f\r"


def _places(batches: Iterator[pa.RecordBatch], least_length: int) -> Iterator[pa.RecordBatch]:
    """(h1, h2, ord, did, th, lines): the distinct long lines of each document, with their places (from 0)."""
    for batch in batches:
        for part, texts in blocks(batch):
            one, two, row, lines = [], [], [], []
            for k, text in enumerate(texts):
                met: dict[bytes, list[int]] = {}
                for at, line in enumerate((text or b"").split(b"\n")):
                    key = line.strip(_BLANKS)
                    if len(key) >= least_length and (len(key) >= 4 * least_length or len(key.decode("utf-8", "replace")) >= least_length):
                        met.setdefault(xxhash.xxh3_128_digest(key.lower()), []).append(at)  # bytes fold A-Z alone
                for h, at in met.items():
                    one.append(int.from_bytes(h[:8], "little", signed=True))
                    two.append(int.from_bytes(h[8:], "little", signed=True))
                    row.append(k)
                    lines.append(np.array(at, "<u4").tobytes())
            own = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), *(part.column(c).take(own) for c in ("ord", "did", "th")), pa.array(lines, pa.binary())], names=["h1", "h2", "ord", "did", "th", "lines"])


def _streamed(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, ord from the largest), as decisions.

    kind 0: lines that go. kind 1: lines of a hash that this task may not know whole. kind 2: up to least_docs of the largest
    documents that a hash at the edge of the task has here.
    """
    names, out = ["kind", "h1", "h2", "ord", "did", "th", "lines"], []
    hash_, first, docs, waiting = None, True, [], []
    schema = None

    def batch_of() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], names=names)

    def edge() -> list[tuple]:
        return [(2, *hash_, d, None, None, None) for d in docs]

    for batch in batches:
        if schema is None:
            schema = [pa.field(n, t) for n, t in zip(names, (pa.int32(), pa.int64(), pa.int64(), batch.schema.field("ord").type, pa.int64(), pa.int64(), pa.binary()), strict=True)]
        for h1, h2, doc, did, th, lines in zip(*(batch.column(c).to_pylist() for c in names[1:]), strict=True):
            if hash_ != (h1, h2):
                if hash_ is not None and first:
                    out += edge()
                    first = False
                hash_, docs, waiting, last = (h1, h2), [], [], None
            if doc != last:
                last = doc
                if len(docs) < least_docs:
                    docs.append(doc)
            if first:
                out.append((1, h1, h2, doc, did, th, lines))
            elif doc != docs[0]:
                waiting.append((h1, h2, doc, did, th, lines))
                if len(docs) == least_docs:
                    out += [(0, *w) for w in waiting]
                    waiting = []
        if out:
            yield batch_of()
            out = []
    if hash_ is not None:
        out += [*edge(), *((1, *w) for w in waiting)]
        yield batch_of()


def _order(docs: DataFrame) -> Column:
    """What doc_id is compared by: itself if it is a whole number (null: the least), else its text (null before all)."""
    if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.col("did")
    return F.concat(F.when(F.col("doc_id").isNull(), "0").otherwise("1"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for parts in batch.column("parts").to_pylist():
            gone = np.frombuffer(b"".join(parts), "<u4")
            bits = np.ones((int(gone.max()) // 8 + 1) * 8, bool)  # whole bytes: what fills the last one stays
            bits[gone] = False
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("th"), pa.array(keep, pa.binary())], names=["did", "th", "keep"])


def keep_bitmaps(docs: DataFrame, least_length: int = LEAST_LENGTH, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(did, th, keep): for each document (see row_key) that loses lines, a compressed bitmap with a bit for each line, 1 if it stays.

    The bitmap ends in the byte of the last line that goes; whatever comes after it stays. Edges as in drop_repeated_lines().
    """
    if least_docs < 2:
        raise ValueError("a repeated line is one that two documents hold, or more")
    spark = docs.sparkSession
    tune(spark)
    with scratch(spark) as made:
        keyed = row_key(docs.select("doc_id", "text"))
        keyed = keyed.select("text", "did", "th", _order(docs).alias("ord"))
        kind = keyed.schema["ord"].dataType.simpleString()
        # Written first: cutting into ranges reads the rows twice.
        places = durable(keyed.mapInArrow(lambda it: _places(it, least_length), f"h1 long, h2 long, ord {kind}, did long, th long, lines binary"))
        order = ["h1", "h2", F.col("ord").desc()]
        dealt = places.repartitionByRange(*order).sortWithinPartitions(*order)
        told = durable(dealt.mapInArrow(lambda it: _streamed(it, least_docs), f"kind int, h1 long, h2 long, ord {kind}, did long, th long, lines binary"))
        # Two hashes a task at most, least_docs documents each.
        known = told.where("kind = 2").groupBy("h1", "h2").agg(F.max("ord").alias("top"), F.count_distinct("ord").alias("docs")).where(F.col("docs") >= least_docs)
        late = told.where("kind = 1").join(known, ["h1", "h2"]).where(F.col("ord") < F.col("top"))
        gone = told.where("kind = 0").select("did", "th", "lines").unionByName(late.select("did", "th", "lines"))
        parts = gone.groupBy("did", "th").agg(F.collect_list("lines").alias("parts"))
        return made.keep(durable(parts.mapInArrow(_bitmaps, "did long, th long, keep binary")))


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in blocks(batch):
            total, gone, kept = [], [], []
            for text, keep in zip(texts, part.column("__keep").to_pylist(), strict=True):
                text = text or b""
                if keep is None:
                    total.append(text.count(b"\n") + 1)
                    gone.append(0)
                    kept.append(text)
                    continue
                lines = text.split(b"\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[: len(lines)]
                drop = set(np.flatnonzero(bits == 0).tolist())
                total.append(len(lines))
                gone.append(len(drop))
                kept.append(b"\n".join(x for k, x in enumerate(lines) if k not in drop))
            own = [n for n in part.schema.names if n != "__keep"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in own), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[*own, "n_lines", "n_dropped", "kept_text"])


def drop_repeated_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Every row of docs (any columns but n_lines, n_dropped and kept_text) with its lines counted, dropped and kept.

    Texts are split at every \\n (null and empty ones are one empty line). A line's key is the line without ASCII blanks at its
    ends and with A-Z in lower case; keys of at least `least_length` code points that at least `least_docs` documents hold lose
    all their lines, repeated ones too, but for those of the largest doc_id holding them. Rows of one doc_id are one document;
    a null doc_id is the least of all; ids other than whole numbers are compared as text. Very long texts and lines are worked
    on whole; an empty table gives no row; other columns, of whatever name, are passed on.
    """
    own = others(docs, "n_lines", "n_dropped", "kept_text", "did", "th", "__keep")
    base = docs.select(*(F.col(f"`{f.name}`") for f in own))
    joined = row_key(base).join(keep_bitmaps(base, least_length, least_docs).withColumnRenamed("keep", "__keep"), ["did", "th"], "left")
    kind = StructType([*own, StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_text", StringType())])
    return joined.select(*(F.col(f"`{f.name}`") for f in own), "__keep").mapInArrow(_applied, kind)


def op13_lines(docs: DataFrame) -> DataFrame:
    """drop_repeated_lines() as counts and a digest, of every document; edges as there."""
    out = drop_repeated_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rid, doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d),
y AS (SELECT rid, doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM x),
h AS (SELECT k, max(doc_id) AS top FROM y WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
z AS (SELECT y.rid, y.doc_id, y.line, y.pos, h.k IS NOT NULL AND y.doc_id < h.top AS gone FROM y LEFT JOIN h ON h.k = y.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM z GROUP BY rid, doc_id
"""
