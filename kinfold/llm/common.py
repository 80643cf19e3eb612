"""Helpers shared by the training-data operators: table access, checkpoints, Arrow access to whole texts, word hashing."""

from __future__ import annotations

import ctypes
import pickle
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

#: Rows of a Python-side block: bounds what a worker holds at once, whatever the Arrow batch holds.
BLOCK_ROWS, BLOCK_BYTES = 512, 4_000_000
#: Entries that a worker's word memo holds before it starts anew.
MEMO_WORDS = 120_000
_own: dict[str, str] = {}
_blocks: list[Scratch] = []


#: Rows of an Arrow batch on its way to Python; Spark's own 10,000 whole texts would take hundreds of MB outside the heap.
ARROW_ROWS = 512


def tune(spark: SparkSession) -> None:
    """Smaller Arrow batches in this session, unless it already has a size of its own."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) in (10_000, 0, -1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder_of(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a temporary one where all of Spark is on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="kinfold-"))
    return folder


def durable(df: DataFrame) -> DataFrame:
    """df cut from its lineage: a table written to the folder that the session names in spark.checkpoint.dir, read again.

    Unlike a checkpointed RDD it keeps no trace of the plan it came from (whose inferred constraints grow from round to
    round), is columnar, and survives the loss of any executor. Inside scratch() it goes with that block unless it is kept.
    """
    spark = df.sparkSession
    path = f"{folder_of(spark)}/kinfold-{uuid.uuid4().hex}"
    if _blocks:
        _blocks[-1].paths.append(path)
    at, system = _located(spark, path)
    system.deleteOnExit(at)  # what nobody deletes before goes with the driver
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinfold_path = path
    return out


def _located(spark: SparkSession, path: str) -> tuple[object, object]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Scratch:
    """The tables that durable() wrote inside a block."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        """df, a table of durable() that what is returned still reads."""
        self.kept.add(df._kinfold_path)
        return df

    def drop(self, df: DataFrame) -> None:
        """Deletes a table of durable() from before at the end of this block; other tables stay."""
        if hasattr(df, "_kinfold_path"):
            self.paths.append(df._kinfold_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Deletes at its end the tables that durable() wrote inside, but for the kept ones, which pass to the block around."""
    own = Scratch()
    _blocks.append(own)
    try:
        yield own
    finally:
        _blocks.remove(own)
        if _blocks:
            _blocks[-1].paths += sorted(own.kept)
        for path in own.paths:
            if path not in own.kept:
                at, system = _located(spark, path)
                system.delete(at, True)


class Shared:
    """A value sent to the executors once, of any class: unlike a plain broadcast it needs no module of this package there."""

    def __init__(self, spark: SparkSession, value: object):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return pickle.loads(self.sent.value)


def kept_by_process(key: tuple, make: Callable[[], object]) -> object:
    """What make() gives, made once in a Python process and kept from task to task; one value at a time, so that memory stays bounded.

    Functions of this package travel by value and have globals of their own in every task, so the place is a module of its own.
    """
    held = sys.modules.setdefault("_kinfold_kept", types.ModuleType("_kinfold_kept")).__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished jobs now, not when the driver next happens to collect garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; null ids give null."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % folds


def row_key(df: DataFrame) -> DataFrame:
    """df with a null-safe join key per row: did (doc_id, or its hash if it isn't whole numbers; null: the least long) and th (hash of the text)."""
    return df.withColumn("did", id_key(df)).withColumn("th", F.xxhash64("text"))


def id_key(df: DataFrame) -> Column:
    """doc_id as a long: itself, or a hash of its text if it is of another type; null ids have the least one."""
    whole = df.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    own = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("string")))
    return F.coalesce(own, F.lit(-(2**63)))


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each value of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def tidy() -> None:
    """Gives freed memory back to the system: workers live on from task to task and stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def blocks(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of a batch with their texts as bytes, each slice bounded in rows and (but for a single long text) in bytes."""
    i = batch.schema.get_field_index(text)
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(at, BLOCK_ROWS)
        texts, start, held = raw(part.column(i)), 0, 0
        for k, t in enumerate(texts):
            held += len(t or b"")
            if held > BLOCK_BYTES and k > start:
                yield part.slice(start, k - start), texts[start:k]
                start, held = k, len(t or b"")
        if texts[start:]:
            yield part.slice(start), texts[start:]
    tidy()


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered for the frequent words; emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def hashes(words: list[bytes], memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTE, _BYTE_BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (parted by ASCII blanks) of all texts in a row, and the number of words of each text.

    A word's hash is the sum of its bytes times powers of an odd number modulo 2^64, finalised with its length: sums up to
    each byte give those of all words at once, without a step per word.
    """
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    blank = _BLANK[data]
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    last = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    out = np.zeros(len(first), np.uint64)
    piece = 1 << 20  # words that start in a piece of the bytes are summed together, so powers stay few
    cut = np.searchsorted(first, np.arange(0, len(data) + piece, piece))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if a < b:
            lo, hi = int(first[a]), int(last[b - 1])
            n = hi - lo
            up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _BYTE))))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:n])))
            down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _BYTE_BACK))))
            f, e = first[a:b] - lo, last[a:b] - lo
            out[a:b] = mix((total[e] - total[f]) * down[f] + (e - f).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), 21)
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1
    return out, np.diff(np.searchsorted(first, ends), prepend=0)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), applied element by element."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def thinned(sample: DataFrame, most_bytes: int, seed: int) -> DataFrame:
    """A written sample (doc_id, text, ...) cut to about most_bytes of text, by a hash of doc_id."""
    held = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if held <= most_bytes:
        return sample
    return sample.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) < int(most_bytes / held * (1 << 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, limit: int, most_bytes: int) -> DataFrame:
    """(doc_id, text, label) of about `limit` labelled documents and `most_bytes` of text at most, from the folds that may be learnt from.

    The bounds are the documented ones for fitting: rows are taken by hashes of doc_id, so the choice doesn't depend on order
    or partitioning. A document with conflicting labels counts by their maximum. The ids are broadcast: there are never
    more than about `limit` of them. The sample is a written table.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold_of("doc_id", 3) != 1))
    share = min(1.0, limit / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30)))
    ids = chosen.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("label"))
    return thinned(durable(docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")), most_bytes, 18)


def others(docs: DataFrame, *added: str) -> list[StructField]:
    """The fields of docs but those of the names that an operator adds: a column that clashes gives way to the operator's."""
    return [f for f in docs.schema.fields if f.name not in added]


def picked(docs: DataFrame, fields: list[StructField]) -> DataFrame:
    return docs.select(*(F.col(f"`{f.name}`") for f in fields))


def stretches(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows that come sorted by keys (none null) as one table for each run of equal ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch.column(k)
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            new[0] |= bool(held) and held[-1].column(k)[-1] != column[0]
        at = 0
        for edge in [*np.flatnonzero(new).tolist(), batch.num_rows]:
            if edge > at:
                held.append(batch.slice(at, edge - at))
            if edge < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, at = [], edge
    if held:
        yield pa.Table.from_batches(held)
    tidy()
