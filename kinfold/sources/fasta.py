"""FASTA as a data source: files are read in byte ranges, and what is wrong with a record comes as columns beside it.

    register(spark)
    spark.read.format("fasta_records").option("path", folder).load()

A range owns the records that start in it and reads the last one to its end. Whether a line that opens with > starts a record
depends on the lines before it (the line after a definition line is always data), so a range first looks back to the nearest
line that settles this; only that line and those after it are read twice.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "id string, def string, seq string, file string, offset long, n_errors long, error_offset long, reason string, embedded boolean"
#: Bytes of a range, bytes that are looked back through at once, bytes and records of a batch.
RANGE, BACK, BATCH_BYTES, BATCH_ROWS = 64_000_000, 65_536, 4_000_000, 4_096
_OPENING = re.compile(rb"[^A-Za-z>\n]*")
_BAD = re.compile(rb"[^A-Za-z*\n\r]")
_BLANK = re.compile(rb"[ \t]")


@dataclass
class Part(InputPartition):
    """Bytes start (included) to stop of a file; first: where its first record starts, -1 if it has none."""

    path: str
    start: int
    stop: int
    first: int


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files_of(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of a file, or of the files of a folder but hidden ones and marks, by name."""
    import pyarrow.fs as fs

    system, own = _system(path)
    info = system.get_file_info(own)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(own, recursive=True))
    prefix = path[: len(path) - len(own)] if path.endswith(own) else path.split(own.lstrip("/"))[0].rstrip("/")
    rows = [(f.path, f.size) for f in found if f.is_file and not any(p.startswith((".", "_")) for p in f.path[len(own) :].split("/") if p)]
    return sorted((prefix + p if prefix else p, n) for p, n in rows)


def opened(path: str) -> io.BufferedReader:
    system, own = _system(path)
    return io.BufferedReader(system.open_input_file(own), 1 << 20)


def first_mark(f: io.BufferedReader) -> int:
    """Where the first > of a file is, -1 if there is none."""
    f.seek(0)
    at = 0
    while chunk := f.read(1 << 20):
        if (k := chunk.find(b">")) >= 0:
            return at + k
        at += len(chunk)
    return -1


def _line_start(f: io.BufferedReader, at: int, least: int) -> int:
    """Start of the line that byte `at` is in, not before `least`."""
    while at > least:
        lo = max(least, at - BACK)
        f.seek(lo)
        if (k := f.read(at - lo).rfind(b"\n")) >= 0:
            return lo + k + 1
        at = lo
    return least


def settled(f: io.BufferedReader, start: int, first: int) -> tuple[int, bool]:
    """A line start at or before `start` from which reading forward finds the right records; True if it is the file's first record."""
    at = _line_start(f, start, first)
    while at > first:
        f.seek(at)
        before = _line_start(f, at - 1, first)
        f.seek(before)
        line = f.read(at - before).replace(b"\r", b"")
        if before > first and line[_OPENING.match(line).end() :][:1] != b">":
            return at, False  # a line of data: what follows it may start a record
        at = before
    return first, True


@dataclass
class Record:
    """A record as it is read: where it starts, its definition line, its data and what was wrong."""

    offset: int
    head: bytes
    data: list[bytes]
    n_errors: int = 0
    error_offset: int | None = None
    reason: str | None = None
    embedded: bool = False

    def wrong(self, reason: str, bad: bytes, at: int, count: int) -> None:
        if not self.n_errors:
            self.error_offset, self.reason = at, f"{reason} '{bad.decode('latin-1')}'"
        self.n_errors += count

    def row(self, path: str) -> tuple:
        cut = _BLANK.search(self.head)
        id_, rest = (self.head[: cut.start()], self.head[cut.start() :]) if cut else (self.head, b"")
        return (id_.decode("utf-8", "replace"), rest.decode("utf-8", "replace"), b"".join(self.data).decode("ascii"), path, self.offset, self.n_errors, self.error_offset, self.reason, self.embedded or b">" in self.head)


def _data(record: Record, line: bytes, at: int) -> None:
    """Adds the letters and stars of a line of data; anything else counts as wrong."""
    bad = _BAD.search(line)
    if bad:
        record.embedded |= b">" in line
        record.wrong("Bad data character", bad.group(), at + bad.start(), len(_BAD.findall(line)))
        line = _BAD.sub(b"", line)
    record.data.append(line.replace(b"\n", b"").replace(b"\r", b""))


def records(f: io.BufferedReader, part: Part) -> Iterator[Record]:
    """The records that start in a part, each read to its end."""
    at, opens = settled(f, part.start, part.first)
    f.seek(at)
    held: Record | None = None
    fresh = False  # the line after a definition line is data, whatever it opens with
    for line in f:
        mark = 0 if opens else None
        opening = b""
        if not opens and not fresh:
            opening = _OPENING.match(line).group()
            if line[len(opening) : len(opening) + 1] == b">":
                mark = len(opening)
        if held is not None and opening.strip(b"\r"):
            bad = opening.replace(b"\r", b"")
            held.wrong("Bad id or data character", bad[:1], at + opening.index(bad[:1]), len(bad))
        if mark is not None:
            if held is not None:
                yield held
            if at + mark >= part.stop:
                return
            held = Record(at + mark, line[mark + 1 :].rstrip(b"\n").replace(b"\r", b""), []) if at + mark >= part.start else None
            fresh = True
        else:
            if held is not None:
                _data(held, line[len(opening) :], at + len(opening))
            fresh = False
        opens = False
        at += len(line)
    if held is not None:
        yield held


class FastaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.range = options["path"], int(options.get("rangeBytes", RANGE))

    def partitions(self) -> list[Part]:
        parts = []
        for path, size in files_of(self.path):
            with opened(path) as f:
                first = first_mark(f)
            parts += [Part(path, at, at + self.range, first) for at in range(0, size, self.range)]
        return parts or [Part("", 0, 0, -1)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.string()] * 4 + [pa.int64()] * 3 + [pa.string(), pa.bool_()]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        if not part.path:
            return
        rows, held = [], 0
        with opened(part.path) as f:
            if part.start == 0 and part.first != 0:  # what stands before the first record
                f.seek(0)
                wrong = f.read(part.first if part.first > 0 else -1).replace(b"\r", b"")
                if wrong:
                    rows.append((None, None, None, part.path, 0, len(wrong), 0, "Missing >", False))
            if part.first >= 0 and part.stop > part.first:
                for record in records(f, Part(part.path, max(part.start, part.first), part.stop, part.first)):
                    rows.append(record.row(part.path))
                    held += len(rows[-1][2])
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)


class FastaSource(DataSource):
    """Records of FASTA files with their errors.

    A record has id, def (with its leading blank) and seq (letters and *, carriage returns dropped), its file and the byte at
    which it starts. n_errors counts the bytes that belong to neither; error_offset and reason tell of the first. A * that opens
    a line other than the first is wrong, too. embedded: a > stands inside. What comes before the first > of a file is a row of
    its own with reason `Missing >`. Option rangeBytes: bytes that a task reads.
    """

    @classmethod
    def name(cls) -> str:
        return "fasta_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FastaReader:
        return FastaReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastaSource)
