"""Scalar functions over sequences: k-mers, encodings, complements and translation, as columns and row generators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 8
# The amino acid letters in their coding order, the standard genetic code in TCAG order, IUPAC complements.
AMINO = "ACDEFGHIKLMNPQRSTVWY"
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
IUPAC, COMPLEMENT = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_upper(c: Column) -> Column:
    """a-z made capitals; other letters stay (upper() would fold some of them to two)."""
    return F.translate(c, LOWER, UPPER)


def md5_id(seq: Column) -> Column:
    """Checksum id of a sequence, whatever the case of its letters."""
    return F.concat(F.lit("gnl|md5|"), F.md5(ascii_upper(seq).cast("binary")))


def explode_kmers(df: DataFrame, seq: str, k: int = K) -> DataFrame:
    """df with a row per window of k letters: pos (from 0) and kmer. Shorter and null sequences give none.

    The letters are split once and windows put together from eight of them, so a long sequence costs its length, not its
    square, and the row never leaves generated code.
    """
    letters = df.withColumn("_letters", F.split(F.col(seq), ""))
    at = letters.select("*", F.posexplode("_letters").alias("pos", "_first")).where(F.col("pos") <= F.size("_letters") - k)
    return at.withColumn("kmer", F.concat(*(F.get("_letters", F.col("pos") + i) for i in range(k)))).drop("_letters", "_first")


def valid_kmer(kmer: Column, k: int = K) -> Column:
    """Only the 20 amino acid letters, of either case."""
    return kmer.rlike(f"^[{AMINO}{AMINO.lower()}]{{{k}}}$")


def _found(texts: pa.Array, k: int, calling: bool, together: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the text, pos, first byte, bytes) of all windows of k amino acid letters, for texts of about `together` bytes at a time.

    Byte by byte, bytes that start a run of k letters are found by doubling; pos counts letters, so that bytes which go on a letter are left out.
    """
    letter = np.isin(np.arange(256), list((AMINO + AMINO.lower()).encode()))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + together, "right")) - 1)
        data, edge = held[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        run, span = letter[data], 1
        while span < k:
            step = min(span, k - span)
            run, span = run[: max(0, len(run) - step)] & run[step:], span + step
        p = np.flatnonzero(run)
        row = np.searchsorted(edge, p, "right") - 1
        good = p + k <= edge[row + 1]  # not across two texts
        if calling:
            behind = data[np.minimum(p + k, len(data) - 1)]
            good &= (p + k >= edge[row + 1]) | ((behind != ord("X")) & (behind != ord("*")))
        p, row = p[good], row[good]
        more = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that go on a letter
        pos = p - np.searchsorted(more, p) - (edge[:-1] - np.searchsorted(more, edge[:-1]))[row]
        yield row + at, pos.astype(np.int32), p, data
        at = to


def valid_windows(df: DataFrame, seq: str, k: int = K, calling: bool = False, most: int = 100_000, together: int = 2_000_000) -> DataFrame:
    """df without `seq`, with a row per window of k amino acid letters of either case: pos (from 0) and kmer.

    The rows of explode_kmers() that valid_kmer() keeps, found in the bytes of many texts at once. If `calling`, the window
    that ends just before `*` or `X` is left out, as call_kmers() does.
    """
    keep = [f for f in df.schema.fields if f.name != seq]
    schema = T.StructType([*keep, T.StructField("pos", T.IntegerType()), T.StructField("kmer", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in keep])
            for row, pos, p, data in _found(batch.column(seq), k, calling, together):
                for i in range(0, len(p), most):
                    own = p[i : i + most]
                    letters = np.lib.stride_tricks.sliding_window_view(data, k)[own].tobytes()
                    kmer = pa.StringArray.from_buffers(len(own), pa.py_buffer(np.arange(0, k * len(own) + 1, k, dtype=np.int32)), pa.py_buffer(letters))
                    yield pa.RecordBatch.from_arrays([*rest.take(pa.array(row[i : i + most])).columns, pa.array(pos[i : i + most]), kmer], names=[*rest.schema.names, "pos", "kmer"])

    return df.mapInArrow(cut, schema)


def window_lists(df: DataFrame, seq: str, k: int = K, calling: bool = False, most: int = 100_000, together: int = 2_000_000) -> DataFrame:
    """The windows of valid_windows() as lists: df without `seq`, with a row per sequence that has any (one for each `most`): pos and
    kmers, which holds the bytes of up to eight letters as a number (the first is the highest; letters() turns it back)."""
    if k > 8:
        raise ValueError("a number holds up to eight letters")
    keep = [f for f in df.schema.fields if f.name != seq]
    schema = T.StructType([*keep, T.StructField("pos", T.ArrayType(T.IntegerType())), T.StructField("kmers", T.ArrayType(T.LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in keep])
            for row, pos, p, data in _found(batch.column(seq), k, calling, together):
                if not len(p):
                    continue
                first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                runs = np.diff(np.append(first, len(row)))
                starts = np.concatenate([np.arange(i, i + n, most) for i, n in zip(first, runs, strict=True)]) if runs.max() > most else first
                wide = np.zeros((len(p), 8), np.uint8)
                wide[:, 8 - k :] = np.lib.stride_tricks.sliding_window_view(data, k)[p]
                bounds = pa.array(np.append(starts, len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (pos, wide.view(">i8").ravel().astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*rest.take(pa.array(row[starts])).columns, *lists], names=[*rest.schema.names, "pos", "kmers"])

    return df.mapInArrow(cut, schema)


def kmer_sets(df: DataFrame, seq: str, k: int = K, together: int = 2_000_000) -> DataFrame:
    """df without `seq`, with the distinct windows of k amino acid letters of each row as kmers (numbers as in window_lists(), in order; none: empty)."""
    if k > 8:
        raise ValueError("a number holds up to eight letters")
    keep = [f for f in df.schema.fields if f.name != seq]
    schema = T.StructType([*keep, T.StructField("kmers", T.ArrayType(T.LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, _, p, data in _found(batch.column(seq), k, False, together):
                wide = np.zeros((len(p), 8), np.uint8)
                if len(p):
                    wide[:, 8 - k :] = np.lib.stride_tricks.sliding_window_view(data, k)[p]
                code = wide.view(">i8").ravel().astype(np.int64)
                by = np.lexsort((code, row))
                row, code = row[by], code[by]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
                rows.append(row[new])
                codes.append(code[new])
            bounds = np.append(0, np.cumsum(np.bincount(np.concatenate(rows), minlength=batch.num_rows)))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.concatenate(codes)))
            yield pa.RecordBatch.from_arrays([*batch.select([f.name for f in keep]).columns, lists], names=[f.name for f in schema.fields])

    return df.mapInArrow(cut, schema)


def letters(kmer: Column) -> Column:
    """The letters of a k-mer of window_lists()."""
    return F.unhex(F.hex(kmer)).cast("string")


def call_kmers(df: DataFrame, seq: str, k: int = K) -> DataFrame:
    """df with a row per window that calling looks at: pos (from 0) and kmer.

    Windows with `*` or `X` are skipped, and so is the one that ends just before such a letter.
    """
    longer = explode_kmers(df.withColumn("_seq", F.concat(seq, F.lit(" "))), "_seq", k + 1)  # each window with the letter behind it, or a blank at the end
    return longer.where(~F.col("kmer").rlike("[*X]")).withColumn("kmer", F.substring("kmer", 1, k)).drop("_seq")


def callable_windows(seq: Column, k: int = K, strict_reference: bool = True) -> Column:
    """How many windows calling looks at: those without `*` or `X`, and by the strict rule not followed by one either."""
    clean = F.regexp_extract_all(seq, F.lit(r"[^*X]+"), F.lit(0))
    open_end = F.length(F.regexp_extract(seq, r"([^*X]*)$", 1)) >= k
    every = F.aggregate(clean, F.lit(0).cast("bigint"), lambda a, run: a + F.greatest(F.lit(0), F.length(run) - (k if strict_reference else k - 1)))
    return every + F.when(open_end & F.lit(strict_reference), 1).otherwise(0)


def encode20(kmer: Column, k: int = K) -> Column:
    """Base-20 code of a k-mer of capital amino acid letters, first letter highest; null for any other."""
    code = F.lit(0).cast("bigint")
    for i in range(1, k + 1):
        code = code * 20 + (F.instr(F.lit(AMINO), F.substring(kmer, i, 1)) - 1)
    return F.when(kmer.rlike(f"^[{AMINO}]{{{k}}}$"), code)


def decode20(code: Column, k: int = K) -> Column:
    """The k-mer of a base-20 code."""
    return F.concat(*(F.substring(F.lit(AMINO), F.pmod(F.floor(code / F.lit(20**i)), F.lit(20)).cast("int") + 1, F.lit(1)) for i in range(k - 1, -1, -1)))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def translate_dna(seq: Column, frame: int = 0) -> Column:
    """Amino acids of a DNA sequence from a frame (0, 1, 2); codons with other letters give x."""
    dna = F.translate(ascii_upper(seq), "U", "T")
    code = F.create_map(*(F.lit(x) for i, a in enumerate(GENETIC_CODE) for x in ("TCAG"[i // 16] + "TCAG"[i // 4 % 4] + "TCAG"[i % 4], a)))
    count = F.floor((F.length(dna) - frame) / 3).cast("int")
    codons = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.coalesce(F.try_element_at(code, F.substring(dna, i * 3 + frame + 1, F.lit(3))), F.lit("x")))
    return F.when(count > 0, F.array_join(codons, "")).otherwise("")


def six_frames(seq: Column) -> Column:
    """Translations of the three frames of a sequence and of its reverse complement."""
    back = reverse_complement(seq)
    return F.array(*(translate_dna(s, f) for s in (seq, back) for f in range(3)))


def starts_and_stops(dna: Column, code: int = 11) -> Column:
    """Whether a DNA sequence opens with a start and closes with a stop codon of a genetic code (1, 4 or 11)."""
    # Start and stop codons by code number.
    start = {1: ["TTG", "CTG", "ATG"], 4: ["TTA", "TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"], 11: ["TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"]}[code]
    stop = {1: ["TAA", "TAG", "TGA"], 4: ["TAA", "TAG"], 11: ["TAA", "TAG", "TGA"]}[code]
    up = F.translate(ascii_upper(dna), "U", "T")
    return F.substring(up, 1, 3).isin(start) & F.substring(up, -3, 3).isin(stop)


def is_good_sequence(seq: Column, least: int = 25) -> Column:
    """More than `least` letters that aren't X, and no run of ten X."""
    return (F.length(F.translate(seq, "Xx", "")) > least) & ~seq.contains("XXXXXXXXXX")


def ungapped(seq: Column) -> Column:
    return F.translate(seq, "-", "")
