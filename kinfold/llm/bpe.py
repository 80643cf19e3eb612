"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts every text into chunks, so that equal passages give equal chunks wherever they stand.
A chunk is encoded once and then taken from a memo. Cuts fall anywhere, also inside words, so the joins of chunks are
repaired: the end of one and the start of the next are encoded anew together with whole words on both sides, more of them
until the new tokens agree with those of the chunks at both ends.
"""

from __future__ import annotations

import json as json_
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, kept_by_process, tune

#: Chunks are 2**CUT_BITS bytes long on average and LONGEST at most; a worker's memo holds MEMO_BYTES of them.
CUT_BITS, LONGEST, MEMO_BYTES = 10, 1 << 16, 48_000_000
BLANKS = b" \n\t"
#: A normaliser that on plain text does no more than lower-case it: signs below U+0250 neither compose
#: nor lower-case by context (those that only some take for blanks are left out).
_LOWERING = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_NOT_PLAIN = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u012f\u0131-\u024f]|<\\|")
#: A rule that cuts words into pieces, each of which is then encoded on its own; and the same for plain text, built on first use.
_CUTTING = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words, and pieces of words, that a worker remembers (some 200 bytes each).
WORDS, PIECES = 250_000, 300_000


def plain_pieces() -> re.Pattern:
    """_CUTTING for signs below U+0250, in Python's own regular expressions."""
    of = lambda kind: "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == kind)
    return re.compile(_CUTTING.replace("\\p{L}", of("L")).replace("\\p{N}", of("N")))


def cuts(text: bytes) -> list[int]:
    """Where chunks end: after the places whose hash of the last eight bytes has CUT_BITS zeros on top, moved to the next character."""
    n = len(text)
    if n < 16:
        return [n] if n else []
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    for k in (1, 2, 4):  # after this, x[i] holds bytes i to i + 7
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    ends = np.flatnonzero((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CUT_BITS) == 0) + 8
    out, last = [], 0
    for e in [*ends.tolist(), n]:
        while e < n and text[e] & 0xC0 == 0x80:
            e += 1
        while e - last > LONGEST:
            last += LONGEST
            while text[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if e > last:
            out.append(e)
            last = e
    return out


class Chunk:
    """The tokens of a chunk's whole words, and the pieces of words left at its ends (all of it if it holds no blank)."""

    __slots__ = ("core", "head", "ids", "tail")

    def __init__(self, text: bytes):
        first = next((i for i, b in enumerate(text) if b in BLANKS), -1)
        last = max(text.rfind(b) for b in (b" ", b"\n", b"\t")) if first >= 0 else -1
        self.head, self.core, self.tail = (text[:first], text[first : last + 1], text[last + 1 :]) if first >= 0 else (text, None, b"")
        self.ids: np.ndarray | None = None


class Coder:
    """Encodes and decodes whole texts by chunks, with a tokenizer of the tokenizers library in which blanks part words."""

    def __init__(self, json: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens: dict[int, bytes] = {i: t.encode() for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        rules = json_.loads(json)
        self.plain = None
        if rules.get("normalizer") == _LOWERING and all(t["content"].startswith("<|") for t in rules.get("added_tokens", [])):
            self.plain = Tokenizer.from_str(json_.dumps(rules | {"normalizer": None, "truncation": None, "padding": None}))
        cutters = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        same = [c["type"] for c in cutters] == ["Split", "ByteLevel"] and cutters[0]["pattern"] == {"Regex": _CUTTING} and not cutters[1]["add_prefix_space"] and not cutters[1]["use_regex"]
        self.cut = plain_pieces() if self.plain is not None and same else None
        self.simple = self.tokenizer.decoder is None
        self.memo: dict[bytes, Chunk] = {}
        self.held = 0
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Puts the tokens of plain words in the memo: those of their pieces, each encoded once."""
        known = self.pieces
        if len(known) > PIECES:
            known.clear()
        split = {w: self.cut.findall(w) for w in words if not w.isalpha()} if self.cut else {}
        new = {p for parts in split.values() for p in parts if p not in known}
        new.update(w for w in words if w not in split and w not in known)
        fresh = list(new)
        known.update(zip(fresh, [array("I", e.ids).tobytes() for e in self.plain.encode_batch_fast(fresh, add_special_tokens=False)], strict=True))
        get = known.__getitem__
        self.words.update((w, b"".join(map(get, split[w])) if w in split else get(w)) for w in words)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Tokens of stretches that start and end at blanks. Plain ones are put together from the pieces of their words, each encoded once."""
        whole = [t.decode() for t in texts]
        quick = [self.plain is not None and not _NOT_PLAIN.search(t) for t in whole]
        words = [t.lower().split() for t, q in zip(whole, quick, strict=True) if q]
        if len(self.words) > WORDS:
            self.words.clear()
        if new := [w for w in set().union(*words) if w not in self.words]:
            self._learn(new)
        fast = iter([np.frombuffer(b"".join(map(self.words.__getitem__, w)), "<u4") for w in words])
        slow = iter(self.tokenizer.encode_batch_fast([t for t, q in zip(whole, quick, strict=True) if not q], add_special_tokens=False))
        return [next(fast) if q else np.array(next(slow).ids, dtype="<u4") for q in quick]

    def _chunks(self, texts: list[bytes]) -> list[list[Chunk]]:
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        rows, new = [], []
        for t in texts:
            row, last = [], 0
            for e in cuts(t):
                piece = t[last:e]
                last = e
                c = self.memo.get(key := xxhash.xxh3_128_digest(piece))
                if c is None:
                    c = self.memo[key] = Chunk(piece)
                    self.held += 8 * len(piece) // 2 + 200
                    new.append(c)
                row.append(c)
            rows.append(row)
        cores = [c for c in new if c.core is not None]
        for c, ids in zip(cores, self._encode([c.core for c in cores]), strict=True):
            c.ids = ids
        return rows

    @staticmethod
    def _words(core: bytes, n: int, last: bool) -> bytes:
        """The last (or first) n words of a chunk's whole words, with the blanks on their inner side."""
        i = len(core) if last else 0
        for _ in range(n):
            if last:
                while i > 0 and core[i - 1] in BLANKS:
                    i -= 1
                while i > 0 and core[i - 1] not in BLANKS:
                    i -= 1
            else:
                while i < len(core) and core[i] in BLANKS:
                    i += 1
                while i < len(core) and core[i] not in BLANKS:
                    i += 1
        return core[i:] if last else core[:i]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text, equal to the tokenizer's own of the whole text."""
        rows, seams, out = self._chunks(texts), [], []
        for row in rows:
            parts: list = []  # cores' tokens and the numbers of seams between them
            left, middle = None, b""
            for c in row:
                middle += c.head
                if c.core is not None:
                    seams.append([left, middle, c])
                    parts += [len(seams) - 1, c.ids]
                    left, middle = c, c.tail
            seams.append([left, middle, None])
            out.append([*parts, len(seams) - 1])
        fixed: list[np.ndarray] = [np.zeros(0, "<u4")] * len(seams)
        todo, n = [k for k, (_, middle, _c) in enumerate(seams) if middle], 1
        while todo:
            around = [(self._words(a.core, n, True) if a else b"", m, self._words(b.core, n, False) if b else b"") for a, m, b in (seams[k] for k in todo)]
            got = self._encode([x for a, m, b in around for x in (a, b, a + m + b)])
            again = []
            for j, k in enumerate(todo):
                a, b, ids = got[3 * j : 3 * j + 3]
                left, _, right = seams[k]
                # Exact agreement: the words on both sides have the tokens that the chunks end and start with, and the new tokens too.
                ok = len(ids) >= len(a) + len(b) and np.array_equal(ids[: len(a)], a) and np.array_equal(ids[len(ids) - len(b) :], b)
                ok = ok and (not left or np.array_equal(left.ids[len(left.ids) - len(a) :], a)) and (not right or np.array_equal(right.ids[: len(b)], b))
                if ok:
                    fixed[k] = ids[len(a) : len(ids) - len(b)]
                else:
                    again.append(k)
            todo, n = again, 2 * n
            if n > LONGEST:
                raise ValueError("chunk joins do not agree: blanks do not part words in this tokenizer")
        return [np.concatenate([fixed[p] if isinstance(p, int) else p for p in row]) for row in out]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of what the tokenizer's decode() gives, special tokens kept."""
        if self.simple:
            return b" ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()


def coder_of(json: str) -> Coder:
    """The one coder of this Python process: its memos serve every task that the worker runs."""
    return kept_by_process(("bpe", xxhash.xxh3_128_hexdigest(json.encode())), lambda: Coder(json))


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every row of docs (any columns but ids and decoded) with ids (little-endian unsigned 32-bit, as binary) and decoded.

    tokenizer_path is read by the driver alone; executors get its text (a few MB) by broadcast. Null and empty texts have no
    ids and decode to the empty text. Rows that repeat are encoded from the same chunks.
    """
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    tune(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    own = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared.value)
        for batch in batches:
            for part, texts in blocks(batch):
                ids = coder.encode([t or b"" for t in texts])
                decoded = pa.array([coder.decode(x) for x in ids], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x.tobytes() for x in ids], pa.binary()), decoded], names=[*part.schema.names, "ids", "decoded"])

    kind = StructType([*own, StructField("ids", BinaryType()), StructField("decoded", StringType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, kind)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every row of encoded (with a column ids as encode() gives it) with the decoded text; null ids decode to null, none to the
    empty text. A column named decoded gives way; repeated rows repeat results; an empty table gives none."""
    from pyspark.sql.types import StringType, StructField, StructType

    with open(tokenizer_path, encoding="utf-8") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())
    own = [f for f in encoded.schema.fields if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared.value)
        for batch in batches:
            for part, ids in blocks(batch, "ids"):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([None if x is None else coder.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()).cast(pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, StructType([*own, StructField("decoded", StringType())]))


def op1_bpe(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """encode() as digests: doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; edges as there."""
    out = encode(docs.select("doc_id", "text"), tokenizer_path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
