"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of up to ORDER bytes is counted and frozen. The code length of a byte is that of
PPM with escape method C: if the longest known context has seen the byte, minus the log of its share; if not, the escape's
code length and then that of the next shorter context, down to 8 bits. The trees of all languages are laid out as hash tables of
whole code lengths per language, so that a text is scored by a few vector operations an order instead of a walk a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, blocks, durable, fold_of, scratch, thinned, tune

#: Bytes of the longest context, documents of a language and bytes of all that are learnt from at most, bytes that are scored at once.
ORDER, FIT_DOCS, FIT_BYTES, PIECE = 4, 250, 24_000_000, 1_000_000
START = b"\n" * ORDER


class Table:
    """Codes (64-bit) -> row numbers, by open addressing with all probes done as vectors."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.bits = codes, max(8, int(4 * max(1, len(codes)) - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(codes), dtype=np.int32), self._home(codes)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several rows for a slot the last stays
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers, -1 where there is none."""
        at = self._home(codes)
        row = self.slots[at]
        bad = np.flatnonzero((row >= 0) & (self.codes[row] != codes)) if len(self.codes) else np.zeros(0, np.int64)
        while len(bad):
            at[bad] = (at[bad] + 1) & ((1 << self.bits) - 1)
            row[bad] = self.slots[at[bad]]
            bad = bad[(row[bad] >= 0) & (self.codes[row[bad]] != codes[bad])]
        return row


def folded(text: bytes) -> bytes:
    """The text in small letters, as UTF-8."""
    return text.lower() if text.isascii() else text.decode().lower().encode()


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Code of the `size` bytes that end at each byte from the ORDER-th on."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out |= data[ORDER - k : ORDER - k + n].astype(np.uint64) << np.uint64(8 * k)
    return out


class Model:
    """Frozen statistics: for each order the code lengths of known (context, byte) and the escapes of known contexts."""

    def __init__(self, texts: dict[str, list[bytes]]):
        self.langs = sorted(texts)
        n = len(self.langs)
        data = [[np.frombuffer(START + folded(t), np.uint8) for t in texts[lang]] for lang in self.langs]
        self.costs: list[tuple[Table, np.ndarray]] = []  # by order: of grams
        self.escapes: list[tuple[Table, np.ndarray]] = []  # by order: of contexts
        lower: np.ndarray | None = None
        for order in range(ORDER + 1):
            counted = [np.unique(np.concatenate([grams(d, order + 1) for d in own] or [np.zeros(0, np.uint64)]), return_counts=True) for own in data]
            codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in counted)]))
            contexts = np.unique(codes >> np.uint64(8))
            table, places = Table(codes), Table(contexts)
            of = places.find(codes >> np.uint64(8))
            hit, total, distinct = (np.zeros((len(x), n)) for x in (codes, contexts, contexts))
            for j, (c, k) in enumerate(counted):
                rows = table.find(c)
                hit[rows, j] = k
                np.add.at(total[:, j], of[rows], k)
                np.add.at(distinct[:, j], of[rows], 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
                direct = np.log2((total + distinct)[of] / hit)
            if order == 0:
                shorter = np.full((len(codes), n), 8.0)
            else:  # the same byte after the context without its first byte: known, since it was counted there too
                below = self.costs[-1][0].find(codes & np.uint64((1 << 8 * order) - 1))
                shorter = lower[below]
            lower = np.where(hit > 0, direct, escape[of] + shorter)
            self.costs.append((table, lower.astype(np.float32)))
            self.escapes.append((places, escape.astype(np.float32)))

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        size, rows, held = 0, [], []
        for i, t in enumerate(texts):
            whole = START + folded(t)
            for at in range(0, max(1, len(whole) - ORDER), PIECE):
                rows.append(i)
                held.append(whole[at : at + PIECE + ORDER])
                size += len(held[-1])
                if size >= PIECE:
                    self._add(out, rows, held)
                    size, rows, held = 0, [], []
        self._add(out, rows, held)
        return out

    def _add(self, out: np.ndarray, rows: list[int], pieces: list[bytes]) -> None:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        if len(data) <= ORDER:
            return
        lengths = np.array([len(p) for p in pieces])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        use = np.ones(len(data), bool)  # each piece's first ORDER bytes are context alone
        for k in range(ORDER):
            use[starts[lengths > k] + k] = False
        use = use[ORDER:]
        cost = np.zeros((len(use), len(self.langs)), np.float32)
        left = np.flatnonzero(use)
        longest = grams(data, ORDER + 1)[left]
        for order in range(ORDER, -1, -1):
            code = longest & np.uint64((1 << 8 * (order + 1)) - 1)
            table, known = self.costs[order]
            row = table.find(code)
            ok = row >= 0
            cost[left[ok]] += known[row[ok]]
            left, longest, code = left[~ok], longest[~ok], code[~ok]
            if not len(left):
                break
            table, known = self.escapes[order]
            row = table.find(code >> np.uint64(8))
            cost[left[row >= 0]] += known[row[row >= 0]]
        cost[left] += 8
        owner = np.repeat(np.array(rows), lengths)[ORDER:]
        for j in range(len(self.langs)):
            out[:, j] += np.bincount(owner, weights=cost[:, j], minlength=len(out))


def fit(docs: DataFrame, per_lang: int = FIT_DOCS) -> Model:
    """Statistics of about `per_lang` documents of each language at most, taken by a hash of doc_id from the learning folds.

    FIT_BYTES of text at most are learnt from in all, less where there are many languages (a known context holds a number for
    each): that bounds what reaches the driver and the broadcast. Rows without text, lang or id teach nothing, nor do empty texts;
    repeated rows count each; without any there is no language.
    """
    spark = docs.sparkSession
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.coalesce(fold_of("doc_id", 5) != 0, F.lit(False)))
    share = {r["lang"]: min(1.0, per_lang / r["count"]) for r in usable.groupBy("lang").count().collect()}
    rates = spark.createDataFrame(sorted((k, int(v * (1 << 30))) for k, v in share.items()), "lang string, rate long")
    chosen = usable.select("doc_id", "lang", "text").join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(1 << 30)) < F.col("rate"))
    texts: dict[str, list[bytes]] = {lang: [] for lang in share}
    with scratch(spark):
        held = thinned(durable(chosen.select("doc_id", "lang", "text")), int(FIT_BYTES * min(1.0, 20 / max(1, len(share)))), 24)
        for r in held.orderBy("doc_id", "lang", "text").toLocalIterator():
            texts[r["lang"]].append(r["text"].encode())
    return Model({k: v for k, v in texts.items() if v})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of docs (any columns) with lang_pred and score.

    The language with the shortest code (ties: the first by name); the score is its share when code lengths, at a quarter of
    their difference, are taken as odds. Texts that are null or hold no letter give `und` and 0, and so does a model that has
    learnt no language. Repeated rows give repeated results.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    tune(docs.sparkSession)
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part, texts in blocks(batch):
                letters = part.column("_letters").to_pylist()
                langs, scores = ["und"] * len(texts), [0.0] * len(texts)
                some = [i for i, ok in enumerate(letters) if ok] if m.langs else []
                if some:
                    bits = m.bits([texts[i] for i in some])
                    best = bits.argmin(axis=1)
                    share = 1 / np.exp2(-np.minimum(4000, bits - bits.min(axis=1, keepdims=True)) / 4).sum(axis=1)
                    for i, b, s in zip(some, best.tolist(), share.tolist(), strict=True):
                        langs[i], scores[i] = m.langs[b], s
                keep = [n for n in part.schema.names if n != "_letters"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    own = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "_letters")]
    kind = StructType([*own, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in own), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters")).mapInArrow(run, kind)


def op3_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by fit() and identify(); null ids are not held out."""
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
