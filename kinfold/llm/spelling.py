"""Spelling variants by anagram hashing: a word's key is the sum of a power of each of its letters, whatever their order.

Words with one letter added or removed have keys that differ by that letter's power, words with one letter exchanged keys that
differ by the difference of two powers. So every class of words of one key gives its key less each of its letters; classes
that meet at such a remainder are one exchange apart, and a class whose whole key is the remainder is one removal apart. A
remainder has at most one class for each letter of the alphabet, however many words there are. Only words of classes that met
are then compared in the order of their letters, by the text around the letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, durable, scratch, tune

#: Code points and occurrences of a word at least, one in so many runs that loses a letter, how much commoner a form is.
LEAST_LENGTH, LEAST_COUNT, NOISE, COMMONER = 7, 2, 31, 10
#: Distinct words that a task counts before it hands them on.
FLUSH_WORDS = 300_000
#: Keys are sums of the POWER-th powers of code points, modulo a prime below 2^61, so that sums never overflow.
POWER, MODULUS = 11, (1 << 61) - 1
#: The letters of words after folding: a-z, A-Z (never, once folded) and U+00C0 to U+00FF.
FIRST, LAST = 0x61, 0xFF


def _word_counts(batches: Iterator[pa.RecordBatch], least_length: int, noise: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of the documents of a task, added up until FLUSH_WORDS are held."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")
    held: dict[str, int] = {}

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for part, texts in blocks(batch):
            for doc, text in zip(part.column("doc").to_pylist(), texts, strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(runs.findall((text or b"").lower().decode("utf-8", "replace"))).items():  # bytes fold A-Z alone
                    h = zlib.crc32(run.encode(), start)
                    if not h % noise:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    held[run] = held.get(run, 0) + n
                if len(held) > FLUSH_WORDS:
                    yield batch_of()
                    held = {}
    yield batch_of()


def letters(word: Column) -> Column:
    return F.filter(F.split(word, ""), lambda c: c != "")


def power(letter: Column) -> Column:
    """The POWER-th power of a letter's code point modulo MODULUS; 0 for the empty text."""
    table = F.array(*(F.lit(pow(c, POWER, MODULUS)).cast("long") for c in range(FIRST, LAST + 1)))
    return F.when(letter == "", F.lit(0).cast("long")).otherwise(F.get(table, F.ascii(letter) - FIRST))


def anagram_key(word: Column) -> Column:
    return F.aggregate(F.transform(letters(word), power), F.lit(0).cast("long"), lambda total, x: (total + x) % MODULUS)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n, key): the words of docs with their counts and anagram keys."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    counts = rows.mapInArrow(lambda it: _word_counts(it, least_length, noise), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count).withColumn("key", anagram_key(F.col("word")))


def class_links(words: DataFrame) -> DataFrame:
    """(key1, out1, key2, out2): classes of words that are equal but for letter out1 of the first and out2 of the second (empty: none).

    Both less those letters have the same key. A remainder is met by one class for each letter at most, and by the class that
    has it as its own key, so the pairs of a remainder are bounded by the alphabet.
    """
    out = F.explode(F.concat(F.array(F.lit("")), F.array_distinct(letters(F.col("word"))))).alias("out")
    rests = words.select("key", out).select("key", "out", F.pmod(F.col("key") - power(F.col("out")), F.lit(MODULUS)).alias("rest"))
    met = rests.repartition("rest").groupBy("rest").agg(F.collect_set(F.struct("key", "out")).alias("m")).where(F.size("m") > 1)
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: b["key"] > a["key"]), lambda b: F.struct(a["key"].alias("key1"), a["out"].alias("out1"), b["key"].alias("key2"), b["out"].alias("out2")))))
    return met.select(F.explode(pairs).alias("p")).select("p.*")


def _without(word: Column, at: Column, gap: str = "") -> Column:
    """word with `gap` in place of its letter at `at` (from 1; 0: the word as it is)."""
    return F.when(at == 0, word).otherwise(F.concat(F.substring(word, F.lit(1), at - 1), F.lit(gap), F.substring(word, at + 1, F.length(word))))


def _places(word: Column, out: Column, other: Column) -> Column:
    """Where `word` may lose letter `out` (0: nowhere, if it is to lose none).

    Where the other word has no letter there, the first of equal letters in a row stands for all: the rest is the same.
    """
    first = lambda i: (other != "") | (i == 1) | (F.substring(word, i - 1, F.lit(1)) != out)
    here = F.filter(F.sequence(F.lit(1), F.length(word)), lambda i: (F.substring(word, i, F.lit(1)) == out) & first(i))
    return F.when(out == "", F.array(F.lit(0))).otherwise(here)


def near_words(words: DataFrame, links: DataFrame) -> DataFrame:
    """(word, n, other, other_n): both directions of every pair that differs by exactly one letter added, removed or exchanged.

    Words of linked classes meet by a hash of what stands around the letter, so classes of many words aren't paired out; the
    letters are then compared in their order.
    """
    sides = []
    for own, out, other in (("key1", "out1", "out2"), ("key2", "out2", "out1")):
        at = links.join(words.withColumnRenamed("key", own), own)
        at = at.select("*", F.explode(_places(F.col("word"), F.col(out), F.col(other))).alias("at"))
        gapped = F.when((F.col(out) != "") & (F.col(other) != ""), _without(F.col("word"), F.col("at"), " ")).otherwise(_without(F.col("word"), F.col("at")))
        sides.append(at.select(F.xxhash64("key1", "key2", gapped).alias("h"), "word", "n", "at"))
    one, two = sides[0], sides[1].withColumnsRenamed({"word": "other", "n": "other_n", "at": "other_at"})
    same_place = F.when((F.col("at") > 0) & (F.col("other_at") > 0), F.col("at") == F.col("other_at")).otherwise(True)
    in_order = _without(F.col("word"), F.col("at")) == _without(F.col("other"), F.col("other_at"))
    pairs = one.join(two, "h").where(same_place & in_order & (F.col("word") != F.col("other")))
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where following forms ends.

    Each round doubles the steps that are taken. A form is at least ten times commoner than its word, so no chain has more than
    19 steps and the rounds are five at most; rounds end as soon as nothing moves.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, commoner: int = COMMONER, **bounds: int) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of docs (columns doc_id and text).

    Runs are maximal stretches of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where h, the crc32 of
    `<doc_id>:<run>`, is a multiple of 31, the run loses its code point h modulo its length: noise that is the same for all
    equal runs of a document. Words are the results of at least 7 code points that occur at least twice. Near words differ by
    exactly one code point added, removed or exchanged. A word's form is its near word of largest n (ties: the first by code
    points) if that n is `commoner` times its own or more; root follows forms to their end. Null texts have no runs; a null
    doc_id counts as empty; rows that repeat count again; texts of any length are streamed; an empty table gives no row; other
    columns, of whatever name, are ignored. Comparing two linked words costs their length times the places of the letter.
    """
    spark = docs.sparkSession
    tune(spark)
    with scratch(spark) as made:
        words = durable(vocabulary(docs, **bounds))
        links = durable(class_links(words))
        first = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
        near = near_words(words, links).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("top"))
        whole = words.join(near, "word", "left").withColumn("has", F.coalesce(-F.col("top.n") >= commoner * F.col("n"), F.lit(False)))
        told = durable(whole.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("top.word")).alias("form"), F.when(F.col("has"), -F.col("top.n")).alias("form_n")))
        ends = roots(told.where("form is not null"))
        out = told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return made.keep(durable(out))


def op12_spelling(docs: DataFrame) -> DataFrame:
    """variants() of the words of all documents; edges as there. No SQL: DuckDB has no crc32; tested against plain Python."""
    return variants(docs)
