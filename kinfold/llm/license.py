"""License scans: normalised lines, whole texts and passages of them against licence templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, tune

#: Least Dice coefficient of a match.
LEAST = 0.8
#: Notices by which a text states its licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
]
#: Whole licences, by the name of their file. (The SQL has the notices only.)
BODIES = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
_WORD = re.compile(rb"[a-z0-9]+")


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    """Distinct word bigrams of a text in small ASCII letters; words are runs of a-z and 0-9."""
    w = _WORD.findall(text.lower())
    return set(zip(w, w[1:], strict=False))


class Templates:
    """Templates by bigram; sizes bound which of them a text can match at all."""

    def __init__(self, templates: list[tuple[str, str]], least: float):
        self.least, self.names, self.sizes, self.by, self.own = least, [], [], {}, []
        for name, text in templates:
            own = bigrams(text.encode())
            self.own.append(own)
            for g in own:
                self.by.setdefault(g, []).append(len(self.names))
            self.names.append(name)
            self.sizes.append(len(own))
        # Dice of sizes a <= b is 2a / (a + b) at most: a match needs b <= a (2 - least) / least.
        ratio = (2 - least) / least
        self.bounds = [(s / ratio, s * ratio) for s in self.sizes]
        self.low, self.high = (min(b[0] for b in self.bounds), max(b[1] for b in self.bounds)) if self.bounds else (1, 0)

    def match(self, text: bytes) -> list[tuple[str, float]]:
        """Licences at or above the least coefficient."""
        if len(text) < 2 * self.low:  # a bigram more takes two bytes more
            return []
        own = bigrams(text)
        if not self.low <= len(own) <= self.high:
            return []
        common = Counter(t for g in own if g in self.by for t in self.by[g])
        return [(self.names[t], d) for t, k in common.items() if self.bounds[t][0] <= len(own) <= self.bounds[t][1] and (d := 2 * k / (len(own) + self.sizes[t])) >= self.least]

    def possible(self, words: list[bytes]) -> list[int]:
        """Templates that any part of a text can match: with k of their bigrams in it, Dice is 2k / (k + size) at most."""
        common = Counter(t for g in self.by.keys() & set(zip(words, words[1:], strict=False)) for t in self.by[g])
        return [t for t, k in common.items() if k >= self.bounds[t][0] - 1e-9]

    def passages(self, words: list[bytes], which: list[int]) -> list[tuple[float, int, int, int]]:
        """(dice, first word, word after the last, template): from each bigram of a template, the best window if it matches.

        Cutting bigrams that are not the template's, or that come again inside, off an end never lowers the coefficient. So
        windows start at bigrams of the template and end before that bigram comes again: a template's size times the text at most.
        """
        code: dict[tuple[bytes, bytes], int] = {}
        at = np.array([code.setdefault(g, len(code)) for g in zip(words, words[1:], strict=False)])
        order = np.argsort(at, kind="stable")
        again = at[order][1:] == at[order][:-1]
        before, after = np.full(len(at), -1), np.full(len(at), len(at))
        before[order[1:][again]], after[order[:-1][again]] = order[:-1][again], order[1:][again]
        found = []
        for t in which:
            size, high = self.sizes[t], self.bounds[t][1]
            is_own = np.zeros(len(code), bool)
            is_own[[code[g] for g in self.own[t] if g in code]] = True
            own = is_own[at]
            for i in np.flatnonzero(own).tolist():
                reach = int(2 * high) + 8
                while True:
                    end = min(int(after[i]), i + reach)
                    fresh = before[i:end] < i
                    n = np.cumsum(fresh)
                    if end == after[i] or n[-1] > high:
                        break
                    reach *= 2
                dice = 2 * np.cumsum(fresh & own[i:end]) / (n + size)
                j = int(dice.argmax())
                if dice[j] >= self.least:
                    found.append((float(dice[j]), i, i + j + 2, t))
        return found

    def all(self, text: bytes) -> tuple[int, set[str], float]:
        """How many places of a text match (its lines, it as a whole, and passages beyond those), licences, the best coefficient."""
        words = _WORD.findall(text.lower())
        which = self.possible(words)
        if not which:
            return 0, set(), 0.0
        lines = text.split(b"\n")
        by_line = [self.match(line) for line in lines]
        whole = self.match(text) if len(lines) > 1 else []
        passages = sorted(self.passages(words, which), key=lambda x: (-x[0], x[1], x[2], x[3]))
        of_line = np.repeat(np.arange(len(lines)), [len(_WORD.findall(line.lower())) for line in lines])
        n, taken = sum(map(bool, by_line)) + bool(whole), np.zeros(len(words), bool)
        for _, a, b, _ in passages:
            if not taken[a:b].any():  # windows that overlap a better one are the same place
                taken[a:b] = True
                inside = of_line[a] == of_line[b - 1] and by_line[of_line[a]]
                n += not (inside or whole)
        hits = [*(x for m in (*by_line, whole) for x in m), *((self.names[t], d) for d, _, _, t in passages)]
        return n, {name for name, _ in hits}, max((d for _, d in hits), default=0.0)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """Every row of docs (any columns) with n_matches (lines, the whole text, and passages within or across lines, that match), licenses (sorted ids) and dice (the best, else 0).

    Null and empty texts match nothing; a text of one line counts once, a passage in a matching line or text with it; repeated rows repeat results.
    """
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

    tune(docs.sparkSession)
    templates = [*TEMPLATES, *BODIES] if templates is None else templates
    own = [f for f in docs.schema.fields if f.name not in ("n_matches", "licenses", "dice")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least)
        for batch in batches:
            for part, texts in blocks(batch):
                n, names, best = [], [], []
                for t in texts:
                    places, own_names, dice = known.all(t or b"")
                    n.append(places)
                    names.append(sorted(own_names))
                    best.append(dice)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(best, pa.float64())], names=[*part.schema.names, "n_matches", "licenses", "dice"])

    kind = StructType([*own, StructField("n_matches", LongType()), StructField("licenses", ArrayType(StringType())), StructField("dice", DoubleType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, kind)


def op9_license(docs: DataFrame) -> DataFrame:
    out = scan(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_matches", F.concat_ws(",", "licenses").alias("licenses"), "dice")


_VALUES = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TEMPLATES))
OP9_SQL = f"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
), parts AS (
  SELECT doc_id, 0 AS line, x FROM low
  UNION ALL SELECT doc_id, i, string_split(x, chr(10))[i] FROM (SELECT doc_id, x, unnest(range(1, len(string_split(x, chr(10))) + 1)) AS i FROM low) WHERE len(string_split(x, chr(10))) > 1
), words AS (SELECT doc_id, line, regexp_extract_all(x, '[a-z0-9]+') AS w FROM parts
), grams AS (SELECT DISTINCT doc_id, line, w[i] AS a, w[i + 1] AS b FROM (SELECT doc_id, line, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)
), sized AS (SELECT doc_id, line, count(*) AS n FROM grams GROUP BY ALL
), tw AS (SELECT t, name, regexp_extract_all(lower(x), '[a-z0-9]+') AS w FROM (VALUES {_VALUES}) AS v(t, name, x)
), tg AS (SELECT DISTINCT t, name, w[i] AS a, w[i + 1] AS b FROM (SELECT t, name, w, unnest(range(1, len(w))) AS i FROM tw)
), ts AS (SELECT t, count(*) AS n FROM tg GROUP BY t
), met AS (SELECT doc_id, line, t, name, count(*) AS k FROM grams JOIN tg USING (a, b) GROUP BY ALL
), hit AS (SELECT m.doc_id, m.line, m.name, 2 * m.k / (s.n + ts.n)::DOUBLE AS dice FROM met m JOIN sized s USING (doc_id, line) JOIN ts USING (t) WHERE 2 * m.k / (s.n + ts.n)::DOUBLE >= {LEAST}
), own AS (SELECT doc_id, count(DISTINCT line) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS dice FROM hit GROUP BY doc_id)
SELECT d.doc_id, coalesce(o.n, 0)::BIGINT AS n_matches, coalesce(o.names, '') AS licenses, coalesce(o.dice, 0)::DOUBLE AS dice FROM documents d LEFT JOIN own o USING (doc_id)
"""
