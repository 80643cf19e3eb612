"""Function calling: hits of a sequence are folded into regions, regions into one call.

The fold of a sequence's hits is sequential by definition, so it runs over rows that stream through a task in order, one run of
hits at a time; gap-only regions and the collapsing of neighbours are plain window plans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .signatures import Options

def gap_regions(hits: DataFrame, max_gap: int, min_hits: int) -> DataFrame:
    """Regions by the gap rule alone: (id, region, start, stop, n, weight) of runs whose neighbours are max_gap apart at most."""
    w = Window.partitionBy("id").orderBy("pos", "ord")
    new = F.when(F.col("pos") - F.lag("pos").over(w) > max_gap, 1).otherwise(0)
    marked = hits.withColumn("_new", new).withColumn("region", F.sum("_new").over(w))
    return marked.groupBy("id", "region").agg(F.min("pos").alias("start"), F.max("pos").alias("stop"), F.count("*").alias("n"), F.sum("weight").alias("weight")).where(F.col("n") >= min_hits)


def collapse(rows: DataFrame) -> DataFrame:
    """Neighbouring rows (id, ord, function, n, weight) of one function made one: (id, run, function, n, weight)."""
    w = Window.partitionBy("id").orderBy("ord")
    changed = F.when(F.col("function") == F.lag("function").over(w), 0).otherwise(1)
    marked = rows.withColumn("_c", changed).withColumn("run", F.sum("_c").over(w))
    return marked.groupBy("id", "run", "function").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))


class Folder:
    """Folds hits (pos, function, weight, mean length, distance from end, otu) that come in order of pos into regions.

    A region is the hits of its function in a run. It ends at a gap above max_gap, or once two hits in a row share another
    function; these two then open the next. A single stray hit ends nothing. Whether a run is long enough at a gap counts
    strays too; whether it is emitted counts its function's hits alone. A region's otus are those of its hits but the last.
    """

    def __init__(self, o: Options):
        self.o, self.run, self.current = o, [], None
        self.regions: list[dict] = []
        self.otus: Counter = Counter()

    def _emit(self, start: int, stop: int, function: str, weights: list[float], means: list[float], otus: list) -> None:
        weight = float(sum(weights))
        if means and len(means) >= self.o.min_hits and weight >= self.o.min_weighted:
            mid = median(means)
            self.regions.append({"start": start, "stop": stop + 7, "n": len(means), "function": function, "weight": weight, "med_len": float(int(mid)), "mad": float(median([abs(m - mid) for m in means]))})
            self.otus.update([u for u in otus[:-1] if u is not None])

    def _flush(self) -> None:
        run, current = self.run, self.current
        own = [h for h in run if h[1] == current]
        self._emit(run[0][0], own[-1][0] if own else run[0][0], current, [h[2] for h in own], [h[3] for h in own], [h[5] if len(h) > 5 else None for h in own])
        if len(run) > 1 and run[-1][1] == run[-2][1] != current:
            self.run, self.current = run[-2:], run[-1][1]
        else:
            self.run = []

    def add(self, h: tuple) -> None:
        if self.run and self.run[-1][0] + self.o.max_gap < h[0]:
            if len(self.run) >= self.o.min_hits:
                self._flush()
            else:
                self.run = []
        if not self.run:
            self.current = h[1]
        elif self.o.order_constraint and not (h[1] == self.run[-1][1] and abs((h[0] - self.run[-1][0]) - (self.run[-1][4] - h[4])) <= 20):
            return
        self.run.append(h)
        if len(self.run) > 1 and h[1] != self.current and self.run[-2][1] == h[1]:
            self._flush()

    def stretch(self, pos: list[int], function: str, weights: list[float], means: list[float], otus: list) -> None:
        """As add() of each hit, for hits of one function, none far from the next, with a gap (or nothing) in front of them and behind."""
        self.end()
        self._emit(pos[0], pos[-1], function, weights, means, otus)

    def end(self) -> list[dict]:
        if len(self.run) >= self.o.min_hits:
            self._flush()
        self.run = []
        return self.regions


def fold(hits: list[tuple], o: Options = Options()) -> list[dict]:
    """The regions of a sequence's hits."""
    f = Folder(o)
    for h in hits:
        f.add(h)
    return f.end()


def joined(regions: list[dict]) -> list[dict]:
    """Neighbours of one function made one; then F1 F2 F1 with few F2 (under 5) and enough F1 (10 or more) made F1, as often as it goes.

    What is made one keeps the first's lengths.
    """

    def two(a: dict, b: dict) -> dict:
        return {**a, "stop": b["stop"], "n": a["n"] + b["n"], "weight": a["weight"] + b["weight"]}

    out: list[dict] = []
    for r in regions:
        if out and out[-1]["function"] == r["function"]:
            out[-1] = two(out[-1], r)
        else:
            out.append(dict(r))
    i = 0
    while i + 2 < len(out):
        a, b, c = out[i : i + 3]
        if a["function"] == c["function"] and b["n"] < 5 and a["n"] + c["n"] >= 10:
            out[i : i + 3] = [two(a, c)]
        else:
            i += 1
    return out


def fusion(regions: list[dict]) -> str | None:
    """The multi-role function that a row of regions spells: one part, itself in between, another part, in order, with the parts'
    lengths adding up to its own within a tenth. Parts are lettered in the order in which they are met."""
    parts: dict[str, str] = {}
    wholes: dict[tuple, str] = {}
    spelt, lengths, names = [], {}, {}
    for r in regions:
        own = tuple(parts.setdefault(p, f"p{len(parts)}") for p in r["function"].split(" / "))
        sign = own[0] if len(own) == 1 else wholes.setdefault(own, f"w{len(wholes)}")
        spelt.append(sign)
        lengths.setdefault(sign, []).append(r["med_len"])
        names[sign] = r["function"]
    sign = {"p0": "A", "p1": "B", "w0": "W"}
    if not re.fullmatch(r"W?A[AW]*W[BW]*BW?", "".join(sign.get(x, "-") for x in spelt)):
        return None
    a, b, w = (sum(lengths[k]) / len(lengths[k]) for k in ("p0", "p1", "w0"))
    return names["w0"] if w and abs(a + b - w) / w < 0.1 else None


def scored_call(regions: list[dict], least: float = 5.0, ambiguous: bool = False) -> tuple[str, float, float, float] | None:
    """(function, score, offset, weighted score) of a sequence's regions, or None where no function leads by `least` hits.

    A fusion has offset 0. If ambiguous calls are wanted, two functions that lie close are named together: with others behind
    them only if these are more than two hits behind, and the offset is then the distance to them.
    """
    regions = joined(regions)
    if not regions:
        return None
    if len(regions) > 1 and (whole := fusion(regions)):
        return whole, float(sum(r["n"] for r in regions)), 0.0, float(sum(r["weight"] for r in regions))
    score: dict[str, list[float]] = {}
    for r in regions:
        s = score.setdefault(r["function"], [0, 0.0])
        s[0], s[1] = s[0] + r["n"], s[1] + r["weight"]
    rank = sorted(((f, n, w) for f, (n, w) in score.items()), key=lambda x: (-x[1], x[0]))
    lead = float(rank[0][1] - (rank[1][1] if len(rank) > 1 else 0))
    if lead >= least:
        return rank[0][0], float(rank[0][1]), lead, float(rank[0][2])
    if ambiguous and len(rank) > 1:
        both = " ?? ".join(sorted((rank[0][0], rank[1][0]), reverse=True))
        if len(rank) == 2:
            return both, float(rank[0][1]), lead, 0.0
        if (behind := float(rank[1][1] - rank[2][1])) > 2:
            return both, float(rank[0][1]), behind, float(rank[0][2])
    return None


def best_call(regions: list[dict], least: float = 5.0, ambiguous: bool = False) -> tuple[str, float, float] | None:
    """(function, score, offset) of scored_call()."""
    got = scored_call(regions, least, ambiguous)
    return got[:3] if got else None


def folded(hits: DataFrame, o: Options = Options(), ambiguous: bool = False, least: float = 5.0, top: int = 5) -> DataFrame:
    """(id, regions, call, otus) of every sequence with hits (id string, pos, function, weight, mean, from_end, and otu if there is one).

    otus: the `top` commonest of the emitted regions' hits (ties: the least). Hits stream through a task in order of id and
    place, so a task holds a batch and one run of hits at a time, however long a sequence is. Stretches of one function between two gaps
    are taken as they are, others hit by hit.
    """
    order = ["id", "pos", "function"]
    cols = [*order, "weight", "mean", "from_end"]
    rows = hits.select(*cols, (F.col("otu") if "otu" in hits.columns else F.lit(None)).cast("string").alias("otu"))
    region = "start: long, stop: long, n: long, function: string, weight: double, med_len: double, mad: double"
    kind = f"id string, regions array<struct<{region}>>, call struct<function: string, score: double, offset: double, weighted: double>, otus array<struct<otu: string, n: long>>"

    def close(id_: str, f: Folder) -> dict:
        found = f.end()
        got = scored_call(found, least, ambiguous)
        best = sorted(f.otus.items(), key=lambda x: (-x[1], x[0]))[:top]
        return {"id": id_, "regions": found, "call": dict(zip(("function", "score", "offset", "weighted"), got, strict=True)) if got else None, "otus": [{"otu": k, "n": n} for k, n in best]}

    def values(column: pa.Array) -> list:
        if pa.types.is_primitive(column.type):
            return column.to_pylist() if column.null_count else column.to_numpy().tolist()
        own = column.dictionary_encode(null_encoding="encode")  # a text is made once a batch
        return np.array([*own.dictionary.to_pylist(), None], object)[own.indices.to_numpy()].tolist()

    def starts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """First places of stretches, which end with a sequence or at a gap, and whether each is of one function."""
        code = lambda c: batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
        pos, function = batch.column("pos").to_numpy(), np.append(0, np.cumsum(np.diff(code("function")) != 0))
        first = np.flatnonzero(np.append(True, (np.diff(code("id")) != 0) | (np.diff(pos) > o.max_gap)))
        return first, function[np.append(first[1:], len(pos)) - 1] == function[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f, out = None, None, []
        for batch in batches:
            if not len(batch):
                continue
            id_, pos, function, weight, mean, from_end, otu = (values(batch.column(c)) for c in ("id", "pos", "function", "weight", "mean", "from_end", "otu"))
            first, one = starts(batch)
            for i, (a, b) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(id_)], strict=True)):
                if f is None or id_[a] != now:
                    if f is not None:
                        out.append(close(now, f))
                    now, f = id_[a], Folder(o)
                if one[i] and not o.order_constraint and b < len(id_) and (i or not f.run):
                    f.stretch(pos[a:b], function[a], weight[a:b], mean[a:b], otu[a:b])
                else:  # a stretch may go on from or in another batch
                    for h in zip(*(x[a:b] for x in (pos, function, weight, mean, from_end, otu)), strict=True):
                        f.add(h)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if f is not None:
            out.append(close(now, f))
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    part = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("n", pa.int64()), ("function", pa.string()), ("weight", pa.float64()), ("med_len", pa.float64()), ("mad", pa.float64())])
    call = pa.struct([("function", pa.string()), ("score", pa.float64()), ("offset", pa.float64()), ("weighted", pa.float64())])
    arrow = pa.schema([("id", pa.string()), ("regions", pa.list_(part)), ("call", call), ("otus", pa.list_(pa.struct([("otu", pa.string()), ("n", pa.int64())])))])
    return rows.repartition("id").sortWithinPartitions(*order).mapInArrow(run, kind)


def regions(hits: DataFrame, o: Options = Options()) -> DataFrame:
    """Regions of each sequence's hits: id, start, stop, n, function, weight, med_len, mad."""
    return folded(hits, o).select("id", F.explode("regions").alias("r")).select("id", "r.*")


def calls(hits: DataFrame, o: Options = Options(), ambiguous: bool = False) -> DataFrame:
    """The call of each sequence that has one: id, function, score, offset, weighted."""
    return folded(hits, o, ambiguous).where(F.col("call").isNotNull()).select("id", "call.*")


def split_called(calls_: DataFrame, ids: DataFrame, least: float = 1.0) -> DataFrame:
    """Every id with its function, or without one if its score is under `least` or it has no call."""
    good = calls_.where(F.col("score") >= least).select("id", "function")
    return ids.select("id").distinct().join(good, "id", "left").withColumn("called", F.col("function").isNotNull())
