"""Folds along a global order whose state depends on all rows before: page filling and bin packing, without one stream of rows.

Rows are dealt by ranges of (size down, item) and written once. Each range says in a few numbers what it does to any state that
it may be entered with; one row a range is folded in order; each range then runs its own rows from the state it is given.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut_lineage


def _in_ranges(rows: DataFrame) -> DataFrame:
    """(item, size, _part, _nth): rows dealt by ranges and written, with their place in the range. A null size counts as 0."""
    order = [F.col("size").desc(), F.col("item")]
    sized = rows.select("item", F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"))
    placed = cut_lineage(sized.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    return placed.withColumn("_nth", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))


def _started(summaries: DataFrame, fold: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """The states that ranges are entered with: one row a range goes through the fold in order."""
    return summaries.repartition(1).sortWithinPartitions("_part").mapInPandas(fold, schema)


def _run(placed: DataFrame, starts: DataFrame, column: str, replay: Callable[[np.ndarray, dict], list[int]]) -> DataFrame:
    """(item, size, column): each range replayed from its state. Items pass through Arrow, so any type and nulls stay as they are."""
    state = [c for c in starts.columns if c != "_part"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_nth")
        first = {c: table[c][0].as_py() for c in state}
        found = replay(table["size"].to_numpy(), first)
        return table.select(["item", "size"]).append_column(column, pa.array(found, pa.int32()))

    kind = placed.schema["item"].dataType.simpleString()
    return placed.join(starts, "_part").groupBy("_part").applyInArrow(run, f"item {kind}, size long, {column} int")


def next_break(upto: np.ndarray, at: int, most: int) -> int:
    """Where the page that opens at row `at` ends: the first row that would take it over `most`, never a page's first row with a size.

    `upto` holds the running sums of the sizes, 0 in front.
    """
    j = int(np.searchsorted(upto[1:], most + upto[at], "right"))
    return j + 1 if j < len(upto) - 1 and upto[j] == upto[at] else j


def page_summary(sizes: np.ndarray, most: int) -> dict:
    """What a range does to a page it is entered with: (first sums, and by the row at which that page ends: pages opened, sum held at last).

    Only rows at which a page of `most` at most can end count, so the lists have no more distinct sums than `most` + 2.
    """
    n, upto = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    pages, held = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for at in range(n - 1, -1, -1):
        end = next_break(upto, at, most)
        pages[at], held[at] = (1, upto[n] - upto[at]) if end >= n else (pages[end] + 1, held[end])
    alone = next_break(upto, 0, most)
    ends = sorted({int(np.searchsorted(upto[1:], x, "right")) for x in {*upto[1:][upto[1:] <= most].tolist(), most, -1, 0}} - {n})
    return {
        "total": int(upto[n]), "sums": upto[1:][ends].tolist(), "pages": pages[ends].tolist(), "held": held[ends].tolist(),
        "alone_pages": int(pages[alone]) if alone < n else 0, "alone_held": int(held[alone]) if alone < n else int(upto[n]),
    }


def paginate(rows: DataFrame, most: int) -> DataFrame:
    """(item, size, page): pages in order of size down and item, a new one where the sum of sizes would exceed `most`.

    An item larger than `most` has a page of its own. Sizes are not negative; null counts as 0. Empty tables give none. Where the
    page before a range ends inside it is one of at most `most` + 2 places, so a range's effect is told by lists of that length.
    """
    placed = _in_ranges(rows)

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"_part": pdf["_part"].iloc[0], **page_summary(pdf.sort_values("_nth")["size"].to_numpy(np.int64), most)}])

    lists = "_part int, total long, sums array<long>, pages array<long>, held array<long>, alone_pages long, alone_held long"
    summaries = placed.select("_part", "_nth", "size").groupBy("_part").applyInPandas(summarise, lists)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page, held = 1, 0
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                out.append((r[0], page, held))
                k = int(np.searchsorted(r.sums, most - held, "right"))
                if not held:
                    page, held = page + r.alone_pages, r.alone_held
                elif k < len(r.sums):
                    page, held = page + int(r.pages[k]), int(r.held[k])
                else:
                    held += r.total
            yield pd.DataFrame(out, columns=["_part", "_page", "_held"])

    def replay(sizes: np.ndarray, state: dict) -> list[int]:
        page, held, out = state["_page"], state["_held"], []
        for s in sizes.tolist():
            if held and held + s > most:
                page, held = page + 1, 0
            held += s
            out.append(page)
        return out

    return _run(placed, _started(summaries, fold, "_part int, _page long, _held long"), "page", replay)


def dealt(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """Loads after `count` items of one size went each to the least loaded bin (ties: the lower one).

    The loads at which bins take items are `load + j * size`, and items take them in order: a threshold splits them, found by bisection.
    """
    if not size:
        return loads
    taken = lambda t: np.maximum(0, -((loads - t) // size))  # noqa: E731  items that bins take at loads below t
    low, high = int(loads.min()), int(loads.min()) + size * count + 1
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if int(taken(mid).sum()) <= count else (low, mid)
    n = taken(low)
    at = np.flatnonzero((loads <= low) & ((low - loads) % size == 0))[: count - int(n.sum())]
    n[at] += 1
    return loads + n * size


def lpt_bins(items: DataFrame, bins: int) -> DataFrame:
    """(item, size, bin): largest first to the least loaded bin (ties: the lower one), in order of size down and item.

    Sizes are not negative; null counts as 0. A range is told by its distinct sizes and their counts; items of one size are dealt at
    once, so the fold's work follows the distinct sizes, not the items. Empty tables give none.
    """
    placed = _in_ranges(items)
    each = placed.groupBy("_part", "size").agg(F.count("*").alias("n"))
    summaries = each.groupBy("_part").agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("less"), "n"))).alias("sizes")).select("_part", "sizes.less", "sizes.n")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loads = np.zeros(bins, np.int64)
        for pdf in batches:
            out = []
            for part, less, counts in pdf.itertuples(index=False):
                out.append((part, loads.tolist()))
                for s, n in zip(less, counts):
                    loads = dealt(loads, -int(s), int(n))
            yield pd.DataFrame(out, columns=["_part", "_loads"])

    def replay(sizes: np.ndarray, state: dict) -> list[int]:
        heap, out = [(load, b) for b, load in enumerate(state["_loads"])], []
        heapq.heapify(heap)
        for s in sizes.tolist():
            load, b = heap[0]
            heapq.heapreplace(heap, (load + s, b))
            out.append(b)
        return out

    return _run(placed, _started(summaries, fold, "_part int, _loads array<long>"), "bin", replay)
