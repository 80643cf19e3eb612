"""Streaming forms of calling: sequences as they come, looked up in a table of signatures, and their hits folded into regions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.sequences import call_kmers
from kinfold.operators.calling import Folder
from kinfold.operators.signatures import Options

REGIONS = "id string, start long, stop long, n long, function string, weight double, med_len double, mad double"


def stream_hits(seqs: DataFrame, signatures: DataFrame) -> DataFrame:
    """(id, pos, and the signatures' columns) of a stream of sequences (id, seq): the windows that calling looks at.

    A stream-static join without state, in append mode; the same rows as call_hits() of the same sequences in a batch.
    """
    return call_kmers(seqs.select("id", "seq"), "seq").select("id", "pos", "kmer").join(signatures, "kmer")


def stream_regions(events: DataFrame, gap: str, late: str, min_hits: int) -> DataFrame:
    """Gap regions of a stream (id, ts, weight): a session ends once `gap` has passed without a hit; hits later than `late` are left out."""
    session = F.session_window("ts", gap)
    agg = events.withWatermark("ts", late).groupBy("id", session).agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    return agg.where(F.col("n") >= min_hits).select("id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), "n", "weight")


def stream_folded(hits: DataFrame, options: Options = Options(), idle_seconds: float = 600.0) -> DataFrame:
    """Regions of a stream of hits (id, pos, function, weight, mean, from_end), by the rules of the batch fold, in append mode.

    What is kept of a sequence between batches is its run of hits that hasn't ended, and its function. A sequence's hits come
    in order of pos from batch to batch (inside a batch in any order); however they are cut into batches, the regions are those
    of the fold over all of them. A row without a function ends its sequence; one that gets no rows for `idle_seconds` ends by
    a timer. A hit that comes after that opens the sequence anew. Hits without a position have no place and are left out.
    """
    columns = [c.split()[0] for c in REGIONS.split(", ")]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: object) -> Iterator[pd.DataFrame]:
        folder = Folder(options)
        if state.exists:
            run, folder.current = json.loads(state.get[0])
            folder.run = [tuple(h) for h in run]
        ended = state.hasTimedOut
        if not ended:
            rows = pd.concat(list(frames))
            ended = bool(rows["function"].isna().any())
            rows = rows[rows["function"].notna() & rows["pos"].notna()].sort_values("pos", kind="stable")
            for h in zip(rows["pos"].astype(int).tolist(), rows["function"].tolist(), rows["weight"].astype(float).tolist(), rows["mean"].astype(float).tolist(), rows["from_end"].astype(int).tolist(), strict=True):
                folder.add(h)
        if ended:
            folder.end()
            if state.exists:
                state.remove()
        else:
            state.update((json.dumps([folder.run, folder.current]),))
            state.setTimeoutDuration(max(1, int(idle_seconds * 1000)))
        if folder.regions:
            yield pd.DataFrame([{"id": str(key[0]), **r} for r in folder.regions])[columns]

    rows = hits.select("id", "pos", "function", "weight", "mean", "from_end")
    return rows.groupBy("id").applyInPandasWithState(step, REGIONS, "held string", "append", "ProcessingTimeTimeout")
