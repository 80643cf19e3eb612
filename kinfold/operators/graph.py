"""Graph operators: connected components, Markov clustering, representative clustering."""

from __future__ import annotations

import functools
import itertools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Cells of a block of flow that a task holds at once; entries of a row of the flow table, about.
CELLS, ENTRIES = 4_000_000, 500_000
_dirs: dict[str, str] = {}


def scratch_path(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir (a temporary one in local runs that name none), deleted with the driver at the latest."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = _dirs.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="kinfold-"))
    path = f"{folder}/kinfold-{uuid.uuid4().hex}"
    at, system = _located(spark, path)
    system.deleteOnExit(at)
    return path


def _located(spark: SparkSession, path: str) -> tuple[object, object]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a table at a scratch path."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables of cut_lineage() that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table at a scratch path."""
    at, system = _located(spark, path)
    system.delete(at, True)


def by_part(df: DataFrame, *order: str) -> str:
    """Writes df to a scratch path by its column `part`, a part in one file; for stored()."""
    path = scratch_path(df.sparkSession)
    df.repartition("part").sortWithinPartitions("part", *order).write.option("compression", "zstd").partitionBy("part").parquet(path)
    return path


def stored(path: str, part: int) -> Iterator[pa.NativeFile]:
    """The files of a part of a scratch table that was written by `part`, for tasks: read through pyarrow's file systems, nothing is shuffled."""
    system, at = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    for info in sorted(system.get_file_info(pafs.FileSelector(f"{at}/part={part}", allow_not_found=True)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as f:
                yield f


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes on edges (a, b): the least node that can be reached.

    Every node takes its least neighbour's label, labels are shortened through each other, and edges between labels carry on
    until none is left; each round at least halves a chain and cuts its lineage.
    """
    left = cut_lineage(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    label = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("p")))
        held = up
        while True:
            to = up.select(F.col("node").alias("p"), F.col("p").alias("q"))
            step = cut_lineage(up.join(to, "p").select("node", "q", (F.col("p") != F.col("q")).alias("moved")))
            discard(held)
            up, held = step.select("node", F.col("q").alias("p")), step
            if step.where("moved").isEmpty():
                break
        if label is None:
            label, kept = up, held
        else:
            before, kept = kept, None
            label = cut_lineage(label.join(up.select(F.col("node").alias("p"), F.col("p").alias("q")), "p", "left").select("node", F.coalesce("q", "p").alias("p")))
            discard(before)
            kept = label
        ra, rb = up.select(F.col("node").alias("a"), F.col("p").alias("x")), up.select(F.col("node").alias("b"), F.col("p").alias("y"))
        moved = left.join(ra, "a").join(rb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        done, left = left, cut_lineage(moved.distinct())
        discard(done, held if held is not kept else None)
    if label is None:
        return nodes.select("node", F.col("node").alias("component"))
    discard(left)
    return label.select("node", F.col("p").alias("component"))


def mcl(a: np.ndarray, b: np.ndarray, w: np.ndarray, inflation: float, rounds: int = 60, prune: float = 1e-4) -> list[list]:
    """Markov clusters of a weighted undirected graph: flow is spread by squaring and sharpened by powers until it rests.

    Flow below `prune` is dropped, but never what is near the most of its column: that of a large clique is small everywhere.
    """
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    n = len(names)
    m = np.zeros((n, n))
    m[at[: len(a)], at[len(a) :]] = w
    m = np.maximum(m, m.T)
    m[np.arange(n), np.arange(n)] = np.maximum(m.max(axis=0), 1e-12)
    m /= m.sum(axis=0)
    for _ in range(rounds):
        new = np.power(m @ m, inflation)
        new /= new.sum(axis=0)
        new[new < np.minimum(prune, new.max(axis=0) / 2)] = 0
        new /= new.sum(axis=0)
        if np.abs(new - m).max() < 1e-6:
            m = new
            break
        m = new
    root = {}
    for j in range(n):  # columns that flow to the same attractor are one cluster
        root.setdefault(int(m[:, j].round(6).argmax()), []).append(j)
    return [names[v].tolist() for v in root.values()]


_FLOW = "part long, first long, lens binary, rows binary, flow binary, most double, roots array<int>"


def _width(n: int) -> int:
    """Columns of a block of n nodes: so many that a task's dense block stays within CELLS."""
    return max(1, min(512, CELLS // n))


def _flow_rows(part: int, first: int, lens: np.ndarray, rows: np.ndarray, flow: np.ndarray, most: float, roots: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Columns from `first` on, of so many entries each, as rows of the flow table: each of ENTRIES entries about, for a column stays whole."""
    ends = np.append(0, np.cumsum(lens))
    at = 0
    while at < len(lens):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + ENTRIES, "right")) - 1)
        own = slice(ends[at], ends[to])
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (lens[at:to].astype(np.int32), rows[own].astype(np.int32), flow[own].astype(np.float64))]
        root = pa.array([[] if roots is None else roots[at:to].tolist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([first + at]), *blobs, pa.array([most], pa.float64()), root], names=["part", "first", "lens", "rows", "flow", "most", "roots"])
        at = to


def _flow_of(path: str, part: int, shared: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first column, entries of each column, their rows, their flow) of a part's rows in a flow table, one after another."""
    for f in stored(path, part):
        for batch in pq.ParquetFile(f).iter_batches(batch_size=1, columns=["first", "lens", "rows", "flow"]):
            first, lens, rows, flow = (c[0].as_py() for c in batch.columns)
            lens, rows, flow = np.frombuffer(lens, np.int32).astype(np.int64), np.frombuffer(rows, np.int32), np.frombuffer(flow, np.float64)
            if not shared:
                flow = flow / np.repeat(np.add.reduceat(flow, np.append(0, np.cumsum(lens)[:-1])), lens)
            yield first, lens, rows, flow


def _spread(n: int, lens: np.ndarray, rows: np.ndarray, flow: np.ndarray, own: np.ndarray, total: np.ndarray) -> None:
    """Adds to total (n x columns of a block) the product of some columns of the flow and their rows (own) of the block: as
    matrices where that is less work than meeting by meeting."""
    k, j = np.nonzero(own)
    start = np.append(0, np.cumsum(lens))
    each = lens[k]
    if each.sum() * 60 > n * len(lens) * own.shape[1]:
        for a in range(0, len(lens), 256):
            b = min(a + 256, len(lens))
            dense = np.zeros((n, b - a))
            cut = slice(start[a], start[b])
            dense[rows[cut], np.repeat(np.arange(b - a), lens[a:b])] = flow[cut]
            total += dense @ own[a:b]
        return
    upto = np.append(0, np.cumsum(each))
    at, flat = 0, total.reshape(-1)
    while at < len(k):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + CELLS // 2, "right")) - 1)
        here = each[at:to]
        met = np.repeat(start[k[at:to]] - (upto[at:to] - upto[at]), here) + np.arange(upto[to] - upto[at])
        np.add.at(flat, rows[met].astype(np.int64) * own.shape[1] + np.repeat(j[at:to], here), flow[met] * np.repeat(own[k[at:to], j[at:to]], here))
        at = to


def _next_flow(path: str, part: int, n: int, first: int, width: int, shared: bool, inflation: float, prune: float) -> Iterator[pa.RecordBatch]:
    """A block of columns after a round. All that is done to a column needs the flow as it was and this column alone."""
    width = min(width, n - first)
    old = np.zeros((n, width))
    for at, lens, rows, flow in _flow_of(path, part, shared):
        col = np.repeat(np.arange(at - first, at - first + len(lens)), lens)
        mine = (col >= 0) & (col < width)
        old[rows[mine], col[mine]] = flow[mine]
    new = np.zeros((n, width))
    for at, lens, rows, flow in _flow_of(path, part, shared):
        _spread(n, lens, rows, flow, old[at : at + len(lens)], new)
    np.power(new, inflation, out=new)
    new /= new.sum(axis=0)
    new[new < np.minimum(prune, new.max(axis=0) / 2)] = 0
    new /= new.sum(axis=0)
    old -= new
    most = float(np.abs(old, out=old).max())
    roots = new.round(6).argmax(axis=0)
    col, row = np.nonzero(new.T)
    yield from _flow_rows(part, first, np.bincount(col, minlength=width), row, new[row, col], most, roots)


def mcl_by_columns(edges: DataFrame, inflation: float, rounds: int = 60, prune: float = 1e-4) -> DataFrame:
    """(part, cluster, member): what mcl() finds in each part of (part, a, b, weight), a round being one pass over blocks of columns.

    The flow is a table of packed columns. A round needs a column of the result and all of the flow that is there, never two
    results: each task makes a block of columns and reads its part of the flow row by row from the scratch folder. Nothing is
    shuffled after the first table, no meeting of entries is written, and a task holds CELLS cells of a block at a time.
    """
    spark = edges.sparkSession
    ends = edges.select("part", F.col("a").alias("node")).union(edges.select("part", "b")).distinct()
    ids = ends.withColumn("i", (F.row_number().over(Window.partitionBy("part").orderBy("node")) - 1).cast("int"))
    ids = cut_lineage(ids.withColumn("n", F.count("*").over(Window.partitionBy("part")).cast("int")))
    one = lambda c, i: ids.select("part", F.col("node").alias(c), F.col("i").alias(i), *(["n"] if c == "a" else []))
    placed = edges.join(one("a", "i"), ["part", "a"]).join(one("b", "j"), ["part", "b"]).select("part", "n", "i", "j", F.col("weight").cast("double").alias("weight"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                rows += batch.num_rows
            if rows and (batch is None or rows >= CELLS // 4):
                t = pa.Table.from_batches(held)
                part, n, i, j, w = (np.tile(t[c].to_numpy(), 2) for c in ("part", "n", "i", "j", "weight"))
                i, j = np.concatenate((i[:rows], j[:rows])), np.concatenate((j[:rows], i[:rows]))
                block = j // np.maximum(1, np.minimum(512, CELLS // n))
                by = np.lexsort((i, j, part))
                part, block, i, j, w, n = part[by], block[by], i[by], j[by], w[by], n[by]
                edge = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (block[1:] != block[:-1])])
                cuts = list(zip(edge, [*edge[1:], len(part)], strict=True))
                blobs = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (j.astype(np.int32), i.astype(np.int32), w)]
                yield pa.RecordBatch.from_arrays([pa.array(part[edge]), pa.array(block[edge].astype(np.int64)), pa.array(n[edge].astype(np.int64)), *blobs], names=["part", "block", "n", "cols", "rows", "flow"])
                held, rows = [], 0

    def begun(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, n = (k.as_py() for k in key)
        t = pa.Table.from_batches(batches)
        col, row, w = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in t[c]]) for c, kind in (("cols", np.int32), ("rows", np.int32), ("flow", np.float64)))
        first = block * _width(n)
        width = min(_width(n), n - first)
        m = np.zeros((n, width))
        np.maximum.at(m, (row, col - first), w)
        m[np.arange(first, first + width), np.arange(width)] = np.maximum(m.max(axis=0), 1e-12)
        col, row = np.nonzero(m.T)
        yield from _flow_rows(part, first, np.bincount(col, minlength=width), row, m[row, col], 1.0, None)

    def write(df: DataFrame) -> str:
        path = scratch_path(spark)
        df.write.option("compression", "zstd").partitionBy("part").parquet(path)
        return path

    blocks = placed.mapInArrow(packed, "part long, block long, n long, cols binary, rows binary, flow binary")
    sizes = {x["part"]: x["n"] for x in ids.groupBy("part").agg(F.max("n").alias("n")).collect()}  # a row for each large component
    path, shared, rested = write(blocks.groupBy("part", "block", "n").applyInArrow(begun, _FLOW)), False, []
    for turn in range(rounds):
        todo = [(p, n, first, _width(n)) for p, n in sizes.items() for first in range(0, n, _width(n))]

        def turned(batches: Iterator[pa.RecordBatch], todo=todo, path=path, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in batch.column(0).to_pylist():
                    yield from _next_flow(path, *todo[x], shared, inflation, prune)

        before, path = path, write(spark.range(0, len(todo), 1, len(todo)).mapInArrow(turned, _FLOW))
        shared = True
        flow = spark.read.schema(_FLOW).parquet(path)
        still = {x["part"] for x in flow.groupBy("part").agg(F.max("most").alias("most")).collect() if x["most"] >= 1e-6 and turn + 1 < rounds}
        rest = flow.where(~F.col("part").isin(list(still))) if still else flow
        if len(still) < len(sizes):
            rested.append(cut_lineage(rest.select("part", F.posexplode("roots").alias("at", "root"), "first").select("part", (F.col("first") + F.col("at")).cast("int").alias("i"), "root")))
        remove(spark, before)
        sizes = {p: n for p, n in sizes.items() if p in still}
        if not sizes:
            break
    remove(spark, path)
    root = functools.reduce(DataFrame.unionByName, rested)
    name = ids.select("part", "i", "node")
    named = root.join(name.withColumnRenamed("node", "member"), ["part", "i"])
    return named.join(named.groupBy("part", "root").agg(F.min("member").alias("cluster")), ["part", "root"]).select("part", "cluster", "member")


def markov_clusters(edges: DataFrame, inflation: float = 3.0, largest: int = 3000) -> DataFrame:
    """(group, cluster, member): Markov clusters inside each component of (group, a, b, weight).

    A cluster never spans two components, so each is clustered by itself: in one task, or by blocks of columns if it has more
    than `largest` nodes. Both ways do the same rounds over all links.
    """
    kind = edges.schema["a"].dataType.simpleString()
    keyed = edges.where("weight > 0")
    comp = components(keyed.select("a", "b"))
    size = cut_lineage(comp.join(comp.groupBy("component").agg(F.count("*").alias("nodes")), "component"))
    sized = keyed.join(size.withColumnRenamed("node", "a"), "a")
    small, big = sized.where(F.col("nodes") <= largest), sized.where(F.col("nodes") > largest)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = mcl(pdf["a"].to_numpy(), pdf["b"].to_numpy(), pdf["weight"].to_numpy(float), inflation)
        return pd.DataFrame([(pdf["group"].iloc[0], min(c), x) for c in found for x in c], columns=["group", "cluster", "member"])

    out = small.groupBy("group", "component").applyInPandas(run, f"group string, cluster {kind}, member {kind}")
    if size.where(F.col("nodes") > largest).isEmpty():
        return out
    parts = cut_lineage(big.select("group", "component").distinct().withColumn("part", F.monotonically_increasing_id()))
    keys = parts.select("part", F.col("group").alias("g"), F.col("component").alias("c"))
    found = mcl_by_columns(big.join(keys, F.col("group").eqNullSafe(F.col("g")) & (F.col("component") == F.col("c"))).select("part", "a", "b", "weight"), inflation)
    return out.unionByName(found.join(parts, "part").select(F.col("group").cast("string").alias("group"), "cluster", "member"))


def representatives(pairs: DataFrame, nodes: DataFrame, identity: float = 0.5) -> DataFrame:
    """(rep, member): greedy representatives by size. A node is a representative unless a larger one (ties: the lesser id) with
    score of `identity` or more is; members go to the largest such.

    Decided in rounds over the links to larger nodes: a node without any such link left represents itself, those linked to it are
    then members, and the links of members go, as members hold back nobody. Whose member a node is follows once all are decided.
    """
    order = F.struct((-F.col("size")).alias("s"), F.col("id"))
    n = nodes.select("id", order.alias("o"))
    p = pairs.where(F.col("score") >= identity)
    both = p.select("a", "b").unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    up = cut_lineage(both.join(n.select(F.col("id").alias("a"), F.col("o").alias("oa")), "a").join(n.select(F.col("id").alias("b"), F.col("o").alias("ob")), "b").where("ob < oa").select("a", "b", "ob"))
    left, members = up.select("a", "b"), None
    before, found = None, []
    while True:
        tops = left.select("b").distinct().join(left.select(F.col("a").alias("b")), "b", "left_anti")
        now = cut_lineage(left.join(tops, "b", "left_semi").select("a").distinct())
        if now.isEmpty():
            break
        members = now if members is None else members.unionByName(now)
        found.append(now)
        left = cut_lineage(left.join(now, "a", "left_anti").join(now.select(F.col("a").alias("b")), "b", "left_anti").select("a", "b"))
        discard(before)
        before = left
    discard(before, now)
    if members is None:
        discard(up)
        return n.select(F.col("id").alias("rep"), F.col("id").alias("member"))
    own = up.join(members.select(F.col("a").alias("b")), "b", "left_anti").groupBy("a").agg(F.min("ob").alias("best"))
    own = cut_lineage(own.select(F.col("a").alias("id"), F.col("best.id").alias("rep")))
    discard(up, *found)
    return n.join(own, "id", "left").select(F.coalesce("rep", "id").alias("rep"), F.col("id").alias("member"))
