"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

Rows of a table are told apart by a number that is given once and written (`rid`), so ids may repeat, be null or be text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, durable, mix, release, row_key, scratch, tune, word_hashes

#: Bands and rows of a band. A pair at Jaccard 0.8 shares no band with probability (1 - 0.8^6)^48 < 5e-7.
BANDS, ROWS = 48, 6
#: Hubs a bucket gives in each round of the last search; later rounds take the next ones until none is left.
HUBS = 128
#: Members of a hub that are verified in one group; larger stars are dealt over as many groups as they need.
STAR = 200
#: Shingles of hubs that a worker keeps at once.
HELD = 200_000
#: Members of a bucket that are searched in one group.
SPREAD = 512
#: Cells in which a set's shingles are counted (to 255): the sum of the lesser counts bounds an intersection from above.
CELLS = 64
_TOP = np.uint64(2**64 - 1)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Distinct hashes of the word shingles of each text (A-Z lower-cased, words parted by ASCII blanks); with fewer words the whole sequence is one."""
    h, counts = word_hashes([(t or b"").lower() for t in texts])
    first = np.concatenate(([0], np.cumsum(counts)))
    n = max(0, len(h) - size + 1)
    every = np.full(n, size, np.uint64)
    for k in range(size):
        every = mix(every * np.uint64(0x100000001B3) ^ h[k : k + n], 3)
    out = []
    for a, c in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if c >= size:
            out.append(np.unique(every[a : a + c - size + 1]))
        elif c:
            one = np.full(1, c, np.uint64)
            for k in range(c):
                one = mix(one * np.uint64(0x100000001B3) ^ h[a + k : a + k + 1], 3)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(elements: np.ndarray, owner: np.ndarray, docs: int, m: int) -> np.ndarray:
    """SuperMinHash signatures (docs x m) of sets given as flat elements and their owners.

    At level j each element of a set draws a fraction and the j-th entry of its own random permutation of the m places; the
    place keeps the least of (level, fraction). A set stops as soon as all its places are held by levels so far, since
    later levels only bring larger values: a set much larger than m takes one or two levels, one of a single element m.
    """
    sig = np.full(docs * m, _TOP)
    e, o, perm = elements, owner, None
    for j in range(m):
        r = mix(e, 101 + j)
        k = (j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            place = k
        else:
            if perm is None:  # only sets that level 0 leaves open need their permutations written out
                perm = np.tile(np.arange(m, dtype=np.uint16), (len(e), 1))
                at = np.arange(len(e))
                perm[at, 0], perm[at, first] = first, 0
            at = np.arange(len(e))
            place = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
            perm[:, j] = place
        np.minimum.at(sig, o * m + place, (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)))
        open_ = sig.reshape(docs, m).max(axis=1) >= (np.uint64(j + 1) << np.uint64(32))
        left = open_[o]
        if not left.any():
            break
        if not left.all() or j == 0:
            first = k[left] if j == 0 else None
            e, o, perm = e[left], o[left], None if perm is None else perm[left]
    return sig.reshape(docs, m)


def _signed(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in blocks(batch):
            sets = shingle_sets(texts, size)
            n = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            owner, ends = np.repeat(np.arange(len(sets)), n), np.cumsum(n)
            sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat, seed)))) for seed in (11, 12)]
            h1, h2 = (t[ends] - t[ends - n] for t in sums)
            counts = np.bincount(owner * CELLS + (flat >> np.uint64(58)).astype(np.int64), minlength=len(sets) * CELLS)
            cells = np.minimum(255, counts).astype(np.uint8).reshape(len(sets), CELLS)
            keys, full = np.zeros((len(sets), bands), np.uint64), np.flatnonzero(n)
            for some in _parts(full, n):
                sig = superminhash(np.concatenate([sets[i] for i in some]), np.repeat(np.arange(len(some)), n[some]), len(some), bands * rows).reshape(len(some), bands, rows)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(some), bands)).copy()
                for i in range(rows):
                    key = mix(key * np.uint64(0x100000001B3) ^ sig[:, :, i], 13)
                keys[some] = key
            bits = pa.array(keys.reshape(-1).view(np.int64))
            cols = [part.column("doc_id"), part.column("did"), part.column("th"), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), bits)
            yield pa.RecordBatch.from_arrays([*cols, lists, pa.array([c.tobytes() for c in cells], pa.binary())], names=["doc_id", "did", "th", "n_shingles", "h1", "h2", "bands", "cells"])


def _parts(full: np.ndarray, n: np.ndarray, most: int = 60_000) -> Iterator[np.ndarray]:
    """Cuts sets into runs of bounded total size (a larger set is alone)."""
    if len(full):
        yield from np.split(full, np.flatnonzero(np.diff(np.cumsum(n[full]) // most)) + 1)


def shingles_of(text: bytes, size: int) -> set:
    words = text.lower().split()
    return set(zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else {tuple(words)}


def _verified(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (hub, salt, role): the hub's text, then its members'. Yields the members that are linked to it."""
    hub, lead, mine = None, b"", None
    for batch in batches:
        a, b = [], []
        for part, texts in blocks(batch):
            for h, s, member, text in zip(part.column("hub").to_pylist(), part.column("salt").to_pylist(), part.column("member").to_pylist(), texts, strict=True):
                if member is None:
                    hub, lead, mine = (h, s), text or b"", None
                elif hub == (h, s):
                    if lead == text:
                        linked = True
                    else:
                        mine = shingles_of(lead, size) if mine is None else mine
                        other = shingles_of(text or b"", size)
                        both = len(mine & other)
                        linked = 100 * both >= percent * (len(mine) + len(other) - both)
                    if linked:
                        a.append(h)
                        b.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verify(texts: DataFrame, rows: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """The (hub, member) edges whose full shingle sets have 100 * intersection >= percent * union, as (a, b).

    texts: did, th, text; rows: rid, did, th. Each member's text is sent once an edge, a hub's once for every STAR of its
    members: no pair of texts is ever a row.
    """
    count = durable(edges.groupBy("hub").agg(F.count("*").alias("k")))
    groups = F.ceil(F.col("k") / STAR).cast("int")
    members = edges.join(count, "hub").select(F.col("member").alias("rid"), "hub", F.pmod(F.xxhash64("member"), groups).cast("int").alias("salt"), "member")
    hubs = count.select(F.col("hub").alias("rid"), "hub", F.explode(F.sequence(F.lit(0), groups - 1)).alias("salt"), F.lit(None).cast("long").alias("member"))
    found = members.unionByName(hubs).join(rows.select("rid", "did", "th"), "rid").join(texts.hint("merge"), ["did", "th"])
    sent = found.select("hub", "salt", "member", "text").repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("member").asc_nulls_first())
    return sent.mapInArrow(lambda it: _verified(it, size, percent), "a long, b long")


def possible(cells: np.ndarray, sizes: np.ndarray, own: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Which sets (cell counts, sizes) can have the similarity with one set, by the bound on their intersection.

    A cell of which both counts are full bounds nothing.
    """
    least = np.minimum(cells, own)
    both = least.sum(axis=1, dtype=np.int64)
    return (100 * both >= percent * (sizes + n - both)) | (least == 255).any(axis=1)


def _searched(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, salt, role): the hubs of a bucket, then members. Yields links between different groups."""
    group, hubs, sets, joined, facts = None, [], {}, set(), None
    for batch in batches:
        a, b = [], []
        for part, texts in blocks(batch):
            cols = [part.column(c).to_pylist() for c in ("key", "salt", "role", "band", "rid", "n", "c", "rank", "bands", "cells")]
            for (key, salt, role, band, rid, n, c, rank, bands, cells), text in zip(zip(*cols, strict=True), texts, strict=True):
                if group != (key, salt):
                    group, hubs, sets, joined, facts = (key, salt), [], {}, set(), None
                if role == 0:
                    hubs.append((rid, n, c, rank, bands, text, np.frombuffer(cells, np.uint8)))
                    continue
                if not hubs:
                    continue
                if facts is None:
                    facts = [np.array([h[i] for h in hubs], np.int64) for i in range(5)] + [np.array([h[6] for h in hubs])]
                hid, hn, hc, hr, hb, hcells = facts
                # A pair is looked at in the first of the bands that it shares, if its sizes and cells let it be a link at all.
                ok = ((hr < rank) | ((hr == rank) & (hid < rid))) & (hc != c) & (100 * np.minimum(hn, n) >= percent * np.maximum(hn, n))
                at = np.flatnonzero(ok)
                at = at[(hb[at] == np.array(bands, np.int64)).argmax(axis=1) == band]
                at = at[possible(hcells[at], hn[at], np.frombuffer(cells, np.uint8), n, percent)]
                mine = None
                for i in at.tolist():
                    if (hubs[i][2], c) in joined:
                        continue
                    mine = shingles_of(text or b"", size) if mine is None else mine
                    if i not in sets:
                        if sum(map(len, sets.values())) > HELD:
                            sets.clear()
                        sets[i] = shingles_of(hubs[i][5] or b"", size)
                    both = len(mine & sets[i])
                    if 100 * both >= percent * (len(mine) + len(sets[i]) - both):
                        joined.add((hubs[i][2], c))
                        a.append(hubs[i][0])
                        b.append(rid)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def search(texts: DataFrame, nodes: DataFrame, open_: DataFrame, turn: int, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of different groups in buckets, of those pairs whose first is one of this turn's hubs.

    open_: key, band, rid, n, c (group), rank, turn. A member's text is sent once a bucket and that of a hub once for SPREAD
    members, so what is sent follows the number of rows, whatever the number of pairs.
    """
    count = durable(open_.groupBy("key").agg(F.count("*").alias("k")))
    dealt = open_.join(count, "key").withColumn("groups", F.ceil(F.col("k") / SPREAD).cast("int"))
    members = dealt.withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("groups")).cast("int")).withColumn("role", F.lit(1))
    lead = dealt.where(F.col("turn") == turn).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).withColumn("role", F.lit(0))
    rows = members.unionByName(lead).select("key", "salt", "role", "band", "rid", "n", "c", "rank").join(nodes.select("rid", "did", "th", "bands", "cells"), "rid")
    sent = rows.join(texts.hint("merge"), ["did", "th"]).drop("did", "th").repartition("key", "salt").sortWithinPartitions("key", "salt", "role", "rank")
    return sent.mapInArrow(lambda it: _searched(it, size, percent), "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: as many or fewer edges, each from a node to the least of its set."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (p := parent.setdefault(root, root)) != root:
            root = p
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 10_000):
        some = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([find(x) for x in some], pa.int64()), pa.array(some, pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b) that isn't the least of its component.

    Union-find in each partition shortens the edges first. Then rounds: every root hooks to its least neighbour, pointers are
    doubled until they rest, and edges are drawn anew between roots, until none joins two of them. Every round cuts its
    lineage by a checkpoint; nothing but counts reaches the driver.
    """
    spark = edges.sparkSession
    left = durable(edges.mapInArrow(_forest, "a long, b long"))
    parent = None
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = durable(both.groupBy("a").agg(F.min("b").alias("p")).where("p < a").withColumnRenamed("a", "node"))
        while True:
            up = hook.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            step = durable(hook.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")))
            hook = step.select("node", "p")
            if step.where("moved").isEmpty():
                break
        if parent is None:
            parent = hook
        else:
            roots = hook.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(roots, "p", "left").select("node", F.coalesce("pp", "p").alias("p")).unionByName(hook)
        parent = durable(parent)
        pa_, pb = hook.select(F.col("node").alias("a"), F.col("p").alias("ra")), hook.select(F.col("node").alias("b"), F.col("p").alias("rb"))
        moved = left.join(pa_, "a", "left").join(pb, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        left = durable(moved.where("a <> b").distinct())
    if parent is None:
        parent = spark.createDataFrame([], "node long, p long")
    return parent.select("node", F.col("p").alias("component"))


def grouped(docs: DataFrame, size: int, percent: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(rid, doc_id, did, th, n_shingles, c) of every row of docs: c is the number of its group of linked rows.

    Equal sets (by 128 bits of hashes, then confirmed on the full sets like any link) are one node, whatever their number. In
    every band the members of a bucket are joined to one hub (in even bands the least row, in odd ones a random member, so
    that a group has many hubs), never to each other; each node first tries the hub that it meets in most bands, and only
    edges between groups that are still apart are tried next. Buckets whose members still lie in several groups then take
    further hubs, about HUBS a turn, until every pair of different groups in them has been tried; members of the largest
    group of a bucket serve as partners, not as hubs. A member's turn is drawn by hash, so no bucket is ever sorted in one task.
    """
    with scratch(docs.sparkSession) as made:
        return made.keep(_grouped(docs, size, percent, bands, rows))


def _grouped(docs: DataFrame, size: int, percent: int, bands: int, rows: int) -> DataFrame:
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = row_key(docs.select("doc_id", "text"))
    made = keyed.mapInArrow(lambda it: _signed(it, size, bands, rows), f"doc_id {kind}, did long, th long, n_shingles long, h1 long, h2 long, bands array<long>, cells binary")
    signed = durable(made.withColumn("rid", F.monotonically_increasing_id()))
    texts = keyed.select("did", "th", "text")
    if not signed.groupBy("did", "th").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        texts = durable(texts.dropDuplicates(["did", "th"]))  # a row that repeats id and text must not send its text twice
    full = signed.where("n_shingles > 0")
    while True:
        reps = durable(full.groupBy("h1", "h2").agg(F.min("rid").alias("rep")))
        nodes = durable(full.join(reps.select(F.col("rep").alias("rid")), "rid", "left_semi").select("rid", "did", "th", F.col("n_shingles").alias("n"), "bands", "cells"))
        copies = durable(full.select("rid", "h1", "h2").join(reps, ["h1", "h2"]).where("rid <> rep").select(F.col("rep").alias("hub"), F.col("rid").alias("member")))
        banded = nodes.select("rid", "n", F.posexplode("bands").alias("band", "key"))
        order = F.when(F.col("band") % 2 == 0, F.col("rid")).otherwise(F.xxhash64("rid", "band"))
        hubs = durable(banded.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("rid").alias("hub"))).alias("x"), F.count("*").alias("k")).where("k > 1").select("key", "x.hub", "k"))
        edges = durable(banded.join(hubs, "key").where("hub <> rid").groupBy("hub", F.col("rid").alias("member")).agg(F.count("*").alias("met")))
        release(spark)
        best = edges.groupBy("member").agg(F.max(F.struct("met", (-F.col("hub")).alias("o"))).alias("x")).select((-F.col("x.o")).alias("hub"), "member")
        best = durable(best)
        links = durable(verify(texts, full, best.unionByName(copies), size, percent))
        release(spark)
        unlike = durable(copies.join(links.select(F.col("a").alias("hub"), F.col("b").alias("member")), ["hub", "member"], "left_anti"))
        if unlike.isEmpty():
            break
        # Sets with equal hashes that are not equal: from here on rows of their own.
        apart = unlike.select(F.col("member").alias("rid"), F.lit(True).alias("own"))
        full = durable(full.join(apart, "rid", "left").withColumn("h2", F.when(F.col("own"), F.xxhash64("h2", "rid")).otherwise(F.col("h2"))).drop("own"))
    links = durable(links.join(copies.select(F.col("member").alias("b")), "b", "left_anti").select("a", "b"))
    comp = durable(components(links))
    at = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"{c}_c"))
    apart = edges.join(at("hub"), "hub", "left").join(at("member"), "member", "left").where(F.coalesce("hub_c", "hub") != F.coalesce("member_c", "member")).select("hub", "member")
    apart = durable(apart.join(best, ["hub", "member"], "left_anti"))
    if not apart.isEmpty():
        links = durable(links.unionByName(verify(texts, full, apart, size, percent)))
        comp = durable(components(links))
    release(spark)
    # Buckets of three or more: their pairs have not all been tried.
    now = lambda df: df.join(comp.select(F.col("node").alias("rid"), "component"), "rid", "left").withColumn("c", F.coalesce("component", "rid")).drop("component")
    split = lambda df: df.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    wide = durable(now(banded.join(hubs.where("k > 2").select("key"), "key")))
    wide = wide.join(split(wide), "key")
    sizes = wide.groupBy("key", "c").agg(F.count("*").alias("s")).groupBy("key").agg(F.max(F.struct("s", "c")).alias("x"), F.sum("s").alias("all"))
    draw = F.shiftrightunsigned(F.xxhash64("rid", "key"), 2)
    turns = F.ceil((F.col("all") - F.col("x.s")) / HUBS)
    drawn = wide.join(sizes, "key").withColumn("top", F.col("c") == F.col("x.c")).withColumn("turns", turns)
    drawn = drawn.withColumn("turn", F.when(~F.col("top"), F.least(F.col("turns") - 1, F.floor(draw / F.lit(float(1 << 62)) * F.col("turns")))).cast("int"))
    drawn = durable(drawn.select("key", "band", "rid", "n", F.when(F.col("top"), draw + F.lit(1 << 62)).otherwise(draw).alias("rank"), "turn", "turns"))
    last = drawn.agg(F.max("turn")).first()[0]
    for turn in range(0 if last is None else last + 1):
        held = now(drawn.where((F.col("turns") > turn) & (F.col("turn").isNull() | (F.col("turn") >= turn))).drop("turns"))
        open_ = durable(held)
        open_ = durable(open_.join(split(open_), "key"))
        found = durable(search(texts, nodes, open_, turn, size, percent))
        if not found.isEmpty():
            links = durable(links.unionByName(found))
            comp = durable(components(links))
    release(spark)
    named = durable(reps.join(comp, reps["rep"] == comp["node"], "left").select("h1", "h2", F.coalesce("component", "rep").alias("c")))
    out = full.select("rid", "doc_id", "did", "th", "n_shingles", "h1", "h2").join(named, ["h1", "h2"]).drop("h1", "h2")
    return durable(out.unionByName(signed.where("n_shingles = 0").select("rid", "doc_id", "did", "th", "n_shingles", F.col("rid").alias("c"))))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (least doc_id reachable over links), kept (it is that one).

    Links: 100 * intersection >= percent * union of the sets of `size`-word shingles, confirmed on the full sets (see
    grouped() for the method). Null or empty texts have no shingle and link with nothing. A null doc_id takes part as a row,
    gets the least id of its group (null if there is none) and kept false. Rows that share a doc_id are rows of their own;
    ids may be of any type that can be ordered. Ties have no effect; an empty table gives no row; other columns are ignored.
    """
    out = grouped(docs, size, percent, bands, rows)
    least = out.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    named = out.join(least, "c").select("doc_id", "n_shingles", "component_id")
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs (all its columns) of each group of near-duplicates: that of the least doc_id, then text hash (null ids last).

    Rows without words all stay. Rows with the same doc_id but unlike texts are in groups of their own, so none is lost; of
    rows that repeat doc_id and text any one stays. Columns of any name pass through; an empty table gives none.
    """
    out = grouped(docs, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "did")).alias("x")
    lead = durable(out.where("n_shingles > 0").groupBy("c").agg(first).select(F.col("x.did").alias("did"), F.col("x.th").alias("th")))
    names, did, th = [F.col(f"`{c}`") for c in docs.columns], "__kinfold_did", "__kinfold_th"
    worded = F.col("text").rlike("[^ \t-\r]")
    keyed = row_key(docs.where(worded).select(F.struct(*names).alias("row"), "doc_id", "text")).select("row", F.col("did").alias(did), F.col("th").alias(th))
    kept = keyed.join(lead.select(F.col("did").alias(did), F.col("th").alias(th)), [did, th], "left_semi")
    if not out.groupBy("did", "th").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        kept = kept.dropDuplicates([did, th])
    return kept.select("row.*").unionByName(docs.where(~F.coalesce(worded, F.lit(False))))


def op6_minhash(docs: DataFrame) -> DataFrame:
    """near_duplicates() of 2-word shingles at 0.8: doc_id, n_shingles, component_id, kept of every document; edges as there."""
    return near_duplicates(docs, size=2, percent=80)
