"""Embedding near-duplicates on a robust-pruned flat graph.

Vectors of one label are dealt to overlapping cluster shards: each is a node
of the shards of its ``OVERLAP`` nearest centres and asks in that of the
nearest.  There are as many centres as keep a shard near ``TARGET`` rows, so
the work grows with the vectors.  Every shard builds a robust-pruned neighbour
graph; the adjacency lists that a vector got in its shards are united.  The
vectors of a shard then search its graph together, greedily from the nearest
medoids and from themselves, and the search widens to the neighbours of
whatever lies in range or a little beyond.  Found pairs are verified by their
cosine in double precision.

The recall of the walk is measured in every shard: ``PROBES`` of its queries
are compared with all its nodes, and a shard that met less than ``LEAST`` of
their links is compared whole, by matrix products in blocks.  :func:`audit`
compares the links of up to ``AUDIT`` vectors with brute force over their
whole label; a label below ``LEAST`` there was parted badly and is done again
as one shard, dealt in blocks.

Equal vectors of a label are collapsed first and count with their number.
Shards above ``SHARD_ROWS`` (a dense group that no centres part) are dealt to
sub-shards by a hash, with a graph each; queries go to all of them in blocks,
so no task holds more than ``SHARD_ROWS`` or so nodes and queries.  Tasks give
link counts and a spanning forest, never all pairs of a group.

The centres are fitted on at most ``SAMPLE`` vectors and there are at most
``MAX_CENTRES`` of them (what is broadcast).  Every vector is indexed.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without a label or id, link with nothing; vectors of
different lengths do not link; of centres equally near, the first counts as
the nearer; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regpanel.llm.common import Scratch, components

THRESHOLD = 0.98
OVERLAP = 3  # shards a vector is a node of
TARGET, SHARD_ROWS = 1000, 1500  # rows a shard is planned for; rows above which it is dealt to sub-shards
SAMPLE = 20_000
MAX_CENTRES = 4096
MERGE = 0.8  # cosine of centres that are merged
DEGREE, ALPHA, POOL, BEAM = 16, 1.2, 48, 12
STARTS, SPREAD, BALL = 4, 32, 0.9  # medoids a search starts from; spread over a shard; cosine of a ball's edges
WIDER = 1.25  # angles of nodes that are followed, in multiples of the range
TOGETHER = 256  # queries searched at once
PROBES, LEAST = 64, 0.95  # queries of a shard that its recall is measured by; recall below which it is compared whole
AUDIT = 512
SLACK = 1e-6  # added to bounds for rounding


def _matrix(col) -> np.ndarray:
    a = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(a), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def _angle(cos):
    return np.arccos(np.clip(cos, -1, 1))


# ------------------------------------------------------------ one shard


def robust_prune(sims: np.ndarray, among: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Which of each row's pool, sorted by falling similarity, stay: the nearest
    does, and those go that are alpha times nearer to one that stays."""
    far, alive, keep = 1 - sims, np.ones(sims.shape, dtype=bool), np.zeros(sims.shape, dtype=bool)
    row = np.arange(len(sims))
    for _ in range(min(degree, sims.shape[1])):
        i = alive.argmax(axis=1)
        on = alive[row, i]
        if not on.any():
            break
        keep[row[on], i[on]] = True
        alive &= alpha * (1 - among[row, i]) > far
        alive[row, i] = False
    return keep


def build(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (from, to) of the pruned graph over the rows of a unit matrix."""
    n = len(x)
    pool = min(POOL, n - 1)
    if pool < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x, src, dst = x.astype(np.float32), [], []
    for at in range(0, n, TOGETHER):
        s = x[at:at + TOGETHER] @ x.T
        row = np.arange(len(s))[:, None]
        s[row[:, 0], row[:, 0] + at] = -2
        cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        cand = np.take_along_axis(cand, np.argsort(-s[row, cand], axis=1, kind="stable"), axis=1)
        keep = robust_prune(s[row, cand], x[cand] @ x[cand].transpose(0, 2, 1))
        src.append(np.repeat(np.arange(at, at + len(s)), keep.sum(axis=1)))
        dst.append(cand[keep])
    return np.concatenate(src), np.concatenate(dst)


def _groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows is joined with by the pairs (a, b)."""
    low = np.arange(n)
    while True:
        x, y = low[a], low[b]
        part = x != y
        if not part.any():
            return low
        np.minimum.at(low, np.maximum(x, y)[part], np.minimum(x, y)[part])
        while True:
            up = low[low]
            if np.array_equal(up, low):
                break
            low = up


class Graph:
    """United adjacency lists of a shard's nodes, in both directions."""

    def __init__(self, x: np.ndarray, edges: tuple[np.ndarray, np.ndarray]):
        n = len(x)
        key = np.unique(np.r_[edges[0] * n + edges[1], edges[1] * n + edges[0]].astype(np.int64))
        a, self.to = key // n, key % n
        self.x = x.astype(np.float32)
        self.first = np.searchsorted(a, np.arange(n + 1))
        # medoids: of the shard, some spread over it, and one of every group that edges of near vectors join,
        # of which the angle to the farthest member is known
        near = (self.x[a] * self.x[self.to]).sum(axis=1) >= BALL
        ball = _groups(n, a[near], self.to[near])
        order = np.argsort(ball, kind="stable")
        cuts = np.r_[np.flatnonzero(np.diff(ball[order], prepend=-1)), n]
        middles, radius = [], []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j - i > 1:
                rows = order[i:j]
                m = rows[(self.x[rows] @ self.x[rows].mean(axis=0)).argmax()]
                middles.append(m)
                radius.append(_angle((self.x[rows] @ self.x[m]).min()))
        self.middles, self.radius = np.array(middles, dtype=np.int64), np.array(radius)
        spread = np.arange(0, n, max(1, n // SPREAD))
        self.medoids = np.unique(np.r_[spread, (self.x @ self.x.mean(axis=0)).argmax(), self.middles].astype(np.int64))

    def around(self, q: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of the nodes, each with its node's query."""
        n = self.first[nodes + 1] - self.first[nodes]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[nodes], n)
        return np.repeat(q, n), self.to[at]

    def search(self, qs: np.ndarray, own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the visited nodes with a similarity of ``least`` or
        more to rows of a unit matrix; ``own`` is the node that a query is (-1: none)."""
        x, n, qs = self.x, len(self.x), qs.astype(np.float32)
        sims = np.full((len(qs), n), -2, dtype=np.float32)  # -2: not visited
        fresh = np.ones(sims.shape, dtype=bool)  # not followed
        wide = math.cos(min(math.pi, float(_angle(least)) * WIDER))

        def visit(q, nodes):
            new = sims[q, nodes] == -2
            key = np.unique(q[new] * n + nodes[new])
            for i in range(0, len(key), 1 << 17):
                q, nodes = key[i:i + (1 << 17)] // n, key[i:i + (1 << 17)] % n
                sims[q, nodes] = np.maximum(-1, np.einsum("ij,ij->i", x[nodes], qs[q]))
        rows = np.arange(len(qs))
        k = min(STARTS, len(self.medoids))
        near = np.argpartition(-(qs @ x[self.medoids].T), k - 1, axis=1)[:, :k]
        visit(np.repeat(rows, k), self.medoids[near].ravel())
        visit(rows[own >= 0], own[own >= 0])
        # angles are a metric: a group farther than its radius and the range holds nothing
        q, m = np.nonzero(_angle(qs @ x[self.middles].T) <= self.radius + _angle(least) + 1e-3)
        visit(q, self.middles[m])
        active = rows
        while len(active):
            s = sims[active]
            cut = np.partition(s, n - BEAM, axis=1)[:, n - BEAM] if n > BEAM else np.full(len(s), -2)
            r, nodes = np.nonzero(fresh[active] & (s > -2) & (s >= np.minimum(cut, wide)[:, None]))
            q = active[r]
            fresh[q, nodes] = False
            active = np.unique(q)
            visit(*self.around(q, nodes))
        return np.nonzero(sims >= least - SLACK)


# ------------------------------------------------------------ Spark steps


def _near(x: np.ndarray, c: np.ndarray, overlap: int) -> np.ndarray:
    """The nearest centres of each row of a unit matrix, the nearest first."""
    return np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap]


def _centres(reps: DataFrame) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """(label, length) -> (number of the first centre, unit centres), fitted on a bounded sample."""
    sizes = {(r["label"], r["dim"]): r["n"] for r in
             reps.groupBy("label", "dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label", "dim")
             .limit(MAX_CENTRES - 1).collect()}
    sample = reps.orderBy(F.xxhash64("one"), "one").limit(SAMPLE).select("label", "dim", "v").toArrow()
    by: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(sample.column("label").to_pylist(), sample.column("dim").to_pylist(), strict=True)):
        by.setdefault(key, []).append(i)
    wanted = {key: math.ceil(n * OVERLAP / TARGET) if n > SHARD_ROWS else 1 for key, n in sizes.items()}
    scale = min(1.0, MAX_CENTRES / max(1, sum(wanted.values())))
    out, first = {}, 0
    for key, k in wanted.items():
        x = _unit(_matrix(sample.column("v").take(pa.array(by[key])))) if key in by else np.ones((1, key[1]))
        k = max(1, min(len(x), int(k * scale)))
        c = x[:: max(1, len(x) // k)][:k].copy()
        for _ in range(3 if k > 1 else 0):  # spherical k-means
            near = (x @ c.T).argmax(axis=1)
            for j in range(len(c)):
                m = x[near == j].sum(axis=0)
                if np.linalg.norm(m) > 0:
                    c[j] = m / np.linalg.norm(m)
        apart: list[int] = []  # a border through a dense group would part its links: near centres become one
        for j in range(len(c)):
            if not apart or (c[apart] @ c[j]).max() < MERGE:
                apart.append(j)
        out[key] = (first, c[apart])
        first += len(apart)
    return out


def _assign(sent, overlap: int):
    """Each vector as a node of the shards of its nearest centres; labels beyond the list are one shard each."""
    def run(batches):
        centres = sent.value
        for b in batches:
            shard, row, home = [], [], []
            groups: dict[tuple, list] = {}
            for i, key in enumerate(zip(b.column("label").to_pylist(), b.column("dim").to_pylist(), strict=True)):
                groups.setdefault(key, []).append(i)
            for key, rows in ((k, g[i:i + 1024]) for k, g in groups.items() for i in range(0, len(g), 1024)):
                first, c = centres.get(key, (-1, None))
                if c is None or len(c) == 1:
                    near = np.zeros((len(rows), 1), dtype=np.int64)
                else:
                    near = _near(_unit(_matrix(b.column("v").take(pa.array(rows)))), c, overlap)
                shard += (first + near).ravel().tolist()
                row += np.repeat(rows, near.shape[1]).tolist()
                home += ([True] + [False] * (near.shape[1] - 1)) * len(rows)
            t = b.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(home, pa.bool_()), t.column("one"),
                                              t.column("c"), t.column("label"), t.column("dim"), t.column("v")],
                                             names=["shard", "home", "one", "c", "label", "dim", "v"])
    return run


def _build(t: pa.Table) -> pa.Table:
    one = t.column("one").to_numpy()
    src, dst = build(_unit(_matrix(t.column("v"))))
    return pa.table({"src": one[src], "dst": one[dst]}, schema=pa.schema([("src", pa.int64()), ("dst", pa.int64())]))


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("met", pa.int64())])


def _search(threshold: float):
    """One block's link counts (a, n), spanning forest (a, b) and recall of the
    walk over its probes (n links, met of them)."""
    def run(t: pa.Table) -> pa.Table:
        node, one = t.column("node").to_numpy(), t.column("one").to_numpy()
        at = np.flatnonzero(node)
        at = at[np.argsort(one[at])]
        asks = np.flatnonzero(t.column("asks").to_numpy())
        if not len(at) or not len(asks):
            return FOUND.empty_table()
        v, c, ids = _matrix(t.column("v")), t.column("c").to_numpy(), one[at]
        norm = np.linalg.norm(v, axis=1)
        x = v / norm[:, None]

        def place(names):
            i = np.minimum(np.searchsorted(ids, names), len(ids) - 1)
            return np.where(ids[i] == names, i, -1)
        near = t.column("near").take(pa.array(at)).combine_chunks()
        src = np.repeat(np.arange(len(at)), pc.fill_null(pc.list_value_length(near), 0).to_numpy(zero_copy_only=False))
        dst = place(near.flatten().to_numpy(zero_copy_only=False).astype(np.int64))  # neighbours of other shards are not here
        graph = Graph(x[at], (src[dst >= 0], dst[dst >= 0]))
        own = place(one[asks])

        def links(some, whole):
            """(query, node) at the threshold or above, by the walk or by every node."""
            if whole:
                q, j = np.nonzero(x[asks[some]] @ x[at].T >= threshold - SLACK)
            else:
                q, j = graph.search(x[asks[some]], own[some], threshold)
            q = some[q]
            q, j = q[own[q] != j], j[own[q] != j]
            ok = np.empty(len(q), dtype=bool)
            for i in range(0, len(q), 1 << 16):
                e, g = asks[q[i:i + (1 << 16)]], at[j[i:i + (1 << 16)]]
                ok[i:i + (1 << 16)] = np.einsum("ij,ij->i", v[e], v[g]) / (norm[e] * norm[g]) >= threshold
            return q[ok], j[ok]
        probes = np.arange(0, len(asks), max(1, len(asks) // PROBES))[:PROBES]
        true, met = len(links(probes, True)[0]), len(links(probes, False)[0])
        counts = np.zeros(len(asks), dtype=np.int64)
        strange = np.flatnonzero(own < 0)  # queries of other sub-shards follow the nodes
        name, entry = np.r_[ids, one[asks[strange]]], own.copy()
        entry[strange] = len(ids) + np.arange(len(strange))
        low = np.arange(len(name))
        for i in range(0, len(asks), TOGETHER):
            q, j = links(np.arange(i, min(i + TOGETHER, len(asks))), met < LEAST * true)
            np.add.at(counts, q, c[at[j]])
            low = _groups(len(name), np.r_[entry[q], np.arange(len(name))], np.r_[j, low])
        some, joined = np.flatnonzero(counts), np.flatnonzero(low != np.arange(len(low)))
        return pa.table([pa.array([*one[asks[some]].tolist(), *name[joined].tolist(), None], pa.int64()),
                         pa.array([None] * len(some) + name[low[joined]].tolist() + [None], pa.int64()),
                         pa.array([*counts[some].tolist(), *[None] * len(joined), true], pa.int64()),
                         pa.array([None] * (len(some) + len(joined)) + [met], pa.int64())], schema=FOUND)
    return run


def _valid(v):
    return (F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def _linked(scratch: Scratch, reps: DataFrame, centres: dict, threshold: float, run: str) -> tuple[DataFrame, float]:
    """Every vector with its links and component (by its least id), and the recall of the walk over the probes."""
    spark, kind = reps.sparkSession, reps.schema["v"].dataType.simpleString()
    members = reps.mapInArrow(_assign(spark.sparkContext.broadcast(centres), OVERLAP),
                              f"shard long, home boolean, one long, c long, label string, dim int, v {kind}")
    members = scratch.save(members, f"members-{run}")
    sizes = members.groupBy("shard", "label", "dim").agg(
        F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.count_if("home") / SHARD_ROWS)).cast("int").alias("blocks"))
    members = (members.join(sizes, ["shard", "label", "dim"])
               .withColumn("sub", F.pmod(F.xxhash64("one"), F.col("parts")).cast("int"))
               .withColumn("own", F.pmod(F.xxhash64("one", F.lit(3)), F.col("blocks")).cast("int")))
    shard = ["shard", "label", "dim", "sub"]
    edges = members.groupBy(*shard).applyInArrow(_build, "src long, dst long")
    united = scratch.save(edges.groupBy("src").agg(F.collect_set("dst").alias("near")), f"graph-{run}")
    nodes = members.join(united, members["one"] == united["src"], "left").drop("src")
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    all_ = F.sequence(F.lit(0), F.col("parts") - 1)
    node_rows = (nodes.select("*", blocks)
                 .withColumn("node", F.lit(True)).withColumn("asks", F.col("home") & (F.col("own") == F.col("block"))))
    asking = (members.where("home and parts > 1").withColumn("block", F.col("own")).withColumnRenamed("sub", "in")
              .withColumn("sub", F.explode(all_)).where("sub <> in")
              .withColumn("near", F.lit(None).cast("array<long>")).withColumn("node", F.lit(False)).withColumn("asks", F.lit(True)))
    cols = [*shard, "block", "one", "c", "v", "near", "node", "asks"]
    found = scratch.save(node_rows.select(*cols).unionAll(asking.select(*cols)).groupBy(*shard, "block")
                         .applyInArrow(_search(threshold), "a long, b long, n long, met long"), f"found-{run}")
    counts = found.where("a is not null and b is null").groupBy(F.col("a").alias("one")).agg(F.sum("n").alias("n"))
    comp = components(spark, found.where("b is not null")).withColumnRenamed("id", "one")
    groups = reps.join(counts, "one", "left").join(comp, "one", "left").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("c") - 1).alias("n_links"),
        F.coalesce("component", "one").alias("component"), "one", "least")
    groups = scratch.save(groups, f"groups-{run}")
    named = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = scratch.save(groups.join(named, "component"), f"named-{run}")
    walk = found.where("a is null").agg(F.sum("met").alias("met"), F.sum("n").alias("n")).first()
    scratch.drop(*(f"{t}-{run}" for t in ("members", "graph", "found", "groups")))
    return groups, walk["met"] / walk["n"] if walk["n"] else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept, audit_recall (of the result, by the
    audit), walk_recall (of the graph search alone, over the probes): one row per input row.
    Where rows of one vec_id hold different vectors, each is a vector of its
    own, with its own links; equal vectors of a label link with one another,
    whatever their ids."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "graph-dedup")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("v"),
                          F.col(f"`{label}`").cast("string").alias("label"))
    rows = rows.withColumn("ok", F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _valid("v"))
    # a vector is named by its label and components; a vec_id may stand for several vectors
    reps = scratch.save(rows.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("c"))
                        .withColumn("one", F.xxhash64("label", "v")).withColumn("dim", F.size("v")), "vectors")
    centres = _centres(reps)
    groups, walk = _linked(scratch, reps, centres, threshold, "parted")
    recall, total = audit(reps, groups, threshold)
    low = [k for k, r in recall.items() if r < LEAST and len(centres.get(k, (0, ()))[1]) > 1]
    if low:  # links lie across the borders of these labels' shards
        for k in low:
            centres[k] = (centres[k][0], centres[k][1][:1])
        groups, walk = _linked(scratch, reps, centres, threshold, "whole")
        scratch.drop("named-parted")
        recall, total = audit(reps, groups, threshold)
    out = rows.where("ok").join(groups, ["label", "v"]).select("vec_id", "n_links", "component_id")
    out = out.unionAll(rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                   F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))) \
        .withColumn("audit_recall", F.lit(total)).withColumn("walk_recall", F.lit(walk))


def audit(reps: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> tuple[dict[tuple, float], float]:
    """Part of the true links of up to AUDIT distinct vectors (a fixed choice by
    hash) that the result has, against brute force over all rows of their label: by label and length, and of all."""
    asked = groups.orderBy(F.xxhash64("one", F.lit(5)), "one").limit(AUDIT).select("one", "label", "v", "n_links").collect()
    if not asked:
        return {}, 1.0
    by: dict[tuple, tuple[list, list]] = {}
    for r in asked:
        ids, vs = by.setdefault((r["label"], len(r["v"])), ([], []))
        ids.append(r["one"])
        vs.append(r["v"])
    sent = reps.sparkSession.sparkContext.broadcast({k: (i, np.array(v, dtype=np.float64)) for k, (i, v) in by.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n = [], []
            label, dim = b.column("label").to_pylist(), b.column("dim").to_pylist()
            groups_: dict[tuple, list] = {}
            for i, key in enumerate(zip(label, dim, strict=True)):
                if key in sent.value:
                    groups_.setdefault(key, []).append(i)
            for key, at in groups_.items():
                q_ids, q = sent.value[key]
                x = _matrix(b.column("v").take(pa.array(at)))
                c = b.column("c").to_numpy()[at]
                cos = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :])
                ids += q_ids
                n += ((cos >= threshold) * c).sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["one", "n"])
    true = {r["one"]: r["n"] - 1 for r in reps.mapInArrow(run, "one long, n long").groupBy("one").agg(F.sum("n").alias("n")).collect()}
    tally: dict[tuple, tuple[int, int]] = {}
    for r in asked:
        key = (r["label"], len(r["v"]))
        met, n = tally.get(key, (0, 0))
        tally[key] = (met + min(r["n_links"], true[r["one"]]), n + true[r["one"]])
    met, n = (sum(x) for x in zip(*tally.values(), strict=True))
    return {k: a / b if b else 1.0 for k, (a, b) in tally.items()}, met / n if n else 1.0
