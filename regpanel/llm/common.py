"""Helpers shared by the operators: scratch tables in the shared folder,
word hashing over Arrow buffers, Arrow row batches, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regpanel.session import ensure_checkpoint_dir

# ------------------------------------------------------------ scratch tables


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``);
    without one, a cluster raises and a local session uses its own."""
    return ensure_checkpoint_dir(spark).rstrip("/")


class Scratch:
    """Written tables that cut lineage: each survives lost executors, and all
    but the ones a result still reads are deleted with :meth:`drop`."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/regpanel-llm/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            p.getFileSystem(conf).delete(p, True)


# ------------------------------------------------------------ 64-bit mixing

U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (published splitmix64 constants)."""
    x = x ^ (x >> U(30))
    x = x * _M1
    x ^= x >> U(27)
    x *= _M2
    x ^= x >> U(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit values derived from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U(GOLDEN) + U(seed))


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


# ------------------------------------------------------------ words of texts

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = seeded(11, 256)
_BASE = 0x5851F42D4C957F2D  # odd multiplier of the per-word polynomial
BLOCK = 1 << 21  # bytes hashed at once; longer texts go through block by block


def _powers(n: int, _cache: dict = {}) -> np.ndarray:
    p = _cache.get("p")
    if p is None or len(p) < n:
        size = max(1024, 1 << int(n - 1).bit_length())
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        _cache["p"] = p if size <= BLOCK else None
    return p[:n]


def word_bounds(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word ``[^\\x20\\x09-\\x0D]+`` of one text
    (white space is ASCII, so the bytes of UTF-8 can be used as they are)."""
    word = np.empty(len(b) + 2, dtype=np.int8)
    word[0] = word[-1] = 0
    np.logical_not(_SPACE[b], out=word[1:-1].view(bool))
    d = np.diff(word)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _hash_block(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    lens = ends - starts
    first = np.cumsum(lens) - lens
    body = b[~_SPACE[b]]
    if lower:
        body = _LOWER[body]
    pos = np.arange(len(body)) - np.repeat(first, lens)
    h = np.add.reduceat(_BYTE[body] * _powers(int(lens.max()))[pos], first)
    return mix(h ^ (lens.astype(np.uint64) * U(GOLDEN)))


def word_hashes(text: bytes | memoryview | np.ndarray, lower: bool = False,
                bounds: bool = False):
    """64-bit hash of every word of one text, in order; ``lower`` maps A-Z
    first.  With ``bounds`` also the words' byte ranges."""
    b = text if isinstance(text, np.ndarray) else np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_bounds(b)
    if not len(starts):
        out = np.empty(0, dtype=np.uint64)
    elif len(b) <= BLOCK:
        out = _hash_block(b, starts, ends, lower)
    else:
        parts, i = [], 0
        while i < len(starts):  # whole words, about BLOCK bytes at a time
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
            lo, hi = starts[i], ends[j - 1]
            parts.append(_hash_block(b[lo:hi], starts[i:j] - lo, ends[i:j] - lo, lower))
            i = j
        out = np.concatenate(parts)
    return (out, starts, ends) if bounds else out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of k words (empty when there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    c = seeded(29, k) | U(1)
    h = words[:n] * c[0]
    for i in range(1, k):
        h = h + words[i:i + n] * c[i]
    return mix(h)


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column without a copy (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        for c in column.chunks:
            yield from texts(c)
        return
    a = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if a.null_count:
        a = a.fill_null("")
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], dtype=np.uint8) if a.buffers()[2] is not None else np.empty(0, np.uint8)
    for s, e in zip(off[:-1], off[1:], strict=True):
        yield data[s:e]


def rows_out(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c
                                       for c, t in zip(cols, schema.types, strict=True)], schema=schema)


# ------------------------------------------------------------ components


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over the edges, for every id on an edge.

    Rounds of contraction: every node takes the neighbour (or itself) of least
    random rank, edges move to those, loops and repeats go.  The rank changes
    with each round, so paths shorten by a constant factor; each round is a
    written table, so a lost executor costs no more than its round's tasks.
    Null ends and loops are ignored; no edge at all gives an empty table.
    """
    scratch = Scratch(spark, "components")
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    e = scratch.save(e.where("a <> b").distinct(), "cc-edges-0")
    nodes, k = None, 0
    while not e.isEmpty():
        k += 1
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        to = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least("m", rank("a"))["v"].alias("to"))
        to = scratch.save(to, f"cc-map-{k}")
        left, right = to.withColumnRenamed("to", "x"), to.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = e.join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        nxt = scratch.save(moved.where("a <> b").distinct(), f"cc-edges-{k}")
        if nodes is None:
            nodes = to.select(F.col("a").alias("id"), F.col("to").alias("root"))
        else:
            step = to.select(F.col("a").alias("root"), F.col("to").alias("next"))
            nodes = nodes.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
            nodes = scratch.save(nodes, f"cc-nodes-{k}")
            scratch.drop(f"cc-nodes-{k - 1}", f"cc-map-{k - 1}")
        scratch.drop(f"cc-edges-{k - 1}")
        e = nxt
    if nodes is None:
        return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    least = nodes.groupBy("root").agg(F.min("id").alias("component"))
    out = scratch.save(nodes.join(least, "root").select("id", "component"), "cc-result")
    scratch.drop(f"cc-edges-{k}", f"cc-map-{k}", f"cc-nodes-{k}")
    return out
