"""Contiguous shards of nearly equal bytes.

Documents are put in one global order by a range partitioning on the hash of
their text (equal texts become neighbours, ties are broken by the id, so a
group of copies spreads over as many partitions as it needs).  Global byte
prefix sums from per-partition totals then cut the order at equal targets: a
document belongs to the shard that holds its middle byte, so no shard is
further from the target than one document at each end.

Defined cases: a null text has size 1 (no bytes plus 1) and checksum 0; empty
texts likewise; repeated rows are placed one by one; an empty table gives an
empty result; a single document larger than a shard's target leaves
neighbouring shards empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regpanel.llm.common import Scratch
from regpanel.llm.prefix import partition_bases


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number, the row's place in it and the bytes before the row."""
    part, row, before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.num_rows
        size = b.column("size").to_numpy(zero_copy_only=False)
        ends = before + np.cumsum(size)
        out = [*b.columns, pa.array(np.full(n, part, dtype=np.int32)),
               pa.array(np.arange(row, row + n, dtype=np.int64)), pa.array((ends - size).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(out, names=[*b.schema.names, "part", "row_in_part", "before"])
        row, before = row + n, int(ends[-1]) if n else before


def assign_shards(docs: DataFrame, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text",
                  keep_text: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (and the text): one row per input row."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    cols = [F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
            F.crc32(t.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(t).alias("h")]
    if keep_text:
        cols.append(F.col(f"`{text}`").alias("text"))
    order = ["h", "text_crc32", "doc_id"]
    rows = docs.select(*cols)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    scratch = Scratch(docs.sparkSession, "shards")
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("row_in_part", T.LongType()), T.StructField("before", T.LongType())])
    placed = scratch.save(rows.mapInArrow(_running, schema), "placed")
    bases, _, total = partition_bases(placed, "size")
    if not total:
        total = 1
    middle = 2 * (F.col("base") + F.col("before")) + F.col("size")
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(2 * total)).cast("int"))
    placed = (placed.join(F.broadcast(bases), "part")
              .withColumn("row", F.col("base_row") + F.col("row_in_part")).withColumn("shard", shard))
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    out = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("row") - F.col("first"))
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", *(["text"] if keep_text else []))


def write_shards(shards: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; the rows of a file are consecutive slots."""
    run = F.floor(F.col("slot") / rows_per_file)
    (shards.withColumn("run", run).repartition("shard", "run").sortWithinPartitions("shard", "slot")
     .drop("run").write.mode("overwrite").partitionBy("shard").parquet(path))
