"""Sinks (K rows).  Writes are distributed (no coalesce(1)); partitioned
outputs give one folder per group value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regpanel.session import scratch_path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """write_csv with header, NULL written as NA."""
    df.write.mode(mode).option("header", True).option("nullValue", "NA").csv(path)


TARGET_FILE_BYTES = 128 << 20


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row: the bytes of its texts, 8 for every other value."""
    parts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if f.dataType.simpleString() in ("string", "binary")
             else F.lit(8) for f in df.schema.fields]
    return sum(parts[1:], parts[0]).cast("bigint")


def files_per_group(df: DataFrame, group: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """(group, n_bytes, n_files): how many files of about ``target_bytes`` each
    group gets, by its own size."""
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum(row_bytes(df)).alias("n_bytes"))
    return g.withColumn("n_files", F.greatest(F.ceil(F.col("n_bytes") / target_bytes), F.lit(1)).cast("int"))


def sized_by_group(df: DataFrame, group: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rows dealt so that a write partitioned by ``group`` gives every group
    total / target files: one salt per file, by a hash of the row, so a large
    group is spread and a small one is not cut into one file per task.  Rows
    with a NULL group go, as with R's split.  The rows are written once first,
    so that the sizes and the rows are one and the same evaluation."""
    d = checkpoint_to(df.sparkSession, df.where(F.col(group).isNotNull()), scratch_path(df.sparkSession, "sized"))
    sizes = files_per_group(d, group, target_bytes).select(F.col(group).alias("__g"), "n_files")
    j = d.join(sizes, F.col(group) == F.col("__g")).drop("__g")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("n_files"))
    return j.withColumn("__salt", salt).repartition(group, "__salt").drop("__salt", "n_files")


def write_per_group(df: DataFrame, path: str, group: str, fmt: str = "parquet",
                    lower: bool = True, mode: str = "overwrite", target_bytes: int = TARGET_FILE_BYTES) -> str:
    """split(f = group) |> iwalk(write): one folder per group value, with as
    many files as the group's size asks for.  The folder key is a derived
    ``<group>_key`` column (lower-cased when ``lower``); the files keep the
    original ``group`` column, as the source's files do.  Rows with a NULL
    group are not written (split drops them).  Returns the name of the key column."""
    key = f"{group}_key"
    out = df.withColumn(key, F.lower(F.col(group)) if lower else F.col(group))
    w = sized_by_group(out, key, target_bytes).write.mode(mode).partitionBy(key).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("nullValue", "NA")
    w.save(path)
    return key


def checkpoint_to(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Interim result written next to the final one and re-read: cuts lineage
    and survives executor loss (reliable storage, not local checkpoints)."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def land_long_facts(df: DataFrame, path: str, partition_col: str = "dataset", mode: str = "overwrite") -> None:
    """Land long coded facts partitioned by dataset id, so every spec read
    prunes whole partitions (PartitionFilters) before any file is opened."""
    df.write.mode(mode).partitionBy(partition_col).parquet(path)
