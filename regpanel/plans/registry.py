"""Query catalogue registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query; ``sql`` is its DuckDB oracle (None = rows-only)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------ result normalisation
# Non-integral doubles are rounded on BOTH sides to 28 significant bits with
# exact power-of-two arithmetic (x * 2^k is exact), so summation-order noise
# of a few ulps cannot change the compared value and no decimal midpoint
# (common with cent-valued data) is a rounding boundary.  Integral values
# are left as they are.
BITS = 28


def sig(c, bits: int = BITS):
    x = F.col(c) if isinstance(c, str) else c
    ax = F.abs(x)
    k0 = F.lit(bits - 1) - F.floor(F.log2(ax))
    m = ax * F.pow(F.lit(2.0), k0)
    k = k0 + F.when(m >= float(2 ** bits), -1).when(m < float(2 ** (bits - 1)), 1).otherwise(0)
    p = F.pow(F.lit(2.0), k)
    r = F.floor(x * p + 0.5) / p
    return (F.when(x.isNull(), F.lit(None)).when(x == 0, F.lit(0.0))
             .when((ax < float(2 ** 52)) & (x == F.floor(x)), x).otherwise(r).cast("double"))


def sql_sig(expr: str, bits: int = BITS) -> str:
    x = f"({expr})"
    ax = f"abs({x})"
    k0 = f"({bits - 1} - floor(log2(greatest({ax}, 1e-300))))"
    m = f"({ax} * pow(2.0, {k0}))"
    k = (f"({k0} + CASE WHEN {m} >= {float(2 ** bits)} THEN -1 "
         f"WHEN {m} < {float(2 ** (bits - 1))} THEN 1 ELSE 0 END)")
    return (f"CAST(CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 0.0 "
            f"WHEN {ax} < {float(2 ** 52)} AND {x} = floor({x}) THEN {x} "
            f"ELSE floor({x} * pow(2.0, {k}) + 0.5) / pow(2.0, {k}) END AS DOUBLE)")


def sig_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Apply :func:`sig` to ``cols`` (default: every double column)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    s = set(cols)
    return df.select(*[sig(c).alias(c) if c in s else F.col(c) for c in df.columns])
