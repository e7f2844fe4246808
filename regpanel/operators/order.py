"""Ordering, first/last rows and seeded sampling (L rows).  Spark has no
file order, so every positional operator takes an explicit order key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regpanel.constants import SAMPLE_SEED


def _keys(order):
    return [order] if isinstance(order, (str, Column)) else list(order)


def head_n(df: DataFrame, order, n: int = 6) -> DataFrame:
    """head(n): first n rows by ``order`` (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*_keys(order)).limit(n)


def tail_n(df: DataFrame, order, n: int = 6) -> DataFrame:
    """tail(n): last n rows by ``order``, returned in ascending order.
    Ascending order puts NULLs first, so the reversed order puts them last."""
    ks = _keys(order)
    desc = [(F.col(k) if isinstance(k, str) else k).desc_nulls_last() for k in ks]
    return df.orderBy(*desc).limit(n).orderBy(*ks)


def sample_n(df: DataFrame, n: int, seed: int = SAMPLE_SEED, by: list[str] | None = None) -> DataFrame:
    """sample_n(n) with a seed: the n rows with the smallest md5 of
    (``by`` columns, seed).  Deterministic for any partitioning; ties are broken by the
    row itself."""
    cols = by or df.columns
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))).cast("binary"))
    return df.withColumn("__h", h).orderBy("__h", *cols).limit(n).drop("__h")


def ordinal_levels(df: DataFrame, label: str, name: str = "level") -> DataFrame:
    """The distinct labels, numbered by the number they begin with; labels
    without one come last, equal ones by their text.  One row per level."""
    key = F.regexp_replace(F.col(label), " .*", "").try_cast("double")
    d = df.select(label).distinct().where(F.col(label).isNotNull())
    from pyspark.sql import Window
    w = Window.orderBy(key.asc_nulls_last(), F.col(label))
    return d.select(label, F.row_number().over(w).alias(name))
