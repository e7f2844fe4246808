"""Set operations (U rows); dplyr matches columns by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """dplyr union(): by name, duplicates removed."""
    return a.unionByName(b).distinct()


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """unique() / distinct(cols...)."""
    return (df.select(*cols) if cols else df).distinct()


def bind_rows(tables: list[DataFrame], fill: bool = False) -> DataFrame:
    """bind_rows(): bag union by name; ``fill`` adds missing columns as NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=fill), tables)
