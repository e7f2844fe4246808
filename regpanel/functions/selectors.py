"""tidyselect-style column selectors, resolved from ``df.schema`` (no job)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType, DateType, TimestampType, TimestampNTZType


def starts_with(df: DataFrame, prefix: str, ignore_case: bool = True) -> list[str]:
    p = prefix.lower() if ignore_case else prefix
    return [c for c in df.columns if (c.lower() if ignore_case else c).startswith(p)]


def matches(df: DataFrame, pattern: str, ignore_case: bool = True) -> list[str]:
    """Regex found anywhere in the name (tidyselect matches, case-insensitive)."""
    rx = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return [c for c in df.columns if rx.search(c)]


def where_numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def where_string(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def where_date(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """a:b — contiguous columns from ``first`` to ``last`` inclusive."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return cols[i:j + 1]


def exclude(cols: list[str], drop: list[str]) -> list[str]:
    """!sel — keep schema order."""
    d = set(drop)
    return [c for c in cols if c not in d]


def both(a: list[str], b: list[str]) -> list[str]:
    """sel1 & sel2."""
    s = set(b)
    return [c for c in a if c in s]
