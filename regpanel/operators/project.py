"""Projection, renaming and row filters (P rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regpanel.functions.text import sanitize_name


def select_cols(df: DataFrame, keep: list[str] | None = None, drop: list[str] | None = None,
                rename: dict[str, str] | None = None) -> DataFrame:
    """select(): keep (in the given order) / drop / rename-in-select."""
    cols = keep if keep is not None else df.columns
    if drop:
        cols = [c for c in cols if c not in set(drop)]
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in cols])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """dplyr rename(new = old) given as {old: new}; a missing source column raises."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"rename: columns not found: {missing}")
    return df.withColumnsRenamed(mapping)


def rename_with(df: DataFrame, fn: Callable[[str], str] = sanitize_name) -> DataFrame:
    """rename_with(fn) over all columns; a name collision raises."""
    new = [fn(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"rename_with: names collide after renaming: {dup}")
    return df.toDF(*new)


def relocate(df: DataFrame, column: str, before: str) -> DataFrame:
    """relocate(column, .before = before)."""
    rest = [c for c in df.columns if c != column]
    i = rest.index(before)
    return df.select(*rest[:i], column, *rest[i:])


def mutate_across(df: DataFrame, cols: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    """across()/mutate_if(): apply ``fn`` to ``cols`` in one projection."""
    s = set(cols)
    return df.select(*[fn(F.col(c)).alias(c) if c in s else F.col(c) for c in df.columns])


def keep_latest(df: DataFrame, period: str) -> DataFrame:
    """filter(period == max(period)) over the whole table (one global max, not
    per group).  The max is a scalar subquery, taken when the query runs.  Any
    NULL period makes R's max NA, so no row survives (kept here)."""
    mx = df.agg(F.when(F.count_if(F.col(period).isNull()) == 0, F.max(period)).alias("mx"))
    return df.where(F.col(period) == mx.scalar())


def coalesce_pair(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Resolve a join-suffix pair (or two spellings of a measure): left wins."""
    return df.withColumn(name, F.coalesce(F.col(left), F.col(right))).drop(
        *[c for c in (left, right) if c != name])


_LOGICAL = ["T", "F", "TRUE", "FALSE", "true", "false", "True", "False"]


def parse_guess(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """readr parse_guess per text column: the narrowest of logical, double,
    date, timestamp, text that fits every non-missing value.  One aggregate
    job decides all columns; the casts are then applied in one projection."""
    from regpanel.functions.exprs import NUMERIC_TEXT
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    checks = []
    for c in cols:
        s = F.trim(F.col(c))
        n = F.count(s)
        checks += [(F.count_if(s.isin(_LOGICAL)) == n).alias(f"{c}__l"),
                   (F.count_if(s.rlike(NUMERIC_TEXT)) == n).alias(f"{c}__d"),
                   (F.count_if(s.rlike(r"^\d{4}-\d{2}-\d{2}$") & s.try_cast("date").isNotNull()) == n).alias(f"{c}__t"),
                   (F.count_if(s.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$")
                               & s.try_cast("timestamp").isNotNull()) == n).alias(f"{c}__ts")]
    r = df.agg(*checks).first()
    out = []
    for c in cols:
        s = F.trim(F.col(c))
        if r[f"{c}__l"]:
            e = F.upper(F.substring(s, 1, 1)) == "T"
            e = F.when(s.isNull(), F.lit(None).cast("boolean")).otherwise(e)
        elif r[f"{c}__d"]:
            e = s.try_cast("double")
        elif r[f"{c}__t"]:
            e = s.try_cast("date")
        elif r[f"{c}__ts"]:
            e = s.try_cast("timestamp")
        else:
            e = F.col(c)
        out.append(e.alias(c))
    keep = set(cols)
    return df.select(*[next(o for o, c2 in zip(out, cols) if c2 == c) if c in keep else F.col(c)
                       for c in df.columns])


def single_value(df: DataFrame, column: str):
    """The one distinct value of ``column`` (a name taken from data, e.g. the
    indicator of a landed file).  Reads at most two distinct values; raises
    unless there is exactly one."""
    vals = [r[0] for r in df.select(column).distinct().limit(2).collect()]
    if len(vals) != 1:
        raise ValueError(f"{column}: expected exactly one distinct value, got {vals}")
    return vals[0]
