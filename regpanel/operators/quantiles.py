"""Exact type-7 quantiles per group without a task per group.

Values are counted first (combined map-side, spread over all tasks by group
and value) and the counts are written once.  While a group has more distinct
values than one task should order, the range that holds a wanted rank is cut
anew by a sketch into CUTS parts, of all groups at once, and only the parts
that hold a wanted rank are kept; so no window ever orders more than LIMIT
rows, whatever the group's size.  The sketch steers the work only: any cut
gives the same exact result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regpanel.session import scratch_path

CUTS = 64
LIMIT = 1 << 20  # distinct values that one window task orders (about 30 MB)


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where NULL equals NULL; the keys of the left stay."""
    r = right.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)])
    return left.join(r, cond).drop(*[f"__r_{i}" for i in range(len(keys))])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """keys, ``__v`` (double, neither NULL nor NaN) and ``__n``, how often; written once."""
    v = value.cast("double")
    return _written(df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
                    .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")), "counts")


def _ranks(rows: Column, probs: list[float]) -> tuple[list[Column], Column]:
    """The lower rank of every probability, and the array of all ranks wanted."""
    at = [F.floor((rows - 1) * p) for p in probs]
    return at, F.array_distinct(F.array(*at, *[F.least(a + 1, rows - 1) for a in at]))


def _narrowed(c: DataFrame, cols: list[str], probs: list[float], limit: int) -> DataFrame:
    """The counts of the ranges that hold a wanted rank: cols, ``__part`` (the
    range), ``__v``, ``__n``, ``__rows`` (of the group), ``__before`` (rows of
    the group before the range); at most ``limit`` values a range."""
    part = [*cols, "__part"]
    totals = c.groupBy(*cols).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__d"))
    if not totals.where(F.col("__d") > limit).limit(1).count():
        return c.withColumn("__part", F.lit(0).cast("bigint")).withColumn("__rows", F.sum("__n").over(Window.partitionBy(*cols))) \
                .withColumn("__before", F.lit(0).cast("bigint"))
    held = _on(c, totals.drop("__d"), cols).withColumn("__part", F.lit(0).cast("bigint")).withColumn("__before", F.lit(0).cast("bigint"))
    cuts = [i / CUTS for i in range(1, CUTS)]
    while held.groupBy(*part).count().where(F.col("count") > limit).limit(1).count():
        bounds = held.groupBy(*part).agg(F.percentile_approx("__v", cuts, 1000).alias("__b"))
        k = F.size(F.filter("__b", lambda b: b < F.col("__v"))).cast("bigint")
        placed = _on(held, bounds, part).withColumn("__k", k).drop("__b")
        sizes = placed.groupBy(*part, "__k").agg(F.sum("__n").alias("__m"), F.first("__rows").alias("__rows"),
                                                 F.first("__before").alias("__from"))
        before = F.coalesce(F.sum("__m").over(Window.partitionBy(*part).orderBy("__k")
                                              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # CUTS rows a range
        sizes = sizes.withColumn("__from", F.col("__from") + before)
        wanted = F.exists(_ranks(F.col("__rows"), probs)[1],
                          lambda r: (r >= F.col("__from")) & (r < F.col("__from") + F.col("__m")))
        keep = sizes.where(wanted).select(*part, "__k", "__from")
        held = _on(placed, keep, [*part, "__k"]).withColumn("__part", F.col("__part") * CUTS + F.col("__k"))
        held = _written(held.withColumn("__before", F.col("__from")).drop("__k", "__from"), "narrowed")
    return held


def quantiles_of_counts(c: DataFrame, keys: list[str], probs: list[float], name: str = "__q",
                        limit: int = LIMIT) -> DataFrame:
    """keys and ``name``, an array of doubles in the order of ``probs``, of counts as :func:`value_counts` gives them."""
    cols = keys or ["__all"]
    c = c if keys else c.withColumn("__all", F.lit(0))
    held = _narrowed(c, cols, probs, limit)
    order = Window.partitionBy(*cols, "__part").orderBy("__v")
    to = F.col("__before") + F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at, wanted = _ranks(F.col("__rows"), probs)
    mine = F.filter(wanted, lambda r: (r >= F.col("__to") - F.col("__n")) & (r < F.col("__to")))
    found = (held.withColumn("__to", to).select(*cols, "__rows", "__v", F.explode(mine).alias("__r")).groupBy(*cols)
             .agg(F.first("__rows").alias("__rows"), F.map_from_entries(F.collect_list(F.struct("__r", "__v"))).alias("__at")))
    last = F.col("__rows") - 1

    def quantile(p, a):
        lo, hi = F.col("__at")[a], F.col("__at")[F.least(a + 1, last)]
        part = last * p - a
        return (1 - part) * lo + part * hi

    return found.select(*keys, F.array(*[quantile(p, a) for p, a in zip(probs, at, strict=True)]).alias(name))


def grouped_quantiles(df: DataFrame, keys: list[str], value: Column, probs: list[float], name: str = "__q",
                      limit: int = LIMIT) -> DataFrame:
    """keys and ``name``, an array of doubles in the order of ``probs``; groups
    without a value give no row, NaN is no value.  ``keys`` may be empty (one row)."""
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs, name, limit)
