"""Grouped mutate / window operators (W rows).

Group totals and medians are computed with groupBy (map-side partial
aggregation) and joined back on the group key with NULL-safe equality,
rather than with a window partitioned by the group: a window puts every
row of a hot group into one task, while the join lets AQE split skewed
partitions (or broadcast the small per-group table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regpanel.constants import BLOCK_BANDS, BLOCK_GROUPS
from regpanel.operators.joins import join
from regpanel.operators.quantiles import grouped_quantiles
from regpanel.session import scratch_path
from regpanel.sources.sinks import checkpoint_to


def with_group_aggs(df: DataFrame, keys: list[str], aggs: dict[str, Column],
                    materialize: bool = False) -> DataFrame:
    """Attach per-group aggregates to every row (row count preserved).

    ``df`` feeds both the aggregate and the join; with ``materialize`` it is
    written once to the shared folder (lineage cut) so an expensive upstream
    is not computed twice."""
    if materialize:
        df = checkpoint_to(df.sparkSession, df, scratch_path(df.sparkSession, "groups"))
    g = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return join(df, g, keys, "left", null_safe=True)


def share_of_group(df: DataFrame, keys: list[str], shares: dict[str, Column],
                   strict: bool = True) -> DataFrame:
    """mutate(name = x / sum(x)) within groups, for several expressions at once.
    ``strict`` (R without na.rm): any NULL of x in the group makes every share
    of that group NULL.  Division by a zero total gives NULL."""
    d = df.select("*", *[e.alias(f"__x_{n}") for n, e in shares.items()])
    aggs = {}
    for n in shares:
        x = F.col(f"__x_{n}")
        aggs[f"__t_{n}"] = F.sum(x)
        aggs[f"__ok_{n}"] = F.count(x) == F.count(F.lit(1))
    j = with_group_aggs(d, keys, aggs)
    out = []
    for n in shares:
        sh = F.try_divide(F.col(f"__x_{n}"), F.col(f"__t_{n}"))
        out.append((F.when(F.col(f"__ok_{n}"), sh) if strict else sh).alias(n))
    keep = [c for c in df.columns]
    return j.select(*keep, *out)


def net_pay_share(f: Column, m: Column, h: Column, total_fmh: Column, corrected: bool = False) -> Column:
    """Share of f + m + h.  ``corrected=False`` reproduces the source's missing
    parentheses: f + m + h / sum(f + m + h)."""
    if corrected:
        return F.try_divide(f + m + h, total_fmh)
    return f + m + F.try_divide(h, total_fmh)


def forward_fill(df: DataFrame, partition: list[str], order: str, cols: list[str],
                 chunk: Column | None = None) -> DataFrame:
    """tidyr fill(.direction = "down") along ``order`` within ``partition``;
    ``order`` is unique there.

    The fill has two levels, so that no window holds a whole key: (1) fill
    inside each (key, chunk); (2) the last non-NULL value of every chunk,
    carried forward over the chunk-level table (one row per key and chunk);
    (3) rows still NULL take the carried value.  ``chunk`` is a coarse bucket
    that never decreases along ``order``, e.g. the day of a timestamp.
    Without one the rows are dealt by ranges of (key, order) and written once
    with their range's number, which is the chunk: a key of any size lies in
    as many ranges as its rows fill."""
    s = set(cols)
    if chunk is None:
        keys = [*partition, order]
        ranged = df.repartitionByRange(*keys).withColumn("__chunk", F.spark_partition_id())
        d = checkpoint_to(df.sparkSession, ranged, scratch_path(df.sparkSession, "fill"))
    else:
        d = df.withColumn("__chunk", chunk)
    w_in = Window.partitionBy(*partition, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inner = d.select(*d.columns, *[F.last(c, ignorenulls=True).over(w_in).alias(f"__in_{c}") for c in cols])
    per_chunk = d.groupBy(*partition, "__chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__end_{c}") for c in cols])
    w_carry = Window.partitionBy(*partition).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*partition, "__chunk",
                             *[F.last(f"__end_{c}", ignorenulls=True).over(w_carry).alias(f"__carry_{c}")
                               for c in cols])
    j = join(inner, carry, [*partition, "__chunk"], "left")
    return j.select(*[F.coalesce(F.col(f"__in_{c}"), F.col(f"__carry_{c}")).alias(c) if c in s else F.col(c)
                      for c in df.columns])


def first_appearance_ordinal(df: DataFrame, partition: list[str], order: str,
                             cols: list[str], name: str = "group") -> DataFrame:
    """unique() |> mutate(name = row_number()): distinct combinations of ``cols``
    numbered in order of first appearance along ``order``."""
    g = df.groupBy(*partition, *cols).agg(F.min(order).alias("__first"))
    w = Window.partitionBy(*partition).orderBy("__first")
    return g.select(*partition, *cols, F.row_number().over(w).alias(name))


def block_cycle_ordinal(idx, block: int = BLOCK_BANDS, cycle: int = BLOCK_GROUPS) -> Column:
    """Number (from 1) of the block that the 1-based position ``idx`` is in,
    starting over after ``cycle`` blocks."""
    i = F.col(idx) if isinstance(idx, str) else idx
    return (F.pmod(F.floor((i - 1) / block), F.lit(cycle)) + 1).cast("bigint")


def group_medians(df: DataFrame, keys: list[str], cols: dict[str, str],
                  approx: bool = False, materialize: bool = False) -> DataFrame:
    """mutate(m = median(x, na.rm = TRUE)) by group, for several columns."""
    if approx:
        return with_group_aggs(df, keys, {n: F.percentile_approx(c, 0.5, 10000).cast("double") for n, c in cols.items()},
                               materialize=materialize)
    if materialize:
        df = checkpoint_to(df.sparkSession, df, scratch_path(df.sparkSession, "medians"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).cast("double").alias("x")) for n, c in cols.items()]))
    long = df.select(*keys, each.alias("__c")).select(*keys, F.col("__c.n").alias("__name"), F.col("__c.x").alias("__x"))
    q = grouped_quantiles(long, [*keys, "__name"], F.col("__x"), [0.5])
    wide = q.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == n, F.col("__q")[0])).alias(n) for n in cols])
    return join(df, wide, keys, "left", null_safe=True)


def quadrant_label(x: Column, y: Column, mx: Column, my: Column,
                   labels: tuple[str, str, str, str]) -> Column:
    """case_when on (x >= mx, y >= my): high/high, low/high, high/low, low/low.
    Any NULL operand gives a NULL label."""
    a, b, c, d = labels
    return (F.when((x >= mx) & (y >= my), a).when((x < mx) & (y >= my), b)
             .when((x >= mx) & (y < my), c).when((x < mx) & (y < my), d))
