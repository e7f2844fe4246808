"""Column profile (skim) in ONE aggregation: every column contributes one
struct of a common shape, the structs are exploded into one row per
(group, column).  Statistics by type family:

* all: n_missing, complete_rate
* string: min/max length, n_empty, n_unique, n_whitespace
* numeric: mean, sd, p0, p25, p50, p75, p100 (type-7 quantiles)
* date/timestamp: min, max, median, n_unique
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from regpanel.functions.exprs import without_nan
from regpanel.operators.joins import join
from regpanel.operators.quantiles import grouped_quantiles

FIELDS = [
    ("n_missing", "bigint"), ("complete_rate", "double"),
    ("min_len", "bigint"), ("max_len", "bigint"), ("n_empty", "bigint"),
    ("n_unique", "bigint"), ("n_whitespace", "bigint"),
    ("mean", "double"), ("sd", "double"), ("p0", "double"), ("p25", "double"),
    ("p50", "double"), ("p75", "double"), ("p100", "double"),
    ("date_min", "date"), ("date_max", "date"), ("date_median", "date"),
]


def _kind(dt) -> str:
    if isinstance(dt, BooleanType):
        return "logical"
    if isinstance(dt, NumericType):
        return "numeric"
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return "date"
    return "character"


def profile(df: DataFrame, group: list[str] | None = None, approx: bool = False) -> DataFrame:
    """skimr::skim(df) or group_by(group) |> skim(): one row per column.

    Exact distinct counts make Spark expand every row once per counted
    column; ``approx=True`` uses HyperLogLog counts and quantile sketches
    instead (bounded state, no expansion) for wide tables at scale."""
    group = list(group or [])
    df = without_nan(df)
    structs, ranked = [], []
    n = F.count(F.lit(1))
    for f in df.schema.fields:
        if f.name in group:
            continue
        c = F.col(f.name)
        kind = _kind(f.dataType)
        vals = {k: F.lit(None).cast(t) for k, t in FIELDS}
        vals["n_missing"] = F.count_if(c.isNull()).cast("bigint")
        vals["complete_rate"] = F.count(c) / n
        if kind == "character":
            s = c.cast("string")
            vals.update(min_len=F.min(F.length(s)).cast("bigint"), max_len=F.max(F.length(s)).cast("bigint"),
                        n_empty=F.count_if(s == "").cast("bigint"),
                        n_unique=(F.approx_count_distinct(s) if approx else F.count_distinct(s)).cast("bigint"),
                        n_whitespace=F.count_if(s.rlike(r"^\s+$")).cast("bigint"))
        elif kind == "numeric":
            x = c.cast("double")
            vals.update(mean=F.avg(x), sd=F.stddev_samp(x), p0=F.min(x), p100=F.max(x))
            if approx:
                q = F.percentile_approx(x, [0.25, 0.5, 0.75], 10000)
                vals.update(p25=q[0].cast("double"), p50=q[1].cast("double"), p75=q[2].cast("double"))
            else:
                ranked.append((f.name, x))
        elif kind == "date":
            d = c.cast("date")
            u = F.unix_date(d)
            vals.update(date_min=F.min(d), date_max=F.max(d),
                        n_unique=(F.approx_count_distinct(d) if approx else F.count_distinct(d)).cast("bigint"))
            if approx:
                vals.update(date_median=F.date_from_unix_date(F.percentile_approx(u, 0.5, 10000)))
            else:
                ranked.append((f.name, u))
        else:  # logical
            vals.update(mean=F.avg(c.cast("double")))
        structs.append(F.struct(F.lit(kind).alias("skim_type"), F.lit(f.name).alias("skim_variable"),
                                *[vals[k].alias(k) for k, _ in FIELDS]))
    agg = df.groupBy(*group).agg(F.array(*structs).alias("__p"))
    out = agg.select(*group, F.explode("__p").alias("__s")).select(*group, "__s.*")
    return _with_quantiles(df, out, group, ranked) if ranked else out


def _with_quantiles(df: DataFrame, out: DataFrame, group: list[str], ranked: list) -> DataFrame:
    """Fills the exact quartiles and date medians, all columns in one counted pass."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("skim_variable"), x.cast("double").alias("x")) for c, x in ranked]))
    long = df.select(*group, each.alias("__f")).select(*group, "__f.*")
    keys = [*group, "skim_variable"]
    j = join(out, grouped_quantiles(long, keys, F.col("x"), [0.25, 0.5, 0.75]), keys, "left")
    q, date = F.col("__q"), F.col("skim_type") == "date"
    fill = {"p25": F.when(~date, q[0]), "p50": F.when(~date, q[1]), "p75": F.when(~date, q[2]),
            "date_median": F.when(date, F.date_from_unix_date(F.floor(q[1]).cast("int")))}
    return j.select(*[fill[c].alias(c) if c in fill else F.col(c) for c in out.columns])


def factor_profile(df: DataFrame, cols: list[str], top: int = 4, ordered: dict[str, bool] | None = None,
                   group: list[str] | None = None) -> DataFrame:
    """skim's factor block: per (group, column) the number of distinct levels,
    the ordered flag, and the ``top`` most frequent levels with their counts
    (rank 1 = most frequent, ties by level).  One count per (column, level)
    after unpivoting; the ranking window runs over distinct levels only."""
    from pyspark.sql import Window
    group = list(group or [])
    ordered = ordered or {}
    long = df.select(*group, F.explode(F.array(*[
        F.struct(F.lit(c).alias("skim_variable"), F.col(c).cast("string").alias("level")) for c in cols]))
        .alias("__f")).select(*group, "__f.*").where(F.col("level").isNotNull())
    counts = long.groupBy(*group, "skim_variable", "level").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*group, "skim_variable").orderBy(F.col("n").desc(), F.col("level"))
    wn = Window.partitionBy(*group, "skim_variable")
    ranked = counts.select(*group, "skim_variable", "level", "n", F.row_number().over(w).alias("rank"),
                           F.count(F.lit(1)).over(wn).alias("n_unique"))
    flag = F.lit(False)
    for c, o in ordered.items():
        flag = F.when(F.col("skim_variable") == c, F.lit(o)).otherwise(flag)
    return ranked.where(F.col("rank") <= top).select(
        *group, "skim_variable", flag.alias("ordered"), F.col("n_unique").cast("bigint"),
        F.col("rank").cast("int"), "level", F.col("n").cast("bigint"))
