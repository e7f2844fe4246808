"""Grouped statistics (A rows).  Wide statistic tables are built by
unpivoting first and aggregating by (group, variable): one aggregate, one
shuffle, no per-column plan blow-up.  All aggregates combine map-side."""

from __future__ import annotations

from collections.abc import Callable
from math import atan, cos, exp, lgamma, log1p, pi, sin, sqrt, tan
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regpanel.functions.exprs import (corr_safe, count_missing, log_pos, n_distinct_na,
                                      strict_mean, strict_sum, sum_na_rm, without_nan, zero_as_missing)
from regpanel.operators.quantiles import _written, grouped_quantiles, quantiles_of_counts, value_counts
from regpanel.operators.reshape import pivot_longer


def summarise_sum_mean(df: DataFrame, keys: list[str], sum_cols: list[str],
                       mean_cols: list[str], zero_missing: bool = True) -> DataFrame:
    """group_by(keys) |> summarise(across(sum_cols, sum, na.rm), across(mean_cols,
    mean, na.rm)) |> mutate_if(is.numeric, zero -> NA)."""
    df = without_nan(df)
    aggs = [sum_na_rm(c).alias(c) for c in sum_cols] + [F.avg(c).alias(c) for c in mean_cols]
    out = df.groupBy(*keys).agg(*aggs)
    if zero_missing:
        out = out.select(*keys, *[zero_as_missing(c).alias(c) for c in sum_cols + mean_cols])
    return out


def summarise_strict(df: DataFrame, keys: list[str], sum_cols: list[str] = (),
                     mean_cols: list[str] = ()) -> DataFrame:
    """sum / mean without na.rm: one NULL poisons the group."""
    df = without_nan(df)
    aggs = [strict_sum(c).alias(c) for c in sum_cols] + [strict_mean(c).alias(c) for c in mean_cols]
    return df.groupBy(*keys).agg(*aggs)


def missing_pct(df: DataFrame, period: str, grid: tuple[str, str], value_cols: list[str],
                names_to: str = "variable", values_to: str = "pct_faltantes") -> DataFrame:
    """Share of missing cells, in per cent, for every period and variable.  The
    whole grid of ``a`` by ``b`` values (NULL is a value) is the base, so ``df``
    must have one row per cell."""
    a, b = grid
    df = without_nan(df)
    grid_n = (n_distinct_na(a) * n_distinct_na(b)).cast("double")
    wide = df.groupBy(period).agg(
        *[(count_missing(c) * 100.0 / grid_n).alias(c) for c in value_cols])
    return pivot_longer(wide, value_cols, names_to, values_to, id_cols=[period])


STAT_NAMES = ["min", "p25", "mediana", "media", "p75", "max", "std_dev", "std_err", "cv",
              "cant_faltantes"]


def distribution_table(df: DataFrame, group: str, value_cols: list[str],
                       approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Per group x variable: min, p25, median, mean, p75, max, sd, se, cv,
    missing count.  Quantiles are type 7, exact by counted ranges unless
    ``approx`` (bounded-memory sketch).  se divides by the
    group's row count including missing rows; groups with a NULL label are
    dropped (split())."""
    long = without_nan(pivot_longer(df.where(F.col(group).isNotNull()).select(group, *value_cols),
                                    value_cols, "variable", "__v", id_cols=[group]), ["__v"])
    v = F.col("__v")
    q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy) if approx else F.lit(None)
    sd = F.stddev_samp(v)
    agg = long.groupBy(group, "variable").agg(
        F.min(v).alias("min"), q.alias("__q"), F.avg(v).alias("media"), F.max(v).alias("max"),
        sd.alias("std_dev"), (sd / F.sqrt(F.count(F.lit(1)))).alias("std_err"),
        (100.0 * F.try_divide(sd, F.avg(v))).alias("cv"),
        count_missing(v).alias("cant_faltantes"))
    if not approx:
        from regpanel.operators.joins import join
        exact = grouped_quantiles(long, [group, "variable"], v, [0.25, 0.5, 0.75])
        agg = join(agg.drop("__q"), exact, [group, "variable"], "left", null_safe=False)
    return agg.select(group, "variable", "min",
                      F.col("__q")[0].cast("double").alias("p25"),
                      F.col("__q")[1].cast("double").alias("mediana"),
                      "media", F.col("__q")[2].cast("double").alias("p75"),
                      "max", "std_dev", "std_err", "cv", "cant_faltantes")


def quantile_ranks(df: DataFrame, keys: list[str], value: Column, found: DataFrame, n_probs: int,
                   quantiles: str = "__q") -> DataFrame:
    """The true ranks (from 1) that returned quantiles hold: keys, ``n`` rows with
    a value, and ``ranks``, an array of (first, last) in the order of the
    quantiles' array in ``found``.  One more aggregate over the rows."""
    from regpanel.operators.joins import join
    v = F.col("__v")
    j = join(df.select(*keys, value.cast("double").alias("__v")).where(v.isNotNull()), found, keys, "inner")
    ranks = [F.struct((F.count_if(v < F.col(quantiles)[i]) + 1).alias("first"), F.count_if(v <= F.col(quantiles)[i]).alias("last"))
             for i in range(n_probs)]
    return j.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*ranks).alias("ranks"))


def rank_within(rank: Column, n: Column, p: float, accuracy: int) -> Column:
    """The sketch's promise: one of the ranks held lies between
    floor((p - 1 / accuracy) * n) and ceil((p + 1 / accuracy) * n)."""
    return (rank["last"] >= F.floor((p - 1 / accuracy) * n)) & (rank["first"] <= F.ceil((p + 1 / accuracy) * n))


def distribution_table_approx(df: DataFrame, group: str, value_cols: list[str], accuracy: int = 10000) -> DataFrame:
    """:func:`distribution_table` with sketch quantiles (mergeable, of bounded
    size) and, for each of the three, whether its true rank is as near to the
    wanted one as the sketch promises: ``p25_ok``, ``mediana_ok``, ``p75_ok``."""
    # written once: of known size, so that the values need not move, all of a group to one task, to meet it
    t = _written(distribution_table(df, group, value_cols, approx=True, accuracy=accuracy), "distribution")
    long = without_nan(pivot_longer(df.where(F.col(group).isNotNull()).select(group, *value_cols),
                                    value_cols, "variable", "__v", id_cols=[group]), ["__v"])
    found = t.select(group, "variable", F.array("p25", "mediana", "p75").alias("__q"))
    ranks = quantile_ranks(long, [group, "variable"], F.col("__v"), found, 3)
    from regpanel.operators.joins import join
    j = join(t, ranks, [group, "variable"], "left")
    ok = [F.coalesce(rank_within(F.col("ranks")[i], F.col("n"), p, accuracy), F.lit(True)).alias(f"{name}_ok")
          for i, (name, p) in enumerate((("p25", 0.25), ("mediana", 0.5), ("p75", 0.75)))]
    return j.select(*t.columns, *ok)


def summarise_with(df: DataFrame, keys: list[str], cols: list[str],
                   fns: dict[str, Callable[[Column], Column]], sep: str = "-") -> DataFrame:
    """across(cols, .fns = list(name = fn, ...), .names = "{col}-{fn}") in one agg."""
    return df.groupBy(*keys).agg(*[fn(F.col(c)).alias(f"{c}{sep}{n}")
                                   for c in cols for n, fn in fns.items()])


def table_shape(df: DataFrame) -> DataFrame:
    """nrow / length(colnames)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def duplicate_audit(df: DataFrame) -> DataFrame:
    """Rows vs distinct rows in one aggregation (NULL equals NULL in grouping)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.sum("__n").cast("bigint").alias("n_rows"),
                 F.count(F.lit(1)).cast("bigint").alias("n_distinct"))


def evolution_total(df: DataFrame, period: str, band: str, measure: str,
                    name: str = "total", log: str = "e", strict: bool = True) -> DataFrame:
    """group_by(period, band) |> summarise(total = sum(measure)) plus log(total)
    (NULL for totals <= 0).  ``strict`` keeps R's no-na.rm poisoning."""
    s = strict_sum(measure) if strict else F.sum(measure)
    out = without_nan(df, [measure]).groupBy(period, band).agg(s.alias(name))
    return out.withColumn(f"log_{name}", log_pos(name, log))


def boxplot_stats(df: DataFrame, keys: list[str], y: str, log: str | None = "10",
                  approx: bool = False) -> DataFrame:
    """Box statistics per group, computed after the log transform (non-finite
    values removed): q1, median, q3 (type 7, or a sketch with ``approx``),
    Tukey whiskers, outlier count.  Values are counted once; quartiles,
    whiskers and outliers all come from the counts, so the input is read once."""
    val = log_pos(y, log) if log else F.col(y)
    from regpanel.operators.joins import join
    c = value_counts(df, keys, val)
    if approx:
        v = val.cast("double")
        q = df.where(~F.isnan(v)).groupBy(*keys).agg(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias("__q"))
    else:
        q = quantiles_of_counts(c, keys, [0.25, 0.5, 0.75])
    q = q.select(*keys, F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"), F.col("__q")[2].alias("q3"))
    j = join(c, q, keys, "inner")
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("__v") >= F.col("q1") - 1.5 * iqr) & (F.col("__v") <= F.col("q3") + 1.5 * iqr)
    return j.groupBy(*keys).agg(
        F.sum("__n").cast("bigint").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("__n"))), F.lit(0)).cast("bigint").alias("n_outliers"))


def boxplot_outliers(df: DataFrame, keys: list[str], y: str, log: str | None = "10",
                     carry: list[str] = (), approx: bool = False) -> DataFrame:
    """The rows drawn as outlier points: transformed value outside
    [q1 - 1.5 IQR, q3 + 1.5 IQR] of its group.  Returned as rows (never
    collected into per-group arrays), with ``carry`` columns kept."""
    from regpanel.operators.joins import join
    val = log_pos(y, log) if log else F.col(y)
    d = without_nan(df.select(*keys, *carry, val.cast("double").alias("__y")), ["__y"]).where(F.col("__y").isNotNull())
    q = (d.groupBy(*keys).agg(F.percentile_approx("__y", [0.25, 0.75], 10000).alias("__q")) if approx
         else grouped_quantiles(d, keys, F.col("__y"), [0.25, 0.75]))
    q = q.select(
        *keys, F.col("__q")[0].alias("__q1"), F.col("__q")[1].alias("__q3"))
    j = join(d, q, keys, "inner")
    iqr = F.col("__q3") - F.col("__q1")
    out = j.where((F.col("__y") < F.col("__q1") - 1.5 * iqr) | (F.col("__y") > F.col("__q3") + 1.5 * iqr))
    return out.select(*keys, *carry, F.col("__y").alias("value"))


def linear_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """lm(y ~ x) per group from one pass of regression aggregates: slope,
    intercept, r2, residual standard error, n, mean of x, sxx.  Pairs with a
    NULL are dropped; a constant x or y gives NULL slope/r2 as in R (NaN)."""
    X, Y = F.col(x), F.col(y)
    g = without_nan(df, [x, y]).groupBy(*keys).agg(
        F.regr_count(Y, X).alias("n"), F.regr_sxx(Y, X).alias("sxx"),
        F.regr_syy(Y, X).alias("syy"), F.regr_sxy(Y, X).alias("sxy"),
        F.regr_avgx(Y, X).alias("mean_x"), F.regr_avgy(Y, X).alias("mean_y"))
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    rss = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    return g.select(
        *keys, F.col("n").cast("bigint").alias("n"), slope.alias("slope"),
        (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
        F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy")).alias("r2"),
        F.when(F.col("n") > 2, F.sqrt(F.greatest(rss, F.lit(0.0)) / (F.col("n") - 2))).alias("sigma"),
        "mean_x", "sxx")


T_TABLE = 200  # degrees of freedom up to which the quantile is worked out one by one


def _t_cdf(t: float, df: int) -> float:
    """Student t distribution function of whole degrees of freedom: the finite sums in the angle atan(t / sqrt(df))."""
    a = atan(t / sqrt(df))
    c2, term, total = cos(a) ** 2, 1.0, 0.0
    if df % 2:
        term = cos(a)
        for k in range(1, df - 1, 2):
            total += term
            term *= c2 * (k + 1) / (k + 2)
        return 0.5 + (a + sin(a) * total) / pi
    for k in range(1, df, 2):
        total += term
        term *= c2 * k / (k + 1)
    return 0.5 + sin(a) * total / 2


def _t_density(t: float, df: int) -> float:
    return exp(lgamma((df + 1) / 2) - lgamma(df / 2) - (df + 1) / 2 * log1p(t * t / df)) / sqrt(df * pi)


def t_quantile_value(p: float, df: int) -> float:
    """Student t quantile.  Up to T_TABLE degrees by Newton steps on the
    distribution function from the normal quantile, which lies below it; the
    function is concave there, so the steps rise to the root.  Beyond, the
    asymptotic series, whose next term is below 1e-11 there."""
    if p < 0.5:
        return -t_quantile_value(1 - p, df)
    t = z = NormalDist().inv_cdf(p)
    if df > T_TABLE:
        return z + sum(c / df ** k for k, c in enumerate(_t_terms(z), 1))
    if df == 1:
        return tan(pi * (p - 0.5))
    for _ in range(200):
        step = (p - _t_cdf(t, df)) / _t_density(t, df)
        t += step
        if abs(step) <= 1e-15 * max(1.0, abs(t)):
            break
    return t


def _t_terms(z: float) -> list[float]:
    return [(z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96,
            (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384,
            (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160]


def t_quantile(p: float, df: Column) -> Column:
    """Student t quantile of a fixed level per row's whole degrees of freedom
    (NULL below 1): worked out while the plan is made for 1 to T_TABLE degrees
    and looked up, the asymptotic series beyond."""
    z = NormalDist().inv_cdf(p)
    table = F.array(*[F.lit(t_quantile_value(p, k)) for k in range(1, T_TABLE + 1)])
    series = F.lit(z)
    for k, c in enumerate(_t_terms(z), 1):
        series = series + F.lit(c) / F.pow(df.cast("double"), F.lit(float(k)))
    return F.when(df < 1, F.lit(None)).when(df <= T_TABLE, F.get(table, (df - 1).cast("int"))).otherwise(series)


def fit_grid(df: DataFrame, keys: list[str], x: str, y: str, points: int = 80) -> DataFrame:
    """The support of a fitted line's ribbon: ``points`` equally spaced values
    of ``x`` over each group's range of complete pairs (keys, ``x``)."""
    pair = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    g = df.where(pair).groupBy(*keys).agg(F.min(x).cast("double").alias("__lo"), F.max(x).cast("double").alias("__hi"))
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("__i")
    return g.select(*keys, "__lo", "__hi", i).select(
        *keys, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__i") / (points - 1)).alias(x))


def fit_band(fits: DataFrame, points: DataFrame, keys: list[str], x: str, p: float = 0.975) -> DataFrame:
    """Confidence ribbon of the fitted line at ``points[x]`` (per group):
    yhat +- t * sigma * sqrt(1/n + (x - mean_x)^2 / sxx), t the quantile of
    level ``p`` for the group's n - 2 degrees of freedom."""
    from regpanel.operators.joins import join
    j = join(points, fits, keys, "inner")
    yhat = F.col("intercept") + F.col("slope") * F.col(x)
    half = t_quantile(p, F.col("n") - 2) * F.col("sigma") * F.sqrt(
        1.0 / F.col("n") + F.try_divide((F.col(x) - F.col("mean_x")) ** 2, F.col("sxx")))
    return j.select(*keys, x, yhat.alias("fit"), (yhat - half).alias("lower"), (yhat + half).alias("upper"))


WIDE = 24  # columns up to which every pair is an expression of its own
_HELD = 32 << 20  # bytes of sums that a task holds before it hands them on


def _moments(cols: list[str], keys: list[str], shift: list[float]):
    """Per task and group: for every pair of columns, over the rows that have
    both, their number and the sums of x, y, xx, yy, xy, by matrix products of
    a batch's values and of its marks of what is there."""
    import numpy as np
    import pyarrow as pa
    p = len(cols)
    i, j = np.triu_indices(p, 1)

    def rows(held):
        for k, m in held.items():
            there = np.flatnonzero(m[0][i, j])
            ii, jj = i[there], j[there]
            out = [pa.array([v] * len(there)) for v in k] + [pa.array(ii, pa.int32()), pa.array(jj, pa.int32())]
            n, sx, sxx, sxy = m
            out += [pa.array(a) for a in (n[ii, jj], sx[ii, jj], sx[jj, ii], sxx[ii, jj], sxx[jj, ii], sxy[ii, jj])]
            yield out

    def run(batches):
        held: dict = {}
        names = [*[f"k{n}" for n in range(len(keys))], "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]

        def flush():
            for out in rows(held):
                yield out
            held.clear()
        schema = None
        for b in batches:
            schema = schema or [b.schema.field(n).type for n in range(len(keys))]
            x = np.column_stack([np.asarray(b.column(len(keys) + c).fill_null(float("nan")), dtype=np.float64) for c in range(p)])
            of: dict = {}
            for r, k in enumerate(zip(*[b.column(n).to_pylist() for n in range(len(keys))], strict=True) if keys else [()] * len(x)):
                of.setdefault(k, []).append(r)
            for k, r in of.items():
                v = x[r] - shift
                mark = (~np.isnan(v)).astype(np.float64)
                v = np.nan_to_num(v, nan=0.0)
                add = mark.T @ mark, v.T @ mark, (v * v).T @ mark, v.T @ v
                held[k] = [a + c for a, c in zip(held[k], add, strict=True)] if k in held else list(add)
            if len(held) * p * p * 32 > _HELD:
                yield from (pa.RecordBatch.from_arrays([a.cast(t) if t else a for a, t in zip(o, [*schema, *[None] * 8], strict=True)],
                                                       names=names) for o in flush())
        if held:
            yield from (pa.RecordBatch.from_arrays([a.cast(t) if t else a for a, t in zip(o, [*schema, *[None] * 8], strict=True)],
                                                   names=names) for o in flush())
    return run


def correlation_matrix(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """:func:`correlation_pairs` for many columns: one vectorised pass gives
    every task's sums of all pairs (columns are first moved by their overall
    mean, so that the sums keep their digits), Spark adds them up.  The plan has
    one scan and one aggregate, however many columns there are."""
    cols, keys = list(cols), list(keys)
    d = without_nan(df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]), cols)
    means = d.agg(*[F.avg(f"`{c}`").alias(f"m{n}") for n, c in enumerate(cols)]).first()
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = ", ".join([*[f"k{n} {types[k]}" for n, k in enumerate(keys)], "i int, j int, n double, sx double, sy double, "
                        "sxx double, syy double, sxy double"])
    parts = d.mapInArrow(_moments(cols, keys, [m or 0.0 for m in means]), schema)
    by = [f"k{n}" for n in range(len(keys))]
    s = parts.groupBy(*by, "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    # pairs that no group row has in common are reported too, as the narrow form does
    if keys:
        groups = d.select(*[F.col(k).alias(b) for k, b in zip(keys, by, strict=True)]).distinct()
    else:
        groups = d.sparkSession.range(1).select()
    i, j = (F.explode(F.sequence(F.lit(a), F.lit(b))) for a, b in ((0, len(cols) - 2), (1, len(cols) - 1)))
    every = groups.select("*", i.alias("i")).select("*", j.alias("j")).where("j > i")
    from regpanel.operators.joins import join
    t = join(every, s, [*by, "i", "j"], "left")
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx, vy = F.col("sxx") - sx * sx / n, F.col("syy") - sy * sy / n
    tiny = lambda v, raw: F.when(v > 1e-12 * raw, v)  # noqa: E731 - a constant column leaves rounding only
    corr = (F.col("sxy") - sx * sy / n) / F.sqrt(tiny(vx, F.col("sxx")) * tiny(vy, F.col("syy")))
    names = F.array(*map(F.lit, cols))
    return t.select(*[F.col(b).alias(k) for k, b in zip(keys, by, strict=True)], F.get(names, "i").alias("var_x"),
                    F.get(names, "j").alias("var_y"), corr.alias("corr"), F.coalesce(n, F.lit(0.0)).cast("bigint").alias("n"))


def correlation_pairs(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """Pairwise Pearson correlations (i < j), pair-complete, per group, in one
    aggregation; output long (keys, var_x, var_y, corr, n).  Beyond ``WIDE``
    columns the pairs come from :func:`correlation_matrix`, so that the plan
    does not grow with them."""
    if len(cols) > WIDE:
        return correlation_matrix(df, cols, keys)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    df, aggs = without_nan(df, list(cols)), []
    for k, (a, b) in enumerate(pairs):
        aggs += [corr_safe(a, b).alias(f"__c{k}"), F.regr_count(F.col(b), F.col(a)).alias(f"__n{k}")]
    wide = df.groupBy(*keys).agg(*aggs)
    structs = [F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                        F.col(f"__c{k}").alias("corr"), F.col(f"__n{k}").cast("bigint").alias("n"))
               for k, (a, b) in enumerate(pairs)]
    return wide.select(*keys, F.explode(F.array(*structs)).alias("__p")).select(*keys, "__p.*")


def histogram(df: DataFrame, keys: list[str], x: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram per group: bin = floor((x - min) / width), the max
    value falls in the last bin; a constant group has one bin."""
    from regpanel.operators.joins import join
    d = without_nan(df.select(*keys, F.col(x).alias("__x")), ["__x"]).where(F.col("__x").isNotNull())
    rng = d.groupBy(*keys).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    j = join(d, rng, keys, "inner")
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    h = j.groupBy(*keys, b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.first("__lo").alias("__lo"),
        F.first("__hi").alias("__hi"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    return h.select(*keys, "bin", (F.col("__lo") + F.col("bin") * w).alias("bin_low"),
                    (F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_high"), "n")
