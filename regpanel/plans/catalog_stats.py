"""Catalogue: aggregation and statistics queries (A rows, X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.functions import selectors as S
from regpanel.functions.exprs import n_distinct_na, strict_mean, strict_sum
from regpanel.operators import aggregate as A
from regpanel.operators.profile import FIELDS, profile
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, sig_all, sql_sig, table


def _li(spark, d):
    """lineitem with R-style holes: quantity missing on line 3, discount 0 -> NA."""
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                     "l_linestatus", "l_shipdate", "l_extendedprice", "l_tax", "l_quantity",
                     F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("qty"),
                     F.col("l_extendedprice").alias("price"),
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"))


LI_SQL = """li AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS qty,
  l_extendedprice AS price, nullif(l_discount, 0.0) AS disc FROM lineitem)"""


# ---------------------------------------------------------------- A1 A2 A3 P9 P14
@query("group_sum_mean_zero_missing", f"""WITH {LI_SQL}
SELECT l_returnflag, l_linestatus, l_linenumber,
  {sql_sig("nullif(coalesce(sum(qty), 0), 0)")} AS qty,
  {sql_sig("nullif(coalesce(sum(price), 0), 0)")} AS price,
  {sql_sig("nullif(avg(disc), 0)")} AS disc
FROM li GROUP BY ALL""")
def group_sum_mean_zero_missing(spark, d):
    li = _li(spark, d).select("l_returnflag", "l_linestatus", "l_linenumber", "qty", "price", "disc")
    sums = S.matches(li, "qty|price")
    means = S.starts_with(li, "disc")
    out = A.summarise_sum_mean(li, ["l_returnflag", "l_linestatus", "l_linenumber"], sums, means)
    return sig_all(out)


# ---------------------------------------------------------------- A4 / A5
@query("strict_sum_by_group", f"""WITH {LI_SQL}
SELECT l_orderkey, CASE WHEN count(qty) = count(*) THEN sum(qty) END AS s_qty,
  count(*) AS n_lines FROM li GROUP BY l_orderkey""")
def strict_sum_by_group(spark, d):
    return _li(spark, d).groupBy("l_orderkey").agg(
        strict_sum("qty").alias("s_qty"), F.count(F.lit(1)).alias("n_lines"))


@query("summarise_strict", f"""WITH li AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q,
  CASE WHEN l_linenumber <> 4 THEN l_extendedprice END AS p FROM lineitem)
SELECT l_orderkey, CASE WHEN count(q) = count(*) THEN sum(q) END AS q,
  {sql_sig("CASE WHEN count(p) = count(*) THEN avg(p) END")} AS p FROM li GROUP BY l_orderkey""")
def summarise_strict(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"),
                                            F.when(F.col("l_linenumber") != 4, F.col("l_extendedprice")).alias("p"))
    return sig_all(A.summarise_strict(li, ["l_orderkey"], ["q"], ["p"]), ["p"])


@query("strict_mean_by_group", f"""WITH li AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS p FROM lineitem)
SELECT l_orderkey, {sql_sig("CASE WHEN count(p) = count(*) THEN avg(p) END")} AS m_price
FROM li GROUP BY l_orderkey""")
def strict_mean_by_group(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("p"))
    return sig_all(li.groupBy("l_orderkey").agg(strict_mean("p").alias("m_price")))


# ---------------------------------------------------------------- A16 F27
@query("evolution_log_total", with_panel(f"""
SELECT anio, tramo, CASE WHEN count(numero_empresas) = count(*) THEN sum(numero_empresas) END AS total,
  {sql_sig("CASE WHEN sum(numero_empresas) > 0 AND count(numero_empresas) = count(*) THEN ln(sum(numero_empresas)) END")} AS log_total
FROM panel GROUP BY anio, tramo"""))
def evolution_log_total(spark, d):
    out = A.evolution_total(panel(spark, d), "anio", "tramo", "numero_empresas", "total", log="e")
    return sig_all(out, ["log_total"])


@query("evolution_log10_strict", with_panel(f"""
SELECT anio, tramo, CASE WHEN count(pessoal_ocupado) = count(*) THEN sum(pessoal_ocupado) END AS total,
  {sql_sig("CASE WHEN count(pessoal_ocupado) = count(*) AND sum(pessoal_ocupado) > 0 THEN log10(sum(pessoal_ocupado)) END")} AS log_total
FROM panel GROUP BY anio, tramo"""))
def evolution_log10_strict(spark, d):
    out = A.evolution_total(panel(spark, d), "anio", "tramo", "pessoal_ocupado", "total", log="10")
    return sig_all(out, ["log_total"])


# ---------------------------------------------------------------- A6 R3 F26
_MISS_COLS = ["pessoal_ocupado", "salario_medio", "numero_empresas"]


def _miss_sql():
    nd = ("(CAST(count(DISTINCT region) + max(CASE WHEN region IS NULL THEN 1 ELSE 0 END) AS BIGINT) * "
          "CAST(count(DISTINCT tramo) + max(CASE WHEN tramo IS NULL THEN 1 ELSE 0 END) AS BIGINT))")
    parts = [f"SELECT anio, '{c}' AS variable, "
             f"{sql_sig(f'CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) * 100.0 / CAST({nd} AS DOUBLE)')} "
             f"AS pct_faltantes FROM agg GROUP BY anio" for c in _MISS_COLS]
    agg = """, agg AS (SELECT anio, region, tramo, nullif(sum(pessoal_ocupado), 0) AS pessoal_ocupado,
  nullif(avg(salario_medio), 0) AS salario_medio, nullif(sum(numero_empresas), 0) AS numero_empresas
FROM panel GROUP BY anio, region, tramo)
"""
    return with_panel(agg + "\nUNION ALL\n".join(parts))


@query("missing_pct_by_period", _miss_sql())
def missing_pct_by_period(spark, d):
    agg = A.summarise_sum_mean(panel(spark, d), ["anio", "region", "tramo"], ["pessoal_ocupado", "numero_empresas"],
                               ["salario_medio"])  # one row per cell of the grid
    out = A.missing_pct(agg, "anio", ("region", "tramo"), _MISS_COLS)
    return sig_all(out)


@query("n_distinct_with_null", """SELECT l_returnflag,
  CAST(count(DISTINCT nullif(l_linenumber, 3)) + max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS BIGINT) AS nd_na,
  CAST(count(DISTINCT nullif(l_linenumber, 3)) AS BIGINT) AS nd_plain
FROM lineitem GROUP BY l_returnflag""")
def n_distinct_with_null(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", F.nullif("l_linenumber", F.lit(3)).alias("x"))
    return li.groupBy("l_returnflag").agg(n_distinct_na("x").alias("nd_na"),
                                          F.count_distinct("x").cast("bigint").alias("nd_plain"))


# ---------------------------------------------------------------- A7 R5 R6 X1 F28
_DIST_COLS = ["qty", "price", "disc"]


def _dist_sql(cols, group, src_cte, src):
    parts = []
    for c in cols:
        parts.append(f"""SELECT {group}, '{c}' AS variable, {sql_sig(f'min({c})')} AS min,
  {sql_sig(f'quantile_cont({c}, 0.25)')} AS p25, {sql_sig(f'quantile_cont({c}, 0.5)')} AS mediana,
  {sql_sig(f'avg({c})')} AS media, {sql_sig(f'quantile_cont({c}, 0.75)')} AS p75, {sql_sig(f'max({c})')} AS max,
  {sql_sig(f'stddev_samp({c})')} AS std_dev, {sql_sig(f'stddev_samp({c}) / sqrt(count(*))')} AS std_err,
  {sql_sig(f'100.0 * stddev_samp({c}) / nullif(avg({c}), 0)')} AS cv,
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS cant_faltantes
FROM {src} WHERE {group} IS NOT NULL GROUP BY {group}""")
    body = "\nUNION ALL\n".join(parts)
    return f"WITH {src_cte}\n{body}" if src_cte else body


@query("distribution_by_group", _dist_sql(_DIST_COLS, "l_returnflag", LI_SQL, "li"))
def distribution_by_group(spark, d):
    li = _li(spark, d)
    return sig_all(A.distribution_table(li, "l_returnflag", _DIST_COLS))


@query("distribution_by_group_approx", f"SELECT * EXCLUDE (p25, mediana, p75), true AS p25_ok, true AS mediana_ok, true AS p75_ok FROM ("
       + _dist_sql(_DIST_COLS, "l_returnflag", LI_SQL, "li") + ")")
def distribution_by_group_approx(spark, d):
    """Sketch quantiles, each checked against its true rank (the values
    themselves may differ from the exact ones within the bound)."""
    t = A.distribution_table_approx(_li(spark, d), "l_returnflag", _DIST_COLS)
    return sig_all(t.drop("p25", "mediana", "p75"))


@query("distribution_panel_by_band", with_panel(_dist_sql(
    ["numero_empresas", "valor_total", "salario_medio"], "tramo", None, "panel")))
def distribution_panel_by_band(spark, d):
    return sig_all(A.distribution_table(panel(spark, d), "tramo",
                                        ["numero_empresas", "valor_total", "salario_medio"]))


@query("summarise_named_stats", f"""SELECT o_orderstatus,
  {sql_sig('min(o_totalprice)')} AS "o_totalprice-min", {sql_sig('max(o_totalprice)')} AS "o_totalprice-max",
  {sql_sig('avg(o_totalprice)')} AS "o_totalprice-media",
  CAST(count(*) FILTER (WHERE o_totalprice IS NULL) AS BIGINT) AS "o_totalprice-cant_faltantes"
FROM orders GROUP BY o_orderstatus""")
def summarise_named_stats(spark, d):
    o = table(spark, d, "orders")
    fns = {"min": F.min, "max": F.max, "media": F.avg,
           "cant_faltantes": lambda c: F.count_if(c.isNull()).cast("bigint")}
    return sig_all(A.summarise_with(o, ["o_orderstatus"], ["o_totalprice"], fns))


# ---------------------------------------------------------------- A8 / A9 profile
def _profile_sql(src: str, cols: list[tuple[str, str]], group: list[str] = ()) -> str:
    g = ", ".join(group)
    gsel = (g + ", ") if g else ""
    gby = f" GROUP BY {g}" if g else ""
    parts = []
    for name, kind in cols:
        c = f'"{name}"'
        v = {k: f"CAST(NULL AS {t.upper()})" for k, t in FIELDS}
        v["n_missing"] = f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT)"
        v["complete_rate"] = sql_sig(f"CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE)")
        if kind == "character":
            v.update(min_len=f"CAST(min(length({c})) AS BIGINT)", max_len=f"CAST(max(length({c})) AS BIGINT)",
                     n_empty=f"CAST(count(*) FILTER (WHERE {c} = '') AS BIGINT)",
                     n_unique=f"CAST(count(DISTINCT {c}) AS BIGINT)",
                     n_whitespace=f"CAST(count(*) FILTER (WHERE regexp_full_match({c}, '\\s+')) AS BIGINT)")
        elif kind == "numeric":
            x = f"CAST({c} AS DOUBLE)"
            v.update(mean=sql_sig(f"avg({x})"), sd=sql_sig(f"stddev_samp({x})"), p0=sql_sig(f"min({x})"),
                     p25=sql_sig(f"quantile_cont({x}, 0.25)"), p50=sql_sig(f"quantile_cont({x}, 0.5)"),
                     p75=sql_sig(f"quantile_cont({x}, 0.75)"), p100=sql_sig(f"max({x})"))
        elif kind == "date":
            x = f"CAST({c} AS DATE)"
            v.update(date_min=f"min({x})", date_max=f"max({x})",
                     date_median=f"CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', {x}), 0.5)) AS INTEGER) AS DATE)",
                     n_unique=f"CAST(count(DISTINCT {x}) AS BIGINT)")
        body = ", ".join(f"{v[k]} AS {k}" for k, _ in FIELDS)
        parts.append(f"SELECT {gsel}'{kind}' AS skim_type, '{name}' AS skim_variable, {body} FROM {src}{gby}")
    return "\nUNION ALL\n".join(parts)


def _sig_profile(df):
    return sig_all(df, ["complete_rate", "mean", "sd", "p0", "p25", "p50", "p75", "p100"])


_CUSTOMER = [("c_custkey", "numeric"), ("c_name", "character"), ("c_nationkey", "numeric"), ("c_acctbal", "numeric"),
             ("c_mktsegment", "character")]


@query("profile_numeric", _profile_sql("customer", _CUSTOMER))
def profile_numeric(spark, d):
    return _sig_profile(profile(table(spark, d, "customer")))


@query("profile_string", _profile_sql("part", [("p_partkey", "numeric"), ("p_name", "character"), ("p_brand", "character"),
                                               ("p_type", "character"), ("p_size", "numeric"), ("p_retailprice", "numeric")]))
def profile_string(spark, d):
    return _sig_profile(profile(table(spark, d, "part")))


@query("profile_date", _profile_sql("orders", [("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "character"),
                                               ("o_totalprice", "numeric"), ("o_orderdate", "date"),
                                               ("o_orderpriority", "character")]))
def profile_date(spark, d):
    return _sig_profile(profile(table(spark, d, "orders")))


@query("profile_grouped", _profile_sql("customer", _CUSTOMER[:4], ["c_mktsegment"]))
def profile_grouped(spark, d):
    return _sig_profile(profile(table(spark, d, "customer"), ["c_mktsegment"]))


@query("profile_panel", with_panel(_profile_sql("panel", [("anio", "numeric"), ("region", "character"),
                                                         ("tramo", "character"), ("sector", "character"),
                                                         ("numero_empresas", "numeric"), ("pedidos", "numeric"),
                                                         ("pessoal_ocupado", "numeric"), ("valor_total", "numeric"),
                                                         ("salario_medio", "numeric")])))
def profile_panel(spark, d):
    return _sig_profile(profile(panel(spark, d)))


# ---------------------------------------------------------------- A10 A11
@query("table_shape", """SELECT count(*) AS n_rows,
  (SELECT CAST(len(json_keys(to_json(lineitem))) AS BIGINT) FROM lineitem LIMIT 1) AS n_cols FROM lineitem""")
def table_shape(spark, d):
    return A.table_shape(table(spark, d, "lineitem"))


@query("duplicate_audit", """SELECT count(*) AS n_rows,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_distinct FROM lineitem""")
def duplicate_audit(spark, d):
    return A.duplicate_audit(table(spark, d, "lineitem"))


# ---------------------------------------------------------------- A12
@query("boxplot_stats", f"""WITH y AS (SELECT o_orderstatus, o_orderpriority, log10(o_totalprice) AS v
  FROM orders WHERE o_totalprice > 0),
q AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, quantile_cont(v, 0.25) AS q1,
  quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM y GROUP BY ALL),
b AS (SELECT y.*, q.n, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
  FROM y JOIN q USING (o_orderstatus, o_orderpriority))
SELECT o_orderstatus, o_orderpriority, any_value(n) AS n, {sql_sig('any_value(q1)')} AS q1,
  {sql_sig('any_value(median)')} AS median, {sql_sig('any_value(q3)')} AS q3,
  {sql_sig('min(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_low,
  {sql_sig('max(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_high,
  CAST(count(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS BIGINT) AS n_outliers
FROM b GROUP BY o_orderstatus, o_orderpriority""")
def boxplot_stats(spark, d):
    o = table(spark, d, "orders")
    return sig_all(A.boxplot_stats(o, ["o_orderstatus", "o_orderpriority"], "o_totalprice", log="10"))


@query("boxplot_outliers", f"""WITH y AS (SELECT o_orderstatus, o_orderpriority, o_orderkey, log10(o_totalprice) AS v
  FROM orders WHERE o_totalprice > 0),
q AS (SELECT o_orderstatus, o_orderpriority, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM y GROUP BY ALL)
SELECT y.o_orderstatus, y.o_orderpriority, y.o_orderkey, {sql_sig('y.v')} AS value
FROM y JOIN q USING (o_orderstatus, o_orderpriority)
WHERE y.v < q.q1 - 1.5 * (q.q3 - q.q1) OR y.v > q.q3 + 1.5 * (q.q3 - q.q1)""")
def boxplot_outliers(spark, d):
    o = table(spark, d, "orders")
    return sig_all(A.boxplot_outliers(o, ["o_orderstatus", "o_orderpriority"], "o_totalprice", log="10",
                                      carry=["o_orderkey"]))


# ---------------------------------------------------------------- A13
@query("linear_fit_by_group", f"""WITH g AS (SELECT l_returnflag, regr_count(l_extendedprice, l_quantity) AS n,
  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
  regr_sxy(l_extendedprice, l_quantity) AS sxy, regr_avgx(l_extendedprice, l_quantity) AS mx,
  regr_avgy(l_extendedprice, l_quantity) AS my FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, CAST(n AS BIGINT) AS n, {sql_sig('sxy / nullif(sxx, 0)')} AS slope,
  {sql_sig('my - sxy / nullif(sxx, 0) * mx')} AS intercept,
  {sql_sig('sxy * sxy / nullif(sxx * syy, 0)')} AS r2,
  {sql_sig('CASE WHEN n > 2 THEN sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0.0) / (n - 2)) END')} AS sigma,
  {sql_sig('mx')} AS mean_x, {sql_sig('sxx')} AS sxx FROM g""")
def linear_fit_by_group(spark, d):
    li = table(spark, d, "lineitem")
    return sig_all(A.linear_fit(li, ["l_returnflag"], "l_quantity", "l_extendedprice"))


# ---------------------------------------------------------------- A14
_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(group: list[str]):
    g = "".join(f"{k}, " for k in group)
    gby = f" GROUP BY {', '.join(group)}" if group else ""
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            parts.append(
                f"SELECT {g}'{a}' AS var_x, '{b}' AS var_y, "
                f"{sql_sig(f'regr_sxy({b}, {a}) / nullif(sqrt(regr_sxx({b}, {a}) * regr_syy({b}, {a})), 0)')} AS corr, "
                f"CAST(regr_count({b}, {a}) AS BIGINT) AS n FROM lineitem{gby}")
    return "\nUNION ALL\n".join(parts)


@query("correlation_pairs", _corr_sql([]))
def correlation_pairs(spark, d):
    return sig_all(A.correlation_pairs(table(spark, d, "lineitem"), _CORR_COLS))


_WIDE_COLS = [f"x{i}" for i in range(26)]


def _wide_sql() -> str:
    cols = ", ".join(f"CASE WHEN (l_orderkey + {i}) % {i + 2} <> 0 THEN l_quantity * {i + 1} + l_extendedprice / {i + 3} END AS x{i}"
                     for i in range(26))
    parts = [f"SELECT l_returnflag, 'x{a}' AS var_x, 'x{b}' AS var_y, "
             + sql_sig(f"regr_sxy(x{b}, x{a}) / nullif(sqrt(regr_sxx(x{b}, x{a}) * regr_syy(x{b}, x{a})), 0)", 20)
             + f" AS corr, CAST(regr_count(x{b}, x{a}) AS BIGINT) AS n FROM w GROUP BY l_returnflag"
             for a in range(26) for b in range(a + 1, 26)]
    return f"WITH w AS MATERIALIZED (SELECT l_returnflag, {cols} FROM lineitem)\n" + "\nUNION ALL\n".join(parts)


@query("correlation_wide", _wide_sql())
def correlation_wide(spark, d):
    """26 columns with holes of their own, 325 pairs, from one moment matrix."""
    from regpanel.plans.registry import sig
    li = table(spark, d, "lineitem")
    wide = li.select("l_returnflag", *[F.when((F.col("l_orderkey") + i) % (i + 2) != 0, F.col("l_quantity") * (i + 1)
                                              + F.col("l_extendedprice") / (i + 3)).alias(f"x{i}") for i in range(26)])
    out = A.correlation_pairs(wide, _WIDE_COLS, ["l_returnflag"])
    return out.withColumn("corr", sig("corr", 20))


@query("correlation_pairs_grouped", _corr_sql(["l_returnflag"]))
def correlation_pairs_grouped(spark, d):
    return sig_all(A.correlation_pairs(table(spark, d, "lineitem"), _CORR_COLS, ["l_returnflag"]))


# ---------------------------------------------------------------- A15
@query("histogram_by_group", f"""WITH r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events
  WHERE value IS NOT NULL GROUP BY event_type),
b AS (SELECT e.event_type, r.lo, r.hi, CAST(CASE WHEN r.hi = r.lo THEN 0
  ELSE least(floor((e.value - r.lo) / ((r.hi - r.lo) / 20)), 19) END AS INTEGER) AS bin
  FROM events e JOIN r USING (event_type) WHERE e.value IS NOT NULL)
SELECT event_type, bin, {sql_sig('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 20)')} AS bin_low,
  {sql_sig('any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 20)')} AS bin_high,
  CAST(count(*) AS BIGINT) AS n FROM b GROUP BY event_type, bin""")
def histogram_by_group(spark, d):
    return sig_all(A.histogram(table(spark, d, "events"), ["event_type"], "value", bins=20))


# ---------------------------------------------------------------- A13 ribbon
@query("linear_fit_band", f"""WITH g AS (SELECT l_returnflag, regr_count(l_extendedprice, l_quantity) AS n,
  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
  regr_sxy(l_extendedprice, l_quantity) AS sxy, regr_avgx(l_extendedprice, l_quantity) AS mx,
  regr_avgy(l_extendedprice, l_quantity) AS my FROM lineitem GROUP BY l_returnflag),
f AS (SELECT l_returnflag, n, sxx, mx, sxy / nullif(sxx, 0) AS slope, my - sxy / nullif(sxx, 0) * mx AS intercept,
  CASE WHEN n > 2 THEN sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0.0) / (n - 2)) END AS sigma FROM g),
p AS (SELECT DISTINCT l_returnflag, l_quantity FROM lineitem),
b AS (SELECT p.l_returnflag, p.l_quantity, f.intercept + f.slope * p.l_quantity AS fit,
  (1.959963984540054 + 2.372271230 / (n - 2) + 2.822499 / (n - 2) ** 2) * f.sigma * sqrt(1.0 / f.n + ((p.l_quantity - f.mx) ** 2) / nullif(f.sxx, 0)) AS half
  FROM p JOIN f USING (l_returnflag))
SELECT l_returnflag, l_quantity, {sql_sig('fit')} AS fit, {sql_sig('fit - half')} AS lower, {sql_sig('fit + half')} AS upper FROM b""")
def linear_fit_band(spark, d):
    """geom_smooth(method = "lm") ribbon: fitted line and 95% band at every
    observed x of each group."""
    li = table(spark, d, "lineitem")
    fits = A.linear_fit(li, ["l_returnflag"], "l_quantity", "l_extendedprice")
    pts = li.select("l_returnflag", "l_quantity").distinct()
    return sig_all(A.fit_band(fits, pts, ["l_returnflag"], "l_quantity", 0.975))


@query("profile_factor", """WITH l AS (SELECT 'o_orderpriority' AS skim_variable, o_orderpriority AS level FROM orders
  UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders),
c AS (SELECT skim_variable, level, count(*) AS n FROM l WHERE level IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY skim_variable ORDER BY n DESC, level) AS rank,
  count(*) OVER (PARTITION BY skim_variable) AS n_unique FROM c)
SELECT skim_variable, skim_variable = 'o_orderpriority' AS ordered, CAST(n_unique AS BIGINT) AS n_unique,
  CAST(rank AS INTEGER) AS rank, level, CAST(n AS BIGINT) AS n FROM r WHERE rank <= 4""")
def profile_factor(spark, d):
    from regpanel.operators.profile import factor_profile
    o = table(spark, d, "orders")
    return factor_profile(o, ["o_orderpriority", "o_orderstatus"], top=4, ordered={"o_orderpriority": True})
