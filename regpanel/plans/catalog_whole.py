"""Catalogue: the composite jobs PL7-PL11 whole, with their interim and final writes."""

from __future__ import annotations

from math import exp, lgamma, log, log1p

from regpanel.constants import ES_NATIONAL_FILES, ES_NUTS2, IT_NUTS2
from regpanel.plans import composites as C
from regpanel.plans.catalog_composite import _AGG_SQL
from regpanel.plans.catalog_stats import _dist_sql, _profile_sql, _sig_profile
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, sig_all, sql_sig
from regpanel.session import scratch_path

# ---------------------------------------------------------------- PL7 PL8
_TL = "replace(strip_accents(lower({x})), 'ß', 'ss')"
_CODE = {"ES": ES_NUTS2, "IT": IT_NUTS2}


def _measures_sql(code: str, region_name: str) -> str:
    codes = ", ".join(f"'{c}'" for c in _CODE[code])
    title = "(upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)))"
    return f"""WITH g AS (SELECT c_nationkey AS k, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS renta,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS pbi,
  CAST(count(*) AS DOUBLE) AS dens, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS pobl,
  CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS crim,
  CAST(count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS DOUBLE) AS hom,
  CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS DOUBLE) AS pobr
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
e AS (SELECT g.*, [{codes}][k + 1] AS id_region, n_name AS region FROM g JOIN nation ON k = n_nationkey
  WHERE k < {len(_CODE[code])}),
h AS (SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio,
  lower(CASE WHEN n_nationkey % 2 = 1 THEN translate({title}, 'aio', 'áíó') ELSE {title} END) AS k,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1e6 AS hdi, 'Indice' AS hdi_unidad
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{region_name}' GROUP BY ALL)"""


_EU = ("e.anio, e.id_region, e.region, renta AS renta_media_hogar, 'EUR_HAB' AS renta_media_hogar_unidad, "
       "pbi AS pbi_per_capita, 'EUR_HAB' AS pbi_per_capita_unidad, dens AS densidad_pobl, 'PER_KM2' AS densidad_pobl_unidad")


@query("pl_control_panel_italy", _measures_sql("IT", "EUROPE") + f"""
SELECT {_EU}, pobl AS poblacion_total, 'NR' AS poblacion_total_unidad, crim AS tasa_criminalidad,
  'P_HTHAB' AS tasa_criminalidad_unidad, pobr AS tasa_pobreza, 'PC' AS tasa_pobreza_unidad,
  {sql_sig('h.hdi')} AS hdi, h.hdi_unidad
FROM e LEFT JOIN h ON {_TL.format(x='e.region')} = h.k AND e.anio = h.anio""")
def pl_control_panel_italy(spark, d):
    out = C.control_panel_italy(spark, C.dataset_facts(spark, d), C.nuts_regions(spark, d), C.hdi_table(spark, d, "EUROPE"),
                                "EUROPE", scratch_path(spark, "pl8_italy"), C.TABLE_PERIOD, 1990)
    return sig_all(out, ["hdi"])


def _spain_sql(corrected: bool) -> str:
    whens = " ".join(f"WHEN regexp_matches(n_name, '{p}') THEN '{t}'" for p, t in C.NATIONAL_RECODE)
    rc = f"CASE {whens} ELSE {_TL.format(x='n_name')} END"
    key = _TL.format(x=f"trim({rc})") if corrected else f"lower({rc})"
    value = {"tasa_homicidios": "hom", "tasa_criminalidad": "crim", "tasa_pobreza": "renta", "pobl_total": "pobl"}
    parts = [f"{stem} AS (SELECT k, anio, {value[m]} AS v FROM g WHERE (k + {i}) % 6 <> 0)" for i, (stem, m, _) in
             enumerate(ES_NATIONAL_FILES)]
    base, *rest = [stem for stem, _, _ in ES_NATIONAL_FILES]
    cols = ", ".join(f"{stem}.v AS {m}, CASE WHEN {stem}.k IS NOT NULL THEN '{u[:4]}' END AS {m}_unidad"
                     for stem, m, u in ES_NATIONAL_FILES)
    joins = " ".join(f"LEFT JOIN {s} ON {s}.k = {base}.k AND {s}.anio = {base}.anio" for s in rest)
    out = ", ".join(f"ine.{m}, ine.{m}_unidad" for _, m, _ in ES_NATIONAL_FILES)
    return _measures_sql("ES", "AMERICA") + f""",
{", ".join(parts)},
ine AS (SELECT {key} AS key, {base}.anio, {cols} FROM {base} JOIN nation ON {base}.k = n_nationkey {joins})
SELECT {_EU}, {sql_sig('h.hdi')} AS hdi, h.hdi_unidad, {out}
FROM e LEFT JOIN h ON {_TL.format(x='e.region')} = h.k AND e.anio = h.anio
LEFT JOIN ine ON {_TL.format(x='e.region')} = ine.key AND e.anio = ine.anio"""


def _spain(spark, d, corrected: bool):
    root = scratch_path(spark, "pl7_files")
    for stem, df in C.national_sources(spark, d).items():
        df.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(f"{root}/{stem}.csv")
    out = C.control_panel_spain(spark, C.dataset_facts(spark, d), C.nuts_regions(spark, d), C.hdi_table(spark, d, "AMERICA"),
                                C.read_national_files(spark, root), "AMERICA", C.NATIONAL_RECODE,
                                scratch_path(spark, "pl7_spain"), C.TABLE_PERIOD, 1990, corrected)
    return sig_all(out, ["hdi"])


@query("pl_control_panel_spain", _spain_sql(True))
def pl_control_panel_spain(spark, d):
    return _spain(spark, d, True)


@query("pl_control_panel_spain_as_is", _spain_sql(False))
def pl_control_panel_spain_as_is(spark, d):
    return _spain(spark, d, False)


# ---------------------------------------------------------------- PL9 PL10
_VALUES = ["numero_empresas", "pedidos", "pessoal_ocupado", "valor_total", "salario_medio"]
_CELLS = ", " + _AGG_SQL + "\n"


def _report(spark, d, part: str):
    return C.panel_report(C.cell_panel(panel(spark, d)))[part]()


@query("pl_report_profile", with_panel(_CELLS + _profile_sql("agg", [
    ("anio", "numeric"), ("region", "character"), ("tramo", "character"), *[(c, "numeric") for c in _VALUES]])))
def pl_report_profile(spark, d):
    return _sig_profile(_report(spark, d, "profile"))


@query("pl_report_shape", with_panel(_CELLS + """SELECT count(*) AS n_rows,
  (SELECT CAST(len(json_keys(to_json(agg))) AS BIGINT) FROM agg LIMIT 1) AS n_cols FROM agg"""))
def pl_report_shape(spark, d):
    return _report(spark, d, "shape")


@query("pl_report_duplicates", with_panel(_CELLS + """SELECT CAST(count(*) AS BIGINT) AS n_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM agg)) AS n_distinct FROM agg"""))
def pl_report_duplicates(spark, d):
    return _report(spark, d, "duplicates")


def _missing_sql(c: str) -> str:
    share = f"CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / CAST(count(DISTINCT region) * count(DISTINCT tramo) AS DOUBLE)"
    return f"SELECT anio, '{c}' AS variable, {sql_sig(share)} AS pct_faltantes FROM agg GROUP BY anio"


@query("pl_report_missing", with_panel(_CELLS + "\nUNION ALL\n".join(_missing_sql(c) for c in _VALUES)))
def pl_report_missing(spark, d):
    return sig_all(_report(spark, d, "missing"))


@query("pl_report_distribution", with_panel(_CELLS + _dist_sql(_VALUES, "tramo", None, "agg")))
def pl_report_distribution(spark, d):
    return sig_all(_report(spark, d, "distribution"))


def _evolution_sql(measure: str, name: str, log: str) -> str:
    logged = f"CASE WHEN count({measure}) = count(*) AND sum({measure}) > 0 THEN {log}(sum({measure})) END"
    return with_panel(_CELLS + f"""SELECT anio, tramo, CASE WHEN count({measure}) = count(*) THEN sum({measure}) END AS {name},
  {sql_sig(logged)} AS log_{name} FROM agg GROUP BY anio, tramo""")


@query("pl_report_firms", _evolution_sql("numero_empresas", "cant_empresas", "ln"))
def pl_report_firms(spark, d):
    return sig_all(_report(spark, d, "firms"), ["log_cant_empresas"])


@query("pl_report_staff", _evolution_sql("pessoal_ocupado", "cant_empleados", "log10"))
def pl_report_staff(spark, d):
    return sig_all(_report(spark, d, "staff"), ["log_cant_empleados"])


# ---------------------------------------------------------------- PL11
_WELFARE_SQL = with_panel("""
, g AS (SELECT r_name, n_name AS region, CAST(year(o_orderdate) AS INTEGER) AS anio,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS pob, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS val,
  CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS DOUBLE) AS low
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'ASIA') GROUP BY ALL),
w AS (SELECT CASE r_name WHEN 'EUROPE' THEN 'Italia' ELSE 'España' END AS pais, p.numero_empresas / g.pob * 1000 AS ent_per_1000,
  g.val / g.pob AS pbi_per_capita, g.low / g.n * 100 AS tasa_pobreza, CASE WHEN g.low > 0 THEN g.val / g.n / 1e6 END AS hdi
  FROM g JOIN panel p ON g.region = p.region AND g.anio = p.anio WHERE p.tramo = 'AUTOMOBILE')
""")


@query("pl_regional_welfare_pairs", _WELFARE_SQL + "\nUNION ALL\n".join(
    f"SELECT pais, '{a}' AS var_x, '{b}' AS var_y, "
    f"{sql_sig(f'regr_sxy({b}, {a}) / nullif(sqrt(regr_sxx({b}, {a}) * regr_syy({b}, {a})), 0)')} AS corr, "
    f"CAST(regr_count({b}, {a}) AS BIGINT) AS n FROM w GROUP BY pais"
    for i, a in enumerate(C.WELFARE) for b in C.WELFARE[i + 1:]))
def pl_regional_welfare_pairs(spark, d):
    return sig_all(C.regional_pairs(C.welfare_panel(spark, d))["correlations"]())


@query("pl_regional_marginals", _WELFARE_SQL + f""", l AS (SELECT pais, variable, valor AS v FROM w
  UNPIVOT (valor FOR variable IN ({", ".join(C.WELFARE)}))),
r AS (SELECT pais, variable, min(v) AS lo, max(v) AS hi FROM l GROUP BY ALL),
b AS (SELECT l.pais, l.variable, lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin
  FROM l JOIN r ON l.pais = r.pais AND l.variable = r.variable)
SELECT pais, variable, bin, {sql_sig('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30)')} AS bin_low,
  {sql_sig('any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 30)')} AS bin_high, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY pais, variable, bin""")
def pl_regional_marginals(spark, d):
    return sig_all(C.regional_pairs(C.welfare_panel(spark, d))["marginals"]())


def _upper_tail(t: float, v: int) -> float:
    """P(T > t): half the regularized incomplete beta function at v / (v + t^2),
    by its continued fraction (modified Lentz steps)."""
    x, a, b = v / (v + t * t), v / 2, 0.5
    if x > (a + 1) / (a + b + 2):
        x, a, b, turned = 1 - x, b, a, True
    else:
        turned = False
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / (1 + num * d), 1 + num / c
            value *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    i = front * value
    return (1 - i if turned else i) / 2


def _t_sql(most: int = 200) -> str:
    """(degrees, 0.975 quantile) rows for the oracle, by bisection on the tail:
    another way than the library's."""
    out = []
    for v in range(1, most + 1):
        lo, hi = 1.9, 13.0
        while hi - lo > 1e-15 * hi:
            mid = (lo + hi) / 2
            if mid in (lo, hi):
                break
            lo, hi = (mid, hi) if _upper_tail(mid, v) > 0.025 else (lo, mid)
        out.append(f"({v}, {lo!r}::DOUBLE)")
    return ", ".join(out)


@query("pl_regional_ribbon", _WELFARE_SQL + f""", f AS (SELECT pais, CAST(regr_count(pbi_per_capita, ent_per_1000) AS BIGINT) AS n,
  regr_sxx(pbi_per_capita, ent_per_1000) AS sxx, regr_syy(pbi_per_capita, ent_per_1000) AS syy,
  regr_sxy(pbi_per_capita, ent_per_1000) AS sxy, regr_avgx(pbi_per_capita, ent_per_1000) AS mx,
  regr_avgy(pbi_per_capita, ent_per_1000) AS my, min(ent_per_1000) AS lo, max(ent_per_1000) AS hi
  FROM w WHERE ent_per_1000 IS NOT NULL AND pbi_per_capita IS NOT NULL GROUP BY pais),
x AS (SELECT f.*, sxy / sxx AS slope, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS sigma, lo + (hi - lo) * i / 79 AS x,
  CAST(1.9599639845400542 AS DOUBLE) AS z, CAST(n - 2 AS DOUBLE) AS v FROM f, (SELECT unnest(range(80)) AS i)),
q(df, tq) AS (VALUES {_t_sql()}),
t AS (SELECT x.*, coalesce(tq, z + (z ** 3 + z) / 4 / v + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96 / v ** 2
  + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384 / v ** 3
  + (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160 / v ** 4) AS t
  FROM x LEFT JOIN q ON q.df = x.n - 2),
b AS (SELECT pais, x, my - slope * mx + slope * x AS fit, t * sigma * sqrt(1.0 / n + (x - mx) ** 2 / sxx) AS half FROM t)
SELECT pais, {sql_sig('x')} AS ent_per_1000, {sql_sig('fit')} AS fit, {sql_sig('fit - half')} AS lower, {sql_sig('fit + half')} AS upper
FROM b""")
def pl_regional_ribbon(spark, d):
    return sig_all(C.regional_pairs(C.welfare_panel(spark, d))["ribbon"]())
