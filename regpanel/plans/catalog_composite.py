"""Catalogue: composite jobs PL1-PL11."""

from __future__ import annotations

from regpanel.plans import composites as C
from regpanel.plans.catalog_io import national_file_reader, scratch
from regpanel.plans.catalog_shape import _SHEETS, CROSSTAB_SQL, panel_cells
from regpanel.plans.catalog_stats import _dist_sql, _profile_sql, _sig_profile
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, sig_all, sql_sig

_PL1_SQL = f"SELECT variable, anio, sector, region, tramo, value FROM ({CROSSTAB_SQL})"


@query("pl_crosstab_to_panel", _PL1_SQL)
def pl_crosstab_to_panel(spark, d):
    return C.crosstab_to_panel(spark, panel_cells(spark, d), scratch(spark, "pl1"))


_MEASURE_NAMES = [s[2] for s in _SHEETS.values()]


@query("pl_assemble_measures", "SELECT anio, sector, region, tramo, "
       + ", ".join(f"max(value) FILTER (WHERE variable = '{m}') AS {m}" for m in _MEASURE_NAMES)
       + f" FROM ({_PL1_SQL}) GROUP BY ALL")
def pl_assemble_measures(spark, d):
    path = scratch(spark, "pl2")
    C.crosstab_to_panel(spark, panel_cells(spark, d), path)
    return C.finish(spark, C.assemble_measures(spark, path, _MEASURE_NAMES), scratch(spark, "pl2_final"))


@query("pl_series_wide", f"""WITH f AS (SELECT event_type AS code, CAST(ts AS DATE) AS date,
  CASE WHEN try_cast(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'States' ELSE 'Municipalities' END AS uname,
  CAST(user_id AS VARCHAR) AS tcode, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events WHERE event_type IN ('purchase', 'signup', 'error') GROUP BY ALL),
t AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS tcode, 'Estado ' || CAST(user_id AS VARCHAR) AS tname,
  CAST(user_id AS DOUBLE) AS area FROM events),
w AS (SELECT f.date AS anio, t.tname AS region, t.area AS area_km2,
  max(value) FILTER (WHERE code = 'purchase') AS compras, max(value) FILTER (WHERE code = 'signup') AS altas,
  max(value) FILTER (WHERE code = 'error') AS errores
  FROM f JOIN t USING (tcode) WHERE uname = 'States' GROUP BY ALL)
SELECT anio, region, area_km2, compras, altas, errores, {sql_sig('compras / nullif(area_km2, 0)')} AS densidad FROM w""")
def pl_series_wide(spark, d):
    return sig_all(C.finish(spark, C.series_wide(spark, d), scratch(spark, "pl3_final")), ["densidad"])


PL4_SQL = """WITH f AS (SELECT event_type AS ind, CAST(ts AS DATE) AS anio,
  'Dpto ' || CAST(user_id AS VARCHAR) AS departamento, sum(CAST(value AS DECIMAL(18,2))) AS v
  FROM events GROUP BY ALL),
g AS (SELECT ind, anio, departamento, CASE WHEN v < 2 THEN NULL ELSE CAST(v AS DOUBLE) END AS v FROM f)
SELECT c.anio, c.departamento, c.v AS click, e.v AS error, p.v AS purchase, s.v AS signup, w.v AS view
FROM (SELECT * FROM g WHERE ind = 'click') c
LEFT JOIN (SELECT * FROM g WHERE ind = 'error') e ON c.anio = e.anio AND c.departamento = e.departamento
LEFT JOIN (SELECT * FROM g WHERE ind = 'purchase') p ON c.anio = p.anio AND c.departamento = p.departamento
LEFT JOIN (SELECT * FROM g WHERE ind = 'signup') s ON c.anio = s.anio AND c.departamento = s.departamento
LEFT JOIN (SELECT * FROM g WHERE ind = 'view') w ON c.anio = w.anio AND c.departamento = w.departamento"""


@query("pl_natural_merge", PL4_SQL)
def pl_natural_merge(spark, d):
    files = [C.indicator_file(spark, d, i) for i in C.natural_files(spark, d)]
    return C.natural_merge(files)


PL4_UNLIKE_SQL = """WITH e AS (SELECT event_type AS ind, CAST(ts AS DATE) AS anio, user_id,
  'Dpto ' || CAST(user_id AS VARCHAR) AS departamento, 'T' || CAST(user_id % 3 AS VARCHAR) AS tramo, CAST(value AS DECIMAL(18,2)) AS x
  FROM events),
d AS (SELECT ind, anio, departamento, tramo, sum(x) AS s, CASE WHEN sum(x) < 2 THEN NULL ELSE CAST(sum(x) AS DOUBLE) END AS v
  FROM e GROUP BY ALL),
w AS (SELECT departamento, CASE WHEN sum(x) < 2 THEN NULL ELSE CAST(sum(x) AS DOUBLE) END AS v FROM e WHERE ind = 'view' GROUP BY ALL)
SELECT c.anio, c.departamento, c.tramo, c.v AS click, p.v AS purchase, s.v AS signup, w.v AS view, r.v AS error
FROM (SELECT * FROM d WHERE ind = 'click') c
LEFT JOIN (SELECT * FROM d WHERE ind = 'purchase') p ON c.anio = p.anio AND c.departamento = p.departamento
LEFT JOIN (SELECT * FROM d WHERE ind = 'signup') s ON c.anio = s.anio AND c.departamento = s.departamento
LEFT JOIN w ON c.departamento = w.departamento
LEFT JOIN (SELECT * FROM d WHERE ind = 'error') r
  ON c.anio = r.anio AND c.departamento = r.departamento AND c.tramo = r.tramo"""


@query("pl_natural_merge_unlike", PL4_UNLIKE_SQL)
def pl_natural_merge_unlike(spark, d):
    """Files with other columns each, merged from one scan of their folder."""
    root = scratch(spark, "pl4_unlike")
    C.unlike_files(spark, d, root)
    return C.natural_merge_unlike(spark, f"{root}/*", name_from="dir")


NO_INFO_STAND_IN = "NATION_0"  # the panel region playing "no information"


@query("pl_natural_merge_folder", PL4_SQL)
def pl_natural_merge_folder(spark, d):
    """The indicator files landed in one folder (one file per indicator), merged
    from a single scan."""
    root = scratch(spark, "pl4_folder")
    for ind in C.natural_files(spark, d):
        C.indicator_file(spark, d, ind).write.mode("overwrite").parquet(f"{root}/{ind}.parquet")
    merged = C.natural_merge_folder(spark, f"{root}/*.parquet", ["anio", "Departamento"], name_from="dir")
    return C.finish(spark, merged, scratch(spark, "pl4_final"))


def _share_sql(corrected: bool) -> str:
    def strict(x):
        return f"CASE WHEN count({x}) OVER w = count(*) OVER w THEN sum({x}) OVER w END"
    net = ("fmh / nullif(" + strict("fmh") + ", 0)") if corrected else \
          ("valor_total + salario_medio + pedidos / nullif(" + strict("fmh") + ", 0)")
    return with_panel(f"""
, p AS (SELECT *, valor_total + salario_medio + pedidos AS fmh, pedidos + pessoal_ocupado AS emp
  FROM panel WHERE region <> 'NATION_0')
SELECT anio, region, tramo, sector,
  {sql_sig(f"numero_empresas / nullif({strict('numero_empresas')}, 0)")} AS contribucion_po,
  {sql_sig(f"emp / nullif({strict('emp')}, 0)")} AS contribucion_empleo,
  {sql_sig(f"valor_total / nullif({strict('valor_total')}, 0)")} AS contribucion_vtas,
  {sql_sig(net)} AS contribucion_sal_neto,
  numero_empresas, emp AS trabajadores, valor_total AS ventas, {sql_sig('fmh')} AS sal_neto
FROM p WINDOW w AS (PARTITION BY anio, region)""")


@query("pl_share_panel", _share_sql(False))
def pl_share_panel(spark, d):
    return sig_all(C.share_panel(panel(spark, d), no_info=NO_INFO_STAND_IN), ["contribucion_po", "contribucion_empleo", "contribucion_vtas",
                                                     "contribucion_sal_neto", "sal_neto"])


@query("pl_share_panel_corrected", _share_sql(True))
def pl_share_panel_corrected(spark, d):
    return sig_all(C.share_panel(panel(spark, d), corrected=True, no_info=NO_INFO_STAND_IN),
                   ["contribucion_po", "contribucion_empleo", "contribucion_vtas", "contribucion_sal_neto", "sal_neto"])


@query("pl_indicator_panel", """WITH j AS (SELECT upper(substr(r_name, 1, 2)) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geo,
  CASE WHEN o_totalprice < 50000 THEN '0' WHEN o_totalprice < 200000 THEN '1-9' ELSE 'GE10' END AS sizeclas,
  make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS time_period, o_custkey, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT geo, sizeclas, time_period, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS V11910,
  CAST(count(*) AS DOUBLE) AS V16910, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS V97020 FROM j GROUP BY ALL),
facts AS (SELECT * FROM g UNPIVOT INCLUDE NULLS (vals FOR indic_sb IN (V11910, V16910, V97020))),
countries AS (SELECT upper(substr(r_name, 1, 2)) AS code, upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2, 100)) AS pais
  FROM region WHERE lower(r_name) IN ('europe', 'asia')),
geo AS (SELECT upper(substr(r_name, 1, 2)) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS id, n_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
u AS (SELECT DISTINCT c.pais, geo.region, f.time_period, f.indic_sb, f.sizeclas, f.vals
  FROM facts f JOIN countries c ON substr(f.geo, 1, 2) = c.code JOIN geo ON f.geo = geo.id),
m AS (SELECT * FROM (VALUES ('V11910', 'ENT_NR'), ('V16910', 'EMP_NR')) t(hist, new)),
v AS (SELECT u.*, coalesce(m.new, u.indic_sb) AS variables FROM u LEFT JOIN m ON u.indic_sb = m.hist)
SELECT pais, region, replace(replace(sizeclas, '-', ' a '), 'GE', '+') AS tramo,
  strftime(time_period, '%Y') AS anio, max(vals) FILTER (WHERE variables = 'ENT_NR') AS ent_nr,
  max(vals) FILTER (WHERE variables = 'EMP_NR') AS emp_nr, max(vals) FILTER (WHERE variables = 'V97020') AS v97020
FROM v GROUP BY pais, region, sizeclas, time_period""")
def pl_indicator_panel(spark, d):
    return C.indicator_panel(spark, d, scratch(spark, "pl6"))


def _control_sql(cntr: str, region_name: str, national: bool, corrected: bool = True) -> str:
    title = "(upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)))"
    tl = "replace(strip_accents(lower({x})), 'ß', 'ss')"
    base = f"""WITH o AS (SELECT 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geo,
  make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS time, o_custkey, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (SELECT geo, time, CAST(count(*) AS DOUBLE) AS ord_cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ord_val,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS cust_cnt FROM o GROUP BY ALL),
rg AS (SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS id_region, n_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE upper(substr(r_name, 1, 2)) = '{cntr}'),
eu AS (SELECT g.time AS anio, rg.id_region, rg.region, g.ord_cnt AS pedidos, 'NR' AS pedidos_unidad,
  g.ord_val AS pbi_per_capita, 'EUR_HAB' AS pbi_per_capita_unidad, g.cust_cnt AS pobl_total, 'NR' AS pobl_total_unidad
  FROM g JOIN rg ON g.geo = rg.id_region WHERE year(g.time) BETWEEN 1990 AND 2030),
h AS (SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio,
  lower(CASE WHEN n_nationkey % 2 = 1 THEN translate({title}, 'aio', 'áíó') ELSE {title} END) AS k,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1e6 AS hdi, 'Indice' AS hdi_unidad
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{region_name}' AND year(o_orderdate) > 1990 GROUP BY ALL),
b AS (SELECT eu.*, h.hdi, h.hdi_unidad FROM eu LEFT JOIN h ON {tl.format(x='eu.region')} = h.k AND eu.anio = h.anio)"""
    if not national:
        return base + f"\nSELECT * REPLACE ({sql_sig('hdi')} AS hdi) FROM b"
    whens = " ".join(f"WHEN regexp_matches(region, '{p}') THEN '{t}'" for p, t in C.NATIONAL_RECODE)
    rc = f"CASE {whens} ELSE {tl.format(x='region')} END"
    key = tl.format(x=f"trim({rc})") if corrected else f"lower({rc})"
    return base + f""",
nat AS (SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio, n_name AS region,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ventas, 'Euros' AS ventas_unidad
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
nk AS (SELECT {key} AS k, anio, ventas, ventas_unidad FROM nat)
SELECT b.* REPLACE ({sql_sig('b.hdi')} AS hdi), nk.ventas, nk.ventas_unidad FROM b
LEFT JOIN nk ON {tl.format(x='b.region')} = nk.k AND b.anio = nk.anio"""


@query("pl_control_panel_eu", _control_sql("EU", "EUROPE", False))
def pl_control_panel_eu(spark, d):
    return sig_all(C.control_panel_eu(spark, d, "EU", "EUROPE", scratch(spark, "pl8")), ["hdi"])


@query("pl_control_panel_national", _control_sql("AM", "AMERICA", True))
def pl_control_panel_national(spark, d):
    nat = national_file_reader(spark, d)
    out = C.control_panel_national(spark, d, "AM", "AMERICA", scratch(spark, "pl7"), nat)
    return sig_all(out, ["hdi"])


@query("pl_control_panel_national_as_is", _control_sql("AM", "AMERICA", True, corrected=False))
def pl_control_panel_national_as_is(spark, d):
    nat = national_file_reader(spark, d)
    out = C.control_panel_national(spark, d, "AM", "AMERICA", scratch(spark, "pl7a"), nat, corrected=False)
    return sig_all(out, ["hdi"])


_AGG_SQL = """agg AS (SELECT anio, region, tramo,
  nullif(coalesce(sum(numero_empresas), 0), 0) AS numero_empresas, nullif(coalesce(sum(pedidos), 0), 0) AS pedidos,
  nullif(coalesce(sum(pessoal_ocupado), 0), 0) AS pessoal_ocupado, nullif(coalesce(sum(valor_total), 0), 0) AS valor_total,
  nullif(avg(salario_medio), 0) AS salario_medio FROM panel GROUP BY ALL)"""


@query("pl_eda_aggregated", with_panel(", " + _AGG_SQL + "\n" + _dist_sql(
    ["numero_empresas", "pedidos", "pessoal_ocupado", "valor_total", "salario_medio"], "tramo", None, "agg")))
def pl_eda_aggregated(spark, d):
    return sig_all(C.eda_aggregated(panel(spark, d)))


@query("pl_eda_salary_box", with_panel(", " + _AGG_SQL + f"""
, y AS (SELECT 'salario_medio' AS variable, tramo, ln(salario_medio) AS v FROM agg WHERE salario_medio > 0),
q AS (SELECT variable, tramo, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM y GROUP BY ALL),
b AS (SELECT y.*, q.n, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
  FROM y JOIN q USING (variable, tramo))
SELECT variable, tramo, any_value(n) AS n, {sql_sig('any_value(q1)')} AS q1, {sql_sig('any_value(median)')} AS median,
  {sql_sig('any_value(q3)')} AS q3, {sql_sig('min(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_low,
  {sql_sig('max(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_high,
  CAST(count(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS BIGINT) AS n_outliers,
  CASE WHEN length(variable) > 20 THEN substr(variable, 1, 9) || '..' || right(variable, 9) ELSE variable END AS etiqueta
FROM b GROUP BY variable, tramo"""))
def pl_eda_salary_box(spark, d):
    return sig_all(C.eda_salary_box(panel(spark, d)))


@query("pl_eda_direct", with_panel(f"""
SELECT anio, tramo, CASE WHEN count(numero_empresas) = count(*) THEN sum(numero_empresas) END AS cant_empresas,
  CASE WHEN count(pessoal_ocupado) = count(*) THEN sum(pessoal_ocupado) END AS cant_empleados,
  {sql_sig('CASE WHEN count(salario_medio) = count(*) THEN avg(salario_medio) END')} AS salario_prom,
  {sql_sig('CASE WHEN count(numero_empresas) = count(*) AND sum(numero_empresas) > 0 THEN ln(sum(numero_empresas)) END')} AS log_empresas,
  {sql_sig('CASE WHEN count(pessoal_ocupado) = count(*) AND sum(pessoal_ocupado) > 0 THEN log10(sum(pessoal_ocupado)) END')} AS log10_empleados
FROM panel GROUP BY anio, tramo"""))
def pl_eda_direct(spark, d):
    return sig_all(C.eda_direct(panel(spark, d)), ["salario_prom", "log_empresas", "log10_empleados"])


_EU_SQL = with_panel("""
, g AS (SELECT r_name, n_name AS region, CAST(year(o_orderdate) AS INTEGER) AS anio,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS pob, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS val
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
ctl AS (SELECT region, anio, pob, val / pob AS pbi_per_capita,
  CASE r_name WHEN 'EUROPE' THEN 'Italia' ELSE 'España' END AS pais FROM g WHERE r_name IN ('EUROPE', 'ASIA')),
p AS (SELECT anio, region, tramo, sector, numero_empresas AS ent_nr, pessoal_ocupado AS emp_nr,
  CASE WHEN sector <> '5-LOW' THEN 'pymes' END AS pais FROM panel),
df AS (SELECT c.region, c.anio, c.pbi_per_capita, p.tramo, p.sector, p.ent_nr, p.emp_nr,
  coalesce(c.pais, p.pais) AS pais, c.pob AS poblacion FROM ctl c JOIN p ON c.region = p.region AND c.anio = p.anio),
eu AS (SELECT *, ent_nr / nullif(poblacion, 0) * 1000 AS ent_per_1000, emp_nr / nullif(poblacion, 0) * 100 AS tasa_empleo_pyme
  FROM df)""")

PL11_SQL = _EU_SQL + f"""
, x AS (SELECT * FROM eu WHERE tramo = 'AUTOMOBILE'),
m AS (SELECT *, median(ent_per_1000) OVER (PARTITION BY pais) AS mediana_pyme,
  median(pbi_per_capita) OVER (PARTITION BY pais) AS mediana_pbi FROM x)
SELECT pais, region, anio, sector, {sql_sig('ent_per_1000')} AS ent_per_1000, {sql_sig('tasa_empleo_pyme')} AS tasa_empleo_pyme,
  {sql_sig('pbi_per_capita')} AS pbi_per_capita, {sql_sig('mediana_pyme')} AS mediana_pyme, {sql_sig('mediana_pbi')} AS mediana_pbi,
  CASE WHEN ent_per_1000 >= mediana_pyme AND pbi_per_capita >= mediana_pbi THEN '{C.QUADRANTS[0]}'
       WHEN ent_per_1000 < mediana_pyme AND pbi_per_capita >= mediana_pbi THEN '{C.QUADRANTS[1]}'
       WHEN ent_per_1000 >= mediana_pyme AND pbi_per_capita < mediana_pbi THEN '{C.QUADRANTS[2]}'
       WHEN ent_per_1000 < mediana_pyme AND pbi_per_capita < mediana_pbi THEN '{C.QUADRANTS[3]}' END AS patron
FROM m"""


@query("pl_regional_quadrants", PL11_SQL)
def pl_regional_quadrants(spark, d):
    return sig_all(C.regional_quadrants(spark, d), ["ent_per_1000", "tasa_empleo_pyme", "pbi_per_capita",
                                                    "mediana_pyme", "mediana_pbi"])


@query("pl_regional_fit", _EU_SQL + f"""
, g2 AS (SELECT pais, regr_count(pbi_per_capita, ent_per_1000) AS n, regr_sxx(pbi_per_capita, ent_per_1000) AS sxx,
  regr_syy(pbi_per_capita, ent_per_1000) AS syy, regr_sxy(pbi_per_capita, ent_per_1000) AS sxy,
  regr_avgx(pbi_per_capita, ent_per_1000) AS mx, regr_avgy(pbi_per_capita, ent_per_1000) AS my
  FROM eu WHERE tramo = 'AUTOMOBILE' GROUP BY pais)
SELECT pais, CAST(n AS BIGINT) AS n, {sql_sig('sxy / nullif(sxx, 0)')} AS slope,
  {sql_sig('my - sxy / nullif(sxx, 0) * mx')} AS intercept, {sql_sig('sxy * sxy / nullif(sxx * syy, 0)')} AS r2,
  {sql_sig('CASE WHEN n > 2 THEN sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0.0) / (n - 2)) END')} AS sigma,
  {sql_sig('mx')} AS mean_x, {sql_sig('sxx')} AS sxx FROM g2""")
def pl_regional_fit(spark, d):
    return sig_all(C.regional_fit(spark, d))


_REG_CORR = ["ent_per_1000", "pbi_per_capita", "tasa_empleo_pyme"]


@query("pl_regional_correlations", _EU_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT pais, '{a}' AS var_x, '{b}' AS var_y, "
    f"{sql_sig(f'regr_sxy({b}, {a}) / nullif(sqrt(regr_sxx({b}, {a}) * regr_syy({b}, {a})), 0)')} AS corr, "
    f"CAST(regr_count({b}, {a}) AS BIGINT) AS n FROM eu WHERE tramo = 'AUTOMOBILE' GROUP BY pais"
    for i, a in enumerate(_REG_CORR) for b in _REG_CORR[i + 1:]))
def pl_regional_correlations(spark, d):
    return sig_all(C.regional_correlations(spark, d))


@query("pl_regional_box_latest", _EU_SQL + f"""
, lt AS (SELECT * FROM eu WHERE anio = (SELECT max(anio) FROM eu) AND (SELECT count(*) FROM eu WHERE anio IS NULL) = 0),
y AS (SELECT tramo, pais, log10(ent_nr) AS v FROM lt WHERE ent_nr > 0),
q AS (SELECT tramo, pais, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM y GROUP BY ALL),
b AS (SELECT y.*, q.n, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
  FROM y JOIN q USING (tramo, pais))
SELECT tramo, pais, any_value(n) AS n, {sql_sig('any_value(q1)')} AS q1, {sql_sig('any_value(median)')} AS median,
  {sql_sig('any_value(q3)')} AS q3, {sql_sig('min(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_low,
  {sql_sig('max(v) FILTER (WHERE v >= lo AND v <= hi)')} AS whisker_high,
  CAST(count(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS BIGINT) AS n_outliers FROM b GROUP BY tramo, pais""")
def pl_regional_box_latest(spark, d):
    return sig_all(C.regional_box_latest(spark, d))


_REG_PROFILE = [("ent_nr", "numeric"), ("emp_nr", "numeric"), ("pbi_per_capita", "numeric"),
                ("ent_per_1000", "numeric"), ("tramo", "character")]


@query("pl_regional_profile", _EU_SQL + "\n" + _profile_sql("eu", _REG_PROFILE, ["pais"]))
def pl_regional_profile(spark, d):
    return _sig_profile(C.regional_profile(spark, d))
