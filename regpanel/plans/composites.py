"""Composite jobs (PL1-PL11): the reference's scripts and notebooks
rebuilt from the operators, run on data derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regpanel.constants import (CONTROL_PERIOD, ES_EU_SPECS, ES_NATIONAL_FILES, ES_NUTS2, IT_EU_SPECS, IT_NUTS2, MISSING_TOKEN,
                                NO_INFO_REGION, QUADRANT_LABELS)
from regpanel.functions import selectors as S
from regpanel.functions.dates import date_to_year_text, year_to_date
from regpanel.functions.exprs import r_div, strict_mean, strict_sum, log_pos
from regpanel.functions.text import band_recode, missing_token, sanitize_name, translit_lower
from regpanel.operators import aggregate as A
from regpanel.operators import joins as J
from regpanel.operators import project as P
from regpanel.operators import windows as W
from regpanel.operators.profile import profile
from regpanel.operators.cells import fill_merged, row_to_names
from regpanel.operators.reshape import crosstab_normalise, distinct_names, pivot_longer, pivot_wider
from regpanel.plans.panel import panel
from regpanel.plans.registry import table
from regpanel.session import scratch_path
from regpanel.sources import readers as R
from regpanel.sources import sinks as K


# ------------------------------------------------------------------ PL1 PL2
def crosstab_to_panel(spark: SparkSession, cells: DataFrame, out_path: str) -> DataFrame:
    """PL1: every sheet normalised in one job, one output folder per measure."""
    long = crosstab_normalise(cells).drop("sheet")
    K.sized_by_group(long, "variable").write.mode("overwrite").partitionBy("variable").parquet(out_path)
    return spark.read.parquet(out_path)


def assemble_measures(spark: SparkSession, path: str, measures: list[str]) -> DataFrame:
    """PL2: the per-measure outputs side by side on the panel keys (the
    positional cbind re-aimed as a pivot on the measure name)."""
    long = spark.read.parquet(path)
    return pivot_wider(long, ["anio", "sector", "region", "tramo"], "variable", "value",
                       values=measures, on_duplicate="error")


# ------------------------------------------------------------------ PL3
# Catalogue stand-in: event types as series codes -> output name
# (the source's codes are constants.BR_SERIES).
SERIES_NAMES = {"purchase": "compras", "signup": "altas", "error": "errores"}


def series_facts(spark, d):
    """Events as territory series: code, date, value, uname, tcode."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return (e.where(F.col("event_type").isin(list(SERIES_NAMES)))
             .groupBy(F.col("event_type").alias("code"), F.col("ts").cast("date").alias("date"),
                      F.when(k < 50, "States").otherwise("Municipalities").alias("uname"),
                      F.col("user_id").alias("tcode"))
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")))


def territories(spark, d):
    u = table(spark, d, "events").select("user_id").distinct()
    return u.select(F.col("user_id").cast("string").alias("tcode"),
                    F.concat(F.lit("Estado "), F.col("user_id").cast("string")).alias("tname"),
                    F.col("user_id").cast("double").alias("area"))


def series_wide_from(facts: DataFrame, territories: DataFrame, names: dict[str, str],
                     density: tuple[str, str, str] | None = None, level: str = "States") -> DataFrame:
    """PL3 core: series facts (code, date, value, uname, tcode) filtered to one
    territory level (a single scan over all codes), joined to the territories
    (tcode, tname, area) on the text code, pivoted to one column per code
    (duplicates raise), renamed by ``names`` (code -> column), plus
    ``density = (name, numerator, denominator)`` as a NULL-safe ratio."""
    f = (facts.where(F.col("code").isin(list(names)) & (F.col("uname") == level))
              .withColumn("tcode", F.col("tcode").cast("string")))
    j = J.join(f, territories.withColumn("tcode", F.col("tcode").cast("string")), ["tcode"], "inner")
    wide = pivot_wider(j, ["date", "tname", "area"], "code", "value", values=list(names))
    wide = P.rename(wide, {"date": "anio", "tname": "region", "area": "area_km2", **names})
    if density:
        name, num, den = density
        wide = wide.withColumn(name, r_div(num, den))
    return wide


def series_wide(spark, d) -> DataFrame:
    """PL3 on the driver-derived series (the source's codes are
    constants.BR_SERIES, with density = pobl_total / area_km2)."""
    return series_wide_from(series_facts(spark, d), territories(spark, d), SERIES_NAMES,
                            density=("densidad", "compras", "area_km2"))


# ------------------------------------------------------------------ PL4
def natural_files(spark, d) -> list[str]:
    """The indicators that are landed, one file each, in the order of the file names."""
    return distinct_names(table(spark, d, "events"), "event_type")


def indicator_file(spark, d, indicator: str) -> DataFrame:
    """One landed indicator file: Año, Departamento, Indicador, Valor (text,
    'SIN DATOS' when the daily total is below 2)."""
    e = table(spark, d, "events").where(F.col("event_type") == indicator)
    g = e.groupBy(F.col("ts").cast("date").cast("string").alias("Año"),
                  F.concat(F.lit("Dpto "), F.col("user_id").cast("string")).alias("Departamento")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("__v"))
    return g.select("Año", "Departamento", F.lit(indicator).alias("Indicador"), F.lit("Todos").alias("Sector"),
                    F.when(F.col("__v") < 2, F.lit(MISSING_TOKEN)).otherwise(F.col("__v").cast("string")).alias("Valor"))


# Column renames of the landed indicator files.
INDICATOR_RENAMES = {"Año": "anio", "Tamaño": "tramo"}


def natural_merge(files: list[DataFrame]) -> DataFrame:
    """PL4: rename Valor to the file's indicator (its one distinct Indicador
    value, checked) and Año/Tamaño to anio/tramo, sanitise names, natural
    left-join chain (base = first file), SIN DATOS -> NULL, type guess."""
    tables = []
    for f in files:
        ind = P.single_value(f, "Indicador")
        ren = {k: v for k, v in INDICATOR_RENAMES.items() if k in f.columns}
        t = P.rename(f, {"Valor": ind, **ren})
        t = P.rename_with(t, sanitize_name)
        tables.append(t.drop("indicador", "sector"))
    m = J.left_join_chain(tables)
    m = m.select(*[missing_token(c).alias(c) for c in m.columns])
    return P.parse_guess(m)


def natural_merge_folder(spark, path: str, keys: list[str], fmt: str = "parquet",
                         indicator_col: str = "Indicador", value_col: str = "Valor",
                         drop: tuple[str, ...] = ("Sector",), rename: dict | None = None,
                         name_from: str = "file") -> DataFrame:
    """PL4 at scale: ONE scan of the folder of indicator files.  Each file must
    hold exactly one indicator (checked in one aggregation); the base of the
    left-join chain is the alphabetically first file; the chain itself is one
    conditional aggregation restricted to the base file's keys (keys checked
    unique), then SIN DATOS -> NULL and the type guess.  ``name_from="dir"``
    names each input by its parent folder (Spark-written datasets)."""
    df = spark.read.format(fmt).load(path).withColumn("__file", F.col("_metadata.file_path"))
    part = (r"/([^/]+)/[^/]+$" if name_from == "dir" else r"/([^/]+)$")
    stem = F.regexp_extract(F.regexp_extract("__file", part, 1), r"^(.*?)(\.[^.]*)?$", 1)
    # NULL is a value of its own: a file with an indicator and NULLs holds two
    files = (df.groupBy(stem.alias("__stem")).agg(
        (F.count_distinct(indicator_col) + F.max(F.col(indicator_col).isNull().cast("int"))).alias("__n"),
        F.min(indicator_col).alias("__ind")).orderBy("__stem").collect())  # one row per indicator file
    if any(r["__n"] != 1 or r["__ind"] is None for r in files):
        raise ValueError("natural_merge_folder: a file holds more than one indicator, or none")
    indicators = [r["__ind"] for r in files]
    if len(set(indicators)) < len(indicators):
        raise ValueError("natural_merge_folder: two files hold the same indicator")
    d = df.drop("__file", *drop)
    if rename is None:
        rename = {k: v for k, v in INDICATOR_RENAMES.items() if k in d.columns}
    if rename:
        d = d.withColumnsRenamed(rename)
    wide = J.fold_as_pivot(d, keys, indicator_col, [value_col], indicators, base=indicators[0])
    wide = P.rename_with(wide, sanitize_name)
    wide = wide.select(*[missing_token(c).alias(c) for c in wide.columns])
    return P.parse_guess(wide)


def natural_merge_unlike(spark, path: str, indicator_col: str = "Indicador", value_col: str = "Valor",
                         drop: tuple[str, ...] = ("indicador", "sector"), name_from: str = "file") -> DataFrame:
    """PL4 over files whose columns differ, from ONE scan of the folder.  Every
    file's header is found in that scan, its value column takes the name of its
    one indicator, and the keys are what a step's file shares with the files
    before it (a shared measure becomes a key), as in the file-by-file chain;
    steps with the same keys are one aggregate.  Then SIN DATOS -> NULL and the
    type guess.  The rows are landed by file number, so a step reads its file only."""
    found, rows = R.read_unlike_folder(spark, path, name_from=name_from)
    landed = scratch_path(spark, "natural")
    rows.write.mode("overwrite").partitionBy("file_no").parquet(landed)
    rows = spark.read.schema("values array<string>, file_no int").parquet(landed)
    place = F.element_at(F.create_map(*[x for i, (_, h) in found.items() for x in (F.lit(i), F.lit(h.index(indicator_col)))]),
                         F.col("file_no"))
    ind = F.get("values", place)
    names = {r["file_no"]: r for r in rows.groupBy("file_no").agg(
        F.min(ind).alias("lo"), F.max(ind).alias("hi"), F.count_if(ind.isNull()).alias("none")).collect()}
    tables = []
    for i, (name, header) in found.items():
        r = names.get(i)
        if r is None or r["none"] or r["lo"] != r["hi"]:
            raise ValueError(f"natural_merge_unlike: {name} holds more than one indicator, or none")
        t = rows.where(F.col("file_no") == i).select(*[F.get("values", F.lit(k)).alias(c) for k, c in enumerate(header)])
        ren = {k: v for k, v in INDICATOR_RENAMES.items() if k in header}
        t = P.rename_with(P.rename(t, {value_col: r["lo"], **ren}), sanitize_name)
        tables.append(t.drop(*drop))
    m = J.folded_join_chain(tables)
    return P.parse_guess(m.select(*[missing_token(c).alias(c) for c in m.columns]))


def unlike_files(spark, d, root: str) -> None:
    """Indicator files with other columns each, landed as delimited text: some
    without the size band, one without the year."""
    e = table(spark, d, "events")
    dpt = F.concat(F.lit("Dpto "), F.col("user_id").cast("string")).alias("Departamento")
    day, band = F.col("ts").cast("date").cast("string").alias("Año"), F.concat(F.lit("T"), F.col("user_id") % 3).alias("Tamaño")
    for i, (ind, keys) in enumerate([("click", [day, dpt, band]), ("purchase", [day, dpt]), ("signup", [day, dpt]),
                                     ("view", [dpt]), ("error", [band, day, dpt])]):
        g = e.where(F.col("event_type") == ind).groupBy(*keys).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("__v"))
        g = g.select("*", F.lit(ind).alias("Indicador"), F.lit("Todos, sin detalle").alias("Sector"),
                     F.when(F.col("__v") < 2, F.lit(MISSING_TOKEN)).otherwise(F.col("__v").cast("string")).alias("Valor")).drop("__v")
        K.write_csv(g, f"{root}/{i}_{ind}")


def finish(spark, df: DataFrame, path: str) -> DataFrame:
    """The final table written as CSV, as the source leaves it, and read back with its types."""
    K.write_csv(df, path)
    return R.read_csv(spark, path, schema=df.schema)


# ------------------------------------------------------------------ PL5
def share_panel(p: DataFrame, corrected: bool = False, no_info: str = NO_INFO_REGION,
                keys: tuple[str, str] = ("anio", "region"), band: str = "tramo", extra: tuple[str, ...] = ("sector",),
                firms: str = "numero_empresas", workers: tuple[str, str] = ("pedidos", "pessoal_ocupado"),
                sales: str = "valor_total", pay: tuple[str, str, str] = ("valor_total", "salario_medio", "pedidos"),
                text_numeric: tuple[str, ...] = ()) -> DataFrame:
    """PL5: contribution shares within (year, region) after dropping the
    'no information' region (NULL regions drop too, as with R's filter).

    Roles: ``firms`` count, two ``workers`` columns summed, ``sales``, three
    ``pay`` columns (f, m, h) for the net-pay share (``corrected`` adds the
    missing parentheses); ``text_numeric`` columns are parsed leniently first.
    Shares are strict: one NULL in the group makes the group's shares NULL."""
    from regpanel.functions.exprs import as_num
    year, region = keys
    p = p.where(F.col(region) != no_info)
    if text_numeric:
        p = p.select(*[as_num(c).alias(c) if c in set(text_numeric) else F.col(c) for c in p.columns])
    f, m, h = (F.col(c) for c in pay)
    d = p.withColumn("__fmh", f + m + h).withColumn("__emp", F.col(workers[0]) + F.col(workers[1]))
    parts = {"po": firms, "emp": "__emp", "v": sales, "fmh": "__fmh"}
    aggs = {}
    for k, c in parts.items():
        aggs[f"__t_{k}"] = F.sum(c)
        aggs[f"__ok_{k}"] = F.count(c) == F.count(F.lit(1))
    g = W.with_group_aggs(d, [year, region], aggs)

    def sh(x, k):
        return F.when(F.col(f"__ok_{k}"), r_div(x, f"__t_{k}"))
    return g.select(year, region, band, *extra,
                    sh(firms, "po").alias("contribucion_po"),
                    sh("__emp", "emp").alias("contribucion_empleo"),
                    sh(sales, "v").alias("contribucion_vtas"),
                    W.net_pay_share(f, m, h, F.when(F.col("__ok_fmh"), F.col("__t_fmh")), corrected)
                    .alias("contribucion_sal_neto"),
                    F.col(firms).alias("numero_empresas"), F.col("__emp").alias("trabajadores"),
                    F.col(sales).alias("ventas"), F.col("__fmh").alias("sal_neto"))


# ------------------------------------------------------------------ PL6
# Catalogue stand-in: code correspondence rows (historical -> new), a main
# sheet and a derived-indicator sheet with one overlap on purpose.
MAPPER_MAIN = [("bd_size_r3", "V11910", "ENT_NR"), ("bd_size_r3", "V16910", "EMP_NR"),
               ("bd_other", "V11920", "BIRTH_NR")]
MAPPER_DERIVED = [("V16910", "EMP_NR", "yes"), ("V97020", "GRW_ENT_PC", "no")]


def business_facts(spark, d) -> DataFrame:
    """Long coded facts (indic_sb, sizeclas, geo, TIME_PERIOD, values) from
    orders: geo = region-prefixed nation code, sizeclas from order value."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    size = (F.when(F.col("o_totalprice") < 50000, "0").when(F.col("o_totalprice") < 200000, "1-9").otherwise("GE10"))
    g = j.groupBy(F.concat(F.upper(F.substring("r_name", 1, 2)), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("geo"),
                  size.alias("sizeclas"), F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("TIME_PERIOD")).agg(
        F.count_distinct("o_custkey").cast("double").alias("V11910"),
        F.count(F.lit(1)).cast("double").alias("V16910"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("V97020"))
    return pivot_longer(g, ["V11910", "V16910", "V97020"], "indic_sb", "values", id_cols=["geo", "sizeclas", "TIME_PERIOD"])


def business_dims(spark, d):
    """Countries (code, name, label) and regions (id, NUTS_NAME); every region
    also appears under a child code with the same name."""
    r = table(spark, d, "region")
    countries = r.select(F.upper(F.substring("r_name", 1, 2)).alias("code"),
                         F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.substr("r_name", F.lit(2)))).alias("name"),
                         F.lower("r_name").alias("label"))
    n = table(spark, d, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    base = F.concat(F.upper(F.substring("r_name", 1, 2)), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    geo = n.select(base.alias("id"), F.col("n_name").alias("NUTS_NAME")).unionByName(
        n.select(F.concat(base, F.lit("0")).alias("id"), F.col("n_name").alias("NUTS_NAME")))
    return countries, geo


# Catalogue stand-in: the correspondence workbook's two sheets as cells, with
# the header texts of the source's workbook and its merged ranges.
MAPPER_HEAD = ("Old.Eurobase.Table", "Eurobase.code.in.historical.BD.tables", "Eurobase.code.in.new.tables")
MAPPER_DERIVED_HEAD = ("Eurobase code in historical BD tables", "Eurobase code - from \nreference year 2021 onwards", "bd_size_r")


def mapper_cells(spark) -> tuple[DataFrame, DataFrame]:
    """(cells, merged ranges) of the correspondence workbook: the second sheet
    has a merged line above its header, and equal flags below one another are merged."""
    sheets = {"main": [MAPPER_HEAD, *MAPPER_MAIN],
              "derived": [("Indicators", None, "Data sets"), MAPPER_DERIVED_HEAD, *MAPPER_DERIVED, ("V97999", "GRW_EMP_PC", None)]}
    cells = [(s, r, c, v) for s, rows in sheets.items() for r, row in enumerate(rows, 1) for c, v in enumerate(row, 1) if v is not None]
    n = len(MAPPER_DERIVED) + 2
    ranges = [("derived", 1, 1, 1, 2), ("derived", n, 3, n + 1, 3)]
    return (spark.createDataFrame(cells, "sheet string, row_idx int, col_idx int, value string"),
            spark.createDataFrame(ranges, "sheet string, r0 int, c0 int, r1 int, c1 int"))


def code_mapper_from(cells: DataFrame, ranges: DataFrame, table_name: str = "bd_size_r3", flag: str = "bd_size_r") -> DataFrame:
    """PL6's code correspondence (hist, new) out of the workbook's cells: the
    first sheet's rows of one old table, and the second sheet's flagged rows
    once merged cells are filled and its second line is the header."""
    a = row_to_names(cells.where(F.col("sheet") == "main"), 1)
    old, hist, new = MAPPER_HEAD
    a = a.where(F.col(f"`{old}`") == table_name).select(F.col(f"`{hist}`").alias("hist"), F.col(f"`{new}`").alias("new"))
    b = row_to_names(fill_merged(cells.where(F.col("sheet") == "derived"), ranges.where(F.col("sheet") == "derived")), 2)
    b = P.rename_with(b, lambda c: c.replace(" ", ".").replace("\n", ""))
    b = b.where(F.col(f"`{flag}`") == "yes").select(
        F.col("`Eurobase.code.in.historical.BD.tables`").alias("hist"),
        F.col("`Eurobase.code.-.from.reference.year.2021.onwards`").alias("new"))
    return a.unionByName(b).distinct()


def code_mapper(spark) -> DataFrame:
    return code_mapper_from(*mapper_cells(spark))


def indicator_panel_from(spark, facts: DataFrame, countries: DataFrame, geo: DataFrame, mapper: DataFrame,
                         codes: list[str], out_path: str, countries_kept=("italy", "spain")) -> DataFrame:
    """PL6 core.  facts (indic_sb, sizeclas, geo, TIME_PERIOD, values) -> country
    code = first two letters of geo -> inner join to the kept countries (code,
    name, label; case-insensitive label) and to the region names (id,
    NUTS_NAME) -> distinct (collapses parent/child codes with one name and
    value) -> code mapping (hist, new; unmapped codes kept) -> pivot on the
    explicit ``codes`` -> sanitised names -> band recode -> year text -> one
    output folder per country."""
    facts = facts.withColumn("country_code", F.substring("geo", 1, 2))
    cs = countries.where(F.lower("label").isin(list(countries_kept))).select("code", F.col("name").alias("pais"))
    j = J.join(facts, cs, {"country_code": "code"}, "inner")
    j = J.join(j, geo.select("id", F.col("NUTS_NAME").alias("region")), {"geo": "id"}, "inner")
    u = j.select("pais", "region", "TIME_PERIOD", "indic_sb", "sizeclas", "values").distinct()
    u = J.join(u, mapper.select("hist", "new"), {"indic_sb": "hist"}, "left")
    u = u.withColumn("variables", F.coalesce("new", "indic_sb"))
    wide = pivot_wider(u, ["pais", "region", "sizeclas", "TIME_PERIOD"], "variables", "values", values=codes)
    wide = P.rename_with(wide, sanitize_name)
    wide = P.rename(wide, {"sizeclas": "tramo"}).withColumn("tramo", band_recode("tramo"))
    wide = wide.withColumn("anio", date_to_year_text("time_period"))
    wide = P.relocate(wide, "anio", before="time_period").drop("time_period")
    key = K.write_per_group(wide, out_path, "pais")
    return spark.read.option("basePath", out_path).parquet(out_path).drop(key)


def indicator_panel(spark, d, out_path: str, countries_kept=("europe", "asia")) -> DataFrame:
    """PL6 on the driver-derived business facts."""
    countries, geo = business_dims(spark, d)
    return indicator_panel_from(spark, business_facts(spark, d), countries, geo, code_mapper(spark),
                                ["ENT_NR", "EMP_NR", "V97020"], out_path, countries_kept)


# ------------------------------------------------------------------ PL7 PL8
def control_facts(spark, d) -> DataFrame:
    """Nation-level long control facts (dataset, geo, time, values, unit, sex)."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    g = j.groupBy(F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("geo"),
                  F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("time")).agg(
        F.count(F.lit(1)).cast("double").alias("ord_cnt"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("ord_val"),
        F.count_distinct("o_custkey").cast("double").alias("cust_cnt"))
    long = pivot_longer(g, ["ord_cnt", "ord_val", "cust_cnt"], "dataset", "values", id_cols=["geo", "time"])
    unit = F.when(F.col("dataset") == "ord_val", "EUR_HAB").otherwise("NR")
    return long.withColumn("unit", unit).withColumn("sex", F.lit("T"))


def control_regions(spark, d) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("NUTS_ID"),
                    F.col("n_name").alias("NUTS_NAME"), F.upper(F.substring("r_name", 1, 2)).alias("CNTR_CODE"))


CONTROL_SPECS = [R.DatasetSpec("ord_cnt", "pedidos", {"unit": "NR"}, period=(1990, 2030)),
                 R.DatasetSpec("ord_val", "pbi_per_capita", {"unit": "EUR_HAB"}, period=(1990, 2030)),
                 R.DatasetSpec("cust_cnt", "pobl_total", {"unit": "NR", "sex": "T"}, period=(1990, 2030))]


def hdi_table(spark, d, country_region: str) -> DataFrame:
    """Subnational index file (Country, Level, Region, Year, shdi, extra):
    accented names for one region's nations, a national row per year."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    name = F.concat(F.upper(F.substring("n_name", 1, 1)), F.lower(F.substr("n_name", F.lit(2))))
    name = F.when(F.col("n_nationkey") % 2 == 1, F.translate(name, "aio", "áíó")).otherwise(name)
    shdi = (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
            / F.count(F.lit(1)).cast("double") / 1e6)
    sub = j.groupBy(F.col("r_name").alias("Country"), name.alias("Region"), F.year("o_orderdate").alias("Year")).agg(
        shdi.alias("shdi"))
    sub = sub.withColumn("Level", F.lit("Subnat")).withColumn("extra", F.lit(1))
    nat = j.groupBy(F.col("r_name").alias("Country"), F.year("o_orderdate").alias("Year")).agg(
        shdi.alias("shdi")).withColumn("Level", F.lit("National")) \
        .withColumn("Region", F.lit("Total")).withColumn("extra", F.lit(1))
    return sub.unionByName(nat)


def eu_controls(spark, facts: DataFrame, regions: DataFrame, specs: list[R.DatasetSpec],
                interim_path: str | None = None) -> DataFrame:
    """Spec list -> ONE filtered scan of the landed facts -> keyed fold as one
    conditional aggregation -> (anio, id_region, region, <var>, <var>_unidad…).
    Repeated keys raise (a breakdown left in the facts would fan out); the
    interim result is written next to the final one when asked."""
    long = R.read_specs(facts, specs, regions)
    keys = ["anio", "id_region", "region"]
    eu = J.fold_as_pivot(long, keys, "variable", ["value", "unit"], [s.var_name for s in specs],
                         base=specs[0].var_name)
    eu = eu.toDF(*[c.replace("_unit", "_unidad") for c in eu.columns])
    return K.checkpoint_to(spark, eu, interim_path) if interim_path else eu


def attach_hdi(eu: DataFrame, hdi_raw: DataFrame, country: str, after_year: int) -> DataFrame:
    """Subnational index (Country, Level, Region, Year, shdi, …): column-pruned,
    one country's subnational rows after ``after_year``, joined on (lower-cased
    name, Jan-1 date).  The EU side's name is transliterated, the index side's
    only lower-cased, as the source does."""
    hdi = P.rename_with(hdi_raw.select("Country", "Level", "Region", "Year", "shdi"), str.lower)
    hdi = hdi.where((F.col("country") == country) & (F.col("level") == "Subnat") & (F.col("year") > after_year))
    hdi = hdi.select(year_to_date("year").alias("anio"), F.lower("region").alias("__key"),
                     F.col("shdi").alias("hdi"), F.lit("Indice").alias("hdi_unidad"))
    return J.join(eu.withColumn("__key", translit_lower("region")), hdi, ["__key", "anio"], "left").drop("__key")


def attach_national(base: DataFrame, national: DataFrame, rules: list[tuple[str, str]],
                    corrected: bool = True) -> DataFrame:
    """National file (anio, region, <var>, <var>_unidad) joined on the recoded,
    normalised region name and the year.  ``corrected`` trims and
    transliterates the recode targets (the source's rules leave a trailing
    space and accents in four targets, so those never match)."""
    rc = J.recode_contains("region", rules, default=translit_lower("region"))
    key = translit_lower(F.trim(rc)) if corrected else F.lower(rc)
    nat = national.withColumn("__key", key).drop("region")
    # a national file with a breakdown (e.g. by sex) would fan the join out: it raises
    return J.join(base.withColumn("__key", translit_lower("region")), nat, ["__key", "anio"], "left",
                  expect="one").drop("__key")


def control_panel_eu(spark, d, country: str, region_name: str, out_dir: str) -> DataFrame:
    """PL8 on the driver-derived control facts: EU controls + HDI."""
    regions = control_regions(spark, d).where(F.col("CNTR_CODE") == country)
    eu = eu_controls(spark, control_facts(spark, d), regions, CONTROL_SPECS, f"{out_dir}/interim_eurostat")
    return attach_hdi(eu, hdi_table(spark, d, region_name), region_name, 1990)


# Catalogue stand-in: recode rules for the driver-derived nation names, with
# the same defects as the source's rules (constants.ES_REGION_RECODE): a
# trailing space and an accent left in a target.
NATIONAL_RECODE = [("NATION_1$", "NATION_1"), ("NATION_11", "Nation_11 "), ("NATION_6", "NATIÓN_6")]


def control_panel_national(spark, d, country: str, region_name: str, out_dir: str,
                           national: DataFrame, corrected: bool = True) -> DataFrame:
    """PL7 on the driver-derived tables: PL8 plus a national file."""
    base = control_panel_eu(spark, d, country, region_name, out_dir)
    return attach_national(base, national, NATIONAL_RECODE, corrected)


# ------------------------------------------------------------------ PL9 PL10
def eda_aggregated(p: DataFrame) -> DataFrame:
    """PL9: sum/mean over sectors per (year, region, band), zeros as missing,
    then the distribution table by band."""
    agg = cell_panel(p)
    return A.distribution_table(agg, "tramo", S.exclude(S.where_numeric(agg), ["anio"]))


def eda_salary_box(p: DataFrame) -> DataFrame:
    """PL9: salary columns (not split by sex) of the aggregated panel, long,
    box statistics by (variable, band) on a natural-log scale, with the
    centre-truncated legend label."""
    from regpanel.functions.exprs import trunc_center
    agg = cell_panel(p)
    sal = S.exclude(S.starts_with(agg, "salario"), S.matches(agg, "sexo"))
    long = pivot_longer(agg.select(*S.col_range(agg, "anio", "tramo"), *sal), sal, "variable", "valor",
                        id_cols=S.col_range(agg, "anio", "tramo"))
    box = A.boxplot_stats(long, ["variable", "tramo"], "valor", log="e")
    return box.withColumn("etiqueta", trunc_center("variable"))


def eda_direct(p: DataFrame) -> DataFrame:
    """PL10: national evolution per (year, band): strict totals and means, logs."""
    g = p.groupBy("anio", "tramo").agg(strict_sum("numero_empresas").alias("cant_empresas"),
                                       strict_sum("pessoal_ocupado").alias("cant_empleados"),
                                       strict_mean("salario_medio").alias("salario_prom"))
    return g.select("*", log_pos("cant_empresas").alias("log_empresas"),
                    log_pos("cant_empleados", "10").alias("log10_empleados"))


# ------------------------------------------------------------------ PL11
QUADRANTS = QUADRANT_LABELS


def country_controls(spark, d) -> DataFrame:
    """Both countries' control tables (regions of EUROPE and of ASIA) in one
    pass, with the population measure spelled as each source spells it
    (the other spelling is NULL, as bind_rows(fill) leaves it)."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region").where(F.col("r_name").isin("EUROPE", "ASIA"))
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    g = j.groupBy("r_name", F.col("n_name").alias("region"), F.year("o_orderdate").alias("anio")).agg(
        F.count_distinct("o_custkey").cast("double").alias("__pob"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("__val"))
    it = F.col("r_name") == "EUROPE"
    return g.select("region", "anio",
                    F.when(it, F.col("__pob")).alias("poblacion_total"),
                    F.when(~it, F.col("__pob")).alias("pobl_total"),
                    (F.col("__val") / F.col("__pob")).alias("pbi_per_capita"),
                    F.when(it, F.lit("Italia")).otherwise(F.lit("España")).alias("pais"))


def regional_panel(spark, d) -> DataFrame:
    """PL11 panel: control ⨝ firm panel for both countries, suffix pair and
    population spellings unified, firms per 1000 inhabitants and employment
    rate."""
    p = panel(spark, d).select("anio", "region", "tramo", "sector", F.col("numero_empresas").alias("ent_nr"),
                               F.col("pessoal_ocupado").alias("emp_nr"),
                               F.when(F.col("sector") != "5-LOW", F.lit("pymes")).alias("pais"))
    # bind_rows(it |> inner_join(p), es |> inner_join(p)) == (it ∪ es) |> inner_join(p):
    # one join instead of two, the panel is computed once.
    df = J.join(country_controls(spark, d), p, ["region", "anio"], "inner", suffix=("_x", "_y"))
    df = df.withColumn("pais", F.coalesce("pais_x", "pais_y")) \
           .withColumn("poblacion", F.coalesce("poblacion_total", "pobl_total")) \
           .drop("pais_x", "pais_y", "poblacion_total", "pobl_total")
    return df.withColumn("ent_per_1000", r_div("ent_nr", "poblacion") * 1000) \
             .withColumn("tasa_empleo_pyme", r_div("emp_nr", "poblacion") * 100)


def regional_quadrants(spark, d, band: str = "AUTOMOBILE") -> DataFrame:
    """PL11 (flagship): one band, national medians broadcast to the regions,
    quadrant label."""
    df = regional_panel(spark, d)
    q = W.group_medians(df.where(F.col("tramo") == band), ["pais"],
                        {"mediana_pyme": "ent_per_1000", "mediana_pbi": "pbi_per_capita"},
                        materialize=True)
    lab = W.quadrant_label(F.col("ent_per_1000"), F.col("pbi_per_capita"), F.col("mediana_pyme"),
                           F.col("mediana_pbi"), QUADRANTS)
    return q.select("pais", "region", "anio", "sector", "ent_per_1000", "tasa_empleo_pyme", "pbi_per_capita",
                    "mediana_pyme", "mediana_pbi", lab.alias("patron"))


def regional_fit(spark, d, band: str = "AUTOMOBILE") -> DataFrame:
    """PL11: lm(pbi_per_capita ~ ent_per_1000) per country for one band."""
    df = regional_panel(spark, d).where(F.col("tramo") == band)
    return A.linear_fit(df, ["pais"], "ent_per_1000", "pbi_per_capita")


def regional_correlations(spark, d, band: str = "AUTOMOBILE") -> DataFrame:
    """PL11: pairwise correlations per country for one band."""
    df = regional_panel(spark, d).where(F.col("tramo") == band)
    return A.correlation_pairs(df, ["ent_per_1000", "pbi_per_capita", "tasa_empleo_pyme"], ["pais"])


def regional_box_latest(spark, d) -> DataFrame:
    """PL11: latest year only (global max), box statistics of firms by band
    and country on a log10 scale."""
    df = P.keep_latest(regional_panel(spark, d), "anio")
    return A.boxplot_stats(df, ["tramo", "pais"], "ent_nr", log="10")


def regional_profile(spark, d) -> DataFrame:
    """PL11: group_by(pais) |> skim()."""
    df = regional_panel(spark, d).select("pais", "ent_nr", "emp_nr", "pbi_per_capita", "ent_per_1000", "tramo")
    return profile(df, ["pais"])


# ------------------------------------------------------------------ PL7 PL8 whole
def dataset_facts(spark, d) -> DataFrame:
    """Landed statistical facts of both countries: the six datasets of the
    spec lists with their dimensions, and rows that a spec's filters drop (one
    sex, another unit).  Nation k stands in for the k-th region code of each list."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    cents = lambda x: F.sum(x.cast("decimal(18,2)")).cast("double")
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    g = j.groupBy("c_nationkey", F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("time")).agg(
        cents(F.col("o_totalprice")).alias("renta"), cents(done).alias("pbi"), F.count(F.lit(1)).cast("double").alias("dens"),
        F.count_distinct("o_custkey").cast("double").alias("pobl"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("crim"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").cast("double").alias("pobr"))
    rows = [("nama_10r_2hhinc", "renta", "EUR_HAB", "BAL", "B5N", None, None), ("nama_10r_2hhinc", "dens", "EUR_HAB", "PAID", "B5N", None, None),
            ("nama_10r_3gdp", "pbi", "EUR_HAB", None, None, None, None), ("nama_10r_3gdp", "dens", "MIO_EUR", None, None, None, None),
            ("demo_r_d3dens", "dens", "PER_KM2", None, None, None, None),
            ("demo_r_pjangrp3", "pobl", "NR", None, None, "T", "TOTAL"), ("demo_r_pjangrp3", "dens", "NR", None, None, "F", "TOTAL"),
            ("crim_gen_reg", "crim", "P_HTHAB", None, None, None, None), ("crim_gen_reg", "dens", "NR", None, None, None, None),
            ("ilc_li41", "pobr", "PC", None, None, None, None)]
    names = ("dataset", "values", "unit", "direct", "na_item", "sex", "age")
    each = F.array(*[F.struct(*[(F.col(v) if n == "values" else F.lit(v).cast("string")).alias(n)
                                for n, v in zip(names, r, strict=True)]) for r in rows])
    geo = F.array(*[F.get(F.array(*map(F.lit, codes)), F.col("c_nationkey").cast("int")) for codes in (ES_NUTS2, IT_NUTS2)])
    f = g.select("*", F.explode(geo).alias("geo")).select("time", "geo", F.explode(each).alias("__r"))
    return f.where(F.col("geo").isNotNull()).select("geo", "time", "__r.*")


def nuts_regions(spark, d) -> DataFrame:
    """(NUTS_ID, NUTS_NAME, CNTR_CODE) of both countries' region codes."""
    n = table(spark, d, "nation")
    at = lambda codes: F.get(F.array(*map(F.lit, codes)), F.col("n_nationkey").cast("int"))
    parts = [n.select(at(codes).alias("NUTS_ID"), F.col("n_name").alias("NUTS_NAME"), F.lit(c).alias("CNTR_CODE"))
             for codes, c in ((ES_NUTS2, "ES"), (IT_NUTS2, "IT"))]
    return parts[0].unionByName(parts[1]).where(F.col("NUTS_ID").isNotNull())


#: the catalogue's stand-in for the control period: the years of the tables
TABLE_PERIOD = (1990, 2030)


def control_panel_italy(spark, facts: DataFrame, regions: DataFrame, hdi_raw: DataFrame, country: str, out_dir: str,
                        period: tuple[int, int] = CONTROL_PERIOD, after_year: int = 2007) -> DataFrame:
    """PL8: Italy's six datasets folded on (year, id, region), the subnational
    index, both interim and final tables written."""
    specs = R.specs_from(IT_EU_SPECS, IT_NUTS2, period)
    eu = eu_controls(spark, facts, regions.where(F.col("CNTR_CODE") == "IT"), specs, f"{out_dir}/interim/eurostat")
    return finish(spark, attach_hdi(eu, hdi_raw, country, after_year), f"{out_dir}/control")


def control_panel_spain(spark, facts: DataFrame, regions: DataFrame, hdi_raw: DataFrame, national: list[DataFrame], country: str,
                        rules: list[tuple[str, str]], out_dir: str, period: tuple[int, int] = CONTROL_PERIOD,
                        after_year: int = 2007, corrected: bool = True) -> DataFrame:
    """PL7: Spain's three datasets, the subnational index and the fold of the
    national files (base: the first one) on (year, region); both interim tables
    and the final one are written."""
    specs = R.specs_from(ES_EU_SPECS, ES_NUTS2, period)
    eu = eu_controls(spark, facts, regions.where(F.lower("CNTR_CODE") == "es"), specs, f"{out_dir}/interim/eurostat")
    ine = J.left_join_chain(national, by=["anio", "region"], expect="one")
    ine = K.checkpoint_to(spark, ine, f"{out_dir}/interim/ine")
    base = attach_hdi(eu, hdi_raw, country, after_year)
    return finish(spark, attach_national(base, ine, rules, corrected), f"{out_dir}/control")


def national_sources(spark, d) -> dict[str, DataFrame]:
    """The four national files' tables by file stem: ``NN Name``, period, total, unit."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy("n_nationkey", "n_name", F.year("o_orderdate").alias("y")).agg(
        F.count_if(F.col("o_orderpriority") == "2-HIGH").cast("double").alias("tasa_homicidios"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("tasa_criminalidad"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("tasa_pobreza"),
        F.count_distinct("o_custkey").cast("double").alias("pobl_total"))
    name = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(" "), "n_name")
    return {stem: g.where((F.col("n_nationkey") + F.lit(i)) % 6 != 0)  # every file lacks other regions
            .select(name.alias("Comunidades y ciudades autónomas"), F.col("y").cast("string").alias("Periodo"),
                    F.translate(F.format_number(measure, 2), ",.", ".,").alias("Total"), F.lit(unit[:4]).alias(unit))
            for i, (stem, measure, unit) in enumerate(ES_NATIONAL_FILES)}


def read_national_files(spark, root: str) -> list[DataFrame]:
    """The files of ES_NATIONAL_FILES below ``root``, as (anio, region, measure, unit) each."""
    return [R.read_national_file(R.read_csv_european(spark, f"{root}/{stem}.csv", numeric=["Total"]),
                                 "Comunidades y ciudades autónomas", "Periodo", "Total", unit, measure)
            for stem, measure, unit in ES_NATIONAL_FILES]


# ------------------------------------------------------------------ PL9 PL10 whole
def cell_panel(p: DataFrame) -> DataFrame:
    """One row per (year, region, band): sums and means over the sectors, zeros as missing."""
    return A.summarise_sum_mean(p, ["anio", "region", "tramo"], S.matches(p, "numero|pedidos|pessoal|valor"),
                                S.starts_with(p, "salario"))


def panel_report(p: DataFrame) -> dict[str, DataFrame]:
    """PL9 and PL10 of a panel with one row per (year, region, band): column
    profile, shape, duplicates, missing share by year, distribution by band,
    evolution of firms (natural log) and of staff (base 10)."""
    values = S.exclude(S.where_numeric(p), ["anio"])
    return {"profile": lambda: profile(p), "shape": lambda: A.table_shape(p), "duplicates": lambda: A.duplicate_audit(p),
            "missing": lambda: A.missing_pct(p, "anio", ("region", "tramo"), values),
            "distribution": lambda: A.distribution_table(p, "tramo", values),
            "firms": lambda: A.evolution_total(p, "anio", "tramo", "numero_empresas", "cant_empresas", "e"),
            "staff": lambda: A.evolution_total(p, "anio", "tramo", "pessoal_ocupado", "cant_empleados", "10")}


# ------------------------------------------------------------------ PL11 whole
WELFARE = ["ent_per_1000", "pbi_per_capita", "tasa_pobreza", "hdi"]


def regional_panel_from(controls: DataFrame, firms: DataFrame) -> DataFrame:
    """PL11 panel out of both countries' controls and firm panels (stacked): the
    inner join on (region, year), one country and one population column,
    firms per 1000 inhabitants, employment rate."""
    df = J.join(controls, firms, ["region", "anio"], "inner", suffix=("_x", "_y"))
    df = P.coalesce_pair(df, "pais_x", "pais_y", "pais")
    df = P.coalesce_pair(df, "poblacion_total", "pobl_total", "poblacion")
    return df.withColumn("ent_per_1000", r_div("ent_nr", "poblacion") * 1000) \
             .withColumn("tasa_empleo_pyme", r_div("emp_nr", "poblacion") * 100)


def regional_pairs(df: DataFrame, bins: int = 30) -> dict:
    """PL11's crossed charts of one band: correlations of the welfare measures
    per country, their marginal distributions, and the fitted line of GDP on
    firms with its ribbon on 80 points per country."""
    long = pivot_longer(df.select("pais", *WELFARE), WELFARE, "variable", "valor", id_cols=["pais"])
    x, y = "ent_per_1000", "pbi_per_capita"
    return {"correlations": lambda: A.correlation_pairs(df, WELFARE, ["pais"]),
            "marginals": lambda: A.histogram(long, ["pais", "variable"], "valor", bins),
            "ribbon": lambda: A.fit_band(A.linear_fit(df, ["pais"], x, y), A.fit_grid(df, ["pais"], x, y), ["pais"], x)}


def welfare_panel(spark, d, band: str = "AUTOMOBILE") -> DataFrame:
    """The regional panel of one band with poverty and development indices, from the driver tables."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region").where(F.col("r_name").isin("EUROPE", "ASIA"))
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    rows = F.count(F.lit(1)).cast("double")
    cents = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    g = j.groupBy("r_name", F.col("n_name").alias("region"), F.year("o_orderdate").alias("anio")).agg(
        F.count_distinct("o_custkey").cast("double").alias("__pob"), cents.alias("__val"), rows.alias("__n"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").cast("double").alias("__low"))
    it = F.col("r_name") == "EUROPE"
    controls = g.select("region", "anio", F.when(it, F.col("__pob")).alias("poblacion_total"),
                        F.when(~it, F.col("__pob")).alias("pobl_total"), (F.col("__val") / F.col("__pob")).alias("pbi_per_capita"),
                        (F.col("__low") / F.col("__n") * 100).alias("tasa_pobreza"),
                        F.when(F.col("__low") > 0, F.col("__val") / F.col("__n") / 1e6).alias("hdi"),
                        F.when(it, F.lit("Italia")).otherwise(F.lit("España")).alias("pais"))
    firms = panel(spark, d).where(F.col("tramo") == band).select(
        "anio", "region", "tramo", "sector", F.col("numero_empresas").alias("ent_nr"), F.col("pessoal_ocupado").alias("emp_nr"),
        F.lit(None).cast("string").alias("pais"))
    return regional_panel_from(controls, firms)
