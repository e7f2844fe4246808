"""Golden shape: the Spain EU-control panel (3 datasets folded on region x year)
rebuilt from a synthetic landed-facts generator: 19 regions x 16 years = 304
rows, 9 columns, income missing in the last year only."""

import datetime
import random

from pyspark.sql import functions as F

from regpanel.constants import CONTROL_PERIOD, ES_EU_SPECS, ES_NUTS2, ES_REGION_RECODE
from regpanel.plans.composites import attach_national, eu_controls
from regpanel.sources.readers import specs_from

UNITS = {"nama_10r_2hhinc": "EUR_HAB", "nama_10r_3gdp": "EUR_HAB", "demo_r_d3dens": "PER_KM2"}


def synthetic_facts(spark):
    rnd = random.Random(42)
    rows = []
    lo, hi = CONTROL_PERIOD
    for ds, _, _ in ES_EU_SPECS:
        for geo in ES_NUTS2 + ["FR10", "ES1"]:          # a foreign and a level-1 code, not listed
            for y in range(lo - 2, hi + 2):               # years outside the period too
                v = None if (ds == "nama_10r_2hhinc" and y == hi) else float(rnd.randint(10, 30000))
                base = dict(dataset=ds, geo=geo, time=datetime.date(y, 1, 1), values=v, unit=UNITS[ds],
                            direct="BAL", na_item="B5N", sex="T", age="TOTAL")
                rows.append(base)
                # noise rows the dimension filters must remove (only dimensions the dataset has)
                if ds != "demo_r_d3dens":
                    rows.append({**base, "unit": "MIO_EUR", "values": 1.0})
                if ds == "nama_10r_2hhinc":
                    rows.append({**base, "na_item": "B6N", "values": 2.0})
                    rows.append({**base, "direct": "PAID", "values": 3.0})
    return spark.createDataFrame(rows, "dataset string, geo string, time date, values double, unit string, "
                                       "direct string, na_item string, sex string, age string")


def test_es_control_panel_shape(spark):
    facts = synthetic_facts(spark)
    regions = spark.createDataFrame([(g, f"Region {g}", "ES") for g in ES_NUTS2] + [("FR10", "Paris", "FR")],
                                    "NUTS_ID string, NUTS_NAME string, CNTR_CODE string")
    specs = specs_from(ES_EU_SPECS, geo=ES_NUTS2, period=CONTROL_PERIOD)
    out = eu_controls(spark, facts, regions.where(F.lower("CNTR_CODE") == "es"), specs)
    keys = ["anio", "id_region", "region"]
    assert out.columns == ["anio", "id_region", "region", "renta_media_hogar", "renta_media_hogar_unidad",
                           "pbi_per_capita", "pbi_per_capita_unidad", "densidad_pobl", "densidad_pobl_unidad"]
    assert out.count() == 19 * 16 == 304
    assert out.select(*keys).distinct().count() == 304
    nulls = out.where(F.col("renta_media_hogar").isNull())
    assert nulls.count() == 19
    assert {r[0] for r in nulls.select(F.year("anio")).distinct().collect()} == {CONTROL_PERIOD[1]}
    assert out.where(F.col("densidad_pobl_unidad") != "PER_KM2").count() == 0


def test_es_national_recode_as_is_loses_four_regions(spark):
    """D5: with the source's recode rules, targets with a trailing space or with
    accents left in never match the transliterated EU names."""
    eu = spark.createDataFrame(
        [(datetime.date(2020, 1, 1), n) for n in ["Illes Balears", "Región de Murcia", "Ciudad Autónoma de Ceuta",
                                                  "Ciudad Autónoma de Melilla", "Comunidad de Madrid", "Galicia"]],
        "anio date, region string")
    nat = spark.createDataFrame(
        [(datetime.date(2020, 1, 1), n, float(i), "tasa") for i, n in enumerate(
            ["Balears, Illes", "Murcia, Región de", "Ceuta", "Melilla", "Madrid, Comunidad de", "Galicia"])],
        "anio date, region string, tasa_pobreza double, tasa_pobreza_unidad string")
    as_is = attach_national(eu, nat, ES_REGION_RECODE, corrected=False)
    fixed = attach_national(eu, nat, ES_REGION_RECODE, corrected=True)
    missing = sorted(r["region"] for r in as_is.where(F.col("tasa_pobreza").isNull()).collect())
    assert missing == ["Ciudad Autónoma de Ceuta", "Ciudad Autónoma de Melilla", "Illes Balears", "Región de Murcia"]
    assert fixed.where(F.col("tasa_pobreza").isNull()).count() == 0


def test_chile_shares_with_source_columns(spark):
    """Fixture §5 shape: text numerics with '*', a 'Sin Información' region and a
    NULL region (both dropped), one poisoned (year, region) group, one complete."""
    from regpanel.plans.composites import share_panel
    cols = ("ano_comercial int, region_del_domicilio_o_casa_matriz string, tramo_segun_ventas_5_tramos string, "
            "numero_de_empresas double, numero_de_trabajadores_dependientes_informados double, "
            "numero_de_trabajadores_a_honorarios_informados double, ventas_anuales_en_uf string, "
            "renta_neta_informada_en_uf_trabajadores_de_genero_femenino string, "
            "renta_neta_informada_en_uf_trabajadores_de_genero_masculino string, "
            "honorarios_pagados_informados_en_uf string")
    rows = [(2020, "Maule", "Micro", 30.0, 10.0, 2.0, "100", "10", "20", "10"),
            (2020, "Maule", "Pequeña", 10.0, 20.0, 8.0, "300", "30", "40", "30"),
            (2020, "Biobío", "Micro", 5.0, 1.0, 1.0, "*", "1", "1", "1"),
            (2020, "Biobío", "Pequeña", 5.0, 1.0, 1.0, "50", "1", "1", "1"),
            (2020, "Sin Información", "Micro", 1.0, 1.0, 1.0, "1", "1", "1", "1"),
            (2020, None, "Micro", 1.0, 1.0, 1.0, "1", "1", "1", "1")]
    df = spark.createDataFrame(rows, cols)
    f, m, h = ("renta_neta_informada_en_uf_trabajadores_de_genero_femenino",
               "renta_neta_informada_en_uf_trabajadores_de_genero_masculino", "honorarios_pagados_informados_en_uf")
    out = share_panel(df, keys=("ano_comercial", "region_del_domicilio_o_casa_matriz"),
                      band="tramo_segun_ventas_5_tramos", extra=(), firms="numero_de_empresas",
                      workers=("numero_de_trabajadores_dependientes_informados",
                               "numero_de_trabajadores_a_honorarios_informados"),
                      sales="ventas_anuales_en_uf", pay=(f, m, h),
                      text_numeric=("ventas_anuales_en_uf", f, m, h), no_info="Sin Información")
    got = {(r[1], r[2]): r for r in out.collect()}
    assert set(k[0] for k in got) == {"Maule", "Biobío"}
    maule = got[("Maule", "Micro")]
    assert maule["contribucion_po"] == 0.75 and maule["contribucion_vtas"] == 0.25
    assert maule["contribucion_empleo"] == 12.0 / 40.0
    assert maule["contribucion_sal_neto"] == 10 + 20 + 10 / 140.0    # as-is: missing parentheses
    assert got[("Biobío", "Micro")]["contribucion_vtas"] is None       # '*' poisons the group
    assert got[("Biobío", "Pequeña")]["contribucion_vtas"] is None
    assert got[("Biobío", "Micro")]["contribucion_po"] == 0.5


def test_crosstab_full_width_block_cycle(spark):
    """Full source width: 336 (year, sector) blocks x 9 bands = 3,024 value
    columns, 27 regions; every value cell must land in its own block."""
    from regpanel.constants import BLOCK_BANDS, BLOCK_GROUPS
    from regpanel.operators.reshape import crosstab_normalise
    years, sectors = 16, 21                       # 16 x 21 = 336 blocks
    assert years * sectors == BLOCK_GROUPS
    n_cols, n_reg = BLOCK_GROUPS * BLOCK_BANDS, 27
    cols = spark.range(n_cols).select((F.col("id") + 3).cast("int").alias("col_idx"),
                                      (F.col("id") / BLOCK_BANDS).cast("int").alias("g"),
                                      (F.col("id") % BLOCK_BANDS).cast("int").alias("b"))
    year = (F.floor(F.col("g") / sectors) + 2000).cast("string")
    sector = F.concat(F.lit("S"), F.lpad((F.col("g") % sectors).cast("string"), 2, "0"))
    head3 = cols.where((F.col("b") == 0) & (F.col("g") % sectors == 0)).select(
        F.lit("T1").alias("sheet"), F.lit(3).alias("row_idx"), "col_idx", year.alias("value"))
    head4 = cols.where(F.col("b") == 0).select(F.lit("T1").alias("sheet"), F.lit(4).alias("row_idx"), "col_idx",
                                               sector.alias("value"))
    head5 = cols.select(F.lit("T1").alias("sheet"), F.lit(5).alias("row_idx"), "col_idx",
                        F.concat(F.lit("B"), F.col("b").cast("string")).alias("value"))
    regs = spark.range(n_reg).select((F.col("id") + 6).cast("int").alias("row_idx"))
    reg_cells = regs.select(F.lit("T1").alias("sheet"), "row_idx", F.lit(1).alias("col_idx"),
                            F.concat(F.lit("R"), F.col("row_idx").cast("string")).alias("value"))
    cell = spark.range(n_reg * n_cols).select((F.floor(F.col("id") / n_cols) + 6).cast("int").alias("row_idx"),
                                              (F.col("id") % n_cols + 3).cast("int").alias("col_idx"))
    body = cell.select(F.lit("T1").alias("sheet"), "row_idx", "col_idx",
                       (F.col("row_idx") * 100000 + F.col("col_idx")).cast("string").alias("value"))
    title = spark.createDataFrame([("T1", 1, 1, "Variável - Pessoal ocupado total (pessoas)"),
                                   ("T1", n_reg + 6, 1, "Fonte: nota")], "sheet string, row_idx int, col_idx int, value string")
    cells = title
    for part in (head3, head4, head5, reg_cells, body):
        cells = cells.unionByName(part)
    out = crosstab_normalise(cells)
    assert out.count() == n_cols * n_reg
    # the value encodes (row, col): recompute the expected block labels from it
    col = (F.col("value") % 100000) - 3
    g = F.floor(col / BLOCK_BANDS)
    exp_year = (F.floor(g / sectors) + 2000).cast("string")
    exp_sector = F.concat(F.lit("S"), F.lpad((g % sectors).cast("string"), 2, "0"))
    exp_band = F.concat(F.lit("B"), (col % BLOCK_BANDS).cast("string"))
    bad = out.where((F.col("anio") != exp_year) | (F.col("sector") != exp_sector) | (F.col("tramo") != exp_band)
                    | (F.col("region") != F.concat(F.lit("R"), F.floor(F.col("value") / 100000).cast("string"))))
    assert bad.count() == 0
    assert out.select("variable").distinct().first()[0] == "pessoal_ocupado_total_pessoas"


def test_brazil_series_wide(spark):
    """Fixture §4 shape: 9 series codes, state level only, a sparse population
    series, a zero area (density NULL), one duplicate cell (pivot raises)."""
    import pytest as _pt
    from regpanel.constants import BR_SERIES
    from regpanel.plans.composites import series_wide_from
    rows = []
    for code in BR_SERIES:
        for t in (11, 12, 13):
            for y in (2019, 2020):
                if code == "ADH12_POPTOT" and y == 2019:
                    continue                                   # sparse population
                rows.append((code, datetime.date(y, 1, 1), float(t * 10 + y % 10), "States", t))
        rows.append((code, datetime.date(2020, 1, 1), 1.0, "Municipalities", 11))   # other level
    facts = spark.createDataFrame(rows, "code string, date date, value double, uname string, tcode int")
    terr = spark.createDataFrame([("11", "Rondônia", 200.0), ("12", "Acre", 0.0), ("13", "Amazonas", 1500.0)],
                                 "tcode string, tname string, area double")
    out = series_wide_from(facts, terr, BR_SERIES, density=("densidad_pobl", "pobl_total", "area_km2"))
    assert out.columns == ["anio", "region", "area_km2", *BR_SERIES.values(), "densidad_pobl"]
    got = {(r["region"], r["anio"].year): r for r in out.collect()}
    assert len(got) == 6
    assert got[("Rondônia", 2019)]["pobl_total"] is None and got[("Rondônia", 2019)]["densidad_pobl"] is None
    assert got[("Acre", 2020)]["densidad_pobl"] is None              # zero area
    assert got[("Amazonas", 2020)]["densidad_pobl"] == 130.0 / 1500.0
    dup = facts.unionByName(facts.limit(1))
    with _pt.raises(Exception, match="not uniquely identified"):
        series_wide_from(dup, terr, BR_SERIES).collect()


def test_uruguay_natural_merge(spark):
    """Fixture §3 shape: a row absent from the first file is lost, NULL keys
    match, SIN DATOS becomes NULL, types are guessed."""
    from regpanel.plans.composites import natural_merge
    schema = "`Año` string, Departamento string, `Tamaño` string, Sector string, Indicador string, Valor string"
    a = spark.createDataFrame([("2019", "Montevideo", "Micro", "Todos", "n_empresas", "120"),
                               ("2019", None, "Micro", "Todos", "n_empresas", "7"),
                               ("2020", "Salto", "Pequeña", "Todos", "n_empresas", "SIN DATOS")], schema)
    b = spark.createDataFrame([("2019", "Montevideo", "Micro", "Todos", "tm", "0.5"),
                               ("2019", None, "Micro", "Todos", "tm", "0.25"),
                               ("2021", "Rivera", "Micro", "Todos", "tm", "0.1")], schema)
    out = natural_merge([a, b])
    assert out.columns == ["anio", "departamento", "tramo", "n_empresas", "tm"]
    assert dict(out.dtypes)["n_empresas"] == "double" and dict(out.dtypes)["anio"] == "double"
    got = sorted((r["departamento"] or "", r["n_empresas"], r["tm"]) for r in out.collect())
    assert got == [("", 7.0, 0.25), ("Montevideo", 120.0, 0.5), ("Salto", None, None)]


def test_eu_business_indicator_panel(spark, tmp_path):
    """Fixture §6 shape: overlapping mapper rows, an unmapped code, a country
    that is not listed, parent/child region codes with one name and value."""
    from regpanel.plans.composites import indicator_panel_from
    t = datetime.date(2021, 1, 1)
    facts = spark.createDataFrame([
        ("V11910", "1-9", "ES13", t, 10.0), ("V11910", "1-9", "ES130", t, 10.0),   # parent/child, same value
        ("V16910", "1-9", "ES13", t, 30.0), ("V97020", "GE10", "ES13", t, 2.5),
        ("V11910", "1-9", "ITC1", t, 20.0), ("V11910", "1-9", "FR10", t, 99.0)],
        "indic_sb string, sizeclas string, geo string, TIME_PERIOD date, values double")
    countries = spark.createDataFrame([("ES", "Spain", "Spain"), ("IT", "Italy", "ITALY"), ("FR", "France", "France")],
                                      "code string, name string, label string")
    geo = spark.createDataFrame([("ES13", "Cantabria"), ("ES130", "Cantabria"), ("ITC1", "Piemonte"),
                                 ("FR10", "Ile de France")], "id string, NUTS_NAME string")
    mapper = spark.createDataFrame([("V11910", "ENT_NR"), ("V16910", "EMP_NR"), ("V16910", "EMP_NR")],
                                   "hist string, new string").distinct()
    out = indicator_panel_from(spark, facts, countries, geo, mapper, ["ENT_NR", "EMP_NR", "V97020"],
                               str(tmp_path / "pymes"))
    assert sorted(out.columns) == sorted(["pais", "region", "tramo", "anio", "ent_nr", "emp_nr", "v97020"])
    got = {(r["pais"], r["tramo"]): r for r in out.collect()}
    assert set(got) == {("Spain", "1 a 9"), ("Spain", "+10"), ("Italy", "1 a 9")}
    es = got[("Spain", "1 a 9")]
    assert (es["region"], es["anio"], es["ent_nr"], es["emp_nr"], es["v97020"]) == ("Cantabria", "2021", 10.0, 30.0, None)
    assert got[("Spain", "+10")]["v97020"] == 2.5                 # unmapped code keeps its own name
    assert sorted(p.name for p in (tmp_path / "pymes").iterdir() if p.is_dir()) == ["pais_key=italy", "pais_key=spain"]
