"""Sources and sinks: NULL tokens, European numbers, partitioned output."""

import datetime

from pyspark.sql import functions as F

from regpanel.sources import readers as R
from regpanel.sources import sinks as K


def test_read_csv_null_tokens_and_override(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("anio,region,v,w\n2019,Norte,NA,1.5\n2020,,2,NaN\n2021,NA,,3\n", encoding="utf-8")
    df = R.read_csv(spark, str(p), schema="anio int, region string, v double, w double",
                    overrides={"anio": "string"})
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("2019", "Norte", None, 1.5), ("2020", None, 2.0, None), ("2021", None, None, 3.0)]
    assert dict(df.dtypes)["anio"] == "string"


def test_override_keeps_leading_zeros(spark, tmp_path):
    p = tmp_path / "z.csv"
    p.write_text("code,v\n01,1\n002,2\n", encoding="utf-8")
    for kw in ({"schema": "code int, v int"}, {"infer": True}):
        df = R.read_csv(spark, str(p), overrides={"code": "string"}, **kw)
        assert sorted((r.code, r.v) for r in df.collect()) == [("002", 2), ("01", 1)]


def test_read_csv_european(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_bytes("Comunidades y ciudades autónomas;Periodo;Total\n01 Andalucía;2019;1.234,5\nCeuta;2020;-7,25\n"
                  .encode("latin-1"))
    raw = R.read_csv_european(spark, str(p), numeric=["Total"])
    out = R.read_national_file(raw, "Comunidades y ciudades autónomas", "Periodo", "Total", "Total", "x")
    got = sorted((r["anio"], r["region"], r["x"]) for r in out.collect())
    assert got == [(datetime.date(2019, 1, 1), "Andalucía", 1234.5), (datetime.date(2020, 1, 1), "Ceuta", -7.25)]


def test_write_per_group_lowercases_and_roundtrips(spark, tmp_path):
    df = spark.createDataFrame([("Italia", 1), ("España", 2)], "pais string, v int")
    key = K.write_per_group(df, str(tmp_path / "out"), "pais")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["pais_key=españa", "pais_key=italia"]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["pais"], r[key], r["v"]) for r in back.collect()) == [("España", "españa", 2), ("Italia", "italia", 1)]


def test_dataset_spec_predicate_pushed(spark, tmp_path):
    facts = spark.createDataFrame(
        [("d1", "G1", datetime.date(2010, 1, 1), 1.0, "EUR", "T"), ("d1", "G1", datetime.date(2030, 1, 1), 2.0, "EUR", "T"),
         ("d2", "G1", datetime.date(2010, 1, 1), 3.0, "NR", "M")],
        "dataset string, geo string, time date, values double, unit string, sex string")
    facts.write.parquet(str(tmp_path / "facts"))
    f = spark.read.parquet(str(tmp_path / "facts"))
    regions = spark.createDataFrame([("G1", "Uno")], "NUTS_ID string, NUTS_NAME string")
    specs = [R.DatasetSpec("d1", "a", {"unit": "EUR"}, period=(2008, 2023)), R.DatasetSpec("d2", "b", {"sex": ["T"]})]
    out = R.read_specs(f, specs, regions)
    assert sorted((r["variable"], r["value"]) for r in out.collect()) == [("a", 1.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
