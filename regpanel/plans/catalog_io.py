"""Catalogue: sources and sinks (S, K rows) and parameterised readers (X rows).

Round trips write to the session's shared folder and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.functions.exprs import col
from regpanel.operators.joins import fold_as_pivot
from regpanel.plans.catalog_shape import CROSSTAB_SQL, panel_cells
from regpanel.operators.reshape import crosstab_normalise
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, table
from regpanel.session import scratch_path as scratch
from regpanel.sources import readers as R
from regpanel.sources import sinks as K


CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


# ---------------------------------------------------------------- S1 K1
@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, d):
    path = scratch(spark, "csv_roundtrip")
    K.write_csv(table(spark, d, "customer"), path)
    return R.read_csv(spark, path, schema=CUSTOMER_SCHEMA)


@query("typed_override", "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def typed_override(spark, d):
    path = scratch(spark, "typed_override")
    K.write_csv(table(spark, d, "customer"), path)
    return R.read_csv(spark, path, schema=CUSTOMER_SCHEMA, overrides={"c_nationkey": "string"},
                      select=["c_custkey", "c_nationkey", "c_mktsegment"])


# ---------------------------------------------------------------- S2
def european_text(x):
    """1234.5 -> '1.234,50' (dot grouping, decimal comma)."""
    us = F.format_number(col(x), 2)
    return F.translate(us, ",.", ".,")


@query("csv_european_roundtrip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_european_roundtrip(spark, d):
    path = scratch(spark, "csv_european")
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
                                           european_text("c_acctbal").alias("c_acctbal"))
    c.write.mode("overwrite").option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    back = R.read_csv_european(spark, path, numeric=["c_acctbal"])
    return back.select(F.col("c_custkey").cast("bigint"), "c_name", "c_acctbal")


# ---------------------------------------------------------------- K2 K3 S4
@query("partitioned_sink_roundtrip", """SELECT o_orderkey, o_totalprice, o_orderpriority,
  lower(o_orderpriority) AS o_orderpriority_key FROM orders""")
def partitioned_sink_roundtrip(spark, d):
    path = scratch(spark, "per_group")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    key = K.write_per_group(o, path, "o_orderpriority")
    return (spark.read.option("basePath", path).parquet(path)
                 .select("o_orderkey", "o_totalprice", "o_orderpriority", F.col(key).cast("string")))


@query("multi_file_scan", """SELECT 'n_lines' AS measure, l_partkey AS partkey, CAST(count(*) AS DOUBLE) AS value FROM lineitem GROUP BY 2
UNION ALL SELECT 'qty_total', l_partkey, sum(l_quantity) FROM lineitem GROUP BY 2""")
def multi_file_scan(spark, d):
    """One folder per measure, read back with ONE scan; the folder name is the
    measure (the discriminator)."""
    root = scratch(spark, "multi_file")
    li = table(spark, d, "lineitem")
    li.groupBy(F.col("l_partkey").alias("partkey")).agg(F.count(F.lit(1)).cast("double").alias("value")) \
      .write.mode("overwrite").parquet(f"{root}/n_lines")
    li.groupBy(F.col("l_partkey").alias("partkey")).agg(F.sum("l_quantity").alias("value")) \
      .write.mode("overwrite").parquet(f"{root}/qty_total")
    df = R.read_folder_with_name(spark, f"{root}/*", name_col="measure", name_from="dir")
    return df.select("measure", "partkey", "value")


# ---------------------------------------------------------------- S5 K4
@query("cells_scan", CROSSTAB_SQL)
def cells_scan(spark, d):
    path = scratch(spark, "cells")
    panel_cells(spark, d).write.mode("overwrite").partitionBy("sheet").parquet(path)
    return crosstab_normalise(R.read_cells(spark, path))


@query("interim_checkpoint_roundtrip", with_panel("SELECT * FROM panel"))
def interim_checkpoint_roundtrip(spark, d):
    return K.checkpoint_to(spark, panel(spark, d), scratch(spark, "interim"))


# ---------------------------------------------------------------- S3 S6 S8
@query("column_pruned_scan", "SELECT event_id, value FROM events")
def column_pruned_scan(spark, d):
    return table(spark, d, "events").select("event_id", "value")


@query("pushed_dimension_filter", """SELECT event_id, user_id, event_type, value FROM events
WHERE event_type IN ('click', 'view') AND value >= 5""")
def pushed_dimension_filter(spark, d):
    e = table(spark, d, "events")
    return e.where(F.col("event_type").isin("click", "view") & (F.col("value") >= 5)).select(
        "event_id", "user_id", "event_type", "value")


# Catalogue stand-in: the event types read as series codes in one scan.
SERIES = ["purchase", "signup", "error"]


@query("series_union", """SELECT event_type AS code, user_id, ts, value FROM events
WHERE event_type IN ('purchase', 'signup', 'error')""")
def series_union(spark, d):
    e = table(spark, d, "events")
    return e.where(F.col("event_type").isin(SERIES)).select(F.col("event_type").alias("code"), "user_id", "ts", "value")


# ---------------------------------------------------------------- X2 X3 X4
def long_facts(spark, d):
    """events landed as long statistical facts: dataset = event type,
    geo = user code, time = month, values = monthly total, unit = EUR."""
    e = table(spark, d, "events")
    return (e.groupBy(F.col("event_type").alias("dataset"),
                      F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("geo"),
                      F.trunc(F.col("ts").cast("date"), "month").alias("time"))
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("values"))
             .withColumn("unit", F.lit("EUR")))


def user_regions(spark, d):
    e = table(spark, d, "events").select("user_id").distinct()
    return e.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("NUTS_ID"),
                    F.concat(F.lit("Usuario "), F.col("user_id").cast("string")).alias("NUTS_NAME"))


_FACTS_SQL = """facts AS (SELECT event_type AS dataset, 'U' || CAST(user_id AS VARCHAR) AS geo,
  CAST(date_trunc('month', ts) AS DATE) AS time, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "values", 'EUR' AS unit
  FROM events GROUP BY ALL),
regions AS (SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) AS NUTS_ID, 'Usuario ' || CAST(user_id AS VARCHAR) AS NUTS_NAME FROM events)"""

SPECS = [R.DatasetSpec("purchase", "compras", {"unit": "EUR"}, period=(2008, 2030)),
         R.DatasetSpec("click", "clics", {"unit": ["EUR"]}, period=(2008, 2030)),
         R.DatasetSpec("view", "vistas", period=(2008, 2030))]


@query("dataset_spec_reader", f"""WITH {_FACTS_SQL}
SELECT DISTINCT f.time AS anio, f.geo AS id_region, r.NUTS_NAME AS region,
  CASE f.dataset WHEN 'purchase' THEN 'compras' WHEN 'click' THEN 'clics' ELSE 'vistas' END AS variable,
  f."values" AS value, f.unit FROM facts f JOIN regions r ON f.geo = r.NUTS_ID
WHERE f.dataset IN ('purchase', 'click', 'view') AND f.unit = 'EUR' AND year(f.time) BETWEEN 2008 AND 2030""")
def dataset_spec_reader(spark, d):
    return R.read_specs(long_facts(spark, d), SPECS, user_regions(spark, d))


@query("multi_spec_panel", f"""WITH {_FACTS_SQL},
x AS (SELECT f.time AS anio, f.geo AS id_region, r.NUTS_NAME AS region, f.dataset, f."values" AS v, f.unit
  FROM facts f JOIN regions r ON f.geo = r.NUTS_ID WHERE year(f.time) BETWEEN 2008 AND 2030),
b AS (SELECT * FROM x WHERE dataset = 'purchase'), c AS (SELECT * FROM x WHERE dataset = 'click'),
v AS (SELECT * FROM x WHERE dataset = 'view')
SELECT b.anio, b.id_region, b.region, b.v AS compras, b.unit AS compras_unit, c.v AS clics, c.unit AS clics_unit,
  v.v AS vistas, v.unit AS vistas_unit FROM b
LEFT JOIN c ON b.anio = c.anio AND b.id_region = c.id_region AND b.region = c.region
LEFT JOIN v ON b.anio = v.anio AND b.id_region = v.id_region AND b.region = v.region""")
def multi_spec_panel(spark, d):
    """Spec list -> ONE filtered scan -> keyed left-join fold done as one
    conditional aggregation (repeated keys raise out of it)."""
    long = R.read_specs(long_facts(spark, d), SPECS, user_regions(spark, d))
    keys = ["anio", "id_region", "region"]
    return fold_as_pivot(long, keys, "variable", ["value", "unit"], [s.var_name for s in SPECS], base="compras")


@query("national_file_reader", f"""SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio, n_name AS region,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ventas, 'Euros' AS ventas_unidad
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def national_file_reader(spark, d):
    """A national European-format file (``NN Name;Periodo;Total;unit``)
    written from the tables, then read with the national-file reader."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    agg = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_nationkey", "n_name", F.year("o_orderdate").alias("y"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t")))
    src = agg.select(F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(" "), "n_name")
                     .alias("Comunidades y ciudades autónomas"),
                     F.col("y").cast("string").alias("Periodo"), european_text("t").alias("Total"),
                     F.lit("Euros").alias("Tipo de moneda"))
    path = scratch(spark, "national")
    src.write.mode("overwrite").option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    raw = R.read_csv_european(spark, path, numeric=["Total"])
    return R.read_national_file(raw, "Comunidades y ciudades autónomas", "Periodo", "Total",
                                "Tipo de moneda", "ventas")


_SPEC_SQL = f"""WITH {_FACTS_SQL}
SELECT DISTINCT f.time AS anio, f.geo AS id_region, r.NUTS_NAME AS region,
  CASE f.dataset WHEN 'purchase' THEN 'compras' WHEN 'click' THEN 'clics' ELSE 'vistas' END AS variable,
  f."values" AS value, f.unit FROM facts f JOIN regions r ON f.geo = r.NUTS_ID
WHERE f.dataset IN ('purchase', 'click', 'view') AND f.unit = 'EUR' AND year(f.time) BETWEEN 2008 AND 2030"""


@query("dataset_spec_reader_partitioned", _SPEC_SQL)
def dataset_spec_reader_partitioned(spark, d):
    """Facts landed partitioned by dataset; the spec predicates prune the
    partitions at the scan."""
    path = scratch(spark, "facts_by_dataset")
    K.land_long_facts(long_facts(spark, d), path)
    return R.read_specs(spark.read.parquet(path), SPECS, user_regions(spark, d))
