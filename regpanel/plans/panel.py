"""Panel stand-in built from the driver tables.

region = nation name, anio = order year, tramo = market segment,
sector = order priority.  Measures (doubles; NULL where the source has no
data, as in the real panels):

* numero_empresas  distinct customers
* pedidos          orders
* pessoal_ocupado  fulfilled orders, NULL when none
* valor_total      order value (cents-exact: summed as decimal)
* salario_medio    mean order value (exact cents / count), NULL below 3 orders

orders ⨝ customer is a shuffle join on the customer key (both sides grow
with the data); how nation is joined is left to Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from regpanel.plans.registry import table

KEYS = ["anio", "region", "tramo", "sector"]
MEASURES = ["numero_empresas", "pedidos", "pessoal_ocupado", "valor_total", "salario_medio"]


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice",
                                               "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    cnt = F.count(F.lit(1))
    cents = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return j.groupBy(F.year("o_orderdate").alias("anio"), F.col("n_name").alias("region"),
                     F.col("c_mktsegment").alias("tramo"), F.col("o_orderpriority").alias("sector")).agg(
        F.count_distinct("o_custkey").cast("double").alias("numero_empresas"),
        cnt.cast("double").alias("pedidos"),
        F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0)).cast("double").alias("pessoal_ocupado"),
        cents.alias("valor_total"),
        F.when(cnt >= 3, cents / cnt.cast("double")).alias("salario_medio"))


PANEL_SQL = """panel AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS anio, n.n_name AS region,
         c.c_mktsegment AS tramo, o.o_orderpriority AS sector,
         CAST(count(DISTINCT o.o_custkey) AS DOUBLE) AS numero_empresas,
         CAST(count(*) AS DOUBLE) AS pedidos,
         CAST(nullif(count(*) FILTER (WHERE o.o_orderstatus = 'F'), 0) AS DOUBLE) AS pessoal_ocupado,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor_total,
         CASE WHEN count(*) >= 3 THEN CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
              / CAST(count(*) AS DOUBLE) END AS salario_medio
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL)"""


def with_panel(sql: str) -> str:
    """Prefix an oracle query with the panel CTE (``sql`` may add more CTEs
    starting with a comma)."""
    s = sql.lstrip()
    if s.startswith(","):
        return "WITH " + PANEL_SQL + s
    return "WITH " + PANEL_SQL + "\n" + s
