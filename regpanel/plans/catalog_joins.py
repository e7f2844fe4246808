"""Catalogue: joins (J rows), projection (P rows) and code mapping (F25, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.functions import selectors as S
from regpanel.functions.exprs import r_div, zero_as_missing
from regpanel.functions.text import clean_names, sanitize_name, translit_lower
from regpanel.operators import joins as J
from regpanel.operators import project as P
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, sig_all, sql_sig, table

TRANSLIT_SQL = "replace(strip_accents(lower({x})), 'ß', 'ss')"


def _nation(spark, d):
    return table(spark, d, "nation")


# ---------------------------------------------------------------- J1 J2 J3
@query("inner_diff_keys", """SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def inner_diff_keys(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return J.join(c, _nation(spark, d), {"c_nationkey": "n_nationkey"}, "inner")


@query("inner_after_cast", """SELECT s.s_suppkey, s.s_name, CAST(s.s_nationkey AS VARCHAR) AS tcode, n.n_name
FROM supplier s JOIN nation n ON CAST(s.s_nationkey AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)""")
def inner_after_cast(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("tcode"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("tcode"), "n_name")
    return J.join(s, n, ["tcode"], "inner")


@query("left_lookup", """SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def left_lookup(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return J.join(o, c, {"o_custkey": "c_custkey"}, "left")


@query("left_null_safe", """WITH l AS (SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 3) AS k FROM lineitem),
g AS (SELECT k, count(*) AS n_k FROM l GROUP BY k)
SELECT l.l_orderkey, l.l_linenumber, l.k, g.n_k FROM l LEFT JOIN g ON l.k IS NOT DISTINCT FROM g.k""")
def left_null_safe(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                            F.nullif("l_linenumber", F.lit(3)).alias("k"))
    g = li.groupBy("k").agg(F.count(F.lit(1)).alias("n_k"))
    return J.join(li, g, ["k"], "left", null_safe=True)


# ---------------------------------------------------------------- J4 J5 J6
def _nation_measures(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    o = (table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
         .groupBy(F.col("c_nationkey").alias("nationkey"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    return c, s, o


_NATION_MEASURES_SQL = """c AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1),
o AS (SELECT c_nationkey AS nationkey, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""


@query("natural_left_chain", f"""WITH {_NATION_MEASURES_SQL}
SELECT nationkey, c.n_customers, s.n_suppliers, o.n_orders FROM c LEFT JOIN s USING (nationkey) LEFT JOIN o USING (nationkey)""")
def natural_left_chain(spark, d):
    return J.left_join_chain(list(_nation_measures(spark, d)))


@query("left_join_fold", f"""WITH {_NATION_MEASURES_SQL}
SELECT nationkey, CAST(c.n_customers AS DOUBLE) AS n_customers, CAST(s.n_suppliers AS DOUBLE) AS n_suppliers,
  CAST(o.n_orders AS DOUBLE) AS n_orders FROM c LEFT JOIN s USING (nationkey) LEFT JOIN o USING (nationkey)""")
def left_join_fold(spark, d):
    c, s, o = _nation_measures(spark, d)
    long = None
    for t, name in ((c, "n_customers"), (s, "n_suppliers"), (o, "n_orders")):
        part = t.select("nationkey", F.lit(name).alias("variable"), F.col(name).cast("double").alias("value"))
        long = part if long is None else long.unionByName(part)
    return J.fold_as_pivot(long, ["nationkey"], "variable", ["value"],
                           ["n_customers", "n_suppliers", "n_orders"], base="n_customers")


@query("column_bind_by_key", """WITH t2 AS (SELECT l_partkey AS partkey, sum(l_quantity) AS qty_total, count(*) AS n_lines
  FROM lineitem GROUP BY 1),
t3 AS (SELECT l_partkey AS partkey, max(l_quantity) AS max_qty FROM lineitem GROUP BY 1)
SELECT p.p_partkey AS partkey, p.p_size, t2.qty_total, t2.n_lines, t3.max_qty
FROM part p LEFT JOIN t2 ON p.p_partkey = t2.partkey LEFT JOIN t3 ON p.p_partkey = t3.partkey""")
def column_bind_by_key(spark, d):
    t1 = table(spark, d, "part").select(F.col("p_partkey").alias("partkey"), "p_size")
    li = table(spark, d, "lineitem")
    t2 = li.groupBy(F.col("l_partkey").alias("partkey")).agg(F.sum("l_quantity").alias("qty_total"),
                                                            F.count(F.lit(1)).alias("n_lines"))
    t3 = li.groupBy(F.col("l_partkey").alias("partkey")).agg(F.count(F.lit(1)).alias("n_lines"),
                                                            F.max("l_quantity").alias("max_qty"))
    return J.bind_cols_by_key([t1, t2, t3], ["partkey"])


# ---------------------------------------------------------------- J8 P15
def _control(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy(F.year("o_orderdate").alias("anio"), F.col("n_name").alias("region")).agg(
        F.first("r_name").alias("pais"), F.count_distinct("o_custkey").cast("double").alias("poblacion_total"))


CONTROL_SQL = """, control AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, n_name AS region, any_value(r_name) AS pais,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS poblacion_total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)"""


def _panel_with_pais(spark, d):
    p = panel(spark, d)
    return p.withColumn("pais", F.when(F.col("tramo") != "BUILDING", F.upper(F.substring("region", 1, 3))))


@query("panel_inner_join", with_panel(CONTROL_SQL + """
, p AS (SELECT *, CASE WHEN tramo <> 'BUILDING' THEN upper(substr(region, 1, 3)) END AS pais FROM panel)
SELECT p.anio, p.region, p.tramo, p.sector, p.numero_empresas, p.pais AS pais_x, c.pais AS pais_y, c.poblacion_total
FROM p JOIN control c ON p.region = c.region AND p.anio = c.anio"""))
def panel_inner_join(spark, d):
    p = _panel_with_pais(spark, d).select("anio", "region", "tramo", "sector", "numero_empresas", "pais")
    return J.join(p, _control(spark, d), ["region", "anio"], "inner")


@query("suffix_coalesce", with_panel(CONTROL_SQL + """
, p AS (SELECT *, CASE WHEN tramo <> 'BUILDING' THEN upper(substr(region, 1, 3)) END AS pais FROM panel)
SELECT p.anio, p.region, p.tramo, p.sector, p.numero_empresas, coalesce(p.pais, c.pais) AS pais, c.poblacion_total
FROM p JOIN control c ON p.region = c.region AND p.anio = c.anio"""))
def suffix_coalesce(spark, d):
    j = panel_inner_join(spark, d)
    return P.coalesce_pair(j, "pais_x", "pais_y", "pais")


# ---------------------------------------------------------------- J9 J10 F9
def _hdi(spark, d):
    """Per-nation index table with its own spelling of the names: nations of
    one region carry accents, all are in title case."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    name = F.concat(F.upper(F.substring("n_name", 1, 1)), F.lower(F.substr("n_name", F.lit(2))))
    name = F.when(F.col("n_regionkey") == 1, F.translate(name, "aio", "áíó")).otherwise(name)
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
             .groupBy(name.alias("region")).agg(F.avg("s_acctbal").alias("hdi")))


_TITLE = "(upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)))"
_HDI_SQL = f"""hdi AS (SELECT CASE WHEN n_regionkey = 1 THEN translate({_TITLE}, 'aio', 'áíó') ELSE {_TITLE} END AS region,
  avg(s_acctbal) AS hdi FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)"""


def _cust_region(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return J.join(c, _nation(spark, d).select("n_nationkey", F.col("n_name").alias("region")),
                  {"c_nationkey": "n_nationkey"}, "inner").select("c_custkey", "region")


@query("text_key_join", f"""WITH {_HDI_SQL}
SELECT c.c_custkey, n.n_name AS region, {sql_sig('h.hdi')} AS hdi FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN hdi h ON {TRANSLIT_SQL.format(x='n.n_name')} = lower(h.region)""")
def text_key_join(spark, d):
    """As the source does it: the left key is transliterated and lower-cased,
    the right key only lower-cased (accented right names cannot match)."""
    h = _hdi(spark, d)
    out = J.text_key_join(_cust_region(spark, d), h.select("region", "hdi").withColumnRenamed("region", "__r"),
                          translit_lower("region"), F.lower(F.col("__r"))).drop("__r")
    return sig_all(out)


@query("text_key_join_corrected", f"""WITH {_HDI_SQL}
SELECT c.c_custkey, n.n_name AS region, {sql_sig('h.hdi')} AS hdi FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN hdi h ON {TRANSLIT_SQL.format(x='n.n_name')} = {TRANSLIT_SQL.format(x='h.region')}""")
def text_key_join_corrected(spark, d):
    h = _hdi(spark, d).withColumnRenamed("region", "__r")
    out = J.text_key_join(_cust_region(spark, d), h, translit_lower("region"), translit_lower("__r")).drop("__r")
    return sig_all(out)


# Catalogue stand-in: crosswalk rules (pattern -> canonical name), first match wins.
CROSSWALK = [
    ("NATION_1$", "Nation One"),
    ("NATION_2", "Nation Two"),
    ("NATION_3", "Nation Three "),
    ("_7", "Séptima"),
]


def _crosswalk_sql(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{t}'" for p, t in CROSSWALK)
    return f"CASE {whens} ELSE {x} END"


@query("recode_crosswalk", f"""SELECT c.c_custkey, lower({_crosswalk_sql('n.n_name')}) AS region_cleaned
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def recode_crosswalk(spark, d):
    c = _cust_region(spark, d)
    return c.select("c_custkey", F.lower(J.recode_contains("region", CROSSWALK)).alias("region_cleaned"))


# ---------------------------------------------------------------- F25 S7
@query("coalesce_codes", """WITH m AS (SELECT n_name AS old_code, r_name || '-' || CAST(n_nationkey AS VARCHAR) AS new_code
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))
SELECT c.c_custkey, coalesce(m.new_code, n.n_name) AS variables
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN m ON n.n_name = m.old_code""")
def coalesce_codes(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    mapper = (n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("old_code"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_nationkey").cast("string")).alias("new_code")))
    c = _cust_region(spark, d)
    j = J.join(c, mapper, {"region": "old_code"}, "left")
    return j.select("c_custkey", F.coalesce("new_code", "region").alias("variables"))


# ---------------------------------------------------------------- P1-P6, P9-P14
# Catalogue stand-in: display names given to the customer columns.
_DISPLAY = {"c_custkey": "Código Único (ID)", "c_name": "Nombre Cliente", "c_acctbal": "Saldo (Cuenta)",
            "c_mktsegment": "Segmento de Mercado"}


@query("rename_bulk", """SELECT c_custkey AS codigo_unico_id, c_name AS nombre_cliente, c_acctbal AS saldo_cuenta,
  c_mktsegment AS segmento_de_mercado FROM customer""")
def rename_bulk(spark, d):
    c = table(spark, d, "customer").select(*_DISPLAY)
    return P.rename_with(P.rename(c, _DISPLAY), sanitize_name)


@query("rename_map", "SELECT c_custkey, c_name AS nombre, c_acctbal AS saldo, c_mktsegment AS tramo FROM customer")
def rename_map(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return P.rename(c, {"c_name": "nombre", "c_acctbal": "saldo", "c_mktsegment": "tramo"})


@query("clean_names_columns", """SELECT o_orderkey AS x2019, o_custkey AS ano, o_orderstatus AS estado_pedido,
  o_totalprice AS estado_pedido_2, o_orderpriority AS na FROM orders""")
def clean_names_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return o.toDF(*clean_names(["2019", "Año", "Estado Pedido", "estado pedido", None]))


@query("select_drop_reorder", """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice FROM lineitem""")
def select_drop_reorder(spark, d):
    li = table(spark, d, "lineitem")
    s = P.select_cols(li, keep=["l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linenumber", "l_tax"],
                      drop=["l_tax"])
    s = P.relocate(s, "l_linenumber", before="l_quantity")
    return P.relocate(s, "l_returnflag", before="l_quantity")


@query("selectors", """SELECT l_extendedprice, l_quantity, l_discount, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax
FROM lineitem""")
def selectors(spark, d):
    li = table(spark, d, "lineitem")
    cols = (S.starts_with(li, "L_EXT") + S.matches(li, "quantity|DISCOUNT")
            + S.exclude(S.where_numeric(li), S.matches(li, "price|quantity|discount")))
    return li.select(*dict.fromkeys(cols))


@query("filter_compound", """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW' AND o_totalprice BETWEEN 50000 AND 300000
  AND lower(o_orderpriority) <> '1-urgent'""")
def filter_compound(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.where(F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW")
                   & F.col("o_totalprice").between(50000, 300000)
                   & (F.lower("o_orderpriority") != "1-urgent"))


@query("filter_latest", """WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders)
SELECT * FROM o WHERE anio = (SELECT max(anio) FROM o)""")
def filter_latest(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("anio"))
    return P.keep_latest(o, "anio")


@query("ratio_columns", f"""SELECT c_custkey, {sql_sig('c_acctbal / nullif(c_nationkey, 0)')} AS saldo_por_nacion,
  {sql_sig('(c_acctbal / nullif(c_custkey, 0)) * 1000')} AS saldo_por_1000 FROM customer""")
def ratio_columns(spark, d):
    c = table(spark, d, "customer")
    out = c.select("c_custkey", r_div("c_acctbal", "c_nationkey").alias("saldo_por_nacion"),
                   (r_div("c_acctbal", "c_custkey") * 1000).alias("saldo_por_1000"))
    return sig_all(out)


@query("literal_column", "SELECT o_orderkey, 'Italia' AS pais, CAST(2024 AS INTEGER) AS anio_ref FROM orders")
def literal_column(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.lit("Italia").alias("pais"),
                                            F.lit(2024).cast("int").alias("anio_ref"))


@query("mutate_across", """SELECT p_partkey, p_name, CASE WHEN p_size <> 1 THEN p_size END AS p_size,
  CASE WHEN p_retailprice <> 0 THEN p_retailprice END AS p_retailprice FROM part""")
def mutate_across(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", F.when(F.col("p_size") != 1, F.col("p_size"))
                                       .alias("p_size"), "p_retailprice")
    cols = S.exclude(S.where_numeric(p), ["p_partkey"])
    return P.mutate_across(p, cols, zero_as_missing).withColumn(
        "p_size", F.when(F.col("p_size") != 1, F.col("p_size")))
