"""Catalogue: windows, reshape, ordering and set operations (W, R, L, U rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.constants import BLOCK_BANDS, BLOCK_GROUPS, SAMPLE_SEED
from regpanel.operators import order as L
from regpanel.operators import setops as U
from regpanel.operators import windows as W
from regpanel.operators.reshape import (crosstab_normalise, distinct_names, panel_to_cells,
                                        pivot_duplicates, pivot_longer, pivot_wider)
from regpanel.plans.panel import panel, with_panel
from regpanel.plans.registry import query, sig_all, sql_sig, table
from regpanel.session import scratch_path
from regpanel.sources.sinks import checkpoint_to

# ---------------------------------------------------------------- W1 W2 W3
_SHARE_SRC = """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q, l_tax, l_extendedprice FROM lineitem)"""


def _strict_share_sql(x: str) -> str:
    return (f"CASE WHEN count({x}) OVER w = count(*) OVER w THEN "
            f"{x} / nullif(sum({x}) OVER w, 0) END")


def _li_share(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"), "l_tax", "l_extendedprice")


_ROWID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("share_of_group", f"""{_SHARE_SRC}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_sig(_strict_share_sql('q'))} AS share_q
FROM li WINDOW w AS (PARTITION BY l_orderkey)""")
def share_of_group(spark, d):
    li = _li_share(spark, d)
    out = W.share_of_group(li, ["l_orderkey"], {"share_q": F.col("q")})
    return sig_all(out.select(*_ROWID, "share_q"))


@query("share_multi_expr", f"""{_SHARE_SRC}
, e AS (SELECT *, q + l_tax * 100 AS x FROM li)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_sig(_strict_share_sql('x'))} AS share_x
FROM e WINDOW w AS (PARTITION BY l_orderkey)""")
def share_multi_expr(spark, d):
    li = _li_share(spark, d)
    out = W.share_of_group(li, ["l_orderkey"], {"share_x": F.col("q") + F.col("l_tax") * 100})
    return sig_all(out.select(*_ROWID, "share_x"))


def _net_pay(spark, d, corrected):
    li = _li_share(spark, d)
    f, m, h = F.col("l_extendedprice"), F.col("q"), F.col("l_tax") * 1000
    g = W.with_group_aggs(li.withColumn("__fmh", f + m + h), ["l_orderkey"],
                          {"__t": F.sum("__fmh"), "__ok": F.count("__fmh") == F.count(F.lit(1))})
    val = W.net_pay_share(f, m, h, F.when(F.col("__ok"), F.col("__t")), corrected=corrected)
    return sig_all(g.select(*_ROWID, val.alias("share_net_pay")))


def _net_pay_sql(corrected: bool) -> str:
    tot = "CASE WHEN count(fmh) OVER w = count(*) OVER w THEN sum(fmh) OVER w END"
    expr = (f"fmh / nullif({tot}, 0)" if corrected
            else f"l_extendedprice + q + (l_tax * 1000) / nullif({tot}, 0)")
    return f"""{_SHARE_SRC}
, e AS (SELECT *, l_extendedprice + q + l_tax * 1000 AS fmh FROM li)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_sig(expr)} AS share_net_pay
FROM e WINDOW w AS (PARTITION BY l_orderkey)"""


@query("share_net_pay_as_is", _net_pay_sql(False))
def share_net_pay_as_is(spark, d):
    return _net_pay(spark, d, False)


@query("share_net_pay_corrected", _net_pay_sql(True))
def share_net_pay_corrected(spark, d):
    return _net_pay(spark, d, True)


# ---------------------------------------------------------------- W4 W5
@query("forward_fill_header", """SELECT event_id, user_id,
  last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
FROM events""")
def forward_fill_header(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    w = e.withColumn("__o", F.struct("ts", "event_id"))
    filled = W.forward_fill(w, ["user_id"], "__o", ["last_purchase"], chunk=F.to_date("ts"))
    return filled.select("event_id", "user_id", "last_purchase")


@query("first_appearance_ordinal", """WITH f AS (SELECT user_id, event_type, min(struct_pack(ts := ts, id := event_id)) AS fst
  FROM events GROUP BY ALL)
SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY fst) AS INTEGER) AS "group" FROM f""")
def first_appearance_ordinal(spark, d):
    e = table(spark, d, "events").withColumn("__o", F.struct("ts", "event_id"))
    return W.first_appearance_ordinal(e, ["user_id"], "__o", ["event_type"])


# ---------------------------------------------------------------- W6 F29
@query("block_cycle_ordinal", """SELECT p_partkey, CAST(((p_partkey) // 9) % 336 + 1 AS BIGINT) AS grp,
  CAST(p_partkey // 9 AS BIGINT) AS int_div, CAST(p_partkey % 9 AS BIGINT) AS floor_mod FROM part""")
def block_cycle_ordinal(spark, d):
    from regpanel.functions.exprs import floor_div, floor_mod
    p = table(spark, d, "part")
    return p.select("p_partkey", W.block_cycle_ordinal(F.col("p_partkey") + 1, BLOCK_BANDS, BLOCK_GROUPS).alias("grp"),
                    floor_div("p_partkey", F.lit(9)).alias("int_div"),
                    floor_mod("p_partkey", F.lit(9)).cast("bigint").alias("floor_mod"))


# ---------------------------------------------------------------- W7 W8 F24
_LABELS = ("A: alto/alto", "B: bajo/alto", "C: alto/bajo", "D: bajo/bajo")


@query("group_median_rows", with_panel(f"""
SELECT anio, region, tramo, sector,
  {sql_sig('median(numero_empresas) OVER (PARTITION BY tramo)')} AS med_empresas,
  {sql_sig('median(salario_medio) OVER (PARTITION BY tramo)')} AS med_salario FROM panel"""))
def group_median_rows(spark, d):
    p = panel(spark, d)
    out = W.group_medians(p, ["tramo"], {"med_empresas": "numero_empresas", "med_salario": "salario_medio"})
    return sig_all(out.select("anio", "region", "tramo", "sector", "med_empresas", "med_salario"))


@query("quadrant_label", with_panel(f"""
, m AS (SELECT *, median(numero_empresas) OVER (PARTITION BY tramo) AS mx,
  median(salario_medio) OVER (PARTITION BY tramo) AS my FROM panel)
SELECT anio, region, tramo, sector, CASE
  WHEN numero_empresas >= mx AND salario_medio >= my THEN '{_LABELS[0]}'
  WHEN numero_empresas < mx AND salario_medio >= my THEN '{_LABELS[1]}'
  WHEN numero_empresas >= mx AND salario_medio < my THEN '{_LABELS[2]}'
  WHEN numero_empresas < mx AND salario_medio < my THEN '{_LABELS[3]}' END AS patron FROM m"""))
def quadrant_label(spark, d):
    p = W.group_medians(panel(spark, d), ["tramo"], {"mx": "numero_empresas", "my": "salario_medio"})
    lab = W.quadrant_label(F.col("numero_empresas"), F.col("salario_medio"), F.col("mx"), F.col("my"), _LABELS)
    return p.select("anio", "region", "tramo", "sector", lab.alias("patron"))


# ---------------------------------------------------------------- R1
_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _ev_long(spark, d):
    return (table(spark, d, "events").groupBy("user_id", "event_type")
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")))


@query("pivot_wide_codes", "SELECT user_id, " + ", ".join(
    f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{t}') AS DOUBLE) AS {t}" for t in _EVENT_TYPES)
    + " FROM events GROUP BY user_id")
def pivot_wide_codes(spark, d):
    return pivot_wider(_ev_long(spark, d), ["user_id"], "event_type", "total", values=_EVENT_TYPES)


@query("pivot_duplicate_report", """SELECT user_id, event_type, count(*) AS n_values FROM events
GROUP BY ALL HAVING count(*) > 1""")
def pivot_duplicate_report(spark, d):
    return pivot_duplicates(table(spark, d, "events"), ["user_id"], "event_type")


@query("measure_named_from_data", "SELECT user_id, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in _EVENT_TYPES) + " FROM events GROUP BY user_id")
def measure_named_from_data(spark, d):
    """Column names come from the data (the distinct event types, a bounded
    code list) and are only applied at the pivot edge."""
    e = table(spark, d, "events")
    codes = distinct_names(e, "event_type")
    long = e.groupBy("user_id", F.concat(F.lit("n_"), "event_type").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    out = pivot_wider(long, ["user_id"], "code", "n", values=[f"n_{c}" for c in codes], on_duplicate="first")
    return out.na.fill(0, [f"n_{c}" for c in codes])


# ---------------------------------------------------------------- R2 R3 R4
@query("unpivot_all", """SELECT name, value FROM (SELECT CAST(c_acctbal AS DOUBLE) AS c_acctbal,
  CAST(nullif(c_nationkey, 0) AS DOUBLE) AS c_nationkey FROM customer)
UNPIVOT INCLUDE NULLS (value FOR name IN (c_acctbal, c_nationkey))""")
def unpivot_all(spark, d):
    c = table(spark, d, "customer").select("c_acctbal", F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"))
    return pivot_longer(c, c.columns, "name", "value", id_cols=[])


@query("unpivot_keep_key", """SELECT p_partkey, name, value FROM (SELECT p_partkey,
  CAST(nullif(p_size, 1) AS DOUBLE) AS p_size, p_retailprice FROM part)
UNPIVOT INCLUDE NULLS (value FOR name IN (p_size, p_retailprice))""")
def unpivot_keep_key(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.nullif("p_size", F.lit(1)).alias("p_size"), "p_retailprice")
    return pivot_longer(p, ["p_size", "p_retailprice"], "name", "value")


@query("unpivot_subset", """SELECT p_partkey, p_brand, p_type, variable, valor FROM (SELECT p_partkey, p_brand, p_type,
  CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part)
UNPIVOT INCLUDE NULLS (valor FOR variable IN (p_size, p_retailprice))""")
def unpivot_subset(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return pivot_longer(p, ["p_size", "p_retailprice"], "variable", "valor",
                        id_cols=["p_partkey", "p_brand", "p_type"])


# ---------------------------------------------------------------- R7 P7 P8 J7
# measure -> sheet, title cell, variable name after normalisation
_SHEETS = {"numero_empresas": ("Tabela 0", "Variável - Número de empresas (Unidades)", "numero_de_empresas_unidades"),
           "pedidos": ("Tabela 1", "Variável - Pedidos (Unidades)", "pedidos_unidades"),
           "valor_total": ("Tabela 2", "Variável - Valor total (Reais)", "valor_total_reais"),
           "pessoal_ocupado": ("Tabela 3", "Variável - Pessoal ocupado (Pessoas)", "pessoal_ocupado_pessoas"),
           "salario_medio": ("Tabela 4", "Variável - Salário médio (Reais)", "salario_medio_reais")}


def panel_cells(spark, d):
    """The panel laid out as crosstab sheets, one per measure; a missing value
    is a blank body cell (a row with a NULL value).

    The long panel feeds five branches of the layout and the cells feed five
    branches of the normaliser, so both are written once instead of being
    recomputed per branch."""
    p = panel(spark, d)
    long = pivot_longer(p.select("anio", "region", "tramo", "sector", *_SHEETS), list(_SHEETS), "measure", "value",
                        id_cols=["anio", "region", "tramo", "sector"])
    sheet, title = (F.element_at(F.create_map(*[F.lit(x) for m, s in _SHEETS.items() for x in (m, s[i])]), F.col("measure"))
                    for i in (0, 1))
    long = long.withColumn("sheet", sheet).withColumn("title", title)
    long = checkpoint_to(spark, long, scratch_path(spark, "sheets-long"))
    cells = panel_to_cells(long, "sheet", "title", "anio", "sector", "region", "tramo", "value")
    return checkpoint_to(spark, cells, scratch_path(spark, "sheets-cells"))


CROSSTAB_SQL = with_panel(f"""
, l AS (SELECT * FROM panel UNPIVOT INCLUDE NULLS (value FOR measure IN ({", ".join(_SHEETS)}))),
s(measure, sheet, variable) AS (VALUES {", ".join(f"('{m}', '{x[0]}', '{x[2]}')" for m, x in _SHEETS.items())})
SELECT sheet, variable, CAST(anio AS VARCHAR) AS anio, sector, region, tramo, TRY_CAST(trunc(value) AS INTEGER) AS value
FROM l JOIN s USING (measure)""")


@query("crosstab_normalise", CROSSTAB_SQL)
def crosstab_normalise_q(spark, d):
    return crosstab_normalise(panel_cells(spark, d))


# ---------------------------------------------------------------- L1-L4
@query("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 6")
def head_n(spark, d):
    return L.head_n(table(spark, d, "orders"), "o_orderkey", 6)


@query("tail_n", "SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 6) ORDER BY o_orderkey")
def tail_n(spark, d):
    return L.tail_n(table(spark, d, "orders"), "o_orderkey", 6)


@query("sample_n_seeded", f"""SELECT * FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|{SAMPLE_SEED}'), o_orderkey LIMIT 6""")
def sample_n_seeded(spark, d):
    return L.sample_n(table(spark, d, "orders"), 6, seed=SAMPLE_SEED, by=["o_orderkey"])


def _band_labels(spark, d):
    p = table(spark, d, "part")
    lo = (F.floor(F.col("p_size") / 10) * 10).cast("int")
    lab = F.when(F.col("p_size") > 45, F.lit("Total")).otherwise(
        F.concat(lo.cast("string"), F.lit(" a "), (lo + 9).cast("string")))
    return p.select(lab.alias("tramo"))


@query("ordinal_sort", """WITH t AS (SELECT DISTINCT CASE WHEN p_size > 45 THEN 'Total' ELSE
  CAST(CAST(floor(p_size / 10) * 10 AS INTEGER) AS VARCHAR) || ' a ' || CAST(CAST(floor(p_size / 10) * 10 AS INTEGER) + 9 AS VARCHAR) END AS tramo FROM part)
SELECT tramo, CAST(row_number() OVER (ORDER BY try_cast(regexp_replace(tramo, ' .*', '') AS DOUBLE) ASC NULLS LAST, tramo) AS INTEGER) AS level
FROM t""")
def ordinal_sort(spark, d):
    return L.ordinal_levels(_band_labels(spark, d), "tramo")


# ---------------------------------------------------------------- U1-U5
@query("union_distinct", "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return U.union_distinct(c, s)


@query("distinct_projection", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_projection(spark, d):
    return U.distinct_rows(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_rows", "SELECT DISTINCT * FROM lineitem")
def distinct_rows(spark, d):
    return U.distinct_rows(table(spark, d, "lineitem"))


@query("bind_rows", """SELECT c_custkey AS id, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier""")
def bind_rows(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
                                           F.col("c_acctbal").alias("acctbal"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nationkey"),
                                           F.col("s_acctbal").alias("acctbal"))
    return U.bind_rows([c, s])


@query("bind_rows_fill", """SELECT c_custkey AS id, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def bind_rows_fill(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"),
                                           F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"))
    return U.bind_rows([c, s], fill=True)


CROSSTAB_DOUBLE_SQL = CROSSTAB_SQL.replace("TRY_CAST(trunc(value) AS INTEGER) AS value", "value")


@query("crosstab_normalise_double", CROSSTAB_DOUBLE_SQL)
def crosstab_normalise_double(spark, d):
    """Same sheets with ``value_type="double"``: ratio measures keep their
    fraction instead of the source's truncating integer cast."""
    return crosstab_normalise(panel_cells(spark, d), value_type="double")
