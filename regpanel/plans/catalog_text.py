"""Catalogue: scalar functions (F rows) over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.functions import dates as D
from regpanel.functions import exprs as X
from regpanel.functions import text as T
from regpanel.operators.project import parse_guess
from regpanel.plans.registry import query, table

def _sql_num(x: str) -> str:
    """A cast of the engine itself; what it takes beyond plain decimals (inf, nan, underscores) is shut out."""
    return (f"CASE WHEN lower({x}) NOT SIMILAR TO '.*(inf|nan|_|0x).*' THEN try_cast(trim({x}, ' ') AS DOUBLE) END")


def _sql_int(x: str) -> str:
    d = _sql_num(x)
    return (f"CASE WHEN ({d}) > -2147483648.0 AND ({d}) < 2147483648.0 "
            f"THEN CAST(trunc({d}) AS INTEGER) END")


# ---------------------------------------------------------------- F10 F1 F4
@query("translit_ascii", """SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS text_ascii,
  replace(strip_accents(lower(text)), 'ß', 'ss') AS text_lower FROM documents""")
def translit_ascii(spark, d):
    return table(spark, d, "documents").select("doc_id", T.translit_ascii("text").alias("text_ascii"),
                                               T.translit_lower("text").alias("text_lower"))


@query("sanitize_text", """SELECT doc_id, lower(replace(strip_accents(regexp_replace(regexp_replace(
  replace(text, ' ', '_'), '\\(', ''), '\\)', '')), 'ß', 'ss')) AS text_clean FROM documents""")
def sanitize_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.sanitize("text").alias("text_clean"))


@query("lower_text", "SELECT c_custkey, lower(c_name) AS nombre FROM customer")
def lower_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.lower("c_name").alias("nombre"))


# ---------------------------------------------------------------- F3 F5 F6 F7 F8 F12
@query("replace_first", """SELECT p_partkey, regexp_replace(p_name, ' ', '_') AS first_,
  regexp_replace(p_brand, '#', '') AS brand FROM part""")
def replace_first(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", T.replace_first("p_name", " ", "_").alias("first_"),
                    T.replace_first("p_brand", "#").alias("brand"))


@query("startswith_flag", "SELECT p_partkey, starts_with(p_name, 'b') AS starts_b FROM part")
def startswith_flag(spark, d):
    return table(spark, d, "part").select("p_partkey", F.startswith("p_name", F.lit("b")).alias("starts_b"))


@query("substr_code", "SELECT c_custkey, substr(c_mktsegment, 1, 2) AS code FROM customer")
def substr_code(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.substring("c_mktsegment", 1, 2).alias("code"))


@query("split_nth", "SELECT c_custkey, nullif(split_part(c_name, '#', 2), '') AS numero, nullif(split_part(c_name, '#', 3), '') AS nada FROM customer")
def split_nth(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", T.split_nth("c_name", "#", 2).alias("numero"), T.split_nth("c_name", "#", 3).alias("nada"))


@query("separate_code_name", """SELECT o_orderkey,
  CASE WHEN strpos(o_orderpriority, ' ') > 0 THEN split_part(o_orderpriority, ' ', 1) END AS codigo,
  CASE WHEN strpos(o_orderpriority, ' ') > 0 THEN substr(o_orderpriority, strpos(o_orderpriority, ' ') + 1) ELSE o_orderpriority END AS nombre
FROM orders""")
def separate_code_name(spark, d):
    o = table(spark, d, "orders")
    code, name = T.separate_code_name("o_orderpriority", " ")
    return o.select("o_orderkey", code.alias("codigo"), name.alias("nombre"))


_TRUNC_SRC = "p_name || ' ' || p_type || ' ' || p_brand"


@query("trunc_center", f"""SELECT p_partkey, CASE WHEN length({_TRUNC_SRC}) > 20 THEN
  substr({_TRUNC_SRC}, 1, 9) || '..' || right({_TRUNC_SRC}, 9) ELSE {_TRUNC_SRC} END AS etiqueta FROM part""")
def trunc_center(spark, d):
    p = table(spark, d, "part")
    s = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return p.select("p_partkey", X.trunc_center(s, 20, "..").alias("etiqueta"))


# ---------------------------------------------------------------- F2 F11 F19
_SIZECLASS = "CASE WHEN p_size = 1 THEN '0' WHEN p_size < 10 THEN '1-9' ELSE 'GE10' END"


@query("band_recode", f"SELECT p_partkey, replace(replace({_SIZECLASS}, '-', ' a '), 'GE', '+') AS tramo FROM part")
def band_recode(spark, d):
    p = table(spark, d, "part")
    code = F.when(F.col("p_size") == 1, "0").when(F.col("p_size") < 10, "1-9").otherwise("GE10")
    return p.select("p_partkey", T.band_recode(code).alias("tramo"))


@query("string_build", """SELECT c.c_custkey, concat_ws('-', n.n_name, c.c_mktsegment) AS etiqueta,
  CAST(c.c_nationkey AS VARCHAR) || '-01-01' AS fecha_txt FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def string_build(spark, d):
    from regpanel.operators.joins import join
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = join(c, n, {"c_nationkey": "n_nationkey"}, "inner")
    return j.select("c_custkey", F.concat_ws("-", "n_name", "c_mktsegment").alias("etiqueta"),
                    F.concat(F.col("c_nationkey").cast("string"), F.lit("-01-01")).alias("fecha_txt"))


@query("to_text", "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS tcode FROM customer")
def to_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("tcode"))


# ---------------------------------------------------------------- F13-F16
@query("year_to_date", "SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS anio FROM orders")
def year_to_date(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", D.year_to_date(F.year("o_orderdate").cast("string")).alias("anio"))


@query("date_to_year_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS anio FROM orders")
def date_to_year_text(spark, d):
    return table(spark, d, "orders").select("o_orderkey", D.date_to_year_text(F.col("o_orderdate").cast("date")).alias("anio"))


@query("year_int", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders")
def year_int(spark, d):
    return table(spark, d, "orders").select("o_orderkey", D.year_int("o_orderdate").alias("anio"))


@query("year_sequence", """SELECT CAST(unnest(generate_series(make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1),
  make_date(CAST(max(year(o_orderdate)) AS INTEGER), 1, 1), INTERVAL 1 YEAR)) AS DATE) AS anio FROM orders""")
def year_sequence(spark, d):
    o = table(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    return o.select(F.explode(D.year_sequence("lo", "hi")).alias("anio"))


# ---------------------------------------------------------------- F17 F18 F21 F22 F23
def _texts(spark, d):
    e = table(spark, d, "events")
    v = F.col("value").cast("string")
    return e.select("event_id", v.alias("t1"), F.concat(F.lit(" "), v, F.lit(" ")).alias("t2"),
                    F.when(F.col("event_type") == "error", F.lit("X")).otherwise(v).alias("t3"),
                    (F.col("value") * 1e9).cast("string").alias("t4"), F.concat(v, F.lit("d")).alias("t5"))


_TEXTS_SQL = """WITH t AS (SELECT event_id, CAST(value AS VARCHAR) AS t1, ' ' || CAST(value AS VARCHAR) || ' ' AS t2,
  CASE WHEN event_type = 'error' THEN 'X' ELSE CAST(value AS VARCHAR) END AS t3,
  CAST(value * 1e9 AS VARCHAR) AS t4, CAST(value AS VARCHAR) || 'd' AS t5 FROM events)"""


@query("lenient_int", _TEXTS_SQL + "\nSELECT event_id, " + ", ".join(
    f"{_sql_int(f't{i}')} AS i{i}" for i in range(1, 6)) + " FROM t")
def lenient_int(spark, d):
    t = _texts(spark, d)
    return t.select("event_id", *[X.as_int_trunc(f"t{i}").alias(f"i{i}") for i in range(1, 6)])


@query("lenient_double", _TEXTS_SQL + "\nSELECT event_id, " + ", ".join(
    f"{_sql_num(f't{i}')} AS n{i}" for i in (1, 2, 3, 5)) + " FROM t")
def lenient_double(spark, d):
    t = _texts(spark, d)
    return t.select("event_id", *[X.as_num(f"t{i}").alias(f"n{i}") for i in (1, 2, 3, 5)])


@query("token_to_null", "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prioridad FROM orders")
def token_to_null(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.missing_token("o_orderpriority", "5-LOW").alias("prioridad"))


@query("null_default", "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'region') AS prioridad FROM orders")
def null_default(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.coalesce(T.missing_token("o_orderpriority", "5-LOW"), F.lit("region")).alias("prioridad"))


@query("if_else_null", """SELECT l_orderkey, l_linenumber,
  CASE WHEN nullif(l_linenumber, 3) IS NULL THEN NULL WHEN nullif(l_linenumber, 3) > 2 THEN 'alto' ELSE 'bajo' END AS nivel
FROM lineitem""")
def if_else_null(spark, d):
    li = table(spark, d, "lineitem")
    k = F.nullif("l_linenumber", F.lit(3))
    return li.select("l_orderkey", "l_linenumber", X.if_else3(k > 2, F.lit("alto"), F.lit("bajo")).alias("nivel"))


# ---------------------------------------------------------------- F20
@query("guess_types", """SELECT p_partkey, CAST(p_size AS DOUBLE) AS tam, p_retailprice AS precio, p_name AS nombre,
  p_size > 25 AS grande, CAST(make_date(2000, 1, 1) + CAST(p_size AS INTEGER) AS DATE) AS fecha FROM part""")
def guess_types(spark, d):
    p = table(spark, d, "part")
    txt = p.select("p_partkey", F.col("p_size").cast("string").alias("tam"),
                   F.col("p_retailprice").cast("string").alias("precio"), F.col("p_name").alias("nombre"),
                   F.when(F.col("p_size") > 25, "TRUE").otherwise("FALSE").alias("grande"),
                   F.date_add(F.make_date(F.lit(2000), F.lit(1), F.lit(1)), F.col("p_size")).cast("string").alias("fecha"))
    return parse_guess(txt, ["tam", "precio", "nombre", "grande", "fecha"])
