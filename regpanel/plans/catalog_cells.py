"""Catalogue: cells tables (S5, P7, P8), binding by position (J6), join
contracts (J2, J5), fills (W4), narrowed quantiles (A7), the ribbon's grid
(A13) and files by size (K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regpanel.operators import aggregate as A
from regpanel.operators import cells as S
from regpanel.operators import joins as J
from regpanel.operators import windows as W
from regpanel.operators.quantiles import grouped_quantiles
from regpanel.plans.registry import query, sig_all, sql_sig, table
from regpanel.session import scratch_path
from regpanel.sources import readers as R
from regpanel.sources import sinks as K


# ---------------------------------------------------------------- S5
def _part_cells(spark, d):
    """part as one sheet per manufacturer-like group (brand): a header line, then
    a line per part; the brand stands merged over two columns and four lines."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    b = F.floor((F.col("p_partkey") - 1) / 4)
    row = (F.col("p_partkey") + 1).cast("int")
    first = F.col("p_partkey") == b * 4 + 1

    def cell(col, value, where=None):
        q = p if where is None else p.where(where)
        return q.select(F.lit("partes").alias("sheet"), row.alias("row_idx"), F.lit(col).alias("col_idx"), value.alias("value"))
    cells = (cell(1, F.col("p_brand"), first).unionByName(cell(3, F.col("p_name")))
             .unionByName(cell(4, F.when(F.col("p_size") > 1, F.col("p_size").cast("string")))))
    r0 = (b * 4 + 2).cast("int")
    ranges = p.where(first).select(F.lit("partes").alias("sheet"), r0.alias("r0"), F.lit(1).alias("c0"),
                                   (r0 + 3).alias("r1"), F.lit(2).alias("c1"))
    return cells, ranges


@query("merged_cell_fill", """WITH p AS (SELECT p_partkey AS k, (p_partkey - 1) // 4 AS b, * FROM part),
m AS (SELECT b, p_brand AS v FROM p WHERE k = b * 4 + 1),
f AS (SELECT 'partes' AS sheet, CAST(b * 4 + 2 + i AS INTEGER) AS row_idx, CAST(c AS INTEGER) AS col_idx, v AS value
  FROM m, (SELECT unnest(range(4)) AS i) r, (SELECT unnest([1, 2]) AS c) q)
SELECT * FROM f UNION ALL SELECT 'partes', CAST(k + 1 AS INTEGER), 3, p_name FROM p
UNION ALL SELECT 'partes', CAST(k + 1 AS INTEGER), 4, CASE WHEN p_size > 1 THEN CAST(p_size AS VARCHAR) END FROM p""")
def merged_cell_fill(spark, d):
    return S.fill_merged(*_part_cells(spark, d))


# ---------------------------------------------------------------- P7 P8
def _sheet_cells(spark, d):
    """customer, one sheet per segment: two title lines, a header, the rows, a
    source note; lines are numbered by the customer key inside the segment."""
    from pyspark.sql import Window
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("sheet"))
    n = F.row_number().over(Window.partitionBy("sheet").orderBy("c_custkey"))
    body = c.withColumn("row_idx", (n + 3).cast("int"))
    values = [F.col("c_custkey").cast("string"), F.col("c_name"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string"))]
    body = body.select("sheet", "row_idx", F.posexplode(F.array(*values)).alias("i", "value"))
    body = body.select("sheet", "row_idx", (F.col("i") + 1).cast("int").alias("col_idx"), "value")
    sheets = c.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"))
    head = sheets.select("sheet", F.lit(3).alias("row_idx"), F.posexplode(F.array(*map(F.lit, ["Código", "Nombre", "Saldo"]))).alias("i", "value"))
    head = head.select("sheet", "row_idx", (F.col("i") + 1).cast("int").alias("col_idx"), "value")
    title = sheets.select("sheet", F.explode(F.array(F.lit(1), F.lit(2))).alias("row_idx"), F.lit(1).alias("col_idx"), F.col("sheet").alias("value"))
    note = sheets.select("sheet", (F.col("n") + 4).cast("int").alias("row_idx"), F.lit(1).alias("col_idx"), F.lit("Fuente").alias("value"))
    return body.unionByName(head).unionByName(title).unionByName(note)


_SHEET_SQL = """WITH b AS (SELECT c_mktsegment AS sheet, c_custkey, c_name, c_acctbal,
  CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS INTEGER) AS i FROM customer)"""


@query("row_to_names", _SHEET_SQL + """
SELECT sheet, i AS row_idx, CAST(c_custkey AS VARCHAR) AS "Código", c_name AS "Nombre",
  CASE WHEN c_acctbal > 0 THEN c_acctbal END AS "Saldo" FROM b""")
def row_to_names(spark, d):
    """The note goes by an end-relative slice, the header line names the columns."""
    t = S.row_to_names(S.slice_rows(_sheet_cells(spark, d), 1, -1), 3)
    return t.withColumn("Saldo", F.col("Saldo").cast("double"))


@query("slice_rows", _SHEET_SQL + """
SELECT sheet, i AS row_idx, CAST(1 AS INTEGER) AS col_idx, 'Código' AS name, CAST(c_custkey AS VARCHAR) AS value FROM b
WHERE i <= (SELECT max(i) FROM b x WHERE x.sheet = b.sheet) - 1
UNION ALL SELECT sheet, i, 2, 'Nombre', c_name FROM b WHERE i <= (SELECT max(i) FROM b x WHERE x.sheet = b.sheet) - 1""")
def slice_rows(spark, d):
    """Lines 3 to n - 2 of every sheet, long, with the header's names; two columns."""
    c = _sheet_cells(spark, d).where(F.col("col_idx") <= 2)
    return S.row_to_names_long(S.slice_rows(c, 3, -2), 1)


@query("mapper_from_sheets", """SELECT * FROM (VALUES ('V11910', 'ENT_NR'), ('V16910', 'EMP_NR')) t(hist, new)""")
def mapper_from_sheets(spark, d):
    from regpanel.plans.composites import code_mapper
    return code_mapper(spark)


# ---------------------------------------------------------------- J6
def _line_files(spark, d):
    """Three measure files of lineitem in one order, keys repeated in each and many part files."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber")
    li = li.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    root = scratch_path(spark, "bind")
    for name, cols in (("a", ["l_partkey", "l_quantity"]), ("b", ["l_partkey", "l_extendedprice"]), ("c", ["l_quantity", "l_linenumber"])):
        li.select(*cols).write.option("maxRecordsPerFile", 7000).parquet(f"{root}/{name}")
    return root


@query("bind_by_position", "SELECT l_partkey, l_quantity, l_extendedprice, l_linenumber FROM lineitem")
def bind_by_position(spark, d):
    root = _line_files(spark, d)
    tables = [R.read_with_ordinal(spark, f"{root}/{x}") for x in "abc"]
    return J.bind_cols_by_position(tables).drop("__ord")


@query("bind_by_position_csv", "SELECT CAST(c_nationkey AS INTEGER) AS c_nationkey, c_mktsegment, c_acctbal FROM customer")
def bind_by_position_csv(spark, d):
    """The same over text files, whose rows are numbered from a written copy."""
    c = table(spark, d, "customer").orderBy("c_custkey")
    root = scratch_path(spark, "bind_csv")
    parts = {"a": "c_nationkey int, c_mktsegment string", "b": "c_nationkey int, c_acctbal double"}
    for name, schema in parts.items():
        c.select(*[x.split()[0] for x in schema.split(", ")]).write.option("header", True).option("maxRecordsPerFile", 400).csv(f"{root}/{name}")
    tables = [R.read_with_ordinal(spark, f"{root}/{n}", "csv", schema=s, header=True) for n, s in parts.items()]
    return J.bind_cols_by_position(tables).drop("__ord")


# ---------------------------------------------------------------- J2 J5
@query("join_expect_one", """SELECT o.o_orderkey, o.o_custkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_expect_one(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return J.join(o, table(spark, d, "customer").select("c_custkey", "c_name"), {"o_custkey": "c_custkey"}, expect="one")


@query("join_conflicts", """SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY ALL HAVING count(*) > 1""")
def join_conflicts(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    c = J.join_conflicts(li, ["l_orderkey", "l_suppkey"])
    return J.join(c, o.select("o_orderkey"), {"l_orderkey": "o_orderkey"}, "left_semi")


# ---------------------------------------------------------------- W4
@query("forward_fill_spread", """SELECT event_id, event_type,
  last_value(CASE WHEN user_id % 7 = 0 THEN value END IGNORE NULLS) OVER
    (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_value FROM events""")
def forward_fill_spread(spark, d):
    """Five keys hold all rows: ranges of (key, order) are filled and joined up."""
    e = table(spark, d, "events").select("event_id", "event_type", F.struct("ts", "event_id").alias("__o"),
                                         F.when(F.col("user_id") % 7 == 0, F.col("value")).alias("last_value"))
    return W.forward_fill(e, ["event_type"], "__o", ["last_value"]).select("event_id", "event_type", "last_value")


# ---------------------------------------------------------------- A7
@query("quantiles_narrowed", "SELECT l_returnflag, " + ", ".join(
    f"{sql_sig(f'quantile_cont(l_extendedprice, {p})')} AS {n}" for n, p in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)))
    + " FROM lineitem GROUP BY l_returnflag")
def quantiles_narrowed(spark, d):
    """With a bound so low that the ranges are cut anew several times."""
    q = grouped_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), [0.01, 0.5, 0.99], limit=50)
    return sig_all(q.select("l_returnflag", *[F.col("__q")[i].alias(n) for i, n in enumerate(["p01", "p50", "p99"])]))


# ---------------------------------------------------------------- A13
@query("linear_fit_grid", f"""WITH g AS (SELECT l_returnflag, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY l_returnflag)
SELECT l_returnflag, {sql_sig('lo + (hi - lo) * i / 79')} AS l_quantity FROM g, (SELECT unnest(range(80)) AS i)""")
def linear_fit_grid(spark, d):
    return sig_all(A.fit_grid(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice"))


# ---------------------------------------------------------------- K2
@query("files_per_group", """WITH b AS (SELECT o_orderpriority, sum(16 + strlen(o_orderpriority)) AS n_bytes FROM orders
  WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(greatest(ceil(n_bytes / 20000.0), 1) AS INTEGER) AS n_files FROM b""")
def files_per_group(spark, d):
    return K.files_per_group(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"),
                             "o_orderpriority", 20000)
