"""Merged cells, header rows, ordinals, join contracts, fills, narrowed
quantiles, checked sketches, moment matrices, the ribbon's t and sized files."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from regpanel.operators import aggregate as A
from regpanel.operators import cells as C
from regpanel.operators import joins as J
from regpanel.operators import quantiles as Q
from regpanel.operators import windows as W
from regpanel.operators.project import keep_latest
from regpanel.sources import readers as R
from regpanel.sources import sinks as K

CELLS = "sheet string, row_idx int, col_idx int, value string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


# ------------------------------------------------------------ cells


def test_fill_merged(spark):
    cells = spark.createDataFrame([("s", 1, 1, "A"), ("s", 2, 2, "gone"), ("s", 1, 3, "x"), ("s", 4, 4, None), ("t", 1, 1, "T"),
                                   ("s", 9, 9, "old")], CELLS)
    ranges = spark.createDataFrame([("s", 1, 1, 2, 2), ("s", 4, 4, 5, 4), ("s", 8, 9, 9, 9)],
                                   "sheet string, r0 int, c0 int, r1 int, c1 int")
    got = {(r[0], r[1], r[2]): r[3] for r in C.fill_merged(cells, ranges).collect()}
    assert got == {("s", 1, 1): "A", ("s", 1, 2): "A", ("s", 2, 1): "A", ("s", 2, 2): "A", ("s", 1, 3): "x",
                   ("s", 4, 4): None, ("s", 5, 4): None, ("s", 8, 9): None, ("s", 9, 9): None, ("t", 1, 1): "T"}
    empty = spark.createDataFrame([], "sheet string, r0 int, c0 int, r1 int, c1 int")
    assert rows(C.fill_merged(cells, empty)) == rows(cells)


def test_slices_count_from_each_sheets_end(spark):
    cells = spark.createDataFrame([(s, r, 1, f"{s}{r}") for s, n in (("a", 5), ("b", 3)) for r in range(1, n + 1)], CELLS)
    assert [(r[0], r[1], r[3]) for r in rows(C.slice_rows(cells, 2, -1))] == [
        ("a", 1, "a2"), ("a", 2, "a3"), ("a", 3, "a4"), ("b", 1, "b2")]
    assert [r[3] for r in rows(C.slice_rows(cells, 3, 4))] == ["a3", "a4", "b3"]
    assert [r[3] for r in rows(C.slice_rows(cells, 4))] == ["a4", "a5"]
    assert rows(C.slice_rows(cells, 2, 0)) == rows(C.slice_rows(cells, 2))


def test_row_to_names(spark):
    data = [["t", None, None], ["n", None, "n"], ["1", "2", None], ["3", None, "4"]]
    cells = spark.createDataFrame([("s", r, c, v) for r, row in enumerate(data, 1) for c, v in enumerate(row, 1)], CELLS)
    t = C.row_to_names(cells, 2)
    assert t.columns == ["sheet", "row_idx", "n", "NA", "n_2"]
    assert rows(t) == [("s", 1, "1", "2", None), ("s", 2, "3", None, "4")]
    long = C.row_to_names_long(cells, 2, "tramo").where("col_idx = 1")
    assert rows(long) == [("s", 1, 1, "n", "1"), ("s", 2, 1, "n", "3")]
    other = cells.unionByName(spark.createDataFrame([("u", 2, 1, "m")], CELLS))
    with pytest.raises(ValueError, match="headers differ"):
        C.row_to_names(other, 2)


# ------------------------------------------------------------ ordinals and unlike files


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ordinals_follow_the_files(spark, tmp_path, fmt):
    p = str(tmp_path / "t")
    spark.range(0, 500, 1, 7).write.format(fmt).option("header", True).option("maxRecordsPerFile", 13).save(p)
    opts = {"schema": "id long", "header": True} if fmt == "csv" else {}
    got = R.read_with_ordinal(spark, p, fmt, **opts).collect()
    assert sorted((r["__ord"], int(r["id"])) for r in got) == [(i, i) for i in range(500)]


def test_bind_by_position(spark):
    a = spark.createDataFrame([(0, "k", 1), (1, "k", None), (2, None, 3)], "__ord long, key string, a int")
    b = spark.createDataFrame([(2, "other", 30), (0, "k", 10), (1, "k", 20)], "__ord long, key string, b int")
    assert rows(J.bind_cols_by_position([a, b])) == [(0, "k", 1, 10), (1, "k", None, 20), (2, None, 3, 30)]
    with pytest.raises(Exception, match="number of rows"):
        J.bind_cols_by_position([a, b.where("b > 10")]).collect()


def test_bind_by_key_raises_on_repeats(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("x", 1), ("x", 2)], "k string, b int")
    with pytest.raises(Exception, match="not unique"):
        J.bind_cols_by_key([a, b], ["k"]).collect()
    assert rows(J.bind_cols_by_key([a, b.where("b = 2")], ["k"])) == [("x", 1, 2), ("y", 2, None)]


def test_unlike_folder(spark, tmp_path):
    from regpanel.plans.composites import natural_merge, natural_merge_unlike
    files = {"a.csv": ["Año,Departamento,Tamaño,Indicador,Sector,Valor", "2020,D1,T1,Empresas,s,1", '2020,D2,T1,Empresas,"x, y",2',
                       "2021,D1,T2,Empresas,s,SIN DATOS"],
             "b.csv": ["Departamento,Año,Indicador,Sector,Valor", "D1,2020,Ventas,s,10", "", "D2,2021,Ventas,s,11"],
             "c.csv": ["Indicador,Sector,Valor,Departamento", "Área,s,7.5,D1"],
             "d.csv": ["Empresas,Año,Departamento,Tamaño,Indicador,Sector,Valor", "1,2020,D1,T1,Otra,s,5", "9,2020,D2,T1,Otra,s,6"]}
    for n, lines in files.items():
        (tmp_path / n).write_text("\n".join(lines) + "\n", encoding="utf-8")
    one = natural_merge_unlike(spark, str(tmp_path))
    each = natural_merge([spark.read.option("header", True).csv(str(tmp_path / n)) for n in sorted(files)])
    assert sorted(one.columns) == sorted(each.columns)
    assert rows(one.select(*each.columns)) == rows(each)
    got = {(str(r["anio"]), r["departamento"]): (r["empresas"], r["ventas"], r["area"], r["otra"]) for r in one.collect()}
    assert got[("2020.0", "D1")] == (1.0, 10.0, 7.5, 5.0)  # the shared measure was a key of the last file
    (tmp_path / "e.csv").write_text("Departamento,Indicador,Sector,Valor\nD1,p,s,1\nD1,q,s,1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="more than one indicator"):
        natural_merge_unlike(spark, str(tmp_path))


def test_folded_chain_equals_the_chain(spark):
    t = [spark.createDataFrame([("a", 1, 1.0), ("b", 1, None), (None, 2, 3.0)], "k string, y int, v double"),
         spark.createDataFrame([("a", 1, 5), (None, 2, 6)], "k string, y int, w int"),
         spark.createDataFrame([("b", 1, 7)], "k string, y int, x int"),
         spark.createDataFrame([(1, "p"), (2, "q")], "y int, z string"),
         spark.createDataFrame([("p", 1.0, "u")], "z string, v double, m string")]
    a, b = J.left_join_chain(t), J.folded_join_chain(t)
    assert a.columns == b.columns and rows(a) == rows(b)
    with pytest.raises(Exception, match="not unique"):
        J.folded_join_chain([t[0], t[1].unionAll(t[1]), t[2]]).collect()


# ------------------------------------------------------------ join contract


def test_expect_one(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10, None), (None, 30, "n")], "k string, b int, c string")
    assert rows(J.join(a, b, ["k"], "left", expect="one")) == rows(J.join(a, b, ["k"], "left"))
    twice = b.unionByName(spark.createDataFrame([(None, 31, "m")], b.schema))
    with pytest.raises(Exception, match="not unique"):
        J.join(a, twice, ["k"], "left", expect="one").collect()
    assert rows(J.join_conflicts(twice, ["k"])) == [(None, 2)]
    assert rows(J.join_conflicts(twice, ["k"], a.where("k is not null"))) == []
    assert rows(J.one_per_key(a.select("k"), ["k"])) == rows(a.select("k"))
    with pytest.raises(Exception, match="not unique"):
        J.one_per_key(twice.select("k"), ["k"]).collect()


def test_fold_raises_on_repeats_out_of_its_own_aggregate(spark):
    long = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 2.0), ("q", "b", 3.0)], "k string, n string, v double")
    assert rows(J.fold_as_pivot(long, ["k"], "n", ["v"], ["a", "b"], "a")) == [("r", 1.0, 2.0)]
    plan = J.fold_as_pivot(long, ["k"], "n", ["v"], ["a", "b"], "a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="not unique"):
        J.fold_as_pivot(long.unionAll(long), ["k"], "n", ["v"], ["a", "b"], "a").collect()


# ------------------------------------------------------------ fills and quantiles


def test_fill_without_chunk_equals_the_single_window(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc") if i % 50 else None, i, rng.choice([None, None, i]), rng.choice([None, f"t{i}"])) for i in range(800)]
    df = spark.createDataFrame(data, "k string, o int, v int, t string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(tuple(r) for r in W.forward_fill(df, ["k"], "o", ["v", "t"]).collect() if r["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    last, want = {}, []
    for k, o, v, t in sorted(data, key=lambda r: r[1]):
        a = last.get(k, (None, None))
        last[k] = (v if v is not None else a[0], t if t is not None else a[1])
        if k:
            want.append((k, o, *last[k]))
    assert got == sorted(want)


@pytest.mark.parametrize("limit", [3, 40, 1 << 16])
def test_narrowing_changes_no_quantile(spark, limit):
    rng = random.Random(limit)
    data = [("a", rng.choice([rng.random(), 0.5, float(rng.randint(0, 9))])) for _ in range(700)]
    data += [("b", 1.0)] * 40 + [("c", None), ("d", float("nan")), ("d", 4.0), (None, 2.0), (None, 5.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r["__q"] for r in Q.grouped_quantiles(df, ["g"], F.col("x"), [0.0, 0.25, 0.5, 0.99, 1.0], limit=limit).collect()}
    a = sorted(x for g, x in data if g == "a")
    want = [a[0], *(statistics.quantiles(a, n=100, method="inclusive")[i] for i in (24, 49, 98)), a[-1]]
    assert got["a"] == pytest.approx(want) and got["b"] == [1.0] * 5 and got["d"] == [4.0] * 5 and "c" not in got
    assert got[None] == pytest.approx([2.0, 2.75, 3.5, 4.97, 5.0])


def test_box_reads_its_input_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as y").write.parquet(str(tmp_path / "t"))
    box = A.boxplot_stats(spark.read.parquet(str(tmp_path / "t")), ["g"], "y", log=None)
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "t") not in plan  # only the written counts are left in the plan
    assert plan.count("Exchange") <= 6
    assert rows(box.select("g", "n", "n_outliers", "whisker_low")) == [(0, 334, 0, 0.0), (1, 333, 0, 1.0), (2, 333, 0, 2.0)]


# ------------------------------------------------------------ statistics


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 2020, "r", "t", 1.0, 1.0), ("a", 2020, "r", "t", nan, 2.0), ("a", 2020, "r", "t", 3.0, nan),
                                ("a", 2020, "r", "t", 5.0, 9.0)], "g string, anio int, region string, tramo string, x double, y double")
    r = A.distribution_table(df, "g", ["x"]).first()
    assert (r["min"], r["mediana"], r["media"], r["max"], r["cant_faltantes"]) == (1.0, 3.0, 3.0, 5.0, 1)
    s = A.summarise_sum_mean(df, ["g"], ["x"], ["y"]).first()
    assert (s["x"], s["y"]) == (9.0, 4.0)
    assert A.summarise_strict(df, ["g"], ["x"]).first()["x"] is None
    assert A.missing_pct(df, "anio", ("region", "tramo"), ["x"]).first()["pct_faltantes"] == 100.0
    assert A.boxplot_stats(df, ["g"], "x", log=None).first()["n"] == 3
    assert A.linear_fit(df, ["g"], "x", "y").first()["n"] == 2
    assert A.correlation_pairs(df, ["x", "y"]).first()["n"] == 2
    assert sum(r["n"] for r in A.histogram(df, ["g"], "x", 4).collect()) == 3
    assert A.evolution_total(df, "anio", "tramo", "x", strict=False).first()["total"] == 9.0
    from regpanel.operators.profile import profile
    p = {r["skim_variable"]: r for r in profile(df).collect()}
    assert p["x"]["n_missing"] == 1 and p["x"]["p100"] == 5.0 and p["x"]["p50"] == 3.0


def test_t_quantiles_are_exact():
    # published values of the 0.975 quantile
    known = {1: 12.706204736174696, 2: 4.302652729749462, 3: 3.182446305283708, 5: 2.570581835636314, 10: 2.228138851986274,
             30: 2.042272456301238, 120: 1.9799304050824402}
    for df, t in known.items():
        assert A.t_quantile_value(0.975, df) == pytest.approx(t, rel=1e-9)
    z, edge = statistics.NormalDist().inv_cdf(0.975), A.T_TABLE
    series = z + sum(c / edge ** k for k, c in enumerate(A._t_terms(z), 1))
    assert A.t_quantile_value(0.975, edge) == pytest.approx(series, abs=1e-11)  # both forms meet where one takes over
    for p in (0.6, 0.9, 0.995):
        for df in (1, 2, 3, 8, 51):
            assert A._t_cdf(A.t_quantile_value(p, df), df) == pytest.approx(p, abs=1e-12)


def test_sketch_ranks_are_checked(spark):
    df = spark.range(5000).selectExpr("'g' as g", "cast(id as double) as x")
    t = A.distribution_table_approx(df, "g", ["x"], accuracy=200).first()
    assert t["p25_ok"] and t["mediana_ok"] and t["p75_ok"]
    some = spark.createDataFrame([("g", [0.0, 2500.0])], "g string, __q array<double>")
    r = A.quantile_ranks(df, ["g"], F.col("x"), some, 2)
    assert [tuple(x) for x in r.first()["ranks"]] == [(1, 1), (2501, 2501)]
    ok = r.select(A.rank_within(F.col("ranks")[0], F.col("n"), 0.25, 200), A.rank_within(F.col("ranks")[1], F.col("n"), 0.5, 200))
    assert tuple(ok.first()) == (False, True)


def test_moment_matrix_equals_the_expressions(spark):
    rng = random.Random(9)
    cols = ["a", "b", "c", "d", "e"]
    data = [(rng.choice(["p", "q", None]), *[rng.choice([None, float("nan"), rng.gauss(1e6, 1)]) if c != "d" else 3.0 for c in cols])
            for _ in range(300)] + [("z", 1.0, None, 2.0, None, None)]
    df = spark.createDataFrame(data, "k string, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    key = lambda r: (r["k"] is not None, r["k"], r["var_x"], r["var_y"])
    a = sorted(A.correlation_pairs(df, cols, ["k"]).collect(), key=key)
    b = sorted(A.correlation_matrix(df, cols, ["k"]).collect(), key=key)
    assert [tuple(r)[:3] + (r["n"],) for r in a] == [tuple(r)[:3] + (r["n"],) for r in b]
    for x, y in zip(a, b, strict=True):
        assert (x["corr"] is None) == (y["corr"] is None), (x, y)
        assert x["corr"] is None or x["corr"] == pytest.approx(y["corr"], abs=1e-7)


def test_moment_matrix_of_500_columns_plans_small(spark):
    cols = [f"c{i}" for i in range(500)]
    df = spark.range(20).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(cols)])
    out = A.correlation_pairs(df, cols)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 400_000
    assert out.count() == 500 * 499 // 2


def test_keep_latest_is_lazy(spark):
    df = spark.createDataFrame([(2020, 1), (2021, 2), (2021, 3)], "y int, v int")
    assert rows(keep_latest(df, "y")) == [(2021, 2), (2021, 3)]
    assert keep_latest(df.unionByName(spark.createDataFrame([(None, 4)], "y int, v int")), "y").count() == 0


# ------------------------------------------------------------ sinks


def test_files_follow_the_groups_size(spark, tmp_path):
    big = [("Big", "x" * 100, i) for i in range(4000)]
    small = [(g, "y", i) for g in ("s1", "s2") for i in range(5)]
    df = spark.createDataFrame([*big, *small, (None, "z", 1)], "g string, t string, v int").repartition(9)
    sizes = {r["g"]: r["n_files"] for r in K.files_per_group(df, "g", 100_000).collect()}
    assert sizes == {"Big": 5, "s1": 1, "s2": 1}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = K.write_per_group(df, str(tmp_path / "o"), "g", target_bytes=100_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "o").iterdir() if p.is_dir()}
    assert set(n) == {f"{key}=big", f"{key}=s1", f"{key}=s2"}  # the NULL group is not written
    assert 2 <= n[f"{key}=big"] <= 5 and n[f"{key}=s1"] == n[f"{key}=s2"] == 1
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4010


def test_scratch_is_cleared(spark):
    from regpanel.session import clear_scratch, scratch_path
    p = scratch_path(spark, "t")
    spark.range(3).write.parquet(p)
    assert clear_scratch(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(p)


# ------------------------------------------------------------ small tables that large ones meet


@pytest.fixture
def little_broadcast(spark):
    """Only tables below 20 kB are sent around unasked."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20kb")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _sorted_joins(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin")


def test_rows_stay_where_they_are_for_their_ordinals(spark, tmp_path, little_broadcast):
    p = str(tmp_path / "t")
    spark.range(0, 40000, 1, 3).select("id", F.xxhash64("id").alias("x")).write.option("maxRecordsPerFile", 9000).parquet(p)
    got = R.read_with_ordinal(spark, p)
    assert _sorted_joins(got) == 0
    assert got.where("__ord <> id").count() == 0 and got.count() == 40000


def test_values_stay_where_they_are_for_their_ranks(spark, tmp_path, little_broadcast):
    p = str(tmp_path / "t")
    spark.range(0, 40000, 1, 3).selectExpr("if(id % 4 = 0, 'a', 'b') as g", "cast(id % 997 as double) / 7 as x", "rand(1) as y").write.parquet(p)
    t = A.distribution_table_approx(spark.read.parquet(p), "g", ["x", "y"], accuracy=200)
    assert _sorted_joins(t) == 1  # of the two results, one row a group each
    assert [(r["g"], r["variable"], r["p25_ok"], r["mediana_ok"], r["p75_ok"]) for r in t.orderBy("g", "variable").collect()] == [
        (g, v, True, True, True) for g in "ab" for v in "xy"]
