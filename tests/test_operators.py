"""Operators: NULL poisoning, NULL-key joins, reshape and statistics traps."""

import pytest
from pyspark.sql import functions as F

from regpanel.functions.exprs import n_distinct_na, strict_sum, sum_na_rm
from regpanel.operators import aggregate as A
from regpanel.operators import joins as J
from regpanel.operators import order as L
from regpanel.operators import project as P
from regpanel.operators import windows as W
from regpanel.operators.profile import profile
from regpanel.operators.reshape import crosstab_normalise, pivot_longer, pivot_wider


def _key(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=_key)


def test_strict_vs_na_rm_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "g string, x double")
    out = df.groupBy("g").agg(strict_sum("x").alias("s"), sum_na_rm("x").alias("r"))
    assert rows(out) == [("a", None, 1.0), ("b", 2.0, 2.0), ("c", None, 0.0)]


def test_zero_as_missing_after_sum(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 3.0), ("b", 2.0, 0.0)], "g string, x double, y double")
    out = A.summarise_sum_mean(df, ["g"], ["x"], ["y"])
    assert rows(out) == [("a", None, 2.0), ("b", 2.0, None)]


def test_n_distinct_counts_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    assert df.agg(n_distinct_na("x")).first()[0] == 3


def test_missing_pct_uses_grid(spark):
    df = spark.createDataFrame([(2020, "r1", "t1", None), (2020, "r2", "t1", 1.0), (2020, "r1", "t2", 2.0)],
                               "anio int, region string, tramo string, v double")
    out = A.missing_pct(df, "anio", ("region", "tramo"), ["v"]).first()
    assert out["pct_faltantes"] == pytest.approx(25.0)  # 1 missing / (2 regions * 2 bands)


def test_distribution_se_counts_missing_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("a", 5.0)], "g string, x double")
    r = A.distribution_table(df, "g", ["x"]).first()
    assert (r["min"], r["p25"], r["mediana"], r["p75"], r["max"]) == (1.0, 2.0, 3.0, 4.0, 5.0)
    assert r["std_err"] == pytest.approx(2.0 / 2.0)  # sd 2 / sqrt(4 rows incl. missing)
    assert r["cant_faltantes"] == 1


def test_join_null_keys_match_only_when_null_safe(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("k", 20)], "k string, b int")
    assert rows(J.join(a, b, ["k"], "left")) == [(None, 1, 10), ("k", 2, 20)]
    assert rows(J.join(a, b, ["k"], "left", null_safe=False)) == [(None, 1, None), ("k", 2, 20)]


def test_join_suffixes_and_coalesce(spark):
    a = spark.createDataFrame([("r", None)], "k string, pais string")
    b = spark.createDataFrame([("r", "ES")], "k string, pais string")
    j = J.join(a, b, ["k"])
    assert j.columns == ["k", "pais_x", "pais_y"]
    assert P.coalesce_pair(j, "pais_x", "pais_y", "pais").first()["pais"] == "ES"


def test_natural_chain_shared_measure_becomes_key(spark):
    a = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, m double")
    b = spark.createDataFrame([(1, 5.0, "x"), (2, 7.0, "y")], "id int, m double, z string")
    assert rows(J.left_join_chain([a, b])) == [(1, 5.0, "x"), (2, 6.0, None)]


def test_fold_as_pivot_keeps_base_keys(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "b", 3.0), (3, "a", None)],
                                 "k int, variable string, value double")
    out = J.fold_as_pivot(long, ["k"], "variable", ["value"], ["a", "b"], base="a")
    assert rows(out) == [(1, 1.0, 2.0), (3, None, None)]


def test_recode_first_match_wins(spark):
    df = spark.createDataFrame([("Illes Balears",), ("Región de Murcia",), ("Otra",)], "r string")
    rules = [("Balears", "Illes Balears "), ("Murcia", "Región de Murcia"), ("Illes", "never")]
    assert [r[0] for r in df.select(J.recode_contains("r", rules)).collect()] == [
        "Illes Balears ", "Región de Murcia", "Otra"]


def test_pivot_wider_duplicates_raise_and_all_null_column_kept(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "id int, code string, v double")
    with pytest.raises(Exception, match="not uniquely identified"):
        pivot_wider(df, ["id"], "code", "v", values=["a"]).collect()
    ok = spark.createDataFrame([(1, "a", 1.0), (None, "a", 2.0)], "id int, code string, v double")
    out = pivot_wider(ok, ["id"], "code", "v", values=["a", "zz"])
    assert out.columns == ["id", "a", "zz"]
    assert rows(out) == [(None, 2.0, None), (1, 1.0, None)]


def test_pivot_longer_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 2)], "k int, a int, b int")
    assert rows(pivot_longer(df, ["a", "b"], "name", "value")) == [(1, "a", None), (1, "b", 2.0)]


def test_share_of_group_poisoned_by_null(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g1", 3.0), ("g2", 1.0), ("g2", None), (None, 2.0)],
                               "g string, x double")
    out = W.share_of_group(df, ["g"], {"s": F.col("x")})
    assert rows(out, "g", "x", "s") == [(None, 2.0, 1.0), ("g1", 1.0, 0.25), ("g1", 3.0, 0.75),
                                        ("g2", None, None), ("g2", 1.0, None)]


def test_net_pay_as_is_vs_corrected(spark):
    f, m, h = F.lit(1.0), F.lit(1.0), F.lit(2.0)
    df = spark.range(1)
    r = df.select(W.net_pay_share(f, m, h, F.lit(8.0)).alias("a"),
                  W.net_pay_share(f, m, h, F.lit(8.0), corrected=True).alias("c")).first()
    assert (r["a"], r["c"]) == (2.25, 0.5)


def test_forward_fill_and_first_appearance(spark):
    df = spark.createDataFrame([("s", 1, "2019", "A"), ("s", 2, None, "B"), ("s", 3, "2020", None), ("s", 4, None, "A")],
                               "sheet string, c int, y string, sec string")
    f = W.forward_fill(df, ["sheet"], "c", ["y", "sec"])
    assert rows(f, "c", "y", "sec") == [(1, "2019", "A"), (2, "2019", "B"), (3, "2020", "B"), (4, "2020", "A")]
    g = W.first_appearance_ordinal(f, ["sheet"], "c", ["y", "sec"])
    assert rows(g, "y", "sec", "group") == [("2019", "A", 1), ("2019", "B", 2), ("2020", "A", 4), ("2020", "B", 3)]


def test_block_cycle_ordinal(spark):
    df = spark.createDataFrame([(1,), (9,), (10,), (3024,), (3025,)], "i int")
    assert [r[0] for r in df.select(W.block_cycle_ordinal("i", 9, 336)).collect()] == [1, 1, 2, 336, 1]


def test_quadrant_null_gives_null(spark):
    lab = W.quadrant_label(F.col("x"), F.col("y"), F.lit(1.0), F.lit(1.0), ("A", "B", "C", "D"))
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 2.0), (2.0, 0.0), (0.0, 0.0), (None, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(lab).collect()] == ["A", "B", "C", "D", None]


def test_boxplot_whiskers(spark):
    vals = [("g", float(v)) for v in [1, 2, 3, 4, 100]]
    r = A.boxplot_stats(spark.createDataFrame(vals, "g string, y double"), ["g"], "y", log=None).first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (
        2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_linear_fit_constant_x_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 2.0), ("b", 2.0, 4.0), ("b", 3.0, 6.0)],
                               "g string, x double, y double")
    out = {r["g"]: r for r in A.linear_fit(df, ["g"], "x", "y").collect()}
    assert out["a"]["slope"] is None and out["a"]["r2"] is None
    assert out["b"]["slope"] == pytest.approx(2.0) and out["b"]["intercept"] == pytest.approx(0.0)
    assert out["b"]["r2"] == pytest.approx(1.0)


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 3.5)], "a double, b double, c double")
    out = {(r["var_x"], r["var_y"]): r["corr"] for r in A.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert out[("a", "b")] is None and out[("a", "c")] == pytest.approx(0.9933992677987827)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([("g", float(v)) for v in range(11)], "g string, x double")
    h = {r["bin"]: r["n"] for r in A.histogram(df, ["g"], "x", bins=5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_duplicate_audit_and_shape(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert tuple(A.duplicate_audit(df).first()) == (3, 2)
    assert tuple(A.table_shape(df).first()) == (3, 2)


def test_tail_and_seeded_sample_independent_of_partitioning(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r[0] for r in L.tail_n(df, "k", 3).collect()] == [97, 98, 99]
    a = [r[0] for r in L.sample_n(df.repartition(1), 6).collect()]
    b = [r[0] for r in L.sample_n(df.repartition(8), 6).collect()]
    assert a == b and len(a) == 6


def test_ordinal_levels(spark):
    df = spark.createDataFrame([("10 a 19",), ("Total",), ("0 a 4",), ("5 a 9",)], "t string")
    assert rows(L.ordinal_levels(df, "t"), "level", "t") == [(1, "0 a 4"), (2, "5 a 9"), (3, "10 a 19"), (4, "Total")]


def test_keep_latest_global_max(spark):
    df = spark.createDataFrame([("it", 2020), ("es", 2021), ("es", 2020)], "p string, anio int")
    assert rows(P.keep_latest(df, "anio")) == [("es", 2021)]
    with_null = spark.createDataFrame([("it", 2020), ("es", None)], "p string, anio int")
    assert P.keep_latest(with_null, "anio").count() == 0


def test_rename_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        P.rename(df, {"zz": "c"})
    with pytest.raises(ValueError):
        P.rename_with(df, lambda c: "same")


def test_parse_guess(spark):
    df = spark.createDataFrame([("1", "TRUE", "2020-01-02", "x", None), ("2.5", "FALSE", None, "1", None)],
                               "a string, b string, c string, d string, e string")
    out = P.parse_guess(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "boolean", "date", "string", "boolean"]


def test_profile_string_and_numeric(spark):
    df = spark.createDataFrame([("ab", 1.0), ("", None), ("  ", 3.0), (None, 5.0)], "s string, x double")
    p = {r["skim_variable"]: r for r in profile(df).collect()}
    s, x = p["s"], p["x"]
    assert (s["n_missing"], s["min_len"], s["max_len"], s["n_empty"], s["n_unique"], s["n_whitespace"]) == (1, 0, 2, 1, 3, 1)
    assert (x["n_missing"], x["p0"], x["p50"], x["p100"], x["mean"]) == (1, 1.0, 3.0, 5.0, 3.0)
    assert x["complete_rate"] == pytest.approx(0.75)


def _cells(spark):
    """2 years x 2 sectors x 2 bands, 3 regions, one blank region cell."""
    c = [("T1", 1, 1, "Variável - Pessoal ocupado (pessoas)")]
    c += [("T1", 3, 3, "2019"), ("T1", 3, 7, "2020")]
    for g, sec in enumerate(["Ind", "Serv", "Ind", "Serv"]):
        c.append(("T1", 4, 3 + 2 * g, sec))
        c += [("T1", 5, 3 + 2 * g, "0 a 4"), ("T1", 5, 4 + 2 * g, "5 a 9")]
    vals = {6: ["1", "2.7", "-", "X", "4", "...", "3000000000", " 12 "],
            7: ["5", "6", "7", "8", "9", "10", "11", "12"],
            8: ["1", "1", "1", "1", "1", "1", "1", "1"]}
    regions = {6: "Norte", 7: "Sul", 8: None}
    for r, vs in vals.items():
        if regions[r]:
            c.append(("T1", r, 1, regions[r]))
        c.append(("T1", r, 2, "ignored"))
        c += [("T1", r, 3 + i, v) for i, v in enumerate(vs)]
    c.append(("T1", 9, 1, "Fonte: IBGE"))
    return spark.createDataFrame(c, "sheet string, row_idx int, col_idx int, value string")


def test_crosstab_normalise(spark):
    out = crosstab_normalise(_cells(spark))
    got = rows(out.where("region = 'Norte'"), "anio", "sector", "tramo", "value")
    assert got == [("2019", "Ind", "0 a 4", 1), ("2019", "Ind", "5 a 9", 2), ("2019", "Serv", "0 a 4", None),
                   ("2019", "Serv", "5 a 9", None), ("2020", "Ind", "0 a 4", 4), ("2020", "Ind", "5 a 9", None),
                   ("2020", "Serv", "0 a 4", None), ("2020", "Serv", "5 a 9", 12)]
    assert out.select("variable").distinct().first()[0] == "pessoal_ocupado_pessoas"
    # the blank region cell becomes the literal 'region' (source behaviour); the note row is dropped
    assert out.where("region = 'region'").count() == 8
    assert out.count() == 24


def test_single_value(spark):
    df = spark.createDataFrame([("a",), ("a",)], "x string")
    assert P.single_value(df, "x") == "a"
    with pytest.raises(ValueError):
        P.single_value(df.unionByName(spark.createDataFrame([("b",)], "x string")), "x")


def test_chunked_forward_fill_equals_single_window(spark):
    import random
    rnd = random.Random(7)
    data = [(u, d * 100 + i, d, rnd.choice([None, None, float(i)])) for u in range(3) for d in range(6)
            for i in range(rnd.randint(0, 5))]
    df = spark.createDataFrame(data, "u int, o int, day int, v double")
    a = W.forward_fill(df, ["u"], "o", ["v"])
    b = W.forward_fill(df, ["u"], "o", ["v"], chunk=F.col("day"))
    assert rows(a, "u", "o", "v") == rows(b, "u", "o", "v")


def test_tail_with_null_keys(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,), (2,)], "k int")
    assert [r[0] for r in L.tail_n(df, "k", 2).collect()] == [2, 3]
    assert [r[0] for r in L.head_n(df, "k", 3).collect()] == [None, None, 1]


def test_crosstab_blank_region_modes(spark):
    cells = _cells(spark)
    ff = crosstab_normalise(cells, blank_region="ffill")
    assert ff.where("region = 'region'").count() == 0
    assert ff.where("region = 'Sul'").count() == 16  # row 8 takes the region of row 7
    with pytest.raises(ValueError):
        crosstab_normalise(cells, blank_region="reject")


def test_t_quantile(spark):
    from regpanel.operators.aggregate import t_quantile
    known = {1: 12.7062, 2: 4.30265, 3: 3.18245, 5: 2.57058, 10: 2.22814, 30: 2.04227, 1000: 1.96234}
    df = spark.createDataFrame([(k,) for k in known], "n int")
    for r in df.select("n", t_quantile(0.975, F.col("n")).alias("t")).collect():
        assert r.t == pytest.approx(known[r.n], rel=2e-3 if r.n < 5 else 2e-4)


def test_natural_merge_folder_checks_its_files(spark, tmp_path):
    from regpanel.plans.composites import natural_merge_folder
    schema = "Indicador string, region string, Valor string"
    for case, files in {"null": [[("a", "r1", "1"), (None, "r2", "2")]], "twice": [[("a", "r1", "1")], [("a", "r2", "2")]]}.items():
        for i, rows in enumerate(files):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / case / f"f{i}"))
        with pytest.raises(ValueError, match="indicator"):
            natural_merge_folder(spark, f"{tmp_path}/{case}/*", ["region"], drop=(), name_from="dir")
