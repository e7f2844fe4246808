"""Property tests (hypothesis): invariants of the operators on random small tables."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regpanel.operators import aggregate as A
from regpanel.operators import windows as W
from regpanel.operators.reshape import crosstab_normalise, panel_to_cells, pivot_longer, pivot_wider

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

groups = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 1000)), min_size=1, max_size=30)


@settings(**SETTINGS)
@given(groups)
def test_shares_sum_to_one_without_nulls(spark, data):
    df = spark.createDataFrame([(g, float(v)) for g, v in data], "g string, x double")
    out = W.share_of_group(df, ["g"], {"s": F.col("x")})
    for r in out.groupBy("g").agg(F.sum("s").alias("t")).collect():
        assert r["t"] == pytest.approx(1.0)


@settings(**SETTINGS)
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", "z"])),
                       st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=15))
def test_unpivot_inverts_pivot(spark, cells):
    long = spark.createDataFrame([(k, c, v) for (k, c), v in cells.items()], "k int, code string, v double")
    wide = pivot_wider(long, ["k"], "code", "v", values=["x", "y", "z"])
    back = pivot_longer(wide, ["x", "y", "z"], "code", "v", id_cols=["k"]).where(F.col("v").isNotNull())
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=40))
def test_quartiles_ordered_and_partition_independent(spark, xs):
    df = spark.createDataFrame([("g", x) for x in xs], "g string, x double")
    a = A.distribution_table(df.repartition(1), "g", ["x"]).collect()
    b = A.distribution_table(df.repartition(7), "g", ["x"]).collect()
    assert len(a) == len(b) == 1
    for k, v in a[0].asDict().items():
        w = b[0][k]
        if isinstance(v, float) and isinstance(w, float):
            assert v == pytest.approx(w, rel=1e-9, abs=1e-9), k
        else:
            assert v == w, k
    r = a[0]
    if r["p25"] is not None:
        assert r["min"] <= r["p25"] <= r["mediana"] <= r["p75"] <= r["max"]
    assert r["cant_faltantes"] == sum(x is None for x in xs)


@settings(**SETTINGS)
@given(st.dictionaries(st.tuples(st.sampled_from(["2019", "2020"]), st.sampled_from(["Ind", "Serv"]),
                                 st.sampled_from(["R1", "R2", "R3"]), st.sampled_from(["0 a 4", "5 a 9"])),
                       st.integers(-10_000, 10_000), min_size=1, max_size=24))
def test_crosstab_normaliser_inverts_layout(spark, cells):
    rows = [("T1", "Variável - Medida (u)", y, s, r, b, float(v)) for (y, s, r, b), v in cells.items()]
    long = spark.createDataFrame(rows, "sheet string, title string, y string, s string, r string, b string, v double")
    sheet = panel_to_cells(long, "sheet", "title", "y", "s", "r", "b", "v")
    out = crosstab_normalise(sheet).select("anio", "sector", "region", "tramo", "value")
    assert sorted(map(tuple, out.collect())) == sorted((y, s, r, b, v) for (y, s, r, b), v in cells.items())


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.floats(-5e9, 5e9, allow_nan=False, allow_infinity=False),
                          st.integers(-3_000_000_000, 3_000_000_000)), min_size=1, max_size=60),
       st.sampled_from(["{}", " {} ", "{}e0", "+{}"]))
def test_as_int_trunc_matches_r_rule(spark, nums, fmt):
    import math
    from regpanel.functions.exprs import as_int_trunc
    texts = [fmt.format(repr(float(n)) if isinstance(n, float) else n) for n in nums]
    texts = [t.replace("+-", "-") for t in texts]

    def r_int(t):  # R: as.integer(as.numeric(t)), truncation toward zero, NA outside int range
        try:
            v = float(t)
        except ValueError:
            return None
        if math.isnan(v) or not (-2147483648.0 < v < 2147483648.0):
            return None
        return int(v)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(as_int_trunc("t")).collect()]
    assert got == [r_int(t) for t in texts]


latin = st.text(alphabet=st.sampled_from(list("abcXYZ ()_-ÁÉÍÓÚáéíóúÑñÇçÜüßæœÀÈ12")), max_size=25)


@settings(**SETTINGS)
@given(st.lists(latin, min_size=1, max_size=30))
def test_sanitize_column_equals_python_twin(spark, names):
    from regpanel.functions.text import sanitize, sanitize_name
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = [r[0] for r in df.select(sanitize("s")).collect()]
    assert got == [sanitize_name(n) for n in names]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(-3, 3))), min_size=1,
                max_size=40))
def test_n_distinct_and_strict_sum_match_python(spark, data):
    from regpanel.functions.exprs import n_distinct_na, strict_sum
    df = spark.createDataFrame(data, "g string, x int")
    got = {r["g"]: (r["nd"], r["s"]) for r in
           df.groupBy("g").agg(n_distinct_na("x").alias("nd"), strict_sum("x").alias("s")).collect()}
    for g in {k for k, _ in data}:
        xs = [x for k, x in data if k == g]
        exp_s = None if any(x is None for x in xs) else sum(xs)
        assert got[g] == (len(set(xs)), exp_s)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
                min_size=1, max_size=40))
def test_profile_independent_of_partitioning(spark, data):
    from regpanel.operators.profile import profile
    df = spark.createDataFrame(data, "s string, x double")
    a = sorted(map(tuple, profile(df.repartition(1)).collect()), key=str)
    b = sorted(map(tuple, profile(df.repartition(8)).collect()), key=str)
    for ra, rb in zip(a, b):
        for va, vb in zip(ra, rb):
            if isinstance(va, float) and isinstance(vb, float):
                assert va == pytest.approx(vb, rel=1e-9, abs=1e-9)
            else:
                assert va == vb


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e3, 1e3))),
                min_size=1, max_size=60))
def test_counted_quantiles_equal_percentile(spark, data):
    from regpanel.operators.quantiles import grouped_quantiles
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in data], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for keys in (["g"], []):
        got = {tuple(r[k] for k in keys): r["__q"] for r in grouped_quantiles(df, keys, F.col("v"), probs).collect()}
        want = {tuple(r[k] for k in keys): r["q"] for r in
                df.where("v is not null").groupBy(*keys).agg(F.percentile("v", probs).alias("q")).collect() if r["q"]}
        assert got.keys() == want.keys()
        for k in got:
            assert got[k] == pytest.approx(want[k])
