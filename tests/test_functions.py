"""Scalar functions: the R-semantic traps of the F rows."""

from pyspark.sql import functions as F

from regpanel.functions import exprs as X
from regpanel.functions import text as T
from regpanel.functions.dates import year_to_date


def one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col.alias("y")).collect()]


def test_as_int_trunc_truncates_and_guards(spark):
    vals = [("2.7",), ("-2.7",), (" 12 ",), ("3000000000",), ("X",), ("-",), ("...",), ("12d",), ("1e3",), (None,)]
    assert one(spark, X.as_int_trunc("x"), vals) == [2, -2, 12, None, None, None, None, None, 1000, None]


def test_as_num_rejects_non_numeric(spark):
    assert one(spark, X.as_num("x"), [("1.5",), ("*",), ("0x1A",), ("",)]) == [1.5, None, None, None]


def test_if_else3_null_condition_is_null(spark):
    rows = [(1,), (5,), (None,)]
    assert one(spark, X.if_else3(F.col("x") > 2, F.lit("a"), F.lit("b")), rows, "x int") == ["b", "a", None]


def test_r_div_and_logs(spark):
    rows = [(1.0, 0.0), (0.0, 0.0), (4.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert [r[0] for r in df.select(X.r_div("a", "b")).collect()] == [None, None, 2.0]
    assert one(spark, X.log_pos("x", "10"), [(100.0,), (0.0,), (-1.0,)], "x double") == [2.0, None, None]


def test_trunc_center(spark):
    s = "abcdefghijklmnopqrstuvwxyz"
    assert one(spark, X.trunc_center("x", 20, ".."), [(s,), ("short",)]) == ["abcdefghi..rstuvwxyz", "short"]


def test_floor_mod_sign_of_divisor(spark):
    assert one(spark, X.floor_mod("x", F.lit(9)), [(-1,), (10,)], "x int") == [8, 1]


def test_sanitize_examples(spark):
    got = one(spark, T.sanitize("x"), [("Nombre (Ejemplo)",), ("Código Único (ID)",), ("Indicador",),
                                       ("a (b) (c)",)])
    assert got == ["nombre_ejemplo", "codigo_unico_id", "indicador", "a_b_(c)"]
    assert T.sanitize_name("Código Único (ID)") == "codigo_unico_id"


def test_replace_first_only_first(spark):
    assert one(spark, T.replace_first("x", r"\("), [("a(b)(c)",), ("no parens",)]) == ["ab)(c)", "no parens"]


def test_translit(spark):
    got = one(spark, T.translit_ascii("x"), [("Ñandú ÉCOLE straße Æsir œuvre Øre Łódź",)])
    assert got == ["Nandu ECOLE strasse AEsir oeuvre Ore Lodz"]
    assert one(spark, T.translit_lower("x"), [("ÉÈÊ",)]) == ["eee"]


def test_separate_fill_left(spark):
    df = spark.createDataFrame([("01 Andalucía",), ("Ceuta",), ("12 Comunitat Valenciana",)], "x string")
    code, name = T.separate_code_name("x")
    assert [tuple(r) for r in df.select(code, name).collect()] == [
        ("01", "Andalucía"), (None, "Ceuta"), ("12", "Comunitat Valenciana")]


def test_split_nth_absent_is_null(spark):
    assert one(spark, T.split_nth("x", "Variável - ", 2), [("Variável - Pessoal (pessoas)",), ("nada",)]) == [
        "Pessoal (pessoas)", None]


def test_band_recode_and_order_key(spark):
    assert one(spark, T.band_recode("x"), [("1-9",), ("GE10",), ("0",)]) == ["1 a 9", "+10", "0"]


def test_replace_first_groups_the_pattern(spark):
    assert one(spark, T.replace_first("x", "a|b", "_"), [("xaab",), ("xbba",)]) == ["x_ab", "x_ba"]


def test_signs_are_spelled_alike_in_values_and_names(spark):
    names = ["Nº de empresas", "1ª vez", "“a” – ‘b’"]
    assert one(spark, T.sanitize("x"), [(n,) for n in names]) == [T.sanitize_name(n) for n in names]
    assert T.sanitize_name(names[0]) == "no_de_empresas"


def test_sanitize_equals_its_twin_over_the_latin_blocks(spark):
    chars = [f"a{chr(c)}B" for c in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2010, 0x2030)]]
    assert one(spark, T.sanitize("x"), [(c,) for c in chars]) == [T.sanitize_name(c) for c in chars]


def test_clean_names_drops_quotes():
    assert T.clean_names(["d'Or", 'the "x" name']) == ["d_or", "the_x_name"]


def test_clean_names():
    assert T.clean_names(["Año", "2019", None, "Año", "", "ventasAnuales"]) == [
        "ano", "x2019", "na", "ano_2", "x", "ventas_anuales"]


def test_year_to_date_guards_text(spark):
    import datetime
    assert one(spark, year_to_date("x"), [("2019",), ("abc",)]) == [datetime.date(2019, 1, 1), None]
