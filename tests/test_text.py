"""Hand-written rows for the scalar functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pairwright import settings as S
from pairwright.functions.codes import in_codes, keep_code, normalize_code
from pairwright.functions.numbers import to_number
from pairwright.functions.text import base_name, blank_missing, clean, key_form, short_hash, squeeze, strip, template
from pairwright.functions.vectors import cosine, dot, norm, unit
from pairwright.operators.columns import clean_columns, ensure_columns, fill_group, require_columns
from pairwright.operators.pairs import context_group


def apply(spark, function, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.r for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip_removes_what_python_calls_white_space(spark):
    spaces = [c for c in map(chr, range(0x10000)) if c.isspace() and not 0xD800 <= ord(c) < 0xE000]
    values = [f"{c}a{c}b{c}" for c in spaces] + ["  a \t\n", " x ", "", "​z"]
    assert apply(spark, strip, values) == [v.strip() for v in values]


def test_squeeze(spark):
    values = [" a \n\t b  c ", "x", " ", "a\x1cb"]
    assert apply(spark, squeeze, values) == [" ".join(v.split()) for v in values]


def test_clean_null_and_numbers(spark):
    assert apply(spark, clean, [None, " a "]) == ["", "a"]
    assert apply(spark, clean, [5, None], "v int") == ["5", ""]


def test_missing_tokens(spark):
    values = ["NA", "null", "None", "n/a", "NaN", "nil", " NA", "na", ""]
    got = apply(spark, lambda c: blank_missing(c, S.MISSING_TOKENS), values)
    assert got == ["", "", "", "", "", "nil", " NA", "na", ""]


@pytest.mark.parametrize("value, code, kept", [
    ("008", "8", True), ("8.0", "8", True), ("250.1", "250.1", True), ("250.10", "250.1", False),
    ("8.50", "8.5", False), ("000", "0", True), ("0.0", "0", True), ("00.5", "0.5", True), ("abc", "abc", False),
    ("", "", False), (None, "", False), ("8\n", "8", True), ("-8", "-8", False), ("8.", "8.", False),
    (".5", ".5", False), ("10", "10", True), ("100.00", "100", False), ("1e3", "1e3", False), ("8\n9", "8\n9", False),
    ("٣", "٣", False),
])
def test_codes(spark, value, code, kept):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(normalize_code(F.col("v")), keep_code(F.col("v"))).first() == (code, kept)


def test_allow_list_normalises_both_sides(spark):
    got = apply(spark, lambda c: in_codes(c, ["008", "8.50", 250]), ["8", "8.5", "250.0", "9", None])
    assert got == [True, True, True, False, False]
    assert apply(spark, lambda c: in_codes(c, []), ["8"]) == [False]


@pytest.mark.parametrize("value, base", [
    ("LDL_Visit_2", "ldl"), ("hdlv2", "hdl"), ("x_day_3_visit_2", "x"), ("x_visit_2_day_3", "x_visit_2"),
    ("Chemo12", "che"), ("v1", ""), ("a_month_1_mo_2", "a_month_1"), ("Glucose (mg/dL) yr 3", "glucose_mg_dl"),
    ("__a__b__", "a_b"), (None, ""), ("followup_3", "followup_3".replace("followup_3", "")), ("bmi", "bmi"),
])
def test_base_name(spark, value, base):
    assert apply(spark, base_name, [value]) == [base]


def test_key_form_is_idempotent(spark):
    values = [" A-b  C", "é1", None, "--", "x_y"]
    once = apply(spark, key_form, values)
    assert once == ["a b c", "1", "", "", "x y"]
    assert apply(spark, key_form, once) == once


def test_short_hash(spark):
    values = ["abc", "né", ""]
    assert apply(spark, short_hash, values) == [hashlib.md5(v.encode()).hexdigest()[:10] for v in values]


def test_template(spark):
    df = spark.createDataFrame([(" 8 ", None)], "a string, b string")
    assert df.select(template((("A", "a"), ("B b", "b")))).first()[0] == "A: 8. B b: ."


@pytest.mark.parametrize("study, dataset, name, text, key", [
    ("S 1", "D", "LDL_v2", "long enough text", "same_study_base::s 1::ldl"),
    ("", "D-1", "LDL_v2", "long enough text", "same_dataset_base::d 1::ldl"),
    ("S", "D", "v1", "twelve chars", "same_description::twelve chars"),
    ("S", "D", "v1", "eleven char", "singleton::k"),
    ("", "", "ldl", "short", "singleton::k"),
])
def test_context_group(spark, study, dataset, name, text, key):
    df = spark.createDataFrame([(study, dataset, name, text)], "s string, d string, n string, t string")
    got = df.select(context_group(key_form(F.col("s")), key_form(F.col("d")), base_name(F.col("n")),
                                  key_form(F.col("t")), F.lit("k"))).first()[0]
    assert got == "G_" + hashlib.md5(key.encode()).hexdigest()[:10]


def test_to_number(spark):
    assert apply(spark, to_number, ["1.5", " 2 ", "abc", "", None, "NaN", "1e3"]) == [1.5, 2, None, None, None, None, 1000]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = df.select(dot(a, b), norm(a), cosine(a, b), cosine(a, z), norm(unit(a)), unit(z)).first()
    assert got[:4] == (24.0, 5.0, 0.96, 0.0) and abs(got[4] - 1) < 1e-6 and got[5] == [0.0, 0.0]


def test_columns(spark):
    df = spark.createDataFrame([(" a ", None)], "a string, b string")
    assert clean_columns(df, ("a", "b", "c")).first().asDict() == {"a": "a", "b": "", "c": ""}
    assert ensure_columns(df, ("a", "x")).columns == ["a", "b", "x"]
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(df, ("a", "x"))
    assert fill_group(df, "b", "Dataset name").first().group == "UNKNOWN_DATASET NAME"
