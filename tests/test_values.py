"""Casts, separators and names on text that is not tidy."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lamina.functions import (
    classify_name,
    code_int,
    decimal_comma,
    first_missing,
    landing_target,
    separator_of,
    target_rule,
    uri_parts,
    url_basename,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)


def evaluate(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).sort("i").select(expression(F.col("v"))).collect()]


CASTS = [
    ("1000,50", 1000.5, None),
    ("1.000,50", None, None),
    ("", None, None),
    (" 12 ", 12.0, 12),
    ("12.7", 12.7, None),
    ("1e3", 1000.0, None),
    ("007", 7.0, 7),
    ("2147483648", 2147483648.0, None),
    ("abc", None, None),
    (None, None, None),
]


def test_lenient_casts(spark):
    texts = [c[0] for c in CASTS]
    assert evaluate(spark, texts, decimal_comma) == [c[1] for c in CASTS]
    assert evaluate(spark, texts, code_int) == [c[2] for c in CASTS]


def test_turning_text_away_changes_no_result(spark):
    """Whatever the plain cast accepts, and only that, is accepted."""
    blanks = ["", " ", "\t", "\n", "\r\n", "\x00", "\x1f", "\u00a0", "\u3000"]
    bodies = ["12", "+12", "-12", "--1", "+", ".", "12.", ".5", "1.5", "1e3", "1E-2", "1d", "1f", "0x1", "NaN", "nan"]
    bodies += ["Infinity", "-Infinity", "inf", "+inf", "1_0", "१२", "99999999999", "1 2", "", "a1", "1a", "+ 1"]
    texts = [a + b + c for b in bodies for a in blanks for c in blanks]
    df = column(spark, texts)
    both = df.select(
        "v",
        code_int("v").alias("i"),
        F.col("v").try_cast("int").alias("plain_i"),
        decimal_comma("v").alias("d"),
        F.col("v").try_cast("double").alias("plain_d"),
    )
    differing = both.filter(~F.col("i").eqNullSafe(F.col("plain_i")) | ~F.col("d").eqNullSafe(F.col("plain_d")))
    assert differing.collect() == []
    assert both.filter("i is not null").count() > 100 and both.filter("d is not null").count() > 300


def test_decimal_comma_with_grouping_and_decimal_type(spark):
    out = evaluate(spark, ["1.234.567,89", "10,5"], lambda c: decimal_comma(c, ".", DecimalType(18, 2)))
    assert [str(v) for v in out] == ["1234567.89", "10.50"]


def test_every_comma_is_replaced(spark):
    assert evaluate(spark, ["1,000,5"], decimal_comma) == [None]


@pytest.mark.parametrize(
    "text, expected",
    [("a|b;c,d", "|"), ("a;b,c", ";"), ("a,b,c;d", ","), ("a;b;c|d", ";"), ("abc", ";"), ("", ";"), (None, ";")],
)
def test_separator(spark, text, expected):
    assert evaluate(spark, [text], separator_of) == [expected]


def test_url_basename(spark):
    urls = ["https://h/p/E.zip?x=1", "https://h/p/", "?x=1", "https://h/a//", "https://h/p/E.zip", None]
    assert evaluate(spark, urls, url_basename) == ["E.zip", "p", "file.bin", "a", "E.zip", None]


def test_landing_target_has_one_slash(spark):
    out = evaluate(spark, ["https://h/E.zip?q"], lambda c: landing_target(F.lit("raw/r1//"), c))
    assert out == ["raw/r1/E.zip"]


def test_uri_parts(spark):
    df = column(spark, ["gs://b/x/y.zip", "no uri"]).sort("i")
    parts = [r[0] for r in df.select(uri_parts("v")).collect()]
    assert tuple(parts[0]) == ("gs", "b", "x/y.zip") and parts[1] is None
    with pytest.raises(Exception, match="not an object URI"):
        df.select(uri_parts("v", scheme="gs", strict=True)).collect()


def test_classify_name(spark):
    rules = {"empresas": ("empresa",), "socios": ("socio", "sócio")}
    names = ["EMPRESAS0.ZIP", "Sócios1.zip", "SÓCIOS.ZIP", "socio_empresa.zip", "x.zip"]
    out = evaluate(spark, names, lambda c: classify_name(c, rules))
    assert out == ["empresas", "socios", "socios", "empresas", None]


def test_first_missing_names_the_first(spark):
    df = spark.createDataFrame(
        [("b", "p", ["u"]), ("", None, ["u"]), ("b", None, []), ("b", "p", None)],
        "bucket string, prefix string, urls array<string>",
    )
    fields = {"bucket": F.col("bucket"), "prefix": F.col("prefix"), "urls": F.col("urls")}
    assert [r[0] for r in df.select(first_missing(fields)).collect()] == [None, "bucket", "prefix", "urls"]


def test_target_rule_is_never_null(spark):
    df = spark.createDataFrame([("03", 2), ("03", 1), (None, 5), ("03", None), ("01", 9)], "c string, n long")
    assert [r[0] for r in df.select(target_rule("c", "03", "n")).collect()] == [True, False, False, False, False]
