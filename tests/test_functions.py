from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabelion import functions as tf


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected", [("1234,565", Decimal("1234.57")), ("-1,005", Decimal("-1.01")), ("0,5", Decimal("0.50"))]
)
def test_money_rounds_half_up(spark, text, expected):
    assert one(spark, tf.decimal_from_comma("x"), text) == expected


@pytest.mark.parametrize("text", ["", "1.234,56", "abc"])
def test_money_invalid_lenient_gives_null(spark, text):
    assert one(spark, tf.decimal_from_comma("x", strict=False), text) is None


@pytest.mark.parametrize("text", ["", "1.234,56"])
def test_money_invalid_strict_fails(spark, text):
    with pytest.raises(Exception):
        one(spark, tf.decimal_from_comma("x", strict=True), text)


def test_number_skips_null_part(spark):
    df = spark.createDataFrame([("12345678", None, "01")], "a string, b string, c string")
    assert df.select(tf.registration_number("a", "b", "c")).first()[0] == "1234567801"


def test_left_chars_null_stays_null(spark):
    assert one(spark, tf.left_chars("x", 30), None) is None
    assert one(spark, tf.left_chars("x", 3), "abcdef") == "abc"


@pytest.mark.parametrize(
    "name,expected",
    [
        ("a.b.D30610.EMPRECSV", "10/06/2023"),
        ("a.b.X30610.EMPRECSV", "dd/mm/2025"),
        ("a.b.D3061.EMPRECSV", "dd/mm/2025"),
        ("EMPRECSV", "dd/mm/2025"),
        (None, "dd/mm/2025"),
    ],
)
def test_reference_date(spark, name, expected):
    assert one(spark, tf.reference_date("x"), name) == expected


def test_file_name_and_link(spark):
    assert one(spark, tf.file_name("x"), "http://h/a/b/Empresas0.zip") == "Empresas0.zip"
    df = spark.createDataFrame([("http://h/x.zip", "http://b/"), ("y.zip", "http://b/")], "h string, b string")
    assert [r[0] for r in df.select(tf.resolve_link("h", "b")).collect()] == ["http://h/x.zip", "http://b/y.zip"]


def test_sizes_percent_thousands(spark):
    df = spark.createDataFrame([(3 * 1048576, 9, 5, 1234567)], "b long, e long, x long, n long")
    r = df.select(
        tf.megabytes("b").alias("mb"), tf.excess_percent("e", "x").alias("p"), tf.thousands("n").alias("t"),
        tf.excess_percent("e", F.lit(0)).alias("z"),
    ).first()
    assert r.mb == 3.0 and r.p == 80.0 and r.t == "1,234,567" and r.z is None


@pytest.mark.parametrize("line,n", [('"1";"x;y";"z"', 3), ("1;2;3;4", 4), ('"A""B";"c"', 2), ("", 1)])
def test_count_fields(spark, line, n):
    assert one(spark, tf.count_fields("x"), line) == n


@pytest.mark.parametrize("line,n,over", [('"1";"x;y";"z"', 3, False), ("1;2;3;4", 3, True), ("1;2;3", 3, False),
                                         ('"a;b;c;d"', 2, False), ("", 2, False)])
def test_exceeds_fields(spark, line, n, over):
    assert one(spark, tf.exceeds_fields("x", n), line) is over


def test_reject_cause_does_not_split_lines(spark):
    """Fields of nearly all lines are bounded by counting separators: no array of them is made."""
    df = spark.createDataFrame([('"a";"b"', 2), ('"a";"b";"c"', 2), ('"a;b";"c"', 2), ('"a', 2), ("é;è", 1), (None, 1)], "x string, n int")
    found = df.select(tf.reject_cause("x", F.col("n")).alias("cause"))
    assert [r.cause for r in found.collect()] == [None, "too_long", None, "open_quote", "too_long", None]
    assert "split(" not in found._jdf.queryExecution().analyzed().toString().lower()
