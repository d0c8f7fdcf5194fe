import hashlib

import pytest
from pyspark.sql import functions as F

from gridlore.functions import numbers, text
from gridlore.schema import SchemaError


def one(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


NUMBERS = [
    (" 1.234,56 ", 1234.56), ("1,234.56", 1234.56), ("1,234,567", 1234567.0), ("1,234", 1234.0), ("12,5", 12.5),
    ("0,123", 123.0), (",123", 0.123), ("1.234", 1234.0), ("0.123", 123.0), ("1.2345", 1.2345), ("1,2345", 1.2345),
    ("1.234.567", 1234567.0), ("45.678.9", 456789.0), ("1.5", 1.5), ("5.", 5.0), ("-1,234", -1234.0), ("$ 45.90", 45.9),
    ("EUR 12,99", 12.99), ("2024", 2024.0), ("1e5", 15.0), ("10-20", None), ("abc", None), ("-", None), (",", None),
    ("--1.234", None), ("1.234,567,8", None), ("", None), (None, None), ("12 m³", None),
]


def test_decimal_text(spark):
    got = one(spark, [t for t, _ in NUMBERS], "string", numbers.parse_decimal_text)
    assert list(zip([t for t, _ in NUMBERS], got)) == NUMBERS


def test_numeric_input_passes_and_booleans_do_not(spark):
    assert one(spark, [1.234, None], "double", lambda c: numbers.parse_number(c, "double")) == [1.234, None]
    assert one(spark, [True, None], "boolean", lambda c: numbers.parse_number(c, "boolean")) == [None, None]


def test_int(spark):
    cases = ["2024", "2024.0", "2024.9", "-1.9", " 2024 ", "x", "", None, "NaN", "true", "inf"]
    assert one(spark, cases, "string", numbers.parse_int) == [2024, 2024, 2024, -1, 2024, None, None, None, None, None, None]


def test_blank(spark):
    assert one(spark, ["", "  ", "\t", "\n", " a ", None], "string", text.blank_to_null) == [
        None, None, None, None, "a", None]


def test_classify(spark):
    cases = ["Pumped Storage Hydro", "Hydroelectric Conventional", "Other Gases", "Nuclear", "Eólico", "eolico", None, "Coal"]
    assert one(spark, cases, "string", text.classify) == [
        "Almacenamiento", "Renovable", "Fosil", "Nuclear", "Otra", "Renovable", "Otra", "Fosil"]


def test_snake(spark):
    cases = {"Potencia Neta [MW]": "potencia_neta_mw", "Año/Mes": "ano_mes", "a--b": "a_b", "_x_": "x",
             "CO2 (Metric Tons)": "co2_metric_tons", " Güe ": "güe"}
    assert one(spark, list(cases), "string", text.snake) == list(cases.values())
    assert [text.snake_name(n) for n in cases] == list(cases.values())


def test_snake_columns_collide(spark):
    with pytest.raises(SchemaError, match="a_b"):
        text.snake_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_money(spark):
    assert one(spark, ["£51.77", "Â£ 1,200.50", "gratis", None], "string", numbers.currency_to_double) == [
        51.77, 1200.5, None, None]
    df = spark.createDataFrame([("1.299,", "99"), ("x", "1")], "w string, f string")
    assert [r[0] for r in df.select(numbers.price_from_parts("w", "f")).collect()] == [1299.99, None]
    assert one(spark, ["$ 12.50", "abc"], "string", numbers.digits_only) == ["1250", ""]
    assert one(spark, [1.0, float("nan"), None], "double", numbers.nan_to_null) == [1.0, None, None]


def test_record_key(spark):
    fields = ", ".join(f"{c} {'int' if c == 'periodo' else 'string'}" for c in text.KEY_FIELDS)
    base = ["m", "d", "p", "r", 2024, "i", "c", None, "a", "x||y"]
    blank = [v if v is not None else "" for v in base]
    got = [r[0] for r in spark.createDataFrame([tuple(base), tuple(blank), (None,) * 10], fields)
           .select(text.record_key()).collect()]
    expected = hashlib.sha256("||".join("" if v is None else str(v) for v in base).encode()).hexdigest()
    assert got[0] == got[1] == expected
    assert got[2] == hashlib.sha256(("||" * 9).encode()).hexdigest()


def test_year_of(spark):
    assert one(spark, ["2024-05-01", "2023-01-01 10:00:00", "pronto", None], "string", text.year_of) == [2024, 2023, None, None]
