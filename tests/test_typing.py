from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.functions.typing_rules import as_date, as_decimal, as_flag, as_key, as_timestamp


def value(spark, text, expression):
    frame = spark.createDataFrame([(text,)], "x string")
    return frame.selectExpr(f"{expression} AS v").first().v


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), (" 7 ", 7), ("1.6", 2), ("1.5", 2), ("-3", -3), ("x", None), ("", None), (None, None),
     ("99999999999999999999", None)],
)
def test_key(spark, text, expected):
    assert value(spark, text, as_key("x")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("18.295", Decimal("18.30")), ("98.6", Decimal("98.60")), ("123456789.00", None), ("abc", None), (None, None)],
)
def test_decimal(spark, text, expected):
    assert value(spark, text, as_decimal("x", 10, 2)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2021-02-03 04:05:06", datetime(2021, 2, 3, 4, 5, 6)),
        ("2021-02-03", datetime(2021, 2, 3)),
        ("NOT_A_DATE", None),
        ("25-12-2021 10:11", None),
        (None, None),
    ],
)
def test_timestamp(spark, text, expected):
    assert value(spark, text, as_timestamp("x")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("25-12-2021 10:11", datetime(2021, 12, 25, 10, 11)),
        ("2021-02-03 04:05:06", None),
        ("NOT_A_DATE", None),
        (None, None),
    ],
)
def test_timestamp_with_pattern(spark, text, expected):
    assert value(spark, text, as_timestamp("x", "dd-MM-yyyy HH:mm")) == expected


def test_date(spark):
    assert value(spark, "1999-11-12", as_date("x")) == date(1999, 11, 12)
    assert value(spark, "soon", as_date("x")) is None


@pytest.mark.parametrize("text, expected", [("Y", True), ("y", False), ("N", False), (None, False)])
def test_flag_exact(spark, text, expected):
    assert value(spark, text, as_flag("x", "Y")) is expected


@pytest.mark.parametrize("text, expected", [("TRUE", True), ("true", True), ("yes", False), (None, False)])
def test_flag_any_case(spark, text, expected):
    assert value(spark, text, as_flag("x", "true", fold_case=True)) is expected
