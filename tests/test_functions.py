from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promoledger.functions import crypto, keys, parse, rules


@pytest.mark.parametrize(
    "text, signed, unsigned",
    [
        ("1,234.50-", -1234.5, 1234.5),
        ("1,234.50", 1234.5, 1234.5),
        ("-5", -5.0, 5.0),
        ("0", 0.0, 0.0),
        ("n/a", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_report_numbers(spark, text, signed, unsigned):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(parse.report_number("t"), parse.unsigned_number("t")).first()
    assert (row[0], row[1]) == (signed, unsigned)


@pytest.mark.parametrize("text, double, whole", [("12.0", 12.0, 12), ("x", 0.0, 0), (None, 0.0, 0), ("-3", -3.0, -3)])
def test_measure(spark, text, double, whole):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(parse.measure("t"), parse.measure("t", "int")).first()
    assert (row[0], row[1]) == (double, whole)


def test_report_day(spark):
    df = spark.createDataFrame([("28.01.2019",), ("Overall Result",), (None,)], "t string")
    assert [r[0] for r in df.select(parse.report_day_key("t")).collect()] == [20190128, None, None]


def test_date_keys(spark):
    df = spark.sql("select date'2020-02-03' as d")
    row = df.select(
        keys.time_key("d"), keys.month_key("d"), keys.year_key("d"), keys.month_end_key(keys.time_key("d")), keys.quarter_label("d")
    ).first()
    assert tuple(row) == (20200203, 202002, 2020, 20200229, "Quarter 1")


def test_codes(spark):
    df = spark.createDataFrame([("123", "000000000012345678")], "a string, b string")
    assert tuple(df.select(keys.pad_code("a"), keys.last_chars("b", 8)).first()) == ("0000000123", "12345678")


@pytest.mark.parametrize("month, previous", [(202101, 202012), (202103, 202102), (202105, 202104), (202012, 202011)])
def test_previous_month(month, previous):
    assert keys.previous_month(month) == previous


def test_driver_calendar():
    assert keys.trailing_months(202001) == [201911, 201912, 202001]
    assert keys.trailing_months(202002) == [201912, 202001, 202002]
    assert keys.day_window(20201203, 7) == (20201127, 20201203)
    assert [keys.quarter_of(m) for m in ("01", "04", 9, 12)] == ["Quarter 1", "Quarter 2", "Quarter 3", "Quarter 4"]


@pytest.mark.parametrize("text", ["Nguyễn", "a@b.c", "x" * 500])
def test_encryption_round_trip(spark, text):
    key = b"k" * 16
    df = spark.createDataFrame([(text,), (None,), ("",)], "n string")
    cipher = crypto.encrypt_columns(df, ["n"], key)
    assert [r[0] is None for r in cipher.collect()] == [False, True, True]
    assert text not in [r[0] for r in cipher.collect()]
    assert [r[0] for r in crypto.decrypt_columns(cipher, ["n"], key).collect()] == [text, None, None]


def test_rules(spark):
    df = spark.createDataFrame(
        [("BASKET", "BD", "SOAP (1+A)", None), ("BASKET", "LN", "SOAP", "x banded"), ("DTRDIS", "FQ", None, None)],
        "t string, m string, d string, p string",
    )
    rows = df.select(
        rules.recode_basket("t", F.col("m") == "BD"),
        rules.on_off_flag("m"),
        rules.is_banded("d", "p"),
        rules.default_holder_group(F.lit(None).cast("string"), "t"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("BASKET_BD", 1, True, "Trade Category"),
        ("BASKET", 1, True, "Trade Category"),
        ("DTRDIS", 0, False, "Distributor"),
    ]
    assert df.select(rules.share(F.lit(1.0), F.lit(0.0)), rules.share(F.lit(1.0), F.lit(None))).first()[0:2] == (0.0, 0.0)
