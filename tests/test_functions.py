"""Micro-fixtures of the scalar expressions (hand-derived results)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerline.functions import (
    address_text,
    contact_text,
    find_landline,
    find_mobile,
    lenient_number,
    number_text,
    round_half_even,
    serial_day_to_date,
    serial_day_to_timestamp,
    strict_id,
)

PHONES = [
    ("(21) 99876-5432", "5521998765432", None),
    ("+55 21 99876-5432", "555521998765432", None),
    ("5521998765432", "555521998765432", "5555219987654"),
    ("2133334444", "55213333444", "552133334444"),
    ("(21) 3333-4444", None, "552133334444"),
    ("12345", None, None),
    ("12345678000199", "551234567800019", "5512345678000"),
    ("21 9987-5432", None, None),
    ("987654321", "55987654321", None),
    ("00998765432", "5500998765432", None),
]


def test_phones(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PHONES], "t string")
    got = df.select("t", find_mobile("t").alias("m"), find_landline("t").alias("f")).collect()
    assert [(r.t, r.m, r.f) for r in got] == PHONES


def test_strict_phones(spark):
    df = spark.createDataFrame([("+55 21 99876-5432",), ("12345678000199",), ("(21) 99876-5432",)], "t string")
    got = [r.m for r in df.select(find_mobile("t", strict=True).alias("m")).collect()]
    assert got == ["5521998765432", None, "5521998765432"]


def test_contact_text(spark):
    schema = "a string, b string, " + ", ".join(f"`{i}` string" for i in range(1, 11))
    row = (None, None, "21 99999-0001") + (None,) * 9
    df = spark.createDataFrame([row], schema)
    got = df.select(contact_text(["a", "b"], [str(i) for i in range(1, 11)]).alias("c")).first().c
    assert got == " ||  || 21 99999-0001"


def test_address(spark):
    df = spark.createDataFrame([("20000", "Centro", "Rua A", None, "Rua A", "Rio", "RJ"), (None,) * 7],
                               "a string, b string, c string, d string, e string, f string, g string")
    got = [r.x for r in df.select(address_text(list("abcdefg")).alias("x")).collect()]
    assert got == ["20000, Centro, Rua A, Rio, RJ", ""]


def test_serial_day(spark):
    df = spark.createDataFrame([(45407.0,), (45407.5,)], "d double")
    got = df.select(serial_day_to_date("d").alias("a"), serial_day_to_timestamp("d").alias("b")).collect()
    assert got[0].a == dt.date(2024, 4, 25)
    assert got[1].b == dt.datetime(2024, 4, 25, 12, 0)


def test_rounding(spark):
    df = spark.createDataFrame([(0.00005,), (0.00025,), (5.12345,), (1.00005,)], "x double")
    got = [r.r for r in df.select(round_half_even("x").alias("r")).collect()]
    assert got == [0.0, 0.0002, 5.1234, 1.0001]


def test_strict_id(spark):
    ok = spark.createDataFrame([(12.7,)], "x double").select(strict_id("x", dtype=T.DoubleType()).alias("v"))
    assert ok.first().v == 12
    for value in (None, "12.0"):
        bad = spark.createDataFrame([(value,)], "x string").select(strict_id("x", dtype=T.StringType()).alias("v"))
        with pytest.raises(Exception):
            bad.collect()


def test_lenient(spark):
    df = spark.createDataFrame([("n/a",), ("1_0",), (" 7 ",), ("1.5d",), ("NaN",)], "x string")
    got = [r.v for r in df.select(lenient_number("x").alias("v")).collect()]
    assert got == [None, None, 7.0, None, None]


def test_number_text(spark):
    df = spark.createDataFrame([(5.1,), (5.0,), (12345678.5,), (1181.4639,), (None,)], "x double")
    got = [r.t for r in df.select(number_text("x").alias("t")).collect()]
    assert got == ["5.1", "5.0", "12345678.5", "1181.4639", None]
