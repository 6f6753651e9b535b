import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimloom.functions.curves import curve_type
from dimloom.functions.dates import period_key, within_day
from dimloom.functions.hashing import record_hash
from dimloom.functions.text import dotted_key, empty_to_null, plain_number


def test_plain_number(spark):
    cases = {"10.5000": "10.5", "0.5000": ".5", "-0.2500": "-.25", "0.0000": "0", "100.0000": "100", "-3.0000": "-3",
             "1020.0300": "1020.03"}
    df = spark.createDataFrame([(Decimal(k), v) for k, v in cases.items()], "x decimal(18,4), y string")
    rows = df.select(plain_number(F.col("x"), 4).alias("x"), "y").collect()
    assert [r.x for r in rows] == [r.y for r in rows]


def test_plain_number_keeps_zeros_of_integers(spark):
    df = spark.createDataFrame([(Decimal(100),)], "x decimal(18,0)")
    assert df.select(plain_number(F.col("x"), 0)).first()[0] == "100"


def test_dotted_key_keeps_dots_of_missing_parts(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(dotted_key(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "a..c"


def test_empty_text_is_missing(spark):
    df = empty_to_null(spark.createDataFrame([("", "x", 1)], "a string, b string, n int"))
    assert tuple(df.first()) == (None, "x", 1)


def test_period_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(987, 11, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(period_key(F.col("d"))).collect()] == ["202402", "098711", None]


def test_within_day_is_half_open(spark):
    moments = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 59, 59, 999999), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    assert df.filter(within_day(F.col("t"), "2024-01-01")).count() == 2


def test_curve_type(spark):
    rows = [("actuals", "x", "ACTUAL"), ("Fc", None, "FORECAST"), ("FORECAST", None, "FORECAST"),
            ("other", "s-curve", "S-CURVE"), (None, "budget", "BUDGET"), ("other", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "f string, c string, e string")
    assert all(r.got == r.e for r in df.select(curve_type(F.col("f"), F.col("c")).alias("got"), "e").collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.none() | st.text(max_size=5), st.none() | st.dates(dt.date(1900, 1, 1), dt.date(2100, 1, 1)),
                          st.none() | st.decimals(-1000, 1000, places=4)), min_size=1, max_size=8))
def test_record_hash_matches_hashlib(spark, rows):
    df = spark.createDataFrame(rows, "a string, d date, n decimal(18,4)")

    def number(value):
        text = format(value, "f").rstrip("0").rstrip(".")
        text = "0" if text in ("", "-0", "0") else text
        return text.replace("0.", ".", 1) if text.startswith(("0.", "-0.")) else text

    expected = [hashlib.sha256("\x01".join([
        "NULL" if a is None else a, "NULL" if d is None else d.isoformat(), "NULL" if n is None else number(n),
    ]).encode()).hexdigest().upper() for a, d, n in rows]
    assert [r[0] for r in df.select(record_hash(df, ["a", "d", "n"])).collect()] == expected


def test_hash_does_not_tell_null_from_its_text(spark):
    df = spark.createDataFrame([(None,), ("NULL",)], "a string")
    assert df.select(record_hash(df, ["a"])).distinct().count() == 1
