import math

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.functions import clean


def one(spark, value, kind, function):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [("10,5", 10.5), ("8", 8.0), ("-0,3", -0.3), ("Ip", None), ("Acum", None), ("", None), ("invalid", None),
     (None, None), ("1.5d", None), ("1_0", 10.0), (" 7,25 ", 7.25), ("1e3", 1000.0), (",5", 0.5), ("nan", None), ("_1", None), ("1__0", None), ("1_", None), ("1,_5", None), ("0x1p3", None),
     ("2F", None), ("inf", float("inf")), ("-Infinity", float("-inf")), ("1_000,5", 1000.5)],
)
def test_locale_number(spark, text, number):
    assert one(spark, text, "string", clean.locale_number) == number


@pytest.mark.parametrize(
    "text, degrees",
    [("402455N", 40.415278), ("034041W", -3.678056), ("021730E", 2.291667), ("34041w", -3.678056),
     ("402455s", -40.415278), ("402455X", 40.415278), ("abc", None), ("12", None), ("", None), (None, None),
     ("4024555N", None), ("40ab55N", None)],
)
def test_dms_to_decimal(spark, text, degrees):
    assert one(spark, text, "string", clean.dms_to_decimal) == degrees


@pytest.mark.parametrize(
    "text, key",
    [("2026-01-29", 20260129), ("2026-01-29T10:00", 20260129), ("20260129", 20260129), ("invalid-date", None),
     (None, None), ("None", None)],
)
def test_date_id(spark, text, key):
    assert one(spark, text, "string", clean.date_id) == key


def test_date_id_of_timestamp(spark):
    assert spark.sql("select timestamp_ntz'2026-01-29 05:00:00' as x").select(clean.date_id(F.col("x"))).first()[0] == 20260129


def test_nan_becomes_null_but_text_stays(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "a")], "x double, t string")
    assert rows(clean.normalise_nan(df)) == [(None, "nan"), (1.0, "a")]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Madrid"])
def test_epoch_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1769644800.0,)], "x double")
        assert df.select(clean.epoch_to_ts(F.col("x")).cast("string")).first()[0] == "2026-01-29 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("value, whole, cut", [(5.5, 6, 5), (-5.5, -6, -5), (2.4, 2, 2), (None, None, None), (1e12, None, None)])
def test_rounding_and_cutting(spark, value, whole, cut):
    assert one(spark, value, "double", clean.whole_number) == whole
    assert one(spark, value, "double", clean.truncated_number) == cut


def test_decimal_rounds_half_up_and_overflow_is_null(spark):
    assert str(one(spark, 2.345, "double", lambda c: clean.typed(c, "decimal(5,2)"))) == "2.35"
    assert one(spark, 1000.0, "double", lambda c: clean.typed(c, "decimal(5,2)")) is None


def test_times(spark):
    assert one(spark, "2026-01-29T07:45", "string", clean.time_of_day) == "07:45:00"
    assert one(spark, "soon", "string", clean.time_of_day) is None
    df = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' a, timestamp_ntz'2026-01-01 00:01:30.4' b")
    assert df.select(clean.duration_seconds(F.col("a"), F.col("b"))).first()[0] == 90


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), min_size=1, max_size=20))
def test_comma_text_reads_back(spark, numbers):
    texts = [(str(n).replace(".", ","),) for n in numbers]
    out = [r[0] for r in spark.createDataFrame(texts, "x string").select(clean.locale_number(F.col("x"))).collect()]
    assert all(math.isclose(a, b) for a, b in zip(out, numbers))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False), st.sampled_from(
    [999.994, 999.995, 999.9949999, -999.995, 99.99, 99.995, 2147483647.4, 2147483647.5, -2147483648.5, 2147483647.9, 2147483648.0,
     99999.995, 99999.9949])), min_size=1, max_size=30))
def test_fits_agrees_with_the_conversion(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    for rule in ("decimal(5,2)", "decimal(4,2)", "decimal(7,2)", "decimal(6,4)", "int", "truncated int"):
        out = df.select("x", clean.typed(F.col("x"), rule).isNotNull().alias("typed"), clean.fits(F.col("x"), rule).alias("fits"))
        assert [r for r in out.collect() if r.typed != r.fits] == [], rule
