import json
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.quality import checks, errors, metrics
from skyloom.quality.checks import SUITES, Suite


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize(
    "values, options, expected",
    [
        ((5.0, 15.0, 40.0, 25.0), {"low": 10, "high": 35}, (False, 2, 0.5)),
        ((10.0, 35.0), {"low": 10, "high": 35}, (True, 0, 1.0)),
        ((None, 20.0, float("nan")), {"low": 10, "high": 35}, (True, 0, 1.0)),
        ((None, None), {"low": 10, "high": 35}, (True, 0, 1.0)),
        ((), {"low": 10, "high": 35}, (True, 0, 1.0)),
        ((None, 20.0), {"low": 10, "high": 35, "allow_null": False}, (False, 1, 0.5)),
        ((1.0, 20.0), {"low": 10, "high": 35, "mostly": 0.5}, (True, 1, 0.5)),
        ((50.0,), {"low": 10}, (True, 0, 1.0)),
    ],
)
def test_range(spark, values, options, expected):
    assert rows(checks.range_check(numbers(spark, *values), "x", **options)) == [expected]


def test_missing_column_passes_range_and_not_null(spark):
    df = numbers(spark, 1.0)
    assert rows(checks.range_check(df, "y", 0, 1)) == [(True, 0, 1.0)]
    assert rows(checks.not_null_check(df, "y")) == [(True, 0, 1.0)]


def test_completeness(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (3.0, None), (4.0, float("nan")), (5.0, 5.0)], "a double, b double")
    out = rows(checks.completeness_check(df, ["a", "b", "c"], 0.8))
    assert [(c, round(s, 6), ok) for c, s, ok in out] == [("a", 0.8, True), ("b", 0.6, False), ("c", 0.0, False)]
    assert checks.completeness_check(df.limit(0), ["a"]).count() == 0
    assert dict(rows(metrics.completeness_scores(df))) == {"a": 0.8, "b": 0.6}
    assert metrics.completeness_scores(df.limit(0)).count() == 0
    assert rows(checks.not_null_check(df.limit(0), "a")) == [(True, 0, 1.0)]


OBS = "city string, temperature double, humidity double, pressure double"


def test_overrides(spark):
    half = spark.createDataFrame([("a", 1.0, 1.0, 900.0), ("b", None, 1.0, 900.0), ("c", None, 1.0, 900.0), ("d", 1.0, 1.0, 900.0)], OBS)
    assert not checks.validate(half, SUITES["observation"]).first().success
    assert checks.validate(half, checks.suite_for("observation", threshold=0.40)).first().success
    wild = spark.createDataFrame([("a", 999.0, 1.0, 900.0)] + [("b", 1.0, 1.0, 900.0)] * 3, OBS)
    assert not checks.validate(wild, SUITES["observation"]).first().success
    assert checks.validate(wild, checks.suite_for("observation", mostly=0.50)).first().success


def test_summary_and_details(spark):
    df = spark.createDataFrame([("a", 999.0, 1.0)], "city string, temperature double, humidity double")
    result = checks.validate(df, SUITES["observation"]).first()
    # schema, two ranged columns present, three critical columns present
    assert (result.total_expectations, result.failed_expectations, result.column_count) == (6, 2, 3)
    assert [d.expectation_type for d in result.failed_details] == ["expect_column_to_exist", "expect_column_values_to_be_between"]
    detail = result.failed_details[1]
    assert (detail.column, detail.unexpected_count, detail.unexpected_percent, detail.max_value) == ("temperature", 1, 100.0, 60.0)
    assert result.failed_details[0].column == "pressure"


def test_strict_gate(spark):
    bad = spark.createDataFrame([("a", 999.0, 1.0, 900.0)], OBS)
    with pytest.raises(errors.QualityError) as info:
        checks.gate(bad, SUITES["observation"], strict=True)
    assert info.value.results["failed_expectations"] == 1 and "(1 failed)" in str(info.value)
    assert checks.gate(bad, SUITES["observation"])["success"] is False
    with pytest.raises(ValueError):
        checks.suite_for("tides")


def test_error_texts():
    assert str(errors.QualityError("plain")) == "plain"
    assert str(errors.QualityError("bad", {"failed_expectations": 2})) == "bad (2 failed)"


def test_one_pass_for_all_checks(spark):
    df = spark.range(10).select(*[F.rand().alias(c) for c in SUITES["hourly_forecast"].ranges])
    text = checks.validate(df, SUITES["hourly_forecast"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Range (") == 1


def test_schema_errors(spark):
    df = spark.createDataFrame([(1, "a", True)], "n int, s string, b boolean")
    assert checks.schema_errors(df, ["n", "z"]) == ["Missing required columns: ['z']"]
    assert checks.schema_errors(df, [], {"n": "numeric", "s": "string", "b": "boolean", "q": "numeric"}) == []
    assert len(checks.schema_errors(df, [], {"n": "string", "s": "datetime", "b": "numeric"})) == 3


def test_uniqueness(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "k string, t int")
    assert rows(metrics.uniqueness_score(df, ["k", "t"]))[0][1:] == (2, 2 / 3)
    assert rows(metrics.uniqueness_score(df.limit(0), ["k"]))[0][2] == 1.0
    assert rows(metrics.uniqueness_score(df, ["z"]))[0][2] == 0.0


@pytest.mark.parametrize("latest, score", [("2026-01-29 06:00:00", 1.0), ("2026-01-30 00:00:00", 1.0), ("2026-01-28T18:00", 0.5),
                                           ("2026-01-01", 0.0), ("soon", 0.0), (None, 0.0)])
def test_freshness(spark, latest, score):
    as_of = F.lit("2026-01-29 06:00:00").cast("timestamp_ntz")
    df = spark.createDataFrame([(latest,), ("2020-01-01",) if latest else (None,)], "t string")
    assert rows(metrics.freshness_score(df, "t", as_of)) == [(score,)]


def test_freshness_without_data(spark):
    as_of = F.lit("2026-01-29").cast("timestamp_ntz")
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert rows(metrics.freshness_score(df, "t", as_of)) == [(0.0,)]
    assert rows(metrics.freshness_score(df, "u", as_of)) == [(0.0,)]


def test_range_conformity(spark):
    assert rows(metrics.range_conformity(numbers(spark, 1.0, 5.0, None), "x", 0, 2)) == [(0.5,)]
    assert rows(metrics.range_conformity(numbers(spark, None), "x", 0, 2)) == [(1.0,)]
    assert rows(metrics.range_conformity(numbers(spark), "x", 0, 2)) == [(0.0,)]
    assert rows(metrics.range_conformity(numbers(spark, 1.0), "y", 0, 2)) == [(0.0,)]


def report(spark, df, **options):
    as_of = F.lit(datetime(2026, 1, 29, 6)).cast("timestamp_ntz")
    return metrics.quality_report(df, SUITES["observation"], "t", as_of, **options)


def test_report_weights_are_renormalised(spark):
    df = spark.createDataFrame([("a", 10.0, 50.0, 1000.0), ("a", None, 50.0, 1000.0)], OBS)
    row = report(spark, df, key=["city"]).first()
    assert row.completeness == pytest.approx(0.875) and row.uniqueness == 0.5
    validity = row.validity
    assert row.overall_score == pytest.approx((0.875 * 0.30 + validity * 0.35 + 0.5 * 0.20) / 0.85)
    assert "freshness" not in row.asDict()
    other = report(spark, df, weights={"completeness": 1.0}).first()
    assert other.overall_score == pytest.approx((0.875 + validity * 0.25) / 1.25)
    assert row.report_id == "t_20260129_060000"


def test_recommendations(spark):
    df = spark.createDataFrame([("a", 999.0, None, None), ("a", 999.0, None, None)], OBS)
    row = report(spark, df, key=["city"]).first()
    assert row.recommendations == [
        "Improve data completeness for columns: humidity, pressure",
        "Address validation failures: expect_column_values_to_be_between, expect_column_values_to_not_be_null",
        "Investigate and remove duplicate records before loading",
        "Overall data quality is below threshold - review data sources",
    ]
    names = [m.metric_name for m in row.metrics]
    assert names[0] == "completeness_city" and names[-2:] == ["validity_score", "uniqueness_score"]
    text = json.loads(metrics.report_json(report(spark, df)).first().report)
    assert text["summary"]["table_name"] == "weather_observation_suite"


def test_report_of_an_empty_table(spark):
    row = report(spark, spark.createDataFrame([], OBS), key=["city"]).first()
    assert (row.completeness, row.validity, row.uniqueness, row.scores) == (0.0, 1.0, 1.0, [])


def test_anomalies(spark):
    history = spark.createDataFrame(
        [("t", "m", 1.0)] * 9 + [("t", "m", 10.0)] + [("t", "flat", 1.0)] * 9 + [("t", "short", 1.0)] * 3 + [("t", "short", 99.0)],
        "target_table string, metric_name string, value double")
    out = metrics.metric_anomalies(history)
    assert [(r.metric_name, r.value) for r in out.collect()] == [("m", 10.0)]
    assert out.first().z_score == pytest.approx(3.0)


def test_history_filters(spark):
    history = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "target_table string, dimension string")
    assert metrics.metrics_summary(history).count() == 3
    assert metrics.metrics_summary(history, table="a").count() == 2
    assert metrics.metrics_summary(history, table="a", dimension="x").count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), max_size=30))
def test_scores_stay_between_zero_and_one(spark, values):
    df = numbers(spark, *values)
    suite = Suite("s", ("x",), {"x": (-10.0, 10.0)}, ("x",))
    row = metrics.quality_report(df, suite, "t", F.lit("2026-01-01").cast("timestamp_ntz"), key=["x"]).first()
    assert all(0.0 <= row[c] <= 1.0 for c in ("completeness", "validity", "uniqueness", "overall_score"))
