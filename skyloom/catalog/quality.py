"""Checks, scores and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog.registry import AS_OF, as_of, query, rounded, table
from skyloom.catalog.shapes import view, with_views
from skyloom.quality import checks, metrics, moments
from skyloom.quality.checks import SUITES
from skyloom.session import scratch_path

_VIEW_OF = {
    "observation": "v_obs", "daily_forecast": "v_daily", "hourly_forecast": "v_hourly",
    "air_quality": "v_air_quality", "pollen": "v_pollen", "marine": "v_marine",
}


def checks_sql(kind: str, threshold: float | None = None, mostly: float | None = None) -> str:
    """One row per check of a suite, each stated on its own."""
    suite, source = checks.suite_for(kind, threshold, mostly), _VIEW_OF[kind]
    none = "cast(NULL as double)"
    rows = [
        f"SELECT 0 AS seq, '{fixed.EXPECT_COLUMN}' AS expectation_type, cast(NULL as varchar) AS \"column\", "
        f"cast(0 as bigint) AS unexpected_count, 0.0e0 AS share, {none} AS min_value, {none} AS max_value, "
        f"{none} AS mostly, true AS success"
    ]
    for name, (low, high) in suite.ranges.items():
        bad, all_ = f"count(*) FILTER (WHERE {name} < {low} OR {name} > {high})", f"count({name})"
        share = f"(1.0e0 - {bad} / {all_})"
        rows.append(
            f"SELECT {len(rows)}, '{fixed.EXPECT_RANGE}', '{name}', {bad}, (1.0e0 - {share}) * 100, {low}e0, {high}e0, "
            f"{suite.mostly}e0, {share} >= {suite.mostly}e0 FROM {source}"
        )
    for name in suite.critical:
        bad = f"count(*) FILTER (WHERE {name} IS NULL)"
        share = f"(1.0e0 - {bad} / count(*))"
        rows.append(
            f"SELECT {len(rows)}, '{fixed.EXPECT_NOT_NULL}', '{name}', {bad}, (1.0e0 - {share}) * 100, {none}, {none}, "
            f"{suite.threshold}e0, {share} >= {suite.threshold}e0 FROM {source}"
        )
    return "c AS (" + "\nUNION ALL ".join(rows) + ")"


_DETAILS = """SELECT seq, expectation_type, "column", unexpected_count, round(share, 6) AS unexpected_percent,
  min_value, max_value, mostly, success FROM c"""
_SUMMARY = """SELECT '{name}' AS table_name, bool_and(success) AS success, cast(count(*) as int) AS total_expectations,
  cast(count(*) FILTER (WHERE success) as int) AS successful_expectations,
  cast(count(*) FILTER (WHERE NOT success) as int) AS failed_expectations,
  round(count(*) FILTER (WHERE success) / count(*), 6) AS success_rate,
  (SELECT count(*) FROM {source}) AS row_count FROM c"""
_SUMMARY_COLUMNS = [
    "table_name", "success", "total_expectations", "successful_expectations", "failed_expectations",
    "success_rate", "row_count",
]


def _register(name, kind):
    @query(name, with_views(_VIEW_OF[kind], f", {checks_sql(kind)}\n{_DETAILS}"))
    def run(spark, sf_dir):
        rows = view(spark, sf_dir, _VIEW_OF[kind])
        return rounded(checks.validation_details(rows, SUITES[kind]), "unexpected_percent")


for _name, _kind in (
    ("validate_observation", "observation"), ("validate_daily", "daily_forecast"),
    ("validate_hourly", "hourly_forecast"), ("validate_air_quality", "air_quality"),
    ("validate_pollen", "pollen"), ("validate_marine", "marine"),
):
    _register(_name, _kind)


@query(
    "validation_details",
    with_views("v_obs", f", {checks_sql('observation', 0.95, 0.8)}\n{_DETAILS} WHERE NOT success"),
)
def validation_details(spark, sf_dir):
    """Failed checks under overridden thresholds."""
    details = checks.validation_details(
        view(spark, sf_dir, "v_obs"), checks.suite_for("observation", threshold=0.95, mostly=0.8)
    )
    return rounded(details.filter(~F.col("success")), "unexpected_percent")


@query(
    "validation_summary",
    with_views("v_obs", f", {checks_sql('observation')}\n" + _SUMMARY.format(name="weather_observation_suite", source="v_obs")),
)
def validation_summary(spark, sf_dir):
    summary = checks.validate(view(spark, sf_dir, "v_obs"), SUITES["observation"])
    return rounded(summary.select(*_SUMMARY_COLUMNS), "success_rate")


@query(
    "gate_pass",
    with_views(
        "v_pollen v_air_quality",
        f""", p AS (WITH {checks_sql('pollen')} {_SUMMARY.format(name='pollen_suite', source='v_pollen')}),
a AS (WITH {checks_sql('air_quality')} {_SUMMARY.format(name='air_quality_suite', source='v_air_quality')})
SELECT table_name, success, row_count, CASE WHEN success THEN row_count ELSE 0 END AS rows_through FROM p
UNION ALL SELECT table_name, success, row_count, CASE WHEN success THEN row_count ELSE 0 END FROM a""",
    ),
)
def gate_pass(spark, sf_dir):
    """What a strict gate lets through; the checks run on the whole feed."""
    pollen = checks.validate(view(spark, sf_dir, "v_pollen"), SUITES["pollen"])
    air = checks.validate(view(spark, sf_dir, "v_air_quality"), SUITES["air_quality"])
    both = pollen.unionByName(air).select("table_name", "success", "row_count")
    through = F.when(F.col("success"), F.col("row_count")).otherwise(0)
    return both.withColumn("rows_through", through.cast("long"))


@query(
    "schema_check",
    """SELECT 'lineitem' AS table_name, 'Missing required columns: [''l_weight'']' AS error, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'lineitem', 'Column ''l_returnflag'' should be numeric, got string', count(*) FROM lineitem""",
)
def schema_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    errors = checks.schema_errors(
        rows, ["l_orderkey", "l_weight"],
        {"l_quantity": "numeric", "l_returnflag": "numeric", "l_shipdate": "datetime", "l_tax": "numeric"},
    )
    found = F.explode(F.array(*[F.lit(e) for e in errors]))
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("lineitem").alias("table_name"), found.alias("error"), "n_rows"
    )


@query(
    "range_check",
    """SELECT (1.0e0 - count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 49) / count(*)) >= 0.97e0 AS is_valid,
  count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 49) AS invalid_count,
  round(1.0e0 - count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 49) / count(*), 6) AS compliance_rate
FROM lineitem""",
)
def range_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rounded(checks.range_check(rows, "l_quantity", 2, 49, mostly=0.97), "compliance_rate")


@query(
    "completeness_check",
    with_views(
        "v_obs",
        """SELECT 'temperature' AS "column", round(count(temperature) / count(*), 6) AS score, count(temperature) / count(*) >= 0.92 AS is_valid FROM v_obs
UNION ALL SELECT 'wind_gust', round(count(wind_gust) / count(*), 6), count(wind_gust) / count(*) >= 0.92 FROM v_obs
UNION ALL SELECT 'humidity', round(count(humidity) / count(*), 6), count(humidity) / count(*) >= 0.92 FROM v_obs
UNION ALL SELECT 'sunshine', 0.0e0, false""",
    ),
)
def completeness_check(spark, sf_dir):
    rows = view(spark, sf_dir, "v_obs")
    names = ["temperature", "wind_gust", "humidity", "sunshine"]
    return rounded(checks.completeness_check(rows, names, threshold=0.92), "score")


@query(
    "not_null_check",
    with_views(
        "v_obs",
        """SELECT 1.0e0 - count(*) FILTER (WHERE dt IS NULL) / count(*) >= 0.95 AS is_valid,
  count(*) FILTER (WHERE dt IS NULL) AS null_count,
  round(1.0e0 - count(*) FILTER (WHERE dt IS NULL) / count(*), 6) AS completeness FROM v_obs""",
    ),
)
def not_null_check(spark, sf_dir):
    return rounded(checks.not_null_check(view(spark, sf_dir, "v_obs"), "dt"), "completeness")


_OBS_COLUMNS = [
    "event_id", "city", "country", "dt", "temperature", "humidity", "wind_gust", "rain_1h", "rain_3h", "snow_1h", "snow_3h", "date",
]


@query(
    "completeness_scores",
    with_views(
        "v_obs",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(count({c}) / count(*), 6) AS score FROM v_obs" for c in _OBS_COLUMNS
        ),
    ),
)
def completeness_scores(spark, sf_dir):
    return rounded(metrics.completeness_scores(view(spark, sf_dir, "v_obs"), _OBS_COLUMNS), "score")


@query(
    "freshness_score",
    f"""SELECT 'time' AS "column", round(greatest(0.0e0, least(1.0e0, 1.0e0 - (epoch(TIMESTAMP '{AS_OF}') - epoch(max(
  date_trunc('hour', ts)))) / 3600.0e0 / 24.0e0)), 6) AS freshness FROM events
UNION ALL SELECT 'words', CASE WHEN count(props) >= 0 THEN 0.0e0 END FROM events
UNION ALL SELECT 'missing', 0.0e0""",
)
def freshness_score(spark, sf_dir):
    """Of all events, by a column of moments, one that holds none, and one that does not exist."""
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm")
    marked = table(spark, sf_dir, "events").select(hour.alias("time"), F.col("props").alias("words"))
    parts = [
        metrics.freshness_score(marked, column, as_of()).select(
            F.lit(column).alias("column"), F.round("freshness", 6).alias("freshness")
        )
        for column in ("time", "words", "missing")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "range_conformity",
    with_views(
        "v_obs",
        """SELECT round(count(*) FILTER (WHERE temperature BETWEEN -10 AND 35) / count(temperature), 6) AS conformity FROM v_obs""",
    ),
)
def range_conformity(spark, sf_dir):
    return rounded(metrics.range_conformity(view(spark, sf_dir, "v_obs"), "temperature", -10, 35), "conformity")


# -- reports ----------------------------------------------------------------

_POLLEN = [
    "event_id", "time", "alder_pollen", "birch_pollen", "grass_pollen", "mugwort_pollen", "olive_pollen",
    "ragweed_pollen", "city_code", "city_name", "extraction_date", "extraction_timestamp", "event_type",
]
_SCORES_SQL = f"""{checks_sql('pollen')},
comp AS ({" UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS col, count({c}) / count(*) AS score FROM v_pollen" for i, c in enumerate(_POLLEN))}),
d AS (SELECT (SELECT avg(score) FROM comp) AS completeness,
  (SELECT count(*) FILTER (WHERE success) / count(*) FROM c) AS validity,
  (SELECT count(*) FROM (SELECT DISTINCT city_name, time FROM v_pollen)) / (SELECT count(*) FROM v_pollen) AS uniqueness,
  (SELECT greatest(0.0e0, least(1.0e0, 1.0e0 - (epoch(TIMESTAMP '{AS_OF}')
    - epoch(cast(replace(max(time), 'T', ' ') || ':00' as timestamp))) / 86400.0e0)) FROM v_pollen) AS freshness),
o AS (SELECT *, (completeness * 0.30 + validity * 0.35 + uniqueness * 0.20 + freshness * 0.15) AS overall_score,
  (completeness + validity + uniqueness + freshness) / 4 AS mean_score FROM d)"""


def _pollen_report(spark, sf_dir):
    return metrics.quality_report(
        view(spark, sf_dir, "v_pollen"), SUITES["pollen"], "fct_pollen", as_of(), ["city_name", "time"], "time"
    )


@query(
    "quality_scores",
    with_views(
        "v_pollen",
        f""", {_SCORES_SQL}
SELECT 'fct_pollen_20240131_060000' AS report_id, round(completeness, 6) AS completeness, round(validity, 6) AS validity,
  round(uniqueness, 6) AS uniqueness, round(freshness, 6) AS freshness, round(overall_score, 6) AS overall_score FROM o""",
    ),
)
def quality_scores(spark, sf_dir):
    names = ["completeness", "validity", "uniqueness", "freshness", "overall_score"]
    return rounded(_pollen_report(spark, sf_dir).select("report_id", *names), *names)


@query(
    "quality_report",
    with_views(
        "v_pollen",
        f""", {_SCORES_SQL}
SELECT 'fct_pollen' AS target_table, '{AS_OF}' AS measured_at, 'completeness_' || col AS metric_name, round(score, 6) AS value,
  'completeness' AS dimension FROM comp
UNION ALL SELECT 'fct_pollen', '{AS_OF}', 'validity_score', round(validity, 6), 'validity' FROM o
UNION ALL SELECT 'fct_pollen', '{AS_OF}', 'uniqueness_score', round(uniqueness, 6), 'uniqueness' FROM o
UNION ALL SELECT 'fct_pollen', '{AS_OF}', 'freshness_score', round(freshness, 6), 'freshness' FROM o""",
    ),
)
def quality_report(spark, sf_dir):
    rows = metrics.report_metrics(_pollen_report(spark, sf_dir))
    shown = rows.withColumn("measured_at", F.date_format("measured_at", "yyyy-MM-dd HH:mm:ss"))
    return rounded(shown, "value")


@query(
    "quality_report_json",
    with_views(
        "v_pollen",
        f""", {_SCORES_SQL}
SELECT 'fct_pollen_20240131_060000' AS report_id, '{{"table_name":"pollen_suite","success":' || CASE WHEN bool_and(success) THEN 'true' ELSE 'false' END
  || ',"total_expectations":' || count(*) || ',"failed_expectations":' || count(*) FILTER (WHERE NOT success)
  || ',"row_count":' || (SELECT count(*) FROM v_pollen) || '}}' AS summary FROM c""",
    ),
)
def quality_report_json(spark, sf_dir):
    document = metrics.report_json(_pollen_report(spark, sf_dir))
    schema = (
        "summary struct<table_name: string, success: boolean, total_expectations: int, "
        "failed_expectations: int, row_count: long>"
    )
    return document.select("report_id", F.to_json(F.from_json("report", schema)["summary"]).alias("summary"))


@query(
    "recommendations",
    with_views(
        "v_pollen",
        f""", {_SCORES_SQL},
r AS (SELECT 1 AS i, '{fixed.ADVICE["completeness"]}' || (SELECT string_agg(col, ', ' ORDER BY i) FROM
    (SELECT col, i FROM comp WHERE score < 0.9 ORDER BY i LIMIT 5)) AS text FROM o WHERE completeness < 0.9
  UNION ALL SELECT 2, '{fixed.ADVICE["validity"]}' || (SELECT string_agg(t, ', ') FROM (SELECT DISTINCT expectation_type AS t
    FROM (SELECT * FROM c WHERE NOT success ORDER BY seq LIMIT 3))) FROM o WHERE validity < 0.95
  UNION ALL SELECT 3, '{fixed.ADVICE["uniqueness"]}' FROM o WHERE uniqueness < 1
  UNION ALL SELECT 4, '{fixed.ADVICE["freshness"]}' FROM o WHERE freshness < 0.5
  UNION ALL SELECT 5, '{fixed.ADVICE["overall"]}' FROM o WHERE mean_score < 0.8)
SELECT text FROM r WHERE text IS NOT NULL""",
    ),
)
def recommendations(spark, sf_dir):
    return _pollen_report(spark, sf_dir).select(F.explode("recommendations").alias("text"))


# -- history ----------------------------------------------------------------


@query(
    "metrics_summary",
    with_views("v_metric", "SELECT * FROM v_metric WHERE target_table = 'click' AND dimension = 'validity'"),
)
def metrics_summary(spark, sf_dir):
    history = view(spark, sf_dir, "v_metric")
    return metrics.metrics_summary(history, table="click", dimension="validity")


@query(
    "metric_anomalies",
    with_views(
        "v_metric",
        """, s AS (SELECT target_table, avg(value) AS mean, stddev_pop(value) AS std FROM v_metric
  GROUP BY target_table HAVING count(*) >= 5)
SELECT target_table, metric_name, measured_on, round(value, 6) AS value, dimension, round(abs(value - mean) / std, 6) AS z_score
FROM v_metric JOIN s USING (target_table) WHERE std > 0 AND abs(value - mean) / std > 1.5""",
    ),
)
def metric_anomalies(spark, sf_dir):
    found = metrics.metric_anomalies(view(spark, sf_dir, "v_metric"), threshold=1.5)
    return rounded(found, "value", "z_score")


@query(
    "metric_anomalies_merged",
    with_views(
        "v_metric",
        """, s AS (SELECT target_table, avg(value) AS mean, stddev_pop(value) AS std FROM v_metric
  GROUP BY target_table HAVING count(*) >= 5)
SELECT target_table, metric_name, measured_on, round(value, 6) AS value, round(abs(value - mean) / std, 6) AS z_score
FROM v_metric JOIN s USING (target_table)
WHERE std > 0 AND abs(value - mean) / std > 1.5 AND cast(substr(measured_on, 9, 2) as int) % 4 = 3""",
    ),
)
def metric_anomalies_merged(spark, sf_dir):
    """Four runs add their rows to the moments, the last twice; its anomalies are found from its rows and the moments."""
    path = scratch_path(spark, "moments")
    rows = view(spark, sf_dir, "v_metric").withColumn("measured_at", F.col("measured_on").cast("timestamp_ntz"))
    for run in (0, 1, 2, 3, 3):
        part = rows.filter(F.dayofmonth("measured_at") % 4 == run)
        moments.add_moments(part, path, f"run-{run}")
    found = moments.anomalies_of(part, moments.read_moments(spark, path), threshold=1.5)
    return rounded(found.select("target_table", "metric_name", "measured_on", "value", "z_score"), "value", "z_score")
