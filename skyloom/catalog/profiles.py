"""Frame and document profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.catalog.registry import query, rounded, table
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import diagnostics, schemas
from skyloom.session import scratch_path
from skyloom.sources import sinks

_OBS = {"event_id": "bigint", "city": "string", "dt": "double", "temperature": "double", "wind_gust": "double",
        "rain_1h": "double", "rain_3h": "double", "snow_1h": "double", "weather_main": "string"}


@query(
    "null_profile",
    with_views(
        "v_obs",
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) / count(*), 6) AS null_ratio, (count(*) - count({c})) / count(*) > 0.5 AS mostly_null FROM v_obs"""
            for c, t in _OBS.items()
        ),
    ),
)
def null_profile(spark, sf_dir):
    return rounded(diagnostics.null_profile(view(spark, sf_dir, "v_obs").select(*_OBS)), "null_ratio")


@query(
    "frame_profile",
    """SELECT 'conversations' AS name, false AS valid, count(*) AS row_count, 4 AS column_count,
  'missing columns: score' AS issues FROM conversations
UNION ALL SELECT 'documents', true, count(*), 5, '' FROM documents
UNION ALL SELECT 'labels', true, count(*), 3,
  CASE WHEN count(*) FILTER (WHERE quality = 0) / count(*) > 0.5
    THEN printf('quality: %.1f%% null', count(*) FILTER (WHERE quality = 0) / count(*) * 100) ELSE '' END FROM labels""",
)
def frame_profile(spark, sf_dir):
    """Three tables; in the labels a zero quality is read as missing."""
    labels = table(spark, sf_dir, "labels")
    labels = labels.withColumn("quality", F.when(F.col("quality") != 0, F.col("quality")))
    parts = [
        diagnostics.frame_profile(table(spark, sf_dir, "conversations"), ["conv_id", "score"], "conversations"),
        diagnostics.frame_profile(table(spark, sf_dir, "documents"), ["doc_id", "text"], "documents"),
        diagnostics.frame_profile(labels, ["doc_id"], "labels"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "json_structure",
    """SELECT '$' AS path, 'dict' AS kind, count(*) AS n_values, 3::bigint AS min_members, 3::bigint AS max_members FROM events
UNION ALL SELECT '$.id', 'int', count(*), NULL, NULL FROM events
UNION ALL SELECT '$.props', 'dict', count(*), 1, 1 FROM events
UNION ALL SELECT '$.props.k', 'int', count(*), NULL, NULL FROM events
UNION ALL SELECT '$.tags', 'list', count(*), min(event_id % 4), max(event_id % 4) FROM events
UNION ALL SELECT '$.tags[0]', 'str', count(*), NULL, NULL FROM events WHERE event_id % 4 > 0""",
)
def json_structure(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    tags = F.array_repeat(F.lit('"t"'), (F.col("event_id") % 4).cast("int"))
    text = F.concat(
        F.lit('{"id":'), F.col("event_id"), F.lit(',"props":'), F.col("props"),
        F.lit(',"tags":['), F.array_join(tags, ","), F.lit("]}"),
    )
    return diagnostics.json_structure(events.select(text.alias("text")))


@query(
    "schema_diff",
    """WITH n AS (SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM conversations) AS right_rows)
SELECT * FROM (VALUES ('doc_id', 'only_left', 'bigint', NULL, false), ('text', 'common', 'string', 'string', false),
  ('lang', 'only_left', 'string', NULL, false), ('source', 'common', 'string', 'bigint', true),
  ('n_chars', 'only_left', 'bigint', NULL, false), ('conv_id', 'only_right', NULL, 'bigint', false),
  ('role', 'only_right', NULL, 'string', false)) v("column", presence, left_type, right_type, type_differs), n""",
)
def schema_diff(spark, sf_dir):
    """Conversations with the turn number under the name of a text column."""
    talks = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "source")
    return diagnostics.schema_diff(table(spark, sf_dir, "documents"), talks)


_DAY = "cast(cast(ts as date) as varchar)"


@query(
    "schema_drift",
    f"""WITH d AS (SELECT DISTINCT {_DAY} AS day, cast(day(ts) as int) AS n FROM events),
m AS (SELECT d.day, d.n, k.path, CASE WHEN k.path = '$.value' AND n > 15 THEN 'string' ELSE k.kind END AS kind FROM d,
  (VALUES ('$', 'object'), ('$.id', 'number'), ('$.value', 'number'), ('$.props', 'object'), ('$.props.k', 'number'),
    ('$.tags', 'list'), ('$.tags[*]', 'string'), ('$.alert', 'boolean')) k(path, kind)
  WHERE k.path <> '$.alert' OR n % 3 = 0),
o AS (SELECT day, row_number() OVER (ORDER BY day) AS i FROM d),
p AS (SELECT a.day AS before, b.day AS day FROM o a JOIN o b ON b.i = a.i + 1)
SELECT p.day, k.path, CASE WHEN x.path IS NULL THEN 'added' WHEN y.path IS NULL THEN 'removed' ELSE 'retyped' END AS change,
  x.kind AS kind_before, CASE WHEN y.path IS NULL THEN NULL ELSE y.kind END AS kind
FROM p JOIN (SELECT DISTINCT path FROM m) k ON true LEFT JOIN m x ON x.day = p.before AND x.path = k.path
LEFT JOIN m y ON y.day = p.day AND y.path = k.path
WHERE (x.path IS NULL) <> (y.path IS NULL) OR x.kind <> y.kind""",
)
def schema_drift(spark, sf_dir):
    """Documents of a month: a member that comes every third day, and one that becomes text in its middle."""
    shapes = schemas.day_schemas(_drifting(spark, sf_dir), F.to_date("ts"))
    return schemas.schema_changes(schemas.schema_members(spark, shapes))


def _drifting(spark, sf_dir):
    day = F.dayofmonth("ts")
    value = F.round("value", 2).cast("string")
    text = F.concat(
        F.lit('{"id":'), F.col("event_id"), F.lit(',"props":'), F.col("props"),
        F.lit(',"value":'), F.when(day > 15, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value),
        F.when(day % 3 == 0, F.lit(',"alert":true')).otherwise(F.lit("")), F.lit(',"tags":["t"]}'),
    )
    return table(spark, sf_dir, "events").select("ts", text.alias("text"))


@query(
    "schema_merged",
    f"""WITH d AS (SELECT DISTINCT {_DAY} AS day, cast(day(ts) as int) AS n FROM events)
SELECT path, kind, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM d,
  (VALUES ('$', 'object'), ('$.id', 'number'), ('$.value', 'mixed'), ('$.props', 'object'), ('$.props.k', 'number'),
    ('$.tags', 'list'), ('$.tags[*]', 'string'), ('$.alert', 'boolean')) k(path, kind)
WHERE path <> '$.alert' OR n % 3 = 0 GROUP BY path, kind""",
)
def schema_merged(spark, sf_dir):
    """The schema of the whole month, from the schemas kept per day."""
    path = scratch_path(spark, "schemas")
    docs = _drifting(spark, sf_dir)
    for half in (0, 1):
        part = docs.filter((F.dayofmonth("ts") > 15) == F.lit(bool(half)))
        sinks.append_once(schemas.day_schemas(part, F.to_date("ts")), path, f"half-{half}")
    kept = spark.read.schema("day string, shape string").option("recursiveFileLookup", "true").parquet(path)
    return schemas.merged_schema(schemas.schema_members(spark, kept))
