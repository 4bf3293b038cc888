"""Tables written to the shared folder and read back: sinks, published versions, months, histories."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.catalog import shapes
from skyloom.catalog.facts import load_sql
from skyloom.catalog.quality import _SCORES_SQL, _pollen_report
from skyloom.catalog.registry import AS_OF, as_of, plain, query, rounded, table
from skyloom.catalog.scans import _DOCS_PER_DAY
from skyloom.catalog.shapes import view, with_views
from skyloom.operators import lineage, lookup, partitions
from skyloom.operators.flatten import FEEDS
from skyloom.plans import daily, dims, facts, historical
from skyloom.quality import metrics
from skyloom.session import scratch_path
from skyloom.sources import lake, sinks

# -- sources and sinks ------------------------------------------------------


@query("bronze_json_multiline", with_views("v_air_quality", _DOCS_PER_DAY))
def bronze_json_multiline(spark, sf_dir):
    """Indented documents over many lines; a file holds those of 4,096 consecutive events."""
    path = scratch_path(spark, "bronze")
    docs = shapes.feed_documents(spark, sf_dir, "air_quality")
    body = F.from_json("text", FEEDS["air_quality"].schema())
    chunk = F.regexp_extract("path", r"_(\d+)\.json$", 1).cast("long")
    files = docs.groupBy(F.floor(chunk / 64)).agg(F.collect_list(body).alias("docs"))
    indented = files.select(F.to_json("docs", {"pretty": "true"}).alias("value"))
    indented.write.option("maxRecordsPerFile", 1).text(path)
    found = lake.read_json(spark, path, FEEDS["air_quality"].schema())
    present = F.size(F.filter("hourly.pm10", lambda x: x.isNotNull()))
    return found.groupBy(F.col("_metadata.execution_date").alias("execution_date")).agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size("hourly.time")).cast("long").alias("n_points"),
        F.sum(present).cast("long").alias("n_present"),
    )


@query(
    "sinks_round_trip",
    with_views(
        "v_pollen",
        """SELECT kind, date, count(*) AS n_rows, cast(sum(event_id) as bigint) AS ids, count(birch_pollen) AS n_birch FROM (
  SELECT 'json' AS kind, extraction_date AS date, event_id, birch_pollen FROM v_pollen
  UNION ALL SELECT 'table', extraction_date, event_id, birch_pollen FROM v_pollen
  UNION ALL SELECT 'dates', extraction_date, event_id, birch_pollen FROM v_pollen
    WHERE extraction_date < '2024-01-15' OR event_type <> 'error'
  UNION ALL SELECT 'snapshots', extraction_date, event_id, birch_pollen FROM v_pollen
) GROUP BY kind, date""",
    ),
)
def sinks_round_trip(spark, sf_dir):
    """Documents, a replaced table, replaced dates, and two snapshots side by side."""
    root = scratch_path(spark, "sinks")
    rows = view(spark, sf_dir, "v_pollen").select(
        F.col("extraction_date").alias("date"), "event_id", "birch_pollen", "event_type"
    )

    errors = F.col("event_type") == "error"
    sinks.write_json(rows.select(F.to_json(F.struct("*")).alias("text")), f"{root}/json")
    sinks.write_table(rows.filter(errors), f"{root}/table")
    sinks.write_table(rows, f"{root}/table")
    # all dates, of which the late ones are replaced by rows without errors
    sinks.overwrite_dates(rows, f"{root}/dates")
    sinks.overwrite_dates(rows.filter(~errors & (F.col("date") >= "2024-01-15")), f"{root}/dates")
    sinks.append_snapshot(rows.filter(errors), root, "snapshots/errors")
    sinks.append_snapshot(rows.filter(~errors), root, "snapshots/others")
    back = {
        "json": lake.read_json(spark, f"{root}/json", "date string, event_id long, birch_pollen double", multi_line=False),
        "table": lake.read_table(spark, f"{root}/table"),
        "dates": lake.read_table(spark, f"{root}/dates"),
        "snapshots": lake.read_table(spark, lake.finished_folders(spark, f"{root}/snapshots/*")),
    }
    parts = [
        df.select(F.lit(kind).alias("kind"), F.col("date").cast("string").alias("date"), "event_id", "birch_pollen")
        for kind, df in back.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("kind", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").cast("long").alias("ids"),
        F.count("birch_pollen").alias("n_birch"),
    )


# -- facts ------------------------------------------------------------------


def _loaded_twice(spark, sf_dir, spec, source, path):
    rows, cities = view(spark, sf_dir, source), view(spark, sf_dir, "v_city")
    store = facts.fact_table(spec, path)
    store.create(spark)
    return [facts.load_fact(rows, spec, cities, store, as_of(), ["event_id"]) for _ in range(2)]


@query(
    "load_fact_twice",
    f"""SELECT *, 0 AS loaded_again FROM ({load_sql("pollen")})""",
)
def load_fact_twice(spark, sf_dir):
    """A feed loaded twice into its months: the second load inserts nothing."""
    path, spec = scratch_path(spark, "fact"), facts.FACTS["pollen"]
    _, again = _loaded_twice(spark, sf_dir, spec, "v_pollen", path)
    stored = facts.fact_table(spec, path).open(spark).drop(partitions.PARTITION)
    return plain(stored.withColumn("loaded_again", F.lit(again["rows_loaded"])))


@query(
    "load_outcomes",
    with_views(
        "v_pollen v_city",
        """, k AS (SELECT c.city_id, v.time, v.extraction_date FROM v_pollen v LEFT JOIN v_city c USING (city_name)),
n AS (SELECT count(*) FILTER (WHERE city_id IS NULL) AS lost, count(*) FILTER (WHERE city_id IS NOT NULL) AS keyed,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM k WHERE city_id IS NOT NULL)) AS firsts FROM k)
SELECT 1 AS load, 'loaded' AS outcome, firsts AS n_rows FROM n
UNION ALL SELECT 1, 'duplicate', keyed - firsts FROM n UNION ALL SELECT 1, 'conflict', 0 FROM n
UNION ALL SELECT 1, 'unknown_city', lost FROM n WHERE lost > 0
UNION ALL SELECT 2, 'loaded', 0 FROM n
UNION ALL SELECT 2, 'duplicate', keyed - firsts FROM n UNION ALL SELECT 2, 'conflict', firsts FROM n
UNION ALL SELECT 2, 'unknown_city', lost FROM n WHERE lost > 0""",
    ),
)
def load_outcomes(spark, sf_dir):
    """What the load itself says became of every row."""
    path = scratch_path(spark, "fact")
    found = _loaded_twice(spark, sf_dir, facts.FACTS["pollen"], "v_pollen", path)
    rows = [(i + 1, name, n) for i, load in enumerate(found) for name, n in load["outcomes"].items()]
    return spark.createDataFrame(rows, "load int, outcome string, n_rows long")


@query(
    "load_unknown_names",
    with_views(
        "v_hourly v_city",
        "SELECT DISTINCT city_name AS name FROM v_hourly WHERE city_name NOT IN (SELECT city_name FROM v_city) ORDER BY 1 LIMIT 5",
    ),
)
def load_unknown_names(spark, sf_dir):
    """The cities a load names because the dimension lacks them."""
    spec = facts.FACTS["hourly"]
    store = facts.fact_table(spec, scratch_path(spark, "fact"))
    store.create(spark)
    rows, cities = view(spark, sf_dir, "v_hourly"), view(spark, sf_dir, "v_city")
    found = facts.load_fact(rows, spec, cities, store, as_of(), ["event_id"])
    return spark.createDataFrame([(name,) for name in found["unknown"]], "name string")


@query(
    "load_mapped",
    with_views(
        "v_pollen v_city",
        """, s AS (SELECT c.city_id, cast(replace(extraction_date, '-', '') as int) AS extraction_date_id,
  replace(time, 'T', ' ') || ':00' AS measurement_datetime, v.*  EXCLUDE (time)
  FROM v_pollen v JOIN v_city c USING (city_name))
SELECT city_id, measurement_datetime, extraction_date_id,
  cast(round(birch_pollen) as int) + cast(round(grass_pollen) as int) AS both_pollen
FROM s QUALIFY row_number() OVER (PARTITION BY city_id, measurement_datetime, extraction_date_id ORDER BY event_id) = 1""",
    ),
)
def load_mapped(spark, sf_dir):
    """A fact column that the user computes from two others."""
    both = facts.Mapped(("birch_pollen", "grass_pollen"), lambda a, b: F.round(a) + F.round(b))
    spec = replace(facts.FACTS["pollen"], columns=((both, "both_pollen", "int"),))
    rows = facts.build_fact(view(spark, sf_dir, "v_pollen"), spec, view(spark, sf_dir, "v_city"), as_of(), ["event_id"])
    return plain(rows.select("city_id", "measurement_datetime", "extraction_date_id", "both_pollen"))


_DATE_ID = "(cast(year(o_orderdate) as int) + 28) * 10000 + cast(month(o_orderdate) as int) * 100 + cast(day(o_orderdate) as int)"


@query(
    "month_added_later",
    f"""WITH d AS (SELECT o_orderkey, {_DATE_ID} AS date_id FROM orders)
SELECT CASE WHEN date_id BETWEEN 20240101 AND 20271231 OR floor(date_id / 100) IN (202801, 202802)
    THEN cast(cast(floor(date_id / 100) as int) as varchar) ELSE 'default' END AS p_month,
  count(*) AS n_rows, cast(sum(o_orderkey) as bigint) AS ids FROM d GROUP BY 1""",
)
def month_added_later(spark, sf_dir):
    """Half of the rows come before two months are declared, half after; one month is declared twice."""
    store = partitions.MonthTable(scratch_path(spark, "months"), "o_orderkey long, date_id int", "date_id", ("o_orderkey",))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DATE_ID).alias("date_id"))
    early = F.col("o_orderkey") % 2 == 0
    store.append(store.dealt(store.placed(rows.filter(early))))
    for month in (1, 2, 1):
        store.add_month(spark, "facts", 2028, month)
    store.append(store.dealt(store.placed(rows.filter(~early))))
    return store.open(spark).groupBy("p_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").cast("long").alias("ids")
    )


# -- append-only logs ---------------------------------------------------------


@query(
    "published_log",
    with_views(
        "v_attempt",
        """, d AS (SELECT DISTINCT task_id, execution_date, year(execution_date) % 3 AS turn FROM v_attempt)
SELECT cast(row_number() OVER (ORDER BY turn DESC, task_id, execution_date) as int) AS id, task_id,
  cast(execution_date as varchar) AS execution_date, 'running' AS status FROM d""",
    ),
)
def published_log(spark, sf_dir):
    """Run logs appended in falling order of their turns, compacted in between."""
    path, logs = scratch_path(spark, "log"), view(spark, sf_dir, "v_attempt")
    for turn in (2, 1, 0):
        starts = logs.filter(F.year("execution_date") % 3 == turn).select("dag_id", "task_id", "execution_date")
        starts = starts.withColumn("start_time", as_of())  # tasks repeat within a day
        lineage.append_log(
            spark, path, "etl_run_log", starts, lambda log, starts=starts: lineage.start_runs(log, starts, as_of())
        )
        if turn == 1:
            lineage.compact_log(spark, path, "etl_run_log")
    log = lineage.read_log(spark, path, "etl_run_log")
    return plain(log.select("id", "task_id", "execution_date", "status"))


_STATION = "'S' || lpad(cast(o_custkey % 103 as string), 5, '0')"


@query(
    "upsert_repeated_keys",
    f"""WITH f AS (SELECT {_STATION} AS station_id, o_orderpriority AS station_name,
    cast(cast(o_orderdate as date) as varchar) AS src, o_orderkey AS pos FROM orders),
l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY src DESC, pos DESC) = 1),
t AS (SELECT s_suppkey + 1 AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'S' ELSE 'X' END || lpad(cast(s_suppkey as string), 5, '0') AS station_id,
  s_name AS name FROM supplier),
b AS (SELECT coalesce(max(id), 0) AS top FROM t)
SELECT cast(t.id as int) AS id, t.station_id, coalesce(l.station_name, t.name) AS station_name FROM t LEFT JOIN l USING (station_id)
UNION ALL SELECT cast(top + row_number() OVER (ORDER BY l.station_id) as int), l.station_id, l.station_name
FROM l, b WHERE l.station_id NOT IN (SELECT station_id FROM t)""",
)
def upsert_repeated_keys(spark, sf_dir):
    """An inventory that names its stations many times, merged twice as the daily run does."""
    dim = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).cast("int").alias("id"),
        F.concat(  # the inventory knows every second supplier under another key
            F.when(F.col("s_suppkey") % 2 == 0, "S").otherwise("X"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")
        ).alias("station_id"),
        F.col("s_name").alias("station_name"),
    )
    for name in ("province", "altitude", "latitude", "longitude", "synop_code", "created_at", "updated_at"):
        kind = "timestamp_ntz" if name.endswith("_at") else "string" if name in ("province", "synop_code") else "decimal(9,2)"
        dim = dim.withColumn(name, F.lit(None).cast(kind))
    feed = table(spark, sf_dir, "orders").select(
        F.expr(_STATION).alias("station_id"), F.col("o_orderpriority").alias("station_name"),
        F.lit("P").alias("province"), F.lit(1.0).alias("altitude"), F.lit(2.0).alias("latitude"),
        F.lit(3.0).alias("longitude"), F.lit(None).cast("string").alias("synop_code"),
        F.col("o_orderdate").cast("date").cast("string").alias("_src"), F.col("o_orderkey").alias("_pos"),
    )
    for _ in range(2):
        dim = dims.load_stations(dim, feed, as_of())
    return dim.select("id", "station_id", "station_name")


# -- lookups beyond the broadcast bound -------------------------------------


@query(
    "large_dim_join",
    """SELECT n.n_name AS name, count(*) AS n_rows, cast(sum(l_orderkey) as bigint) AS keys
FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey % 27 END AS k FROM lineitem)
LEFT JOIN nation n ON n_nationkey = k GROUP BY 1""",
)
def large_dim_join(spark, sf_dir):
    """The plan for dimensions above the bound; one key holds a third of all rows."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey") % 27)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", key.cast("long").alias("k"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n"), "n_name")
    joined = lookup.dim_join(lines, nation, "k", "n", {"n_name": "name"}, max_rows=1)
    return joined.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").cast("long").alias("keys")
    )


# -- quality ----------------------------------------------------------------


@query(
    "freshness_by_kind",
    f"""SELECT event_type, round(greatest(0.0e0, least(1.0e0, 1.0e0 - (epoch(TIMESTAMP '{AS_OF}') - epoch(max(
  date_trunc('hour', ts)))) / 3600.0e0 / 24.0e0)), 6) AS freshness FROM events GROUP BY event_type""",
)
def freshness_by_kind(spark, sf_dir):
    """All kinds of events in one scan."""
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm")
    events = table(spark, sf_dir, "events").select("event_type", hour.alias("time"))
    return rounded(metrics.freshness_by(events, ["event_type"], "time", as_of()), "freshness")


@query(
    "metric_history_anomalies",
    with_views(
        "v_metric",
        """, s AS (SELECT target_table, avg(value) AS mean, stddev_pop(value) AS std FROM v_metric
  GROUP BY target_table HAVING count(*) >= 5)
SELECT target_table, metric_name, measured_on, round(value, 6) AS value, round(abs(value - mean) / std, 6) AS z_score
FROM v_metric JOIN s USING (target_table) WHERE std > 0 AND abs(value - mean) / std > 1.5""",
    ),
)
def metric_history_anomalies(spark, sf_dir):
    """Metrics appended to a stored history in two runs; what stood there before was cleared."""
    path = scratch_path(spark, "history")
    rows = view(spark, sf_dir, "v_metric").withColumn("measured_at", F.col("measured_on").cast("timestamp_ntz"))
    rows = rows.select("target_table", "measured_at", "metric_name", "value", "dimension")
    metrics.append_history(rows, path)
    metrics.clear_history(spark, path)
    odd = F.dayofmonth("measured_at") % 2 == 1
    metrics.append_history(rows.filter(odd), path)
    metrics.append_history(rows.filter(~odd), path)
    found = metrics.metric_anomalies(metrics.read_history(spark, path), threshold=1.5)
    day = F.date_format("measured_at", "yyyy-MM-dd").alias("measured_on")
    return rounded(found.select("target_table", "metric_name", day, "value", "z_score"), "value", "z_score")


_ADVICE = [
    f"""SELECT 'recommendations', '{fixed.ADVICE["completeness"]}' || (SELECT string_agg(col, ', ' ORDER BY i) FROM
  (SELECT col, i FROM comp WHERE score < 0.9 ORDER BY i LIMIT 5)), NULL FROM o
  WHERE completeness < 0.9 AND EXISTS (SELECT 1 FROM comp WHERE score < 0.9)""",
    f"""SELECT 'recommendations', '{fixed.ADVICE["validity"]}' || (SELECT string_agg(t, ', ' ORDER BY first) FROM
  (SELECT expectation_type AS t, min(seq) AS first FROM (SELECT * FROM c WHERE NOT success ORDER BY seq LIMIT 3) GROUP BY 1)), NULL
  FROM o WHERE validity < 0.95""",
    f"SELECT 'recommendations', '{fixed.ADVICE['uniqueness']}', NULL FROM o WHERE uniqueness < 1",
    f"SELECT 'recommendations', '{fixed.ADVICE['freshness']}', NULL FROM o WHERE freshness < 0.5",
    f"SELECT 'recommendations', '{fixed.ADVICE['overall']}', NULL FROM o WHERE mean_score < 0.8",
]
_SCORES = ("completeness", "validity", "uniqueness", "freshness", "overall_score")


@query(
    "quality_report_document",
    with_views(
        "v_pollen",
        f""", {_SCORES_SQL},
z AS (SELECT count(*) AS total, count(*) FILTER (WHERE success) AS good FROM c)
SELECT part, name, round(value, 6) AS value FROM (
  SELECT 'scores' AS part, col AS name, score AS value FROM comp
  UNION ALL SELECT 'metrics', 'completeness_' || col, score FROM comp
  UNION ALL SELECT 'metrics', 'validity_score', validity FROM o
  UNION ALL SELECT 'metrics', 'uniqueness_score', uniqueness FROM o
  UNION ALL SELECT 'metrics', 'freshness_score', freshness FROM o
  {" ".join(f"UNION ALL SELECT 'report', '{n}', {n} FROM o" for n in _SCORES)}
  UNION ALL SELECT 'report', 'report_id fct_pollen_20240131_060000', NULL
  UNION ALL SELECT 'report', 'target_table fct_pollen', NULL
  UNION ALL SELECT 'summary', 'table_name pollen_suite', NULL
  UNION ALL SELECT 'summary', 'total_expectations', total FROM z
  UNION ALL SELECT 'summary', 'successful_expectations', good FROM z
  UNION ALL SELECT 'summary', 'failed_expectations', total - good FROM z
  UNION ALL SELECT 'summary', 'success_rate', good / total FROM z
  UNION ALL SELECT 'summary', 'success_percent', good / total * 100 FROM z
  UNION ALL SELECT 'summary', 'row_count', count(*) FROM v_pollen
  UNION ALL SELECT 'summary', 'column_count', 13
  UNION ALL SELECT 'failed', expectation_type, NULL FROM c WHERE NOT success
  {" ".join("UNION ALL " + a for a in _ADVICE)}) WHERE name IS NOT NULL""",
    ),
)
def quality_report_document(spark, sf_dir):
    """The whole report as its JSON document, read back part by part."""
    numbers = ("total_expectations", "successful_expectations", "failed_expectations", "success_rate",
               "success_percent", "row_count", "column_count")
    schema = (
        "report_id string, target_table string, " + ", ".join(f"{n} double" for n in _SCORES)
        + ", scores array<struct<column: string, score: double>>"
        ", metrics array<struct<metric_name: string, value: double, dimension: string>>"
        ", recommendations array<string>, summary struct<table_name: string, "
        + ", ".join(f"{n}: double" for n in numbers) + ", failed_details: array<struct<expectation_type: string>>>"
    )
    read = metrics.report_json(_pollen_report(spark, sf_dir)).select(F.from_json("report", schema).alias("r")).select("r.*")

    def item(part, name, value=None):
        number = F.lit(None).cast("double") if value is None else value
        return F.struct(F.lit(part).alias("part"), name.alias("name"), number.alias("value"))

    texts = [item("report", F.concat(F.lit(f"{n} "), F.col(n))) for n in ("report_id", "target_table")]
    texts.append(item("summary", F.concat(F.lit("table_name "), F.col("summary.table_name"))))
    texts += [item("report", F.lit(n), F.col(n)) for n in _SCORES]
    texts += [item("summary", F.lit(n), F.col(f"summary.{n}")) for n in numbers]
    parts = F.concat(
        F.array(*texts),
        F.transform("scores", lambda s: item("scores", s["column"], s["score"])),
        F.transform("metrics", lambda m: item("metrics", m["metric_name"], m["value"])),
        F.transform("recommendations", lambda r: item("recommendations", r)),
        F.transform("summary.failed_details", lambda e: item("failed", e["expectation_type"])),
    )
    return rounded(read.select(F.inline(parts)), "value")


# -- files seen once, and a whole day ---------------------------------------


@query("load_new_files", load_sql("station_day"))
def load_new_files(spark, sf_dir):
    """Snapshots that arrive one after the other, loaded after each arrival; of each load only the new files are read."""
    root, spec = scratch_path(spark, "historical"), facts.FACTS["station_day"]
    rows, stations = view(spark, sf_dir, "v_clim"), view(spark, sf_dir, "v_station")
    columns = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    store = facts.fact_table(spec, f"{root}/fact")
    store.create(spark)
    last = rows.agg(F.max("o_orderkey")).first()[0]
    for part in range(3):  # a load before anything came, and one after nothing new came
        part_of = F.floor(F.col("o_orderkey") * 3 / (last + 1)) == part
        for again in (False, True):
            found = historical.load_new_files(
                spark, f"{root}/silver", "historical/", columns, f"{root}/ledger", spec, stations, store, as_of(),
                ["o_orderkey"], "aemet",
            )
            assert bool(found["files"]) == (again is False and part > 0), found
        sinks.append_snapshot(rows.filter(part_of), f"{root}/silver", f"historical/{part}")
    historical.load_new_files(
        spark, f"{root}/silver", "historical/", columns, f"{root}/ledger", spec, stations, store, as_of(),
        ["o_orderkey"], "aemet",
    )
    return plain(store.open(spark).drop(partitions.PARTITION))


_RUN_DAY = "2024-01-31"


def writers(n_files: int) -> int:
    """Tasks that write ``n_files``: names sort in order up to 1,000 files a task (``c999``), so each gets about 500."""
    return max(32, -(-n_files // 500))


@query(
    "daily_run",
    with_views(
        "v_air_quality v_city",
        f""", s AS (SELECT c.city_id, v.* FROM v_air_quality v LEFT JOIN v_city c USING (city_name)),
k AS (SELECT * FROM s WHERE city_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city_id, time ORDER BY event_id) = 1),
docs AS (SELECT count(DISTINCT (city_name, floor(event_id / 4096))) AS n FROM v_air_quality),
n AS (SELECT (SELECT count(*) FROM s) AS rows_in, (SELECT count(*) FROM k) AS kept)
SELECT 'fact' AS part, 'fct_air_quality' AS name, kept AS n_rows, (SELECT cast(round(sum(cast(pm10 as decimal(6,2))), 2) as double) FROM k) AS value FROM n
UNION ALL SELECT 'log', 'extract_openmeteo_air_quality success', 1, kept FROM n
UNION ALL SELECT 'log', 'extract_openmeteo_pollen success', 1, 0
UNION ALL SELECT 'lineage', 'bronze', n, n FROM docs
UNION ALL SELECT 'lineage', 'silver', 1, rows_in FROM n
UNION ALL SELECT 'metrics', 'fct_air_quality', rows_in, rows_in - kept FROM n""",
    ),
)
def daily_run(spark, sf_dir):
    """A warehouse that held something is reset and runs a day; its facts and logs."""
    layout = daily.Layout(scratch_path(spark, "lake"), scratch_path(spark, "warehouse"))
    cities = view(spark, sf_dir, "v_city").withColumns({"is_coastal": F.col("is_coastal").cast("int")})
    spec = FEEDS["air_quality"]
    rows = view(spark, sf_dir, "v_air_quality").withColumn("chunk", F.floor(F.col("event_id") / 4096))
    items = F.sort_array(F.collect_list(F.struct("event_id", *spec.fields)))
    keys = ["chunk", "city_name", "city_code"]
    packed = rows.groupBy(*keys).agg(items.alias("items"))
    n_tasks = writers(rows.select(*keys).distinct().count())
    body = packed.repartitionByRange(n_tasks, "chunk", "city_name").sortWithinPartitions("chunk", "city_name").select(
        "city_code", F.col("city_name").alias("municipio_nombre"),
        F.struct(*[F.col("items").getField(n).alias(n) for n in spec.fields]).alias(spec.section),
        F.struct(F.lit(shapes.RUN_STAMP).alias("extraction_timestamp")).alias("_metadata"),
    )
    # files are moved to their place by the tasks, not one after the other by the driver
    files = body.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    files.option("ignoreNullFields", "false").json(layout.bronze("air_quality", _RUN_DAY))
    tasks = ["extract_openmeteo_air_quality", "extract_openmeteo_pollen"]
    for hour, run in ((6, tasks[1:]), (7, tasks)):
        run_at = datetime(2024, 1, 31, hour)
        daily.reset_warehouse(spark, layout, cities, run_at)
        daily.run_day(spark, layout, _RUN_DAY, run_at, tasks=run)

    def part(df, kind, name, n_rows, value):
        return df.select(F.lit(kind).alias("part"), name.alias("name"), n_rows.cast("long").alias("n_rows"),
                         value.cast("double").alias("value"))

    fact = layout.fact_table("air_quality").open(spark).agg(F.count(F.lit(1)).alias("n"), F.sum("pm10").alias("pm10"))
    log = daily.run_log(spark, layout)
    files = lineage.read_log(spark, layout.table("lake_metadata"), "lake_metadata").filter("object_path like 'air_quality/%'")
    files = files.groupBy("layer").agg(F.count(F.lit(1)).alias("n"), F.sum("record_count").alias("records"))
    measured = lineage.read_log(spark, layout.table("etl_metrics"), "etl_metrics")
    out = [
        part(fact, "fact", F.lit("fct_air_quality"), F.col("n"), F.round("pm10", 2)),
        part(log, "log", F.concat_ws(" ", "task_id", "status"), F.lit(1), F.col("records_processed")),
        part(files, "lineage", F.col("layer"), F.col("n"), F.col("records")),
        part(measured, "metrics", F.col("target_table"), F.col("rows_input"), F.col("rows_rejected")),
    ]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
