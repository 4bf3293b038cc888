"""Mergeable moments, schemas by day, documents as VARIANT, and the ledger of loaded files."""

import json
import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyloom.operators import flatten, lineage, schemas
from skyloom.operators.flatten import FEEDS
from skyloom.plans import facts, historical
from skyloom.plans.facts import FACTS
from skyloom.quality import metrics, moments
from skyloom.sources import sinks

HISTORY = "target_table string, measured_at timestamp_ntz, metric_name string, value double, dimension string"


def history(spark, data):
    return spark.createDataFrame([(t, datetime(2026, 1, d, h), m, v, "d") for t, d, h, m, v in data], HISTORY)


def series(seed, n=60):
    r = random.Random(seed)
    out = [("t1", r.randint(1, 9), r.randint(0, 23), "m", 1e6 + r.gauss(0, 1)) for _ in range(n)]
    out += [("t2", r.randint(1, 9), 0, "m", r.choice([None, r.random()])) for _ in range(n)]
    return out + [("t3", 1, 0, "m", 1.0)] * 8 + [("t4", 1, 0, "m", float(i)) for i in range(4)] + [(None, 2, 0, None, float(i * i)) for i in range(20)]


def as_set(df):
    return sorted(repr((r.target_table, r.metric_name, r.measured_at, r.value, round(r.z_score, 6))) for r in df.collect())


def test_anomalies_from_moments_equal_a_full_scan(spark, tmp_path):
    data, path = series(3), str(tmp_path / "m")
    assert moments.read_moments(spark, path).count() == 0
    parts = [data[i::4] for i in range(4)]
    for i, part in enumerate([*parts, parts[-1]]):  # the last run is repeated
        moments.add_moments(history(spark, part), path, f"run-{min(i, 3)}")
    state = moments.read_moments(spark, path)
    whole = metrics.metric_anomalies(history(spark, data), threshold=1.2)
    last = {(r.target_table, r.metric_name, r.measured_at, r.value) for r in history(spark, parts[-1]).collect()}
    found = moments.anomalies_of(history(spark, parts[-1]), state, threshold=1.2)
    want = [x for x in as_set(whole) if any(x.startswith(repr((t, m, at, v))[:-1]) for t, m, at, v in last)]
    assert as_set(found) == want and len(want) > 3
    # days added up, and added up again, give the same
    stored = moments.by_day(state)
    assert stored.count() < state.count()
    assert as_set(moments.anomalies_of(history(spark, parts[-1]), stored, threshold=1.2)) == want
    assert moments.anomalies_of(history(spark, []), state).count() == 0
    assert moments.anomalies_of(history(spark, data), moments.read_moments(spark, str(tmp_path / "none"))).count() == 0


def docs(spark, *texts):
    return spark.createDataFrame([(d, t) for d, t in texts], "day string, text string")


def test_schema_changes(spark):
    table = docs(
        spark, ("d1", '{"a": 1, "b": {"c": null}, "l": [1, 2]}'), ("d1", '{"a": 2.5}'), ("d1", "{broken"),
        ("d2", '{"a": "x", "b": {"c": 1}, "l": []}'), ("d4", '{"b": {"c": 2, "e": true}, "l": [{"z": 1}]}'), ("d5", '{"a": 1, "b": {}}'),
    )
    shapes = schemas.day_schemas(table, F.col("day"))
    assert {(r.day, r.n_documents, r.n_unreadable) for r in shapes.collect()} == {("d1", 2, 1), ("d2", 1, 0), ("d4", 1, 0), ("d5", 1, 0)}
    members = schemas.schema_members(spark, shapes)
    got = {tuple(r) for r in schemas.schema_changes(members).select("day", "path", "change", "kind_before", "kind").collect()}
    assert got == {
        ("d2", "$.a", "retyped", "number", "string"), ("d2", "$.b.c", "retyped", "null", "number"),
        ("d2", "$.l[*]", "retyped", "number", "null"),
        ("d4", "$.a", "removed", "string", None), ("d4", "$.b.e", "added", None, "boolean"),
        ("d4", "$.l[*]", "retyped", "null", "object"), ("d4", "$.l[*].z", "added", None, "number"),
        ("d5", "$.a", "added", None, "number"), ("d5", "$.b.c", "removed", "number", None),
        ("d5", "$.b.e", "removed", "boolean", None), ("d5", "$.l", "removed", "list", None),
        ("d5", "$.l[*]", "removed", "object", None), ("d5", "$.l[*].z", "removed", "number", None),
    }
    merged = {r.path: (r.kind, r.first_day, r.last_day, r.n_days) for r in schemas.merged_schema(members).collect()}
    assert merged["$.a"] == ("mixed", "d1", "d5", 3) and merged["$.b.c"] == ("number", "d1", "d4", 3)
    empty = schemas.schema_members(spark, schemas.day_schemas(table.limit(0), F.col("day")))
    assert schemas.schema_changes(empty).count() == 0


META = {"extraction_timestamp": "20260129_060000", "execution_date": "2026-01-29"}


def test_documents_as_variant_give_the_same_rows(spark, tmp_path):
    hours = ["2026-01-29T00:00", "2026-01-29T01:00"]
    bodies = [
        {"hourly": {"time": hours, "pm10": [1, None]}, "municipio_nombre": "Madrid", "_metadata": META},
        {"hourly": {"time": hours, "pm10": [1.5, 2]}, "municipio_nombre": None, "_metadata": META},
        {"hourly": {"time": hours}, "_metadata": META},
        {"hourly": {}, "daily": {"time": hours, "pm10": [3, 4]}, "_metadata": META},
        {"hourly": {"time": hours, "pm10": [1.0]}, "_metadata": META},
        {"hourly": {"time": hours}, "_metadata": None}, {"hourly": {"pm10": [1]}, "_metadata": META},
    ]
    texts = [json.dumps(b) for b in bodies] + ["{broken", "[1]", "null"]
    table = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "path string, text string")
    path = str(tmp_path / "v")
    flatten.as_variant(table).write.parquet(path)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["body"] == "variant"
    spec = FEEDS["air_quality"]
    assert sorted(map(str, rows(flatten.explode_columnar(stored, spec)))) == sorted(map(str, rows(flatten.explode_columnar(table, spec))))
    reasons = [sorted(rows(flatten.rejects(flatten.parse_columnar(d, spec)))) for d in (stored, table)]
    assert reasons[0] == reasons[1] and len(reasons[0]) >= 5


def test_only_new_files_are_listed(spark, tmp_path):
    root, ledger = str(tmp_path / "silver"), str(tmp_path / "ledger")
    columns = "station_id string, date string, extraction_date string, _src string, _pos int, " + ", ".join(
        f"{s} double" for s, _, _ in FACTS["station_day"].columns)
    stations = spark.createDataFrame([(1, "S1")], "id int, station_id string")
    store = facts.fact_table(FACTS["station_day"], str(tmp_path / "fact"), 4)

    def arrive(name, *days):
        data = [("S1", d, "2026-01-01", name, i, *[1.0] * len(FACTS["station_day"].columns)) for i, d in enumerate(days)]
        sinks.append_snapshot(spark.createDataFrame(data, columns).coalesce(1), root, f"historical/{name}")

    def load(**options):
        return historical.load_new_files(
            spark, root, "historical/", columns, ledger, FACTS["station_day"], stations, store,
            F.lit("2026-01-02").cast("timestamp_ntz"), ["_src", "_pos"], "aemet", **options)

    assert load()["files"] == 0
    arrive("a", "2026-01-01", "2026-01-02")
    assert load(modified_after="2999-01-01T00:00:00")["files"] == 0
    first = load()
    assert (first["files"], first["rows_loaded"], first["skipped"]) == (1, 2, [])
    arrive("b", "2026-01-02", "2026-01-03")
    (tmp_path / "silver" / "historical" / "b" / "bad.parquet").write_bytes(b"PAR1")
    second = load()
    assert (second["files"], second["rows_loaded"], second["skipped"]) == (2, 1, ["historical/b/bad.parquet"])
    assert load()["files"] == 1  # only what could not be read is tried again
    log = lineage.read_log(spark, ledger, "lake_metadata")
    assert {(r.object_path.split("/")[1], r.status, r.record_count) for r in log.collect()} == {("a", "loaded", 2), ("b", "loaded", 2), ("b", "skipped", 0)}


def test_empty_files_are_noted_once(spark, tmp_path):
    root, ledger = str(tmp_path / "silver"), str(tmp_path / "ledger")
    spec = FACTS["station_day"]
    columns = "station_id string, date string, extraction_date string, _src string, _pos int, " + ", ".join(
        f"{s} double" for s, _, _ in spec.columns)
    stations = spark.createDataFrame([(1, "S1")], "id int, station_id string")
    store = facts.fact_table(spec, str(tmp_path / "fact"), 4)
    data = [("S1", "2026-01-01", "2026-01-01", "a", 0, *[1.0] * len(spec.columns))]
    snapshot = spark.createDataFrame(data, columns).coalesce(1)
    sinks.append_snapshot(snapshot, root, "historical/a")
    for name in ("b", "c"):  # Spark writes a file for the first partition, even if it has no row
        sinks.append_snapshot(snapshot.filter("rand() < 0"), root, f"historical/{name}")
    (tmp_path / "silver" / "historical" / "b" / "bad.parquet").write_bytes(b"PAR1")

    def load():
        return historical.load_new_files(
            spark, root, "historical/", columns, ledger, spec, stations, store,
            F.lit("2026-01-02").cast("timestamp_ntz"), ["_src", "_pos"], "aemet")

    first, second = load(), load()
    n = len(list((tmp_path / "silver" / "historical").glob("*/*.parquet")))
    assert n == 4 and (first["files"], first["rows_loaded"], first["skipped"]) == (4, 1, ["historical/b/bad.parquet"])
    assert (second["files"], second["skipped"]) == (1, ["historical/b/bad.parquet"])
    log = lineage.read_log(spark, ledger, "lake_metadata")
    assert sorted((r.status, r.record_count) for r in log.collect()) == [("loaded", 0), ("loaded", 0), ("loaded", 1), ("skipped", 0)]


@pytest.mark.parametrize("n", [0, 3])
def test_loading_nothing_counts_nothing(spark, tmp_path, n):
    store = facts.fact_table(FACTS["pollen"], str(tmp_path / "f"), 4)
    names = ["city_name", "city", "time", "extraction_date", "o", *FACTS["pollen"].sources]
    data = [("Nowhere", "Nowhere", "2026-01-01T00:00", "2026-01-01", i, *[1.0] * len(FACTS["pollen"].sources)) for i in range(n)]
    kinds = ["string"] * 4 + ["int"] + ["double"] * len(FACTS["pollen"].sources)
    batch = spark.createDataFrame(data, ", ".join(f"{a} {b}" for a, b in zip(names, kinds)))
    cities = spark.createDataFrame([(1, "Madrid")], "city_id int, city_name string")
    got = facts.load_fact(batch, FACTS["pollen"], cities, store, F.lit("2026-01-02").cast("timestamp_ntz"), ["o"])
    assert (got["rows_input"], got["rows_loaded"], got["rows_rejected"]) == (n, 0, n)
    assert got["outcomes"] == {"loaded": 0, "duplicate": 0, "conflict": 0, **({"unknown_city": n} if n else {})}
