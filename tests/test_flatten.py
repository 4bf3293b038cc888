import json

from conftest import rows
from pyspark.sql import functions as F

from skyloom.operators import flatten
from skyloom.operators.flatten import FEEDS

META = {"extraction_timestamp": "20260129_060000", "execution_date": "2026-01-29"}


def docs(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b, indent=2) for b in bodies]
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "path string, text string")


OBSERVATION = {
    "coord": {"lon": -3.7, "lat": 40.4}, "weather": [{"id": 800, "main": "Clear", "description": "clear sky"}, {"id": 1}],
    "main": {"temp": 10.5, "feels_like": 9, "temp_min": 8, "temp_max": 12, "pressure": 1015, "humidity": 60},
    "visibility": 10000, "wind": {"speed": 3.5, "deg": 180}, "clouds": {"all": 5}, "dt": 1769644800,
    "sys": {"country": "PT"}, "rain": {"1h": 0.4}, "_metadata": {"city_name": "Madrid", "execution_date": "2026-01-29"},
}


def test_observation_fields(spark):
    row = flatten.flatten_observations(docs(spark, OBSERVATION)).first()
    assert len(row) == 25
    assert (row.city, row.country, row.latitude, row.temperature, row.pressure) == ("Madrid", "PT", 40.4, 10.5, 1015)
    assert (row.weather_id, row.weather_main, row.rain_1h, row.rain_3h, row.snow_1h) == (800, "Clear", 0.4, None, None)
    assert (row.date, row.bronze_source) == ("2026-01-29", "d0")


def test_observation_defaults_only_for_absent_members(spark):
    bare = {"main": {"temp": 1.0}}
    null_country = {**OBSERVATION, "sys": {"country": None}}
    null_main = {**OBSERVATION, "weather": [{"id": 1, "main": None}]}
    found = {r.bronze_source: r for r in flatten.flatten_observations(docs(spark, bare, null_country, null_main)).collect()}
    assert (found["d0"].city, found["d0"].country, found["d0"].weather_main) == ("Unknown", "ES", "Unknown")
    assert found["d0"].weather_description == "No description"
    assert found["d1"].country is None
    assert found["d2"].weather_main is None and found["d2"].weather_description == "No description"


def test_bad_observations_do_not_stop_the_others(spark):
    frame = docs(spark, OBSERVATION, {**OBSERVATION, "weather": []}, {**OBSERVATION, "rain": None}, "{broken")
    tagged = flatten.parse_observations(frame)
    assert sorted(rows(flatten.rejects(tagged))) == [
        ("d1", "empty_weather"), ("d2", "null_section"), ("d3", "unreadable")]
    assert flatten.flatten_observations(frame).count() == 1


def hourly(**extra):
    return {"hourly": {"time": ["2026-01-29T00:00", "2026-01-29T01:00"], "pm10": [1.5, None]},
            "city_code": "28079", "municipio_nombre": "Málaga", "_metadata": META, **extra}


def test_explode_columnar(spark):
    out = flatten.explode_columnar(docs(spark, hourly()), FEEDS["air_quality"])
    assert rows(out.select("time", "pm10", "ozone", "city_code", "city_name", "extraction_date", "_pos")) == [
        ("2026-01-29T00:00", 1.5, None, "28079", "Málaga", "2026-01-29", 0),
        ("2026-01-29T01:00", None, None, "28079", "Málaga", "2026-01-29", 1)]


def test_city_and_stamp_defaults(spark):
    bare = {"hourly": hourly()["hourly"]}
    null_city = hourly(municipio_nombre=None)
    out = flatten.explode_columnar(docs(spark, bare, null_city), FEEDS["air_quality"],
                                   F.lit("2026-01-30"), F.lit("20260130_000000"))
    found = {(r._src, r.city_name, r.extraction_timestamp, r.extraction_date) for r in out.collect()}
    assert found == {("d0", "Unknown", "20260130_000000", "2026-01-30"), ("d1", None, "20260129_060000", "2026-01-30")}


def test_section_fallback_and_rejects(spark):
    section = hourly()["hourly"]
    frame = docs(
        spark,
        {"daily": section, "_metadata": META},
        {"hourly": {}, "daily": section, "_metadata": META},
        {"hourly": {"unknown": [1]}, "daily": section, "_metadata": META},
        {"hourly": {"time": ["a"], "pm10": [1, 2]}, "_metadata": META},
        {"hourly": {"pm10": [1, 2]}, "_metadata": META},
        hourly(_metadata=None),
        "[1, 2",
    )
    tagged = flatten.parse_columnar(frame, FEEDS["air_quality"])
    assert sorted(rows(flatten.rejects(tagged))) == [
        ("d2", "no_time"), ("d3", "ragged_arrays"), ("d4", "no_time"), ("d5", "null_section"), ("d6", "unreadable")]
    out = flatten.explode_columnar(frame, FEEDS["air_quality"])
    assert {r[0] for r in out.select("_src").collect()} == {"d0", "d1"}


def test_empty_time_gives_no_rows(spark):
    frame = docs(spark, {"hourly": {"time": [], "pm10": []}, "_metadata": META})
    assert flatten.explode_columnar(frame, FEEDS["air_quality"]).count() == 0


def test_explode_then_pack_is_identity(spark):
    times = [f"2026-01-29T{h:02d}:00" for h in range(24)]
    body = {"hourly": {"time": times, "ozone": [h / 7 for h in range(24)]}, "_metadata": META}
    out = flatten.explode_columnar(docs(spark, body), FEEDS["air_quality"])
    back = out.groupBy("_src").agg(F.sort_array(F.collect_list(F.struct("_pos", "time", "ozone"))).alias("a")).first()["a"]
    assert [(i["time"], i["ozone"]) for i in back] == list(zip(times, body["hourly"]["ozone"]))


def test_document_is_parsed_once(spark):
    plan = flatten.explode_columnar(docs(spark, hourly()), FEEDS["hourly"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_stations(spark):
    record = {"indicativo": "3129", "nombre": "MADRID", "provincia": "MADRID", "altitud": "667,5",
              "latitud": "402455N", "longitud": "034041W", "indsinop": "08222"}
    out = flatten.flatten_stations(docs(spark, {"stations": [record, {}], "_metadata": META}, {"stations": [None]}))
    assert rows(out.drop("_src")) == [
        ("3129", "MADRID", "MADRID", 667.5, 40.415278, -3.678056, "08222", "2026-01-29", 0),
        (None, None, None, None, None, None, None, "2026-01-29", 1)]


def test_climatology(spark):
    record = {"fecha": "2026-01-01", "indicativo": "other", "nombre": "M", "provincia": "P", "tmed": "8,5",
              "prec": "Ip", "sol": "Acum", "dir": "15", "presMax": ""}
    body = {"station_id": "3129", "year": 2026, "records": [record], "_metadata": META}
    row = flatten.flatten_climatology(docs(spark, body), with_year=True).first()
    assert (row.station_id, row.year, row.date, row.temp_avg, row.precipitation, row.sunshine_hours) == (
        "3129", 2026, "2026-01-01", 8.5, None, None)
    assert (row.wind_direction, row.pressure_max) == (15.0, None)
    assert len(flatten.flatten_climatology(docs(spark, body)).drop("_src", "_pos").columns) == 18


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert rows(flatten.union_by_name(a, b)) == [(1, 2, None), (4, None, 3)]
