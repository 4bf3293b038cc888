import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyloom.plans import dims

def as_of():
    return F.lit("2026-01-29 06:00:00").cast("timestamp_ntz")



@pytest.mark.parametrize("rule, weeks", [("iso", 575), ("calendar", 576)])
def test_calendar_sizes(spark, rule, weeks):
    dates = dims.dim_date(dims.default_bounds(spark), rule)
    assert dates.count() == 4018
    assert dims.dim_week(dates, rule).count() == weeks
    assert dims.dim_month(dates, rule).count() == 132


def day(spark, rule, ident):
    dates = dims.dim_date(dims.default_bounds(spark), rule)
    return dates.filter(F.col("id_calendar_day") == ident).first()


def test_iso_and_calendar_years_differ_at_the_year_end(spark):
    iso, calendar = day(spark, "iso", 20241230), day(spark, "calendar", 20241230)
    assert (iso.id_calendar_week, calendar.id_calendar_week) == (202501, 202401)
    assert (iso.id_calendar_semester, calendar.id_calendar_semester) == (20242, 2)
    first = day(spark, "iso", 20210101)
    assert (first.id_calendar_week, first.id_week, first.id_weekday) == (202053, 53, 5)
    assert first.ds_calendar_day == "Friday, 01 January 2021"
    assert calendar.ds_calendar_day == "2024-12-30"


def test_week_and_month_text(spark):
    dates = dims.dim_date(dims.default_bounds(spark))
    week = dims.dim_week(dates).filter("id_calendar_week = 202501").first()
    assert (week.ds_calendar_week, week.ds_week_from_to) == ("W01 2025", "30/12 - 05/01")
    assert (str(week.dt_monday_of_week), str(week.dt_sunday_of_week)) == ("2024-12-30", "2025-01-05")
    assert dims.dim_month(dates).filter("id_calendar_month = 202505").first().ds_calendar_month == "May 2025"
    other = dims.dim_date(dims.default_bounds(spark), "calendar")
    assert dims.dim_month(other, "calendar").filter("id_calendar_month = 202505").first().ds_calendar_month == "May       2025"
    wide = dims.dim_week(other, "calendar").filter("id_calendar_week = 202401").first()
    assert wide.ds_week_from_to == "2024-01-01 / 2024-12-31"


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        dims.dim_date(dims.default_bounds(spark), "lunar")


def test_seeds(spark):
    assert dims.dim_layers(spark).count() == 15 and dims.dim_layers(spark, both=False).count() == 12
    assert {r.severity_id: r.severity_level for r in dims.dim_severity(spark).collect()}[5] == "Extreme"
    assert {r.season_id: r.name for r in dims.dim_seasons(spark).collect()}[5] == "Verano"
    assert {r.season_id: r.name for r in dims.dim_seasons(spark, both=False).collect()}[5] == "Winter"


def test_season_months_wrap(spark):
    months = dims.season_months(dims.dim_seasons(spark)).filter("season_id = 1")
    assert sorted(r.month for r in months.collect()) == [1, 2, 12]
    assert dims.season_months(dims.dim_seasons(spark)).count() == 24


def test_station_bootstrap(spark):
    empty = dims.empty_table(spark, dims.STATION_COLUMNS)
    stations = dims.ensure_stations(empty, as_of())
    assert stations.count() == 15
    assert dims.load_stations(empty, None, as_of()).count() == 15
    feed = spark.createDataFrame([("0076", "new name", "P", 1.0, 2.0, 3.0, "08")],
                                 "station_id string, station_name string, province string, altitude double, latitude double, longitude double, synop_code string")
    merged = dims.load_stations(stations, feed, as_of())
    assert merged.count() == 15
    row = merged.filter("station_id = '0076'").first()
    assert (row.station_name, row.synop_code) == ("new name", "08")
    before = {r.station_id: r.id for r in stations.collect()}
    assert {r.station_id: r.id for r in merged.collect()} == before


def test_dims_all(spark):
    cities = spark.createDataFrame([("08019", "Barcelona", 41.38, 2.17, "ES", 1)],
                                   "city_code string, city_name string, latitude double, longitude double, country_code string, is_coastal int")
    built = dims.dims_all(spark, cities, "iso", as_of())
    assert list(built)[:3] == ["dim_date", "dim_week", "dim_month"]
    assert rows(built["dim_city"].select("city_id", "city_code")) == [(1, "08019")]
