"""Flattening raw JSON documents into typed rows.

Every function takes documents as ``path, text``, or as ``path, body`` with the
body as VARIANT, and never fails on one of them: a document that cannot be used
carries a ``reject_reason`` instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.functions.clean import dms_to_decimal, locale_number

_READ = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def field_names(text: str) -> list[str]:
    """First word of each line of a field table."""
    return [line.split()[0] for line in text.strip().splitlines()]


def evaluated_once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with ``values`` as columns that are computed once per row.

    A plain projection would be copied into every later filter and projection
    that uses it, and a parsed document is used by dozens.  The output of a
    generator is not copied.
    """
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def as_variant(docs: DataFrame) -> DataFrame:
    """Documents for storage: ``path`` and ``body``, the text as VARIANT; null where it is no JSON."""
    return docs.select("path", F.try_parse_json("text").alias("body"))


def _parse(docs: DataFrame, schema: str) -> DataFrame:
    """Documents with their parsed body as ``doc``.

    A missing member and a null one look the same in ``doc``, but only the
    missing one takes a default.  So the few documents whose text has a null
    member at all are kept as a variant too, in ``nulls``.  Documents stored as
    VARIANT (``body``) are parsed already and tell the two apart themselves; in
    them a member of another type than the schema's counts as null.
    """
    if "body" in docs.columns:
        shape = f"struct<{schema}, _corrupt_record string>"
        return evaluated_once(docs, doc=F.try_variant_get("body", "$", shape), nulls=F.col("body"))
    has_null = F.col("text").contains("null") & F.col("text").rlike(r":\s*null")
    return evaluated_once(
        docs,
        doc=F.from_json("text", f"{schema}, _corrupt_record string", _READ),
        nulls=F.when(has_null, F.try_parse_json("text")),
    )


def _object_text(docs: DataFrame, path: str) -> Column:
    """The JSON text of a member."""
    if "body" in docs.columns:
        return F.to_json(F.try_variant_get("body", path, "variant"))
    return F.get_json_object("text", path)


def _null_member(path: str) -> Column:
    """Whether the document holds an explicit JSON null at ``path``."""
    member = F.try_variant_get("nulls", path, "variant")
    return F.coalesce(F.is_variant_null(member), F.lit(False))


def _default(value: Column, path: str, default: Column) -> Column:
    return F.when(value.isNotNull(), value).when(~_null_member(path), default)


def _first_reason(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(reason)) for bad, reason in rules])


def split_rejects(tagged: DataFrame, watch: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Usable rows without the reason column, and the rest with it.

    ``watch`` counts ``documents`` and ``rejected`` while the usable rows are computed.
    """
    if watch is not None:
        bad = F.count_if(F.col("reject_reason").isNotNull())
        tagged = tagged.observe(watch, F.count(F.lit(1)).alias("documents"), bad.alias("rejected"))
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, tagged.filter(F.col("reject_reason").isNotNull())


def rejects(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNotNull()).select("path", "reject_reason")


# -- current observation ----------------------------------------------------

_OBSERVATION_SCHEMA = """
_metadata struct<city_name: string, extraction_timestamp: string, execution_date: string>,
sys struct<country: string>,
coord struct<lat: double, lon: double>,
dt double,
main struct<temp: double, feels_like: double, temp_min: double, temp_max: double,
            pressure: double, humidity: double>,
weather array<struct<id: double, main: string, description: string>>,
wind struct<speed: double, deg: double, gust: double>,
clouds struct<`all`: double>,
visibility double,
rain struct<`1h`: double, `3h`: double>,
snow struct<`1h`: double, `3h`: double>
"""

_SECTIONS = ["_metadata", "sys", "coord", "main", "weather", "wind", "clouds", "rain", "snow"]


def parse_observations(docs: DataFrame) -> DataFrame:
    """Documents with their parsed body and ``reject_reason``."""
    parsed = _parse(docs, _OBSERVATION_SCHEMA)
    null_section = F.lit(False)
    for section in _SECTIONS:
        null_section = null_section | (
            F.col(f"doc.{section}").isNull() & _null_member(f"$.{section}")
        )
    return parsed.withColumn(
        "reject_reason",
        _first_reason(
            (F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull(), "unreadable"),
            (null_section, "null_section"),
            (F.size("doc.weather") == 0, "empty_weather"),
        ),
    )


def flatten_observations(
    docs: DataFrame, execution_date: Column | None = None, watch: Observation | None = None
) -> DataFrame:
    """One row of 25 fields per usable document."""
    good, _ = split_rejects(parse_observations(docs), watch)
    date = F.col("doc._metadata.execution_date") if execution_date is None else execution_date
    weather = F.get("doc.weather", F.lit(0))
    return good.select(
        _default(F.col("doc._metadata.city_name"), "$._metadata.city_name", F.lit("Unknown")).alias("city"),
        _default(F.col("doc.sys.country"), "$.sys.country", F.lit("ES")).alias("country"),
        F.col("doc.coord.lat").alias("latitude"),
        F.col("doc.coord.lon").alias("longitude"),
        F.col("doc.dt").alias("dt"),
        F.col("doc.main.temp").alias("temperature"),
        *[F.col(f"doc.main.{name}").alias(name)
          for name in ("feels_like", "temp_min", "temp_max", "pressure", "humidity")],
        weather["id"].alias("weather_id"),
        _default(weather["main"], "$.weather[0].main", F.lit("Unknown")).alias("weather_main"),
        _default(weather["description"], "$.weather[0].description", F.lit("No description"))
        .alias("weather_description"),
        F.col("doc.wind.speed").alias("wind_speed"),
        F.col("doc.wind.deg").alias("wind_deg"),
        F.col("doc.wind.gust").alias("wind_gust"),
        F.col("doc.clouds.`all`").alias("clouds"),
        F.col("doc.visibility").alias("visibility"),
        F.col("doc.rain.`1h`").alias("rain_1h"),
        F.col("doc.rain.`3h`").alias("rain_3h"),
        F.col("doc.snow.`1h`").alias("snow_1h"),
        F.col("doc.snow.`3h`").alias("snow_3h"),
        date.alias("date"),
        F.col("path").alias("bronze_source"),
    )


# -- parallel arrays --------------------------------------------------------


@dataclass(frozen=True)
class DocSpec:
    """A feed whose document holds one section of parallel arrays."""

    feed: str
    section: str
    numbers: tuple[str, ...]
    texts: tuple[str, ...] = ()

    @property
    def fields(self) -> tuple[str, ...]:
        return ("time", *self.numbers, *self.texts)

    def section_type(self) -> str:
        arrays = [f"{name}: array<string>" for name in ("time", *self.texts)]
        arrays += [f"{name}: array<double>" for name in self.numbers]
        return f"struct<{', '.join(arrays)}>"

    def schema(self) -> str:
        sections = [self.section] + (["daily"] if self.section == "hourly" else [])
        return ", ".join(
            [
                "city_code string",
                "municipio_nombre string",
                "_metadata struct<extraction_timestamp: string, execution_date: string>",
                *[f"{name} {self.section_type()}" for name in sections],
            ]
        )


def _spec(feed: str, section: str, table: str) -> DocSpec:
    names = field_names(table)
    texts = tuple(n for n in names if n in ("sunrise", "sunset"))
    return DocSpec(feed, section, tuple(n for n in names if n not in texts), texts)


FEEDS = {
    "daily": _spec("daily", "daily", fixed.DAILY_FIELDS),
    "hourly": _spec("hourly", "hourly", fixed.HOURLY_FIELDS),
    "air_quality": _spec("air_quality", "hourly", fixed.AIR_QUALITY_FIELDS),
    "pollen": _spec("pollen", "hourly", fixed.POLLEN_FIELDS),
    "marine": _spec("marine", "daily", fixed.MARINE_FIELDS),
}


def parse_columnar(docs: DataFrame, spec: DocSpec) -> DataFrame:
    """Documents with the chosen section as ``part`` and ``reject_reason``.

    An hourly section without any member gives way to the daily one.  Arrays of
    unequal length are refused, because zipping them would invent nulls.
    """
    parsed = _parse(docs, spec.schema())
    part = F.col(f"doc.{spec.section}")
    if spec.section == "hourly":
        known = F.coalesce(*[F.size(part[name]) for name in spec.fields])
        members = F.json_object_keys(_object_text(docs, "$.hourly"))
        is_empty = known.isNull() & (F.coalesce(F.size(members), F.lit(0)) == 0)
        part = F.when(is_empty, F.col("doc.daily")).otherwise(part)
    chosen = evaluated_once(parsed, part=part)
    length = F.size("part.time")
    ragged = F.lit(False)
    for name in spec.fields[1:]:
        ragged = ragged | F.coalesce(F.size(f"part.{name}") != length, F.lit(False))
    return chosen.withColumn(
        "reject_reason",
        _first_reason(
            (F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull(), "unreadable"),
            (length.isNull(), "no_time"),
            (ragged, "ragged_arrays"),
            (F.col("doc._metadata").isNull() & _null_member("$._metadata"), "null_section"),
        ),
    )


def explode_columnar(
    docs: DataFrame,
    spec: DocSpec,
    execution_date: Column | None = None,
    run_stamp: Column | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """One row per array position, with city and extraction columns.

    ``_src`` and ``_pos`` keep the original order for a later keep-first.
    """
    good, _ = split_rejects(parse_columnar(docs, spec), watch)
    meta = F.col("doc._metadata")
    date = meta["execution_date"] if execution_date is None else execution_date
    stamp = F.lit(None).cast("string") if run_stamp is None else run_stamp
    arrays = [
        F.coalesce(F.col(f"part.{name}"), F.array().cast(
            "array<double>" if name in spec.numbers else "array<string>")).alias(name)
        for name in spec.fields
    ]
    envelope = good.select(
        F.col("path").alias("_src"),
        F.col("doc.city_code").alias("city_code"),
        _default(F.col("doc.municipio_nombre"), "$.municipio_nombre", F.lit("Unknown")).alias("city_name"),
        date.alias("extraction_date"),
        _default(meta["extraction_timestamp"], "$._metadata.extraction_timestamp", stamp)
        .alias("extraction_timestamp"),
        F.posexplode(F.arrays_zip(*arrays)).alias("_pos", "_item"),
    )
    items = [F.col("_item").getField(name).alias(name) for name in spec.fields]
    return envelope.select(
        *items, "city_code", "city_name", "extraction_date", "extraction_timestamp", "_src", "_pos"
    )


# -- record lists -----------------------------------------------------------


def _parse_records(docs: DataFrame, schema: str, member: str) -> DataFrame:
    parsed = _parse(docs, schema)
    listed = F.col(f"doc.{member}")
    return parsed.withColumn(
        "reject_reason",
        _first_reason(
            (F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull(), "unreadable"),
            (listed.isNull() & _null_member(f"$.{member}"), "null_section"),
            (F.exists(listed, lambda item: item.isNull()), "null_record"),
        ),
    )


_STATION_SCHEMA = """
_metadata struct<extraction_timestamp: string, execution_date: string>,
stations array<struct<indicativo: string, nombre: string, provincia: string, altitud: string,
                      latitud: string, longitud: string, indsinop: string>>
"""


def parse_stations(docs: DataFrame) -> DataFrame:
    return _parse_records(docs, _STATION_SCHEMA, "stations")


def flatten_stations(
    docs: DataFrame, execution_date: Column | None = None, watch: Observation | None = None
) -> DataFrame:
    """Station inventory: 8 fields, coordinates in decimal degrees."""
    good, _ = split_rejects(parse_stations(docs), watch)
    date = F.col("doc._metadata.execution_date") if execution_date is None else execution_date
    rows = good.select(
        F.col("path").alias("_src"),
        date.alias("extraction_date"),
        F.posexplode("doc.stations").alias("_pos", "r"),
    )
    return rows.select(
        F.col("r.indicativo").alias("station_id"),
        F.col("r.nombre").alias("station_name"),
        F.col("r.provincia").alias("province"),
        locale_number(F.col("r.altitud")).alias("altitude"),
        dms_to_decimal(F.col("r.latitud")).alias("latitude"),
        dms_to_decimal(F.col("r.longitud")).alias("longitude"),
        F.col("r.indsinop").alias("synop_code"),
        "extraction_date",
        "_src",
        "_pos",
    )


CLIMATOLOGY = [line.split() for line in fixed.CLIMATOLOGY_NUMBERS.strip().splitlines()]


def _climatology_schema() -> str:
    texts = ["fecha", "nombre", "provincia"] + [raw for raw, _ in CLIMATOLOGY]
    record = ", ".join(f"{name}: string" for name in texts)
    return (
        "station_id string, year int, "
        "_metadata struct<extraction_timestamp: string, execution_date: string>, "
        f"records array<struct<{record}>>"
    )


def parse_climatology(docs: DataFrame) -> DataFrame:
    return _parse_records(docs, _climatology_schema(), "records")


def flatten_climatology(
    docs: DataFrame, execution_date: Column | None = None, with_year: bool = False,
    watch: Observation | None = None,
) -> DataFrame:
    """Station days: 18 fields, or 19 with the year of a historical document.

    The station is named by the document, not by its records.
    """
    good, _ = split_rejects(parse_climatology(docs), watch)
    date = F.col("doc._metadata.execution_date") if execution_date is None else execution_date
    rows = good.select(
        F.col("path").alias("_src"),
        F.col("doc.station_id").alias("station_id"),
        F.col("doc.year").alias("year"),
        date.alias("extraction_date"),
        F.posexplode("doc.records").alias("_pos", "r"),
    )
    return rows.select(
        "station_id",
        F.col("r.nombre").alias("station_name"),
        F.col("r.provincia").alias("province"),
        F.col("r.fecha").alias("date"),
        *(["year"] if with_year else []),
        *[locale_number(F.col(f"r.{raw}")).alias(name) for raw, name in CLIMATOLOGY],
        "extraction_date",
        "_src",
        "_pos",
    )


# -- combining --------------------------------------------------------------


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All frames as one; a column a frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def city_projection(cities: DataFrame) -> DataFrame:
    """City columns under the names the documents use."""
    return cities.select(
        "city_code",
        F.col("city_name").alias("municipio_nombre"),
        F.col("latitud").alias("latitude"),
        F.col("longitud").alias("longitude"),
    )


def coastal_cities(cities: DataFrame) -> DataFrame:
    """Coastal cities as ``name, lat, lon, code``."""
    return cities.filter(F.col("is_coastal") == 1).select(
        F.col("city_name").alias("name"),
        F.col("latitud").alias("lat"),
        F.col("longitud").alias("lon"),
        F.col("city_code").alias("code"),
    )
