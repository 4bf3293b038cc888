"""Fact tables: one load shape for all feeds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.functions.clean import date_id, epoch_to_ts, fits, iso_to_ts, normalise_nan, typed
from skyloom.operators.dedupe import keep_first
from skyloom.operators.lookup import city_lookup, first_keys, station_lookup
from skyloom.operators.merge import insert_if_absent
from skyloom.operators.partitions import PARTITION, MonthTable
from skyloom.session import scratch_path
from skyloom.sources.lake import remove_folder


@dataclass(frozen=True)
class Mapped:
    """A value computed from several source columns: ``value`` gets them as columns, in order."""

    sources: tuple[str, ...]
    value: Callable[..., Column]


@dataclass(frozen=True)
class FactSpec:
    """How a cleaned feed becomes a fact table.

    ``columns`` lists (source column, warehouse column, type rule); it is the
    extension point: a new feed is a new list, and a source may be a ``Mapped``
    expression, whose result goes through the type rule like any other value.  ``moment`` is the second key
    column, ``moment_from`` its source column and ``moment_rule`` one of
    ``date`` (date id), ``iso`` (timestamp) or ``epoch``.
    """

    table: str
    feed: str
    columns: tuple[tuple[str | Mapped, str, str], ...]
    moment: str
    moment_from: str
    moment_rule: str
    suite: str | None = None
    entity: str = "city"
    entity_from: str = "city_name"
    entity_fallback: str | None = "city"
    run_date: str = "extraction_date"
    run_date_id: str = "extraction_date_id"
    drop_all_null: bool = False

    @property
    def entity_id(self) -> str:
        return f"{self.entity}_id"

    @property
    def key(self) -> list[str]:
        if self.moment_rule == "epoch":
            return [self.entity_id, self.run_date_id, self.moment]
        return [self.entity_id, self.moment, self.run_date_id]

    @property
    def sources(self) -> list[str]:
        names = [s.sources if isinstance(s, Mapped) else (s,) for s, _, _ in self.columns]
        return list(dict.fromkeys(name for group in names for name in group))

    @property
    def values(self) -> list[tuple[Column, str, str]]:
        """(value, warehouse column, type rule) of every column."""
        return [
            (s.value(*map(F.col, s.sources)) if isinstance(s, Mapped) else F.col(s), target, rule)
            for s, target, rule in self.columns
        ]

    @property
    def overflows(self) -> list[tuple[Column, str]]:
        """(whether a value is outside its type, the reason it gives) of every typed column."""
        return [(~fits(v, rule), f"overflow:{target}") for v, target, rule in self.values if rule != "string"]

    @property
    def refusals(self) -> list[str]:
        """Every reason ``key_rows`` can give."""
        first = ["all_null"] if self.drop_all_null else []
        moment = ["missing_timestamp"] if self.moment_rule == "epoch" else []
        return [*first, f"unknown_{self.entity}", *moment, *[f"null_key:{k}" for k in self.key]]


def _columns(table: str) -> tuple[tuple[str, str, str], ...]:
    rows = [line.split(None, 2) for line in table.strip().splitlines()]
    return tuple((source, target, rule.strip()) for source, target, rule in rows)


FACTS = {
    "observation": FactSpec(
        "fct_weather_observation", "observation", _columns(fixed.OBSERVATION_FIELDS),
        "observation_timestamp", "dt", "epoch", suite="observation",
        entity_from="city", entity_fallback=None, run_date="date", run_date_id="date_id",
    ),
    "daily": FactSpec(
        "fct_weather_forecast", "daily", _columns(fixed.DAILY_FIELDS),
        "forecast_date_id", "time", "date", suite="daily_forecast",
    ),
    "hourly": FactSpec(
        "fct_weather_forecast_hourly", "hourly", _columns(fixed.HOURLY_FIELDS),
        "forecast_datetime", "time", "iso", suite="hourly_forecast",
    ),
    "air_quality": FactSpec(
        "fct_air_quality", "air_quality", _columns(fixed.AIR_QUALITY_FIELDS),
        "measurement_datetime", "time", "iso", suite="air_quality",
    ),
    "pollen": FactSpec(
        "fct_pollen", "pollen", _columns(fixed.POLLEN_FIELDS),
        "measurement_datetime", "time", "iso", suite="pollen",
    ),
    "marine": FactSpec(
        "fct_marine", "marine", _columns(fixed.MARINE_FIELDS),
        "forecast_date_id", "time", "date", suite="marine",
        entity_fallback=None, drop_all_null=True,
    ),
    "station_day": FactSpec(
        "fct_aemet_daily_weather", "station_day", _columns(fixed.STATION_DAY_FIELDS),
        "date_id", "date", "date", entity="station", entity_from="station_id",
        entity_fallback=None,
    ),
}


def fact_schema(spec: FactSpec) -> str:
    """Column definitions of a fact table."""
    moment = "int" if spec.moment_rule == "date" else "timestamp_ntz"
    kinds = {spec.entity_id: "int", spec.run_date_id: "int", spec.moment: moment}
    columns = [f"{name} {kinds[name]}" for name in spec.key]
    types = {"truncated int": "int", "time": "string"}
    columns += [f"{target} {types.get(rule, rule)}" for _, target, rule in spec.columns]
    if spec.feed in fixed.DATA_SOURCE:
        columns.append("data_source string")
    return ", ".join([*columns, "created_at timestamp_ntz"])


def fact_table(spec: FactSpec, path: str, buckets: int = 8) -> MonthTable:
    """Where the rows of a feed are stored."""
    return MonthTable(path, fact_schema(spec), spec.run_date_id, tuple(spec.key), buckets)


def _moment(spec: FactSpec) -> Column:
    source = F.col(spec.moment_from)
    if spec.moment_rule == "epoch":
        return epoch_to_ts(source)
    return date_id(source) if spec.moment_rule == "date" else iso_to_ts(source)


def key_rows(
    silver: DataFrame, spec: FactSpec, dim: DataFrame, run_date: Column | None = None
) -> DataFrame:
    """Silver rows with their warehouse key and ``reject_reason``.

    Nothing is shuffled: the dimension is broadcast up to its checked bound and
    every rule looks at one row.
    """
    day = F.col(spec.run_date) if run_date is None else run_date
    rows = normalise_nan(silver)
    if spec.entity == "station":
        rows = station_lookup(rows, dim).withColumnRenamed("station_id", "_natural_id")
        rows = rows.withColumnRenamed("station_key", "station_id")
    else:
        rows = city_lookup(rows, dim, spec.entity_from, spec.entity_fallback)
    rows = rows.withColumns({spec.moment: _moment(spec), spec.run_date_id: date_id(day)})
    reasons = []
    if spec.drop_all_null:
        reasons.append(F.when(F.coalesce(*spec.sources).isNull(), F.lit("all_null")))
    reasons.append(F.when(F.col(spec.entity_id).isNull(), F.lit(f"unknown_{spec.entity}")))
    if spec.moment_rule == "epoch":
        reasons.append(F.when(F.col(spec.moment).isNull(), F.lit("missing_timestamp")))
    reasons += [F.when(F.col(k).isNull(), F.lit(f"null_key:{k}")) for k in spec.key]
    return rows.withColumn("reject_reason", F.coalesce(*reasons))


def typed_rows(rows: DataFrame, spec: FactSpec, as_of: Column) -> DataFrame:
    """Keyed rows in warehouse types; a value outside its type is an overflow."""
    label = fixed.DATA_SOURCE.get(spec.feed)
    return rows.select(
        *spec.key,
        *[typed(value, rule).alias(target) for value, target, rule in spec.values],
        *([F.lit(label).alias("data_source")] if label else []),
        as_of.alias("created_at"),
        _overflow(spec).alias("reject_reason"),
    )


def _overflow(spec: FactSpec) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(reason)) for bad, reason in spec.overflows], F.lit(None).cast("string"))


def fresh_rows(
    keyed: DataFrame, spec: FactSpec, as_of: Column, order: list[str], target: DataFrame | None = None
) -> DataFrame:
    """Rows of ``key_rows`` to append to the fact table."""
    usable = keyed.filter(F.col("reject_reason").isNull())
    fresh = insert_if_absent(
        usable.select(*spec.key, *spec.sources, *[c for c in order if c not in spec.sources]),
        target, spec.key, order,
    )
    return typed_rows(fresh, spec, as_of).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def build_fact(
    silver: DataFrame,
    spec: FactSpec,
    dim: DataFrame,
    as_of: Column,
    order: list[str],
    target: DataFrame | None = None,
    run_date: Column | None = None,
) -> DataFrame:
    """Rows to append to the fact table.

    ``order`` is the original row order; it decides which of several rows with
    one key is the first.  Keep-first precedes the type check, so a bad first
    row is refused rather than replaced by a later one.
    """
    return fresh_rows(key_rows(silver, spec, dim, run_date), spec, as_of, order, target)


def outcomes(
    keyed: DataFrame, spec: FactSpec, order: list[str], target: DataFrame | None = None
) -> DataFrame:
    """``outcome, n_rows`` of the rows of ``key_rows``: loaded, duplicate, conflict and each reason.

    One pass: a group per key counts its rows and keeps what is wrong with the
    first of them; refused rows meet in the group without a key, reduced before
    the shuffle.  The target is joined on the same key.
    """
    reason, usable = F.col("reject_reason"), F.col("reject_reason").isNull()
    rows = keyed.select(
        reason, *[F.when(usable, F.col(k)).alias(k) for k in spec.key],
        F.when(usable, _overflow(spec)).alias("_wrong"), F.struct(*order).alias("_order"),
    )
    refused = {f"_r{i}": name for i, name in enumerate(spec.refusals)}
    groups = rows.groupBy(*spec.key).agg(
        F.count_if(usable).alias("_n"), F.min_by("_wrong", "_order").alias("_wrong"),
        *[F.count_if(reason == name).alias(column) for column, name in refused.items()],
    )
    if target is None:
        groups = groups.withColumn("_known", F.lit(False))
    else:
        known = target.select(*spec.key).distinct().withColumn("_known", F.lit(True))
        groups = groups.join(known, spec.key, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    first, wrong = F.col("_n") > 0, F.col("_wrong")
    sums = {"loaded": F.count_if(first & ~F.col("_known") & wrong.isNull()),
            "duplicate": F.sum(F.when(first, F.col("_n") - 1)),
            "conflict": F.count_if(first & F.col("_known")),
            **{name: F.sum(column) for column, name in refused.items()},
            **{name: F.count_if(first & ~F.col("_known") & (wrong == name)) for _, name in spec.overflows}}
    total = groups.agg(*[F.coalesce(n, F.lit(0)).alias(f"_{i}") for i, n in enumerate(sums.values())])
    listed = F.array(*[F.struct(F.lit(name).alias("outcome"), F.col(f"_{i}").alias("n_rows"))
                       for i, name in enumerate(sums)])
    always = F.col("outcome").isin("loaded", "duplicate", "conflict")
    return total.select(F.inline(listed)).filter(always | (F.col("n_rows") > 0))


def load_accounting(
    silver: DataFrame, spec: FactSpec, dim: DataFrame, as_of: Column, order: list[str],
    target: DataFrame | None = None, run_date: Column | None = None,
) -> DataFrame:
    """Row accounting of a load: ``outcome, n_rows`` for loaded and each reason."""
    return outcomes(key_rows(silver, spec, dim, run_date), spec, order, target)


def new_rows(stored: DataFrame, spec: FactSpec, table: MonthTable, as_of: Column, order: list[str]) -> DataFrame:
    """The first row of each key in warehouse types, with what keeps it out as ``reject_reason``.

    ``stored`` are usable keyed rows with their month.  Keep-first sends one row
    per key and task; the rows that are left meet the buckets of the table,
    which stay where they are, in the months that the rows name.
    """
    first = keep_first(stored, spec.key, order)
    known = table.touched(stored).select(*spec.key).withColumn("_known", F.lit(True))
    met = table.dealt(first).join(known, spec.key, "left")
    label = fixed.DATA_SOURCE.get(spec.feed)
    return met.select(
        *spec.key,
        *[typed(value, rule).alias(target) for value, target, rule in spec.values],
        *([F.lit(label).alias("data_source")] if label else []),
        as_of.alias("created_at"), PARTITION,
        F.when(F.col("_known"), F.lit("conflict")).otherwise(_overflow(spec)).alias("reject_reason"),
    )


def load_fact(
    silver: DataFrame,
    spec: FactSpec,
    dim: DataFrame,
    table: MonthTable,
    as_of: Column,
    order: list[str],
    run_date: Column | None = None,
) -> dict:
    """Append the new rows of a feed to its table; returns the row accounting.

    The batch is read once: its keyed rows are stored, and what was refused is
    counted by reason while that happens; of rows without a city or station the
    name is stored.  A second pass over what was stored
    finds the new rows, counts the others and appends, all in one stage that
    ends in the table, so that a task that is run again counts once.  ``unknown``
    names the first few cities or stations that the dimension lacks.
    """
    spark = silver.sparkSession
    keyed = key_rows(silver, spec, dim, run_date)
    reason, everything = F.col("reject_reason"), F.count(F.lit(1))
    refused = {f"r{i}": name for i, name in enumerate(spec.refusals)}
    seen, path = Observation(), scratch_path(spark, "keyed")
    watched = keyed.observe(
        seen, everything.alias("n"), *[F.count_if(reason == name).alias(c) for c, name in refused.items()]
    )
    unknown, usable = f"unknown_{spec.entity}", reason.isNull()
    name = spec.entity_from if spec.entity_from in keyed.columns else spec.entity_fallback
    names = list(dict.fromkeys([*spec.key, *spec.sources, *order]))
    table.placed(watched.filter(usable | (reason == unknown))).select(
        *[F.when(usable, F.col(c)).alias(c) for c in [*names, PARTITION]],
        F.when(~usable, F.col(name)).alias("_name"), usable.alias("_usable"),
    ).write.parquet(path)
    kept = spark.read.parquet(path)
    stored = kept.filter("_usable").select(*names, PARTITION)

    found, overflows = Observation(), {f"o{i}": name for i, (_, name) in enumerate(spec.overflows)}
    rows = new_rows(stored, spec, table, as_of, order).observe(
        found, everything.alias("n"), F.count_if(reason == "conflict").alias("conflict"),
        *[F.count_if(reason == name).alias(c) for c, name in overflows.items()],
    )
    loaded = table.append(rows.filter(reason.isNull()))
    first, second = seen.get, found.get
    n_usable = first["n"] - sum(first[c] for c in refused)
    split = {"loaded": loaded, "duplicate": n_usable - second["n"], "conflict": second["conflict"]}
    others = {**{name: first[c] for c, name in refused.items()}, **{name: second[c] for c, name in overflows.items()}}
    split.update({name: n for name, n in others.items() if n})
    lacking = first_keys(kept.filter("NOT _usable"), "_name").collect() if split.get(unknown) else []
    remove_folder(spark, path)
    return {"rows_input": first["n"], "rows_loaded": loaded, "rows_rejected": first["n"] - loaded,
            "outcomes": split, "unknown": [r.key for r in lacking]}
