"""Checks on a whole table, all of them from one aggregation.

``profile`` reads the table once and returns a single row of counters; every
other function here is arithmetic on that row.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import fixed_values as fixed
from skyloom.functions.clean import normalise_nan
from skyloom.quality.errors import QualityError


@dataclass(frozen=True)
class Suite:
    name: str
    required: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    critical: tuple[str, ...] = ()
    threshold: float = fixed.DEFAULT_COMPLETENESS
    mostly: float = fixed.DEFAULT_MOSTLY

    def override(self, threshold: float | None = None, mostly: float | None = None) -> "Suite":
        return replace(
            self,
            threshold=self.threshold if threshold is None else threshold,
            mostly=self.mostly if mostly is None else mostly,
        )


SUITES = {
    kind: Suite(
        name=rules["name"], required=tuple(rules["required"]), ranges=rules["ranges"],
        critical=tuple(rules["critical"]), threshold=rules["threshold"],
    )
    for kind, rules in fixed.SUITES.items()
}


def suite_for(data_type: str, threshold: float | None = None, mostly: float | None = None) -> Suite:
    if data_type not in SUITES:
        raise ValueError(f"unknown data type {data_type!r}, expected one of {sorted(SUITES)}")
    return SUITES[data_type].override(threshold, mostly)


_TYPE_CLASSES = {
    "numeric": (T.NumericType,),
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "boolean": (T.BooleanType,),
}


def schema_errors(df: DataFrame, required: list[str], types: dict[str, str] | None = None) -> list[str]:
    """Missing columns and columns of another type class; looks at no data."""
    errors = []
    missing = [name for name in required if name not in df.columns]
    if missing:
        errors.append(f"Missing required columns: {missing}")
    by_name = {f.name: f.dataType for f in df.schema.fields}
    for name, wanted in (types or {}).items():
        if name in by_name and not isinstance(by_name[name], _TYPE_CLASSES[wanted]):
            errors.append(f"Column '{name}' should be {wanted}, got {by_name[name].simpleString()}")
    return errors


def _number(name: str) -> Column:
    return F.col(f"`{name}`").try_cast("double")


def present(name: str) -> Column:
    return F.count(F.col(f"`{name}`"))


def counters(df: DataFrame, suite: Suite) -> dict[str, Column]:
    """Aggregates a suite needs, by counter name."""
    out = {"row_count": F.count(F.lit(1))}
    for name, (low, high) in suite.ranges.items():
        if name in df.columns:
            number = _number(name)
            out[f"valid:{name}"] = F.count(number)
            out[f"bad:{name}"] = F.count_if((number < low) | (number > high))
    for name in suite.critical:
        if name in df.columns:
            out[f"null:{name}"] = F.count_if(F.col(f"`{name}`").isNull())
    return out


def profile(df: DataFrame, wanted: dict[str, Column]) -> DataFrame:
    """All counters as one row, from one pass over the table."""
    return df.agg(*[value.alias(name) for name, value in wanted.items()])


def _share(bad: Column, total: Column) -> Column:
    """``1 - bad / total`` in double; 1 when there is nothing to judge."""
    return F.when(total > 0, F.lit(1.0) - bad / total).otherwise(F.lit(1.0))


def range_compliance(name: str) -> Column:
    return _share(F.col(f"`bad:{name}`"), F.col(f"`valid:{name}`"))


def completeness(name: str) -> Column:
    return _share(F.col(f"`null:{name}`"), F.col("row_count"))


def expectations(df: DataFrame, suite: Suite) -> list[Column]:
    """One struct per check, in suite order, over a profiled row."""

    def entry(kind, column, bad, share, low, high, mostly, ok) -> Column:
        def num(value):
            return F.lit(value).cast("double")

        return F.struct(
            F.lit(kind).alias("expectation_type"),
            F.lit(column).cast("string").alias("column"),
            bad.cast("long").alias("unexpected_count"),
            ((F.lit(1.0) - share) * 100).alias("unexpected_percent"),
            num(low).alias("min_value"),
            num(high).alias("max_value"),
            num(mostly).alias("mostly"),
            ok.alias("success"),
        )

    missing = [name for name in suite.required if name not in df.columns]
    out = [
        entry(fixed.EXPECT_COLUMN, ", ".join(missing) or None, F.lit(len(missing)),
              F.lit(0.0 if missing else 1.0), None, None, None, F.lit(not missing))
    ]
    for name, (low, high) in suite.ranges.items():
        if name in df.columns:
            share = range_compliance(name)
            out.append(entry(fixed.EXPECT_RANGE, name, F.col(f"`bad:{name}`"), share,
                             low, high, suite.mostly, share >= suite.mostly))
    for name in suite.critical:
        if name in df.columns:
            share = completeness(name)
            out.append(entry(fixed.EXPECT_NOT_NULL, name, F.col(f"`null:{name}`"), share,
                             None, None, suite.threshold, share >= suite.threshold))
    return out


def validation_details(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per check: ``seq`` and the check's outcome."""
    clean = normalise_nan(df)
    row = profile(clean, counters(clean, suite))
    return row.select(F.posexplode(F.array(*expectations(clean, suite))).alias("seq", "e")).select(
        "seq", "e.*"
    )


def summary(checks: Column, suite: Suite, n_columns: int) -> Column:
    """The summary struct of a profiled row from its array of checks."""
    failed = F.filter(checks, lambda e: ~e["success"])
    total, bad = F.size(checks), F.size(failed)
    good = total - bad
    return F.struct(
        F.lit(suite.name).alias("table_name"),
        (bad == 0).alias("success"),
        total.alias("total_expectations"),
        good.alias("successful_expectations"),
        bad.alias("failed_expectations"),
        F.when(total > 0, good / total).otherwise(F.lit(0.0)).alias("success_rate"),
        F.col("row_count"),
        F.lit(n_columns).alias("column_count"),
        F.when(total > 0, good / total * 100).otherwise(F.lit(100.0)).alias("success_percent"),
        failed.alias("failed_details"),
    )


def validate(df: DataFrame, suite: Suite) -> DataFrame:
    """One summary row for all checks of a suite."""
    clean = normalise_nan(df)
    row = profile(clean, counters(clean, suite))
    checks = F.array(*expectations(clean, suite))
    return row.select(summary(checks, suite, len(df.columns)).alias("s")).select("s.*")


def gate(df: DataFrame, suite: Suite, strict: bool = False) -> dict:
    """Validate now; under ``strict`` a failure raises, else it is returned."""
    result = validate(df, suite).first().asDict(recursive=True)
    if strict and not result["success"]:
        raise QualityError(f"validation failed for {suite.name}", result)
    return result


# -- single checks ----------------------------------------------------------


def range_check(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None,
    allow_null: bool = True, mostly: float = fixed.DEFAULT_MOSTLY,
) -> DataFrame:
    """``is_valid, invalid_count, compliance_rate`` of one column; bounds included."""
    if column not in df.columns:
        return df.agg(F.lit(True).alias("is_valid"), F.lit(0).cast("long").alias("invalid_count"),
                      F.lit(1.0).alias("compliance_rate"))
    number = _number(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (number < low)
    if high is not None:
        outside = outside | (number > high)
    row = normalise_nan(df).agg(
        F.count(F.lit(1)).alias("n"), F.count(number).alias("valid"),
        F.count_if(outside).alias("bad"),
    )
    nulls = F.col("n") - F.col("valid")
    share = _share(F.col("bad"), F.col("valid"))
    refused = F.lit(not allow_null) & (nulls > 0)
    return row.select(
        F.when(refused, F.lit(False)).otherwise(share >= mostly).alias("is_valid"),
        F.when(refused, nulls).otherwise(F.col("bad")).alias("invalid_count"),
        F.when(refused, _share(nulls, F.col("n"))).otherwise(share).alias("compliance_rate"),
    )


def completeness_check(
    df: DataFrame, columns: list[str], threshold: float = fixed.DEFAULT_COMPLETENESS
) -> DataFrame:
    """``column, score, is_valid`` per column; a missing column scores 0, an
    empty table yields no rows and so passes."""
    clean = normalise_nan(df)
    wanted = {"row_count": F.count(F.lit(1))}
    wanted.update({f"n:{c}": present(c) for c in columns if c in df.columns})
    scores = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"`n:{c}`") / F.col("row_count") if c in df.columns else F.lit(0.0)).alias("score"),
        )
        for c in columns
    ]
    rows = profile(clean, wanted).filter("row_count > 0").select(F.inline(F.array(*scores)))
    return rows.withColumn("is_valid", F.col("score") >= threshold)


def not_null_check(df: DataFrame, column: str, mostly: float = fixed.DEFAULT_COMPLETENESS) -> DataFrame:
    """``is_valid, null_count, completeness``; a missing column passes."""
    if column not in df.columns:
        return df.agg(F.lit(True).alias("is_valid"), F.lit(0).cast("long").alias("null_count"),
                      F.lit(1.0).alias("completeness"))
    row = normalise_nan(df).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(f"`{column}`").isNull()).alias("null_count")
    )
    share = _share(F.col("null_count"), F.col("n"))
    return row.select((share >= mostly).alias("is_valid"), "null_count", share.alias("completeness"))
