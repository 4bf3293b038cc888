"""Row filters and table constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import fixed_values as fixed
from skyloom.functions.clean import normalise_nan


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the rows whose ``columns`` are all missing; NaN counts as missing."""
    return normalise_nan(df).dropna(how="all", subset=list(columns))


def season_rules() -> dict[str, Column]:
    return {
        "hemisphere_known": F.col("hemisphere").isin(*fixed.HEMISPHERES),
        "start_month_valid": F.col("start_month").between(1, 12),
        "end_month_valid": F.col("end_month").between(1, 12),
    }


def layer_rules() -> dict[str, Column]:
    return {"medium_known": F.col("medium").isin(*fixed.MEDIA)}


def run_log_rules() -> dict[str, Column]:
    return {"status_known": F.col("status").isin(*fixed.RUN_STATUSES)}


def check_constraints(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass: ``rule, violations``.  A rule that is
    null for a row holds, as in SQL."""
    counted = df.agg(
        *[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    )
    return counted.select(F.inline(pairs))
