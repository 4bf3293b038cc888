"""Cleaning functions: column in, column out, all inside Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that is no number although Spark's cast would read it (hexadecimal, a
# trailing "d" or "f" other than that of "inf"), underscores that do not stand
# between digits, and the usual marks, which would each cost a caught exception.
_NO_NUMBER = r"^(Ip|Acum)?$|[xX]|[dD]\s*$|(?<![nN])[fF]\s*$|(^|\D)_|_(\D|$)"


def locale_number(text: Column) -> Column:
    """Decimal-comma text to double; trace and accumulation marks, blanks and
    anything unreadable become null."""
    text = text.cast("string")
    digits = F.replace(F.replace(text, F.lit(","), F.lit(".")), F.lit("_"), F.lit(""))
    return clean_nan(F.when(~text.rlike(_NO_NUMBER), digits.try_cast("double")))


def dms_to_decimal(text: Column) -> Column:
    """``DDMMSSX`` or ``DMMSSX`` to decimal degrees, six places.

    South and west are negative, any other final letter is positive; text of
    another length or with unreadable parts is null.
    """
    size = F.length(text)
    width = F.when(size == 7, 2).when(size == 6, 1)

    def part(start: Column, length) -> Column:
        return text.substr(start, length).try_cast("int")

    degrees = part(F.lit(1), width)
    minutes = part(width + 1, F.lit(2))
    seconds = part(width + 3, F.lit(2))
    value = degrees + minutes / 60 + seconds / 3600
    southwest = F.upper(F.right(text, F.lit(1))).isin("S", "W")
    return F.when(width.isNotNull(), F.round(F.when(southwest, -value).otherwise(value), 6))


def date_id(value: Column) -> Column:
    """First ten characters without dashes as a whole number, else null."""
    head = F.left(value.cast("string"), F.lit(10))
    return F.replace(head, F.lit("-"), F.lit("")).try_cast("int")


def clean_nan(value: Column) -> Column:
    """NaN to null for a floating point column."""
    return F.nanvl(value, F.lit(None).cast("double"))


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN to null in every floating point column of ``df``."""
    floats = {
        f.name: clean_nan(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def epoch_to_ts(seconds: Column) -> Column:
    """Unix seconds to a naive UTC timestamp, whatever the session zone is."""
    span = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + span


def ts_to_epoch(moment: Column) -> Column:
    """A naive UTC timestamp to Unix seconds, whatever the session zone is."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)


def iso_to_ts(text: Column) -> Column:
    """ISO date or date-time text to a naive timestamp, null when unreadable."""
    return text.cast("string").try_cast("timestamp_ntz")


def time_of_day(text: Column) -> Column:
    """ISO date-time text to ``HH:mm:ss`` text."""
    return F.date_format(iso_to_ts(text), "HH:mm:ss")


def whole_number(value: Column) -> Column:
    """Number to INT, half away from zero; null when it does not fit."""
    return F.round(value.cast("double")).try_cast("int")


def truncated_number(value: Column) -> Column:
    """Number to INT by dropping the fraction."""
    number = value.cast("double")
    return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast("int")


def run_stamp(moment: Column) -> Column:
    """``yyyyMMdd_HHmmss`` label of a run."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, half to even."""
    return F.rint(F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)).cast("int")


def typed(value: Column, rule: str) -> Column:
    """``value`` in the warehouse type named by ``rule``.

    A value that does not fit becomes null; the caller compares it with the
    input to tell overflow from a missing value.
    """
    if rule == "int":
        return whole_number(value)
    if rule == "truncated int":
        return truncated_number(value)
    if rule == "time":
        return time_of_day(value)
    if rule == "string":
        return value.cast("string")
    return value.try_cast(rule)


def fits(value: Column, rule: str) -> Column:
    """Whether a present ``value`` survives ``typed`` under the same rule.

    A bound on the magnitude is enough: rounding to the scale cannot cross it
    from below.  This spares a second conversion of every value.
    """
    if rule == "string":
        return F.lit(True)
    if rule == "time":
        return value.isNull() | iso_to_ts(value).isNotNull()
    number = value.cast("double")
    if rule == "int":
        return (number < 2147483647.5) & (number > -2147483648.5)
    if rule == "truncated int":
        return (number < 2147483648.0) & (number > -2147483649.0)
    precision, scale = (int(n) for n in rule.removeprefix("decimal(").rstrip(")").split(","))
    bound = float(f"{'9' * (precision - scale)}.{'9' * scale}5")
    return F.abs(number) < bound
