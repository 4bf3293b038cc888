"""Calendar attributes of a date under the two week rules.

``iso``       week id = ISO year and ISO week, true Monday to Sunday weeks
``calendar``  week id = calendar year and ISO week, half-year as 1 or 2
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RULES = ("iso", "calendar")


def day_attributes(day: Column, week_rule: str = "iso") -> dict[str, Column]:
    if week_rule not in RULES:
        raise ValueError(f"week_rule must be one of {RULES}, got {week_rule!r}")
    year, month = F.year(day), F.month(day)
    week, quarter = F.weekofyear(day), F.quarter(day)
    half = F.when(month <= 6, 1).otherwise(2)
    iso = week_rule == "iso"
    week_year = F.extract(F.lit("YEAROFWEEK"), day) if iso else year
    return {
        "id_calendar_day": F.date_format(day, "yyyyMMdd").cast("int"),
        "dt_date": day,
        "id_year": year,
        "id_calendar_month": year * 100 + month,
        "id_month": month,
        "id_calendar_week": (week_year * 100 + week).cast("int"),
        "id_week": week,
        "id_weekday": F.weekday(day) + 1,
        "id_quarter": quarter,
        "id_calendar_quarter": year * 10 + quarter,
        "id_calendar_semester": (year * 10 + half) if iso else half,
        "nm_day": F.date_format(day, "EEEE"),
        "ds_calendar_day": F.date_format(day, "EEEE, dd MMMM yyyy" if iso else "yyyy-MM-dd"),
    }


def monday_of(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def month_label(first_day: Column, padded: bool) -> Column:
    """``January 2021``, or the same with the month name blank-padded to nine."""
    name = F.date_format(first_day, "MMMM")
    name = F.rpad(name, 9, " ") if padded else name
    return F.concat(name, F.lit(" "), F.date_format(first_day, "yyyy"))
