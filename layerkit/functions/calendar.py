"""Date dimension with a holiday flag.

The calendar is ``spark.range(n)`` turned into dates, so it is generated in parallel. The
holiday flag is a set of Column rules (no per-row Python, no lookup package): fixed-date
holidays moved to the Friday before / Monday after when they fall on a weekend, and
n-th (or last) weekday holidays of a month.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# US federal holiday rules (fixed values).
# Fixed dates: (name, month, day, first year), observed on Friday before / Monday after a weekend.
FIXED_HOLIDAYS = (
    ("New Year's Day", 1, 1, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
)
# Weekday rules: (name, month, ISO weekday Mon=1..Sun=7, n-th occurrence or -1 for last, first year)
WEEKDAY_HOLIDAYS = (
    ("Martin Luther King Jr. Day", 1, 1, 3, 1986),
    ("Washington's Birthday", 2, 1, 3, None),
    ("Memorial Day", 5, 1, -1, None),
    ("Labor Day", 9, 1, 1, None),
    ("Columbus Day", 10, 1, 2, None),
    ("Thanksgiving Day", 11, 4, 4, None),
)


def _iso_dow(d: Column) -> Column:
    return F.weekday(d) + 1   # Spark weekday: Mon=0..Sun=6


def _is_fixed(d: Column, month: int, day: int, since) -> Column:
    c = (F.month(d) == month) & (F.dayofmonth(d) == day)
    return c & (F.year(d) >= since) if since else c


def holiday_flag(day) -> Column:
    d = F.col(day) if isinstance(day, str) else day
    dow = _iso_dow(d)
    conds = []
    for _, m, dd, since in FIXED_HOLIDAYS:
        conds.append(_is_fixed(d, m, dd, since))
        conds.append((dow == 5) & _is_fixed(F.date_add(d, 1), m, dd, since))   # Saturday -> Friday
        conds.append((dow == 1) & _is_fixed(F.date_sub(d, 1), m, dd, since))   # Sunday -> Monday
    for _, m, wd, n, since in WEEKDAY_HOLIDAYS:
        c = (F.month(d) == m) & (dow == wd)
        if n > 0:
            c = c & (F.ceil(F.dayofmonth(d) / 7) == n)
        else:
            c = c & (F.month(F.date_add(d, 7)) != m)
        if since:
            c = c & (F.year(d) >= since)
        conds.append(c)
    return reduce(lambda a, b: a | b, conds)


def is_holiday(day, country: str = "US") -> Column:
    """``is_holiday(date, country)``: the rule table covers the United States only."""
    if country.upper() not in ("US", "USA"):
        raise ValueError(f"no holiday rules for country {country!r}; only US rules are defined")
    return holiday_flag(day)


def calendar(spark: SparkSession, start: _dt.date, n_days: int) -> DataFrame:
    """``n_days`` consecutive dates from ``start`` (the reference builds 731 from 2023-01-01)."""
    return spark.range(n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def date_dimension(spark: SparkSession, start: _dt.date, n_days: int) -> DataFrame:
    """``(day date, holiday_flg boolean)``."""
    return calendar(spark, start, n_days).select("day", holiday_flag("day").alias("holiday_flg"))


def date_dimension_for(df: DataFrame, *date_cols: str) -> DataFrame:
    """Date dimension covering the span of the given date columns of ``df`` (one aggregate row)."""
    aggs = []
    for c in date_cols:
        aggs += [F.min(F.to_date(c)), F.max(F.to_date(c))]
    r = df.agg(*aggs).first()
    days = [v for v in r if v is not None]
    if not days:                                # nothing to cover: an empty dimension
        return date_dimension(df.sparkSession, _dt.date(1970, 1, 1), 0)
    lo, hi = min(days), max(days)
    return date_dimension(df.sparkSession, lo, (hi - lo).days + 1)
