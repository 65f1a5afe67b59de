"""Period grammar and the predicates built from it."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTH = re.compile(r"\d{4}-\d{2}")
_PART = re.compile(r"(\d{4})-([HQ])([1-4])", re.IGNORECASE)


@dataclass(frozen=True)
class Period:
    """Inclusive range of 'YYYY-MM' months, compared as text."""

    start: str
    end: str

    @property
    def is_multi_month(self) -> bool:
        return self.start != self.end

    @property
    def label(self) -> str:
        return f"{self.start} to {self.end}" if self.is_multi_month else self.start

    def of_month(self, year_month: Column) -> Column:
        """Predicate on a 'YYYY-MM' text column."""
        if self.is_multi_month:
            return year_month.between(self.start, self.end)
        return year_month == self.start

    def of_time(self, recorded_at: Column) -> Column:
        """The same months as a half-open timestamp range, which reaches the Parquet scan.

        The grammar does not check the month number, so '2026-00' and '2026-13' are turned
        into the bound at which the text comparison would change.
        """
        since = _month_start(self.start)
        until = _month_start(self.end, following=True)
        return (recorded_at >= since) & (recorded_at < until)


def _month_start(month: str, following: bool = False) -> Column:
    year, number = int(month[:4]), int(month[5:])
    if following and number > 0:
        number += 1
    if number > 12:
        year, number = year + 1, 1
    text = f"{year:04d}-{max(number, 1):02d}-01"
    return F.lit(text).cast("timestamp_ntz")


def normalize_period(text: str) -> str:
    return re.sub(r"[_/.]", "-", text.strip())


def parse_period(text: str) -> Period:
    """YYYY-MM, YYYY-MM:YYYY-MM, YYYY, YYYY-H1/H2 or YYYY-Q1..Q4 ('_', '/', '.' act as '-')."""
    plain = normalize_period(text)
    bounds = plain.split(":")
    if len(bounds) == 2 and all(_MONTH.fullmatch(b) for b in bounds):
        return Period(*bounds)
    if _MONTH.fullmatch(plain):
        return Period(plain, plain)
    if re.fullmatch(r"\d{4}", plain):
        return Period(f"{plain}-01", f"{plain}-12")
    part = _PART.fullmatch(plain)
    if part:
        year, kind, index = part[1], part[2].upper(), int(part[3])
        length = 6 if kind == "H" else 3
        if index * length <= 12:
            last = index * length
            return Period(f"{year}-{last - length + 1:02d}", f"{year}-{last:02d}")
    raise ValueError(
        f"Invalid period {text!r}; use YYYY-MM, YYYY-MM:YYYY-MM, YYYY, YYYY-H1/H2 or YYYY-Q1..Q4"
    )


def single_month(text: str) -> Period:
    """Month argument of summarize / archive / ingestion checks: normalised, not validated."""
    month = normalize_period(text)
    return Period(month, month)


def month_start(time: Column) -> Column:
    """First day of the month: a fixed-width grouping key that needs no time zone."""
    return F.trunc(F.to_date(time), "month")


def month_of(time: Column) -> Column:
    """'YYYY-MM' of a date or a zone-less timestamp.

    Cut from the date's text; date_format would go through the session time zone.
    """
    return F.substring(F.to_date(time).cast("string"), 1, 7)


def summary_in(summary: DataFrame, period: Period | None) -> DataFrame:
    return summary if period is None else summary.filter(period.of_month(F.col("year_month")))


def readings_in(readings: DataFrame, period: Period | None) -> DataFrame:
    """Readings of a period: prunes month partitions where the table has them."""
    if period is None:
        return readings
    if not _MONTH.fullmatch(period.start) or not _MONTH.fullmatch(period.end):
        return readings.filter(F.lit(False))
    scoped = readings.filter(period.of_time(F.col("recorded_at")))
    if "year_month" in readings.columns:
        scoped = scoped.filter(period.of_month(F.col("year_month")))
    return scoped
