"""Date expressions around an injected as-of date, so that a selection can be repeated."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def before(as_of: date | Column, *, years: int = 0, months: int = 0, weeks: int = 0, days: int = 0) -> Column:
    """The day that lies the given span before ``as_of``; folds to a literal and reaches the scan."""
    shifted = day(as_of)
    if years or months:
        shifted = F.add_months(shifted, -(12 * years + months))
    if weeks or days:
        shifted = F.date_sub(shifted, 7 * weeks + days)
    return shifted


def days_since(col: Column, as_of: date | Column) -> Column:
    return F.datediff(day(as_of), col)


def in_iso_week_of(col: Column, target: Column, mode: str = "parity") -> Column:
    """Whether ``col`` falls into the week of ``target``.

    ``parity`` compares ISO week number and *calendar* year, so days of one week on both sides of
    New Year do not match; ``week_start`` compares the Monday and has no such edge.
    """
    if mode == "parity":
        return (F.weekofyear(col) == F.weekofyear(target)) & (F.year(col) == F.year(target))
    if mode == "week_start":
        return F.trunc(col, "week") == F.trunc(target, "week")
    raise ValueError(f"unknown week mode {mode!r}")


def iso_week_due(col: Column, weeks: int, as_of: date | Column, mode: str = "parity") -> Column:
    """Due now: the date moved on by ``weeks`` falls into the current week."""
    return in_iso_week_of(F.date_add(col, 7 * weeks), day(as_of), mode)


def in_previous_iso_week(col: Column, as_of: date | Column, mode: str = "parity") -> Column:
    return in_iso_week_of(col, before(as_of, weeks=1), mode)


def parse_day_first(col: Column) -> Column:
    """``DD-MM-YYYY`` text to a date; malformed text gives null instead of failing the job."""
    return F.try_to_timestamp(col, F.lit("dd-MM-yyyy")).cast("date")


def appointment_date(state: Column, result: Column, scheduled: Column) -> Column:
    """Reference day of an appointment: scheduled day once sent, else the day of the result."""
    return F.when(state == "sent", scheduled).otherwise(result)


def prom_age_bucket(days: Column) -> Column:
    """6-, 12- or 24-month outcome survey by the days between result and invitation."""
    return F.when(days < 364, "prom_6").when(days > 720, "prom_24").otherwise("prom_12")
