"""Text and three-valued-logic expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def is_true(col: Column) -> Column:
    """``x IS TRUE``: null counts as not true."""
    return col.eqNullSafe(True)


def is_false(col: Column) -> Column:
    """``x IS FALSE``: null counts as not false."""
    return col.eqNullSafe(False)


def is_not_true(col: Column) -> Column:
    """``x IS NOT TRUE``: admits null."""
    return ~col.eqNullSafe(True)


def null_or(col: Column, condition: Column) -> Column:
    """Keep rows where the tested column is missing or the condition holds."""
    return col.isNull() | condition


def like_any(col: Column, patterns: Iterable[str]) -> Column:
    return any_of(col.like(p) for p in patterns)


def like_none(col: Column, patterns: Iterable[str]) -> Column:
    """Every ``NOT LIKE`` holds; a null text fails, as in SQL."""
    return all_of(~col.like(p) for p in patterns)


def ilike_any(col: Column, patterns: Iterable[str]) -> Column:
    return any_of(col.ilike(p) for p in patterns)


def ilike_none_or_null(col: Column, patterns: Iterable[str]) -> Column:
    return null_or(col, ~ilike_any(col, patterns))


def not_blank(col: Column) -> Column:
    """Present and not the empty string."""
    return col.isNotNull() & (col != "")


def email_domain(col: Column) -> Column:
    """Lower-case part from ``@`` on; the whole text when there is no ``@``."""
    return F.right(F.lower(col), F.length(col) - F.position(F.lit("@"), col) + 1)


def concat_skip_nulls(*cols: Column | str) -> Column:
    """PostgreSQL ``concat``: nulls contribute nothing."""
    return F.concat_ws("", *cols)


def concat_strict(*cols: Column) -> Column:
    """``||``: one null makes the result null."""
    return F.concat(*cols)


def salutation(gender: Column, keep_unknown: bool = False) -> Column:
    """German form of address from a gender code.

    The short coding knows F and M and yields null otherwise; with ``keep_unknown`` the words are
    read as well and any other value passes through.
    """
    if not keep_unknown:
        return F.when(gender == "F", "Frau").when(gender == "M", "Herr")
    return (
        F.when(gender.isin("female", "F"), "Frau").when(gender.isin("male", "M"), "Herr").otherwise(gender)
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, also for null."""
    return F.when(condition, 1).otherwise(0)


def not_detractor(score: Column, detractors: Iterable[int], admit_null: bool = True) -> Column:
    kept = ~score.isin(*detractors)
    return null_or(score, kept) if admit_null else kept
