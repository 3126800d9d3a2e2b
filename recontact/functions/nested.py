"""Arrays, JSON bodies and text scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_value(value: Column, condition: Callable[[Column], Column]) -> Column:
    """``condition`` on a value that is computed once a row, however often the condition names it. A filter
    that Spark moves below a computed column holds a copy of its expression at each mention."""
    return F.exists(F.array(value), condition)


def first_item(array: Column) -> Column:
    """First element or null; callers never see the index base of the source."""
    return F.try_element_at(array, F.lit(1))


def second_item(array: Column) -> Column:
    return F.try_element_at(array, F.lit(2))


def json_text(body: Column, path: str) -> Column:
    """Text at a ``$.a.b`` path of a JSON body, null when absent."""
    return F.get_json_object(body, path)


def json_list_empty(text: Column) -> Column:
    """A JSON array text without elements; null text gives null."""
    return F.json_array_length(text) == 0


def score_rank(score: Column) -> Column:
    """Order of text scores: 0 to 10, then ``not_specified``; unknown text has no rank."""
    return F.when(score == "not_specified", 11).otherwise(
        F.when(score.rlike("^([0-9]|10)$"), score.try_cast("int"))
    )
