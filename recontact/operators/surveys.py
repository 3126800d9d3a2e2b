"""Surveys and workflow events, reduced to one row per case."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def titled_links(links: DataFrame, surveys: DataFrame) -> DataFrame:
    """Survey invitations with their title."""
    return links.join(surveys.select(F.col("id").alias("survey_id"), "title"), "survey_id", "left")


def survey_class_of(classes: Mapping[str, str]) -> Column:
    """Aggregate: the first class, in order, whose title pattern any survey of the group matches."""
    return F.coalesce(
        *[
            F.when(F.bool_or(F.col("title").like(pattern)), F.lit(label))
            for label, pattern in classes.items()
        ]
    )


def survey_class(links: DataFrame, classes: Mapping[str, str] | None = None) -> DataFrame:
    """Class of each case by its survey titles: one aggregation instead of a lookup per class.

    ``classes`` maps class to title pattern in order of precedence, status survey before PREM by
    default, so a case is PREM only without a status survey.
    """
    classes = classes or {"SS": "%Status%", "PREM": "%PREM%"}
    return links.groupBy("case_id").agg(survey_class_of(classes).alias("case_class"))


def pivot_events(events: DataFrame, types: Mapping[str, str], at: str = "event_time") -> DataFrame:
    """Latest time per case of each event type; ``types`` maps output column to type."""
    wanted = F.upper("event_type").isin(*types.values())
    return (
        events.filter(wanted)
        .groupBy("case_id")
        .agg(*[F.max(F.when(F.upper("event_type") == t, F.col(at))).alias(n) for n, t in types.items()])
    )


def presence_flag(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Distinct ``yes``/null rows per key, by whether the value is present."""
    return df.select(key, F.when(F.col(value).isNotNull(), "yes").alias(name)).distinct()
