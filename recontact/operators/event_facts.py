"""Facts of each case's events, kept as a table that grows by the days that are new.

A fact is a largest or smallest time, a count, or whether something ever happened. Facts of parts
of the events merge to the facts of all, in any order, so a weekly run reads the events that
arrived since the last one and the table of cases, and never the history of events again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.sources.storage import delete, folders, is_prepared, mark_prepared

# How each kind of fact is taken from events and merged.
_TAKEN = {"latest": F.max, "first": F.min, "count": F.count, "any": F.bool_or}
_MERGED = {"latest": F.max, "first": F.min, "count": F.sum, "any": F.bool_or}

#: Name of a fact: its kind, and the value it is taken from, a function that builds the column. The value
#: is null (for ``any``: null or false) for events that do not count.
Facts = Mapping[str, tuple[str, Callable[[], Column]]]


def event_facts(events: DataFrame, facts: Facts, key: str = "case_id") -> DataFrame:
    """One row for each key that has events, by one aggregation with map-side combine."""
    return events.groupBy(key).agg(*[_TAKEN[kind](value()).alias(name) for name, (kind, value) in facts.items()])


def merged(parts: DataFrame, facts: Facts, key: str = "case_id") -> DataFrame:
    """Facts of all events from rows of facts of parts of them."""
    return parts.groupBy(key).agg(*[_MERGED[kind](name).alias(name) for name, (kind, _) in facts.items()])


def of_type(event_type: str, value: str | None = None, column: str = "event_type") -> Callable[[], Column]:
    """Builder: the value of events of one type, whatever its case, null for others; true without a
    column of values."""
    return lambda: F.when(F.upper(column) == event_type.upper(), F.lit(True) if value is None else F.col(value))


def current(spark: SparkSession, path: str) -> tuple[DataFrame | None, date | None]:
    """The newest finished table and the last day of arrival that it holds; none before the first."""
    done = [f for f in folders(spark, path) if f.startswith("through=") and is_prepared(spark, f"{path}/{f}")]
    if not done:
        return None, None
    return spark.read.parquet(f"{path}/{done[-1]}"), date.fromisoformat(done[-1].removeprefix("through="))


def advance(
    spark: SparkSession, path: str, events: DataFrame, facts: Facts, through: date, arrived: str = "arrived_on", key: str = "case_id"
) -> DataFrame:
    """Bring the table at ``path`` up to a day and return it.

    Events count by the day on which they arrived, so one that happened long ago and comes late is
    taken with its own old time. The filter on that day reaches the scan. Events without a day of
    arrival, and those that come under a day that is past, never count. A day that the table holds
    already changes nothing. The new table is written beside the old one and counts from its mark
    on, so a run that stops leaves the old one valid; the one before the old one is deleted.
    """
    known, last = current(spark, path)
    if last is not None and through <= last:
        return known
    new = events.filter(F.col(arrived) <= F.lit(through))
    if last is not None:
        new = new.filter(F.col(arrived) > F.lit(last))
    told = event_facts(new, facts, key)
    if known is not None:
        told = merged(known.unionByName(told), facts, key)
    folder = f"{path}/through={through:%Y-%m-%d}"
    told.write.mode("overwrite").parquet(folder)
    mark_prepared(spark, folder)
    for name in folders(spark, path):
        older = name.startswith("through=") and name != f"through={through:%Y-%m-%d}"
        if older and name != f"through={last}":
            delete(spark, f"{path}/{name}")
    return spark.read.schema(told.schema).parquet(folder)
