"""Current and past state of history, soft-delete and campaign tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.fixed_values import OPEN_END
from recontact.sources.warehouse import Warehouse, marked


def current_version(df: DataFrame, valid_to: str = "valid_to", open_end: str = OPEN_END) -> DataFrame:
    """Rows whose validity is open-ended."""
    return df.filter(F.col(valid_to) == F.lit(open_end).cast("date"))


def version_as_of(
    df: DataFrame, key: Sequence[str], as_of: date, valid_to: str = "valid_to", valid_from: str | None = None
) -> DataFrame:
    """The version of each key that is valid on a day: the one that ends first after it.

    A version ends on ``valid_to``, on which the next one holds. Keys whose last version has ended
    have none; null keys are one key. Of versions that end on one day the least by its other columns
    stays, so the result does not depend on the order of rows. ``valid_from`` also leaves out versions
    that begin after the day. One aggregate with map-side combine, no sort by key and day.
    """
    valid = df.filter(F.col(valid_to) > F.lit(as_of))
    if valid_from is not None:
        valid = valid.filter(F.col(valid_from).isNull() | (F.col(valid_from) <= F.lit(as_of)))
    others = [c for c in df.columns if c not in key and c != valid_to]
    first = valid.groupBy(*key).agg(F.min(F.struct(valid_to, *others)).alias("_v"))
    return first.select(*[F.col(c) if c in key else F.col(f"_v.{c}").alias(c) for c in df.columns])


def not_deleted(df: DataFrame, deleted_at: str = "deleted_at", as_of: date | None = None) -> DataFrame:
    """Rows without a deletion time or, given a day, without one before that day."""
    kept = F.col(deleted_at).isNull()
    return df.filter(kept if as_of is None else kept | (F.col(deleted_at) >= F.lit(as_of)))


def ledger_as_of(
    cam_select: DataFrame, cam_batch: DataFrame, as_of: date | None = None, before_batch: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ledger and batches as they were when a day began, or before a batch was written, or both.

    Batches selected on the day itself are left out, so a run that is repeated for its day does not
    see its own rows; ``before_batch`` tells runs of one day apart, as batch ids grow. Batches without
    a selection date are left out by a day, and ledger rows without batch by either.
    """
    seen = cam_batch
    if as_of is not None:
        seen = seen.filter(F.col("batch_selection_date") < F.lit(as_of))
    if before_batch is not None:
        seen = seen.filter(F.col("batch_id") < before_batch)
    return marked(cam_select, seen), seen


def warehouse_as_of(
    wh: Warehouse, as_of: date, before_batch: int | None = None, versions: Mapping[str, Sequence[str]] | None = None
) -> Warehouse:
    """The warehouse with its campaign tables as of a day; every selection runs on it unchanged.

    ``versions`` names history tables and their key, which show the version of that day. With
    ``before_batch`` the batches of the day itself that were written before are seen too.
    """

    def load(name: str) -> DataFrame:
        if name in ("cam_select", "cam_batch"):
            if before_batch is None:
                tables = ledger_as_of(wh["cam_select"], wh["cam_batch"], as_of)
            else:
                day_after = wh["cam_batch"].filter(F.col("batch_selection_date") <= F.lit(as_of))
                tables = ledger_as_of(wh["cam_select"], day_after, before_batch=before_batch)
            return tables[name == "cam_batch"]
        if name in (versions or {}):
            return version_as_of(wh[name], versions[name], as_of)
        return wh[name]

    return Warehouse(wh.spark, load)
