"""Suppression: keep rows whose key is absent from an exclusion set.

Three null rules exist side by side and change results, so each call names its own:

``guarded``  exclusion keys without nulls; a row without key is dropped (``x NOT IN (.. not null)``)
``admit``    a row without key is kept (``x IS NULL OR x NOT IN ..``)
``sql``      unguarded ``NOT IN``: a null among the exclusion keys empties the result, and an
             empty exclusion set keeps every row
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def exclude_keys(
    df: DataFrame,
    exclusion: DataFrame,
    key: str,
    exclusion_key: str | None = None,
    nulls: str = "guarded",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among the keys of ``exclusion``."""
    return exclude_any(df, [exclusion.select(F.col(exclusion_key or key).alias(key))], key, nulls, spread)


def exclude_any(
    df: DataFrame, exclusions: Sequence[DataFrame], key: str, nulls: str = "guarded", spread: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose ``key`` is in none of the exclusion sets, by one anti join on their union.

    ``spread`` names columns that tell rows without key apart, so wide ones need no hash of all columns.

    A chain of ``NOT IN`` conditions equals one over the union, also in its null rule, and the rows
    are shuffled once instead of once per set.
    """
    keys = reduce(DataFrame.unionByName, [e.select(F.col(key).alias("_x")) for e in exclusions])
    known = keys.filter("_x IS NOT NULL")
    if nulls == "guarded":
        return df.filter(F.col(key).isNotNull()).join(
            known.distinct(), F.col(key) == F.col("_x"), "left_anti"
        )
    if nulls == "admit":
        return _admit_null_keys(df, known, key, spread)
    if nulls == "sql":
        # One aggregate answers both questions, so the sets are read once for it and once to join.
        seen = keys.agg(F.struct(F.count_if(F.col("_x").isNull()).alias("nulls"), F.count(F.lit(1)).alias("keys"))).scalar()
        kept = df.filter((seen["nulls"] == 0) & (F.col(key).isNotNull() | (seen["keys"] == 0)))
        return _admit_null_keys(kept, known, key, spread)
    raise ValueError(f"unknown null rule {nulls!r}")


def _admit_null_keys(df: DataFrame, known: DataFrame, key: str, spread: Sequence[str] | None) -> DataFrame:
    """Anti join in which rows without key pass. They would all hash to one task, so they carry a second
    join key, a hash of the row or of its ``spread``, that deals them to as many tasks as there are;
    the exclusion side has 0 there, like every row with a key."""
    no_spread = F.xxhash64(F.col(key)) * F.lit(0)
    apart = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in spread or df.columns])).otherwise(no_spread)
    right = known.withColumn("_s", F.xxhash64("_x") * F.lit(0)).distinct()
    left = df.withColumn("_spread", apart)
    on = (F.col(key) == F.col("_x")) & (F.col("_spread") == F.col("_s"))
    return left.join(right, on, "left_anti").drop("_spread")


def campaign_ledger(cam_select: DataFrame, cam_batch: DataFrame, cam_cam: DataFrame | None = None) -> DataFrame:
    """Ledger rows with campaign id, selection date and, given the registry, the category.

    The small tables meet first, so the ledger is joined once.
    """
    batches = cam_batch.select("batch_id", "cam_id", "batch_selection_date").dropDuplicates(["batch_id"])
    if cam_cam is not None:
        batches = batches.join(cam_cam.select("cam_id", "cam_category"), "cam_id", "left")
    return cam_select.select("case_id", "batch_id").join(batches, "batch_id", "left")


def contacts(
    ledger: DataFrame,
    *,
    cam_ids: Iterable[int] | None = None,
    not_cam_ids: Iterable[int] | None = None,
    categories: Iterable[str] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """Ledger rows of the named campaigns or categories; ``when`` bounds the selection date."""
    out = ledger
    if cam_ids is not None:
        out = out.filter(F.col("cam_id").isin(*cam_ids))
    if not_cam_ids is not None:
        out = out.filter(~F.col("cam_id").isin(*not_cam_ids))
    if categories is not None:
        out = out.filter(F.col("cam_category").isin(*categories))
    return out if when is None else out.filter(when)


def contacted_patients(contacted: DataFrame, cube: DataFrame) -> DataFrame:
    """Patients of contacted cases: the cube filtered by the contacts, without a distinct over it."""
    cases = contacted.select("case_id").filter("case_id IS NOT NULL").distinct()
    return cube.select("case_id", "patient_id").join(cases, "case_id", "left_semi").select("patient_id")


def suppress(
    df: DataFrame,
    ledger: DataFrame,
    key: str = "case_id",
    *,
    cam_ids: Iterable[int] | None = None,
    not_cam_ids: Iterable[int] | None = None,
    categories: Iterable[str] | None = None,
    when: Column | None = None,
    nulls: str = "guarded",
    cube: DataFrame | None = None,
) -> DataFrame:
    """Drop rows whose case (or, with ``cube``, whose patient) has a matching contact."""
    hits = contacts(ledger, cam_ids=cam_ids, not_cam_ids=not_cam_ids, categories=categories, when=when)
    if cube is not None:
        hits = contacted_patients(hits, cube)
    return exclude_keys(df, hits, key, nulls=nulls)


def selected_more_than(contacted: DataFrame, times: int) -> DataFrame:
    """Cases with more than ``times`` contacts."""
    return (
        contacted.groupBy("case_id")
        .agg(F.count(F.lit(1)).alias("contacts"))
        .filter(F.col("contacts") > times)
    )


def suppression_list(df: DataFrame, suppressed: DataFrame, reasons: Iterable[str] | None = None) -> DataFrame:
    """Drop opted-out and hand-listed cases kept in a suppression table."""
    listed = suppressed if reasons is None else suppressed.filter(F.col("reason").isin(*reasons))
    return exclude_keys(df, listed, "case_id")


def in_set_flag(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Boolean column: the key occurs in ``keys``."""
    hits = keys.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))
    return df.join(hits, key, "left").withColumn(name, F.col(name).isNotNull())
