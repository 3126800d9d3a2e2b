"""Steps shared by the selections."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.operators.dedupe import first_per_key
from recontact.operators.ledger import commit, staged
from recontact.operators.suppress import campaign_ledger, contacts, contacted_patients, exclude_keys
from recontact.sources.warehouse import Warehouse


def newest_case() -> list[Column]:
    """Latest result first, missing results before all, as PostgreSQL sorts; then by case id."""
    return [F.col("result_date").desc_nulls_first(), F.col("case_id").asc_nulls_last()]


def ledger_of(wh: Warehouse, with_category: bool = False) -> DataFrame:
    return campaign_ledger(wh["cam_select"], wh["cam_batch"], wh["cam_cam"] if with_category else None)


def one_per_patient(
    df: DataFrame,
    contacted: DataFrame,
    cube: DataFrame,
    order: Sequence[Column],
    admit_missing: bool = False,
) -> DataFrame:
    """One row per patient, without patients of contacted cases.

    Suppression keeps or drops a patient as a whole, so it commutes with the choice of the row. The
    choice comes first: the anti join then sees one row per patient instead of a patient's cases.
    """
    rows = df if admit_missing else df.filter(F.col("patient_id").isNotNull())
    chosen = first_per_key(rows, ["patient_id"], order)
    patients = contacted_patients(contacted, cube)
    return exclude_keys(chosen, patients, "patient_id", nulls="admit" if admit_missing else "guarded", spread=["case_id"])


def weekly_run(
    wh: Warehouse,
    root: str,
    as_of: date,
    cam_id: int,
    chosen: DataFrame,
    rows_of: Callable[[DataFrame], DataFrame],
    cards_of: Callable[[DataFrame], DataFrame] = lambda cases: cases,
    cards: str = "weekly_cards",
) -> tuple[DataFrame, DataFrame] | None:
    """One weekly run: ``chosen`` is computed once, below ``root``; it gives the ledger rows, the batch row
    and the cards' cases. Returns the written ledger rows and those cases, or None without cases. A
    second run in the week is refused. A run that stops before its batch row leaves nothing that counts.
    """
    with staged(chosen, root) as cases:
        written = commit(wh.spark, rows_of(cases), root, cam_id, fv.ACCEPTOR_PHONE, as_of, weekly=True)
        if written is None:
            return None
        told = cards_of(cases)
        # The cards outlive the staged cases as a table beside the ledger, one folder a batch.
        path = f"{root}/{cards}/batch_id={written.first().batch_id}"
        told.write.mode("overwrite").parquet(path)
        return written, wh.spark.read.schema(told.schema).parquet(path)


__all__ = ["contacts", "ledger_of", "newest_case", "one_per_patient", "weekly_run"]
