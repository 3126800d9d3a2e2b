"""Voucher of a case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact.functions.nested import first_item
from recontact.functions.text import like_none
from recontact.operators.dedupe import first_per_key


def allowed_voucher(excluded_clients: Sequence[str], excluded_codes: Sequence[str]) -> Column:
    """Client not excluded and code free of every excluded pattern; a missing value fails."""
    return ~F.col("voucher_client").isin(*excluded_clients) & like_none(F.col("voucher_code"), excluded_codes)


def voucher_columns(vouchers: DataFrame) -> DataFrame:
    return vouchers.select(
        F.col("id").alias("voucher_id"),
        F.col("value").alias("voucher_code"),
        F.col("client_name").alias("voucher_client"),
    )


def head_voucher(df: DataFrame, vouchers: DataFrame, ids: str = "voucher_ids") -> DataFrame:
    """Join the voucher that stands first in the list."""
    return df.withColumn("voucher_id", first_item(F.col(ids))).join(
        voucher_columns(vouchers), "voucher_id", "left"
    )


def first_voucher(
    df: DataFrame, vouchers: DataFrame, keep: Column, key: str = "case_id", ids: str = "voucher_ids"
) -> DataFrame:
    """Smallest voucher id per key among those that pass ``keep``; a key without one disappears.

    Apply it before joins that multiply rows: the voucher does not depend on them.
    """
    exploded = df.withColumn("voucher_id", F.explode(ids)).drop(ids)
    kept = exploded.join(voucher_columns(vouchers), "voucher_id").filter(keep)
    return first_per_key(kept, [key], [F.col("voucher_id").asc_nulls_last()])
