"""Hand-over to mail, phone and card channels, as tables and files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact.functions.text import concat_strict, like_any


def card_payloads(
    df: DataFrame,
    board: str,
    card_list: str,
    labels: Mapping[str, Column | bool],
    label_ids: Mapping[str, str],
    name: str = "case_id",
    description: str = "client_name",
) -> DataFrame:
    """One card per row. ``labels`` maps a label to its condition (``True``: always), ``label_ids``
    maps it to the id the board knows; both are the caller's configuration."""
    picked = [
        F.lit(label_ids[label]) if condition is True else F.when(condition, F.lit(label_ids[label]))
        for label, condition in labels.items()
    ]
    return df.select(
        F.col(name).alias("name"),
        F.col(description).alias("description"),
        F.lit(board).alias("board_id"),
        F.lit(card_list).alias("list_id"),
        F.array_compact(F.array(*picked)).alias("label_ids"),
    )


def treatment_labels(inquiry_type: str = "inquiry_type") -> dict[str, Column]:
    return {
        "second_opinion": F.col(inquiry_type) == "second_opinion_before_surgery",
        "surgery": F.col(inquiry_type) == "surgery",
    }


def weekly_de_labels() -> dict[str, Column | bool]:
    q3 = F.col("korb").eqNullSafe("waiting_q3")
    return {
        "follow_up": True,
        "q3": q3,
        "q4_q6": ~q3,
        "online": F.col("om_flag") == 1,
        "post": F.col("post") == "post",
        **treatment_labels(),
    }


def weekly_ch_labels() -> dict[str, Column | bool]:
    languages = {lang: F.col("preferred_language") == lang for lang in ("fr", "en", "it")}
    return {"follow_up": True, "q3": True, **languages, **treatment_labels()}


def postal_complete_labels() -> dict[str, Column | bool]:
    """Postal cases to be closed by hand carry one fixed label."""
    return {"complete": True}


def vip_labels() -> dict[str, Column | bool]:
    q3 = F.col("korb").eqNullSafe("waiting_q3")
    return {"follow_up": True, "q3": q3, "pms": ~q3}


def dialer_view(df: DataFrame, link_prefix: str, product: str = "product_v2") -> DataFrame:
    """Call list with a link per case; a missing case id gives a missing link."""
    return df.select(
        "case_id",
        product,
        "result_date",
        "payer_name",
        "payer_group",
        F.col("primary_phone").alias("primary_phone_number"),
        concat_strict(F.lit(link_prefix), F.col("case_id")).alias("case_link"),
    )


def export_csv(df: DataFrame, folder: str, label: str, as_of: date) -> str:
    """CSV dataset in a folder named by label and date; returns its path."""
    path = f"{folder.rstrip('/')}/{label}_{as_of:%Y-%m-%d}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_sheets(df: DataFrame, folder: str, patterns: Sequence[str] = ("%gmail%", "%googlemail%")) -> DataFrame:
    """Write the whole list and its mail-provider subset as ``sheet=all|provider`` of one dataset.

    A row of the subset is repeated within its task, so the list is computed once.
    """
    subset = F.when(like_any(F.col("email"), patterns), F.lit("provider"))
    both = df.withColumn("sheet", F.explode(F.array_compact(F.array(F.lit("all"), subset))))
    both.write.mode("overwrite").partitionBy("sheet").parquet(folder)
    return df.sparkSession.read.parquet(folder)
