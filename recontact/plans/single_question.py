"""One-question mail for cases with an open survey."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.functions.dates import before
from recontact.functions.text import is_true
from recontact.operators.dedupe import stable_shuffle_order
from recontact.operators.suppress import suppress
from recontact.plans.common import ledger_of
from recontact.plans.reviews import case_rows
from recontact.sources.warehouse import Warehouse


def single_question_list(wh: Warehouse, as_of: date, nulls: str = "sql", seed: int = 0) -> DataFrame:
    """Eligible cases with their address and a repeatable random order value."""
    cases = (
        wh["single_question"]
        .filter(F.col("payer_group").isin("gkv", "pkv") & (F.col("product") == "MSS"))
        .filter(F.col("result_date").between(before(as_of, months=7), before(as_of, months=3)))
        .filter(is_true(F.col("reporting_bool")) & F.col("result").isNull())
        .filter(F.col("therapy_group").isin("Knie", "Hüfte", "Schulter"))
        .filter(F.col("therapy") != "Sonstige Operation")
        .filter((F.col("op_category") == 1) & (F.col("cases_last_two_years") == 1))
        .filter(F.col("inquiry_type").isin("surgery", "second_opinion_before_surgery"))
        .filter((F.col("inquiries_state") == "waiting_q3") & (F.col("appointment_type") == "3"))
        .filter(F.col("appointment_state").isin("sent", "call_patient"))
        .filter(is_true(F.col("channel_reach_email")) & (F.col("preferred_channel") == "email"))
    )
    recent = F.col("batch_selection_date") > before(as_of, months=1)
    fresh = suppress(cases, ledger_of(wh), when=recent, nulls=nulls)
    mail = wh["pii"].select("service_id", "email")
    return fresh.join(mail, "service_id", "left").withColumn(
        "random_order", stable_shuffle_order(seed, "case_id")
    )


def single_question(wh: Warehouse, as_of: date, nulls: str = "sql") -> DataFrame:
    return case_rows(single_question_list(wh, as_of, nulls), wh)
