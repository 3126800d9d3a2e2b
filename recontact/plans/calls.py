"""Telephone reviews selected from the phone cube."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.dates import before
from recontact.functions.text import ilike_any, is_false, null_or
from recontact.operators.suppress import contacts, exclude_keys
from recontact.plans.common import ledger_of, newest_case, one_per_patient
from recontact.plans.reviews import case_rows
from recontact.sources.warehouse import Warehouse

CALL_CATEGORIES = (fv.CATEGORY_CALL, fv.CATEGORY_WEEKLY)


def callable_cases(
    cube: DataFrame, as_of: date, products: Sequence[str], payer: str, without_result: bool
) -> DataFrame:
    """Cases old enough to ask, without exclusion, and with no survey under way."""

    def quiet(name: str, weeks: int) -> Column:
        return null_or(F.col(name), F.col(name) < before(as_of, weeks=weeks))

    cases = (
        cube.filter(ilike_any(F.col("product_v2"), products) & F.col("payer_name").ilike(payer))
        .filter(F.col("result_date").between(before(as_of, months=6), before(as_of, weeks=6)))
        .filter(is_false(F.col("hard_exclusion")) & is_false(F.col("questioning_inappropriate")))
        .filter(is_false(F.col("prem_return")))
        .filter(quiet("status_survey_latest_planned_at", 1))
        .filter(quiet("prem_latest_planned_at", 2) & quiet("prem_latest_sent_at", 2))
    )
    return cases.filter(is_false(F.col("prem_result_return"))) if without_result else cases


def _call_list(wh: Warehouse, as_of: date, cases: DataFrame) -> DataFrame:
    """Not called before by case, not in the last month by patient, one case per patient.

    Cases without patient pass the suppression and then form one group, of which one case stays.
    """
    called = contacts(ledger_of(wh, with_category=True), categories=CALL_CATEGORIES)
    recent = called.filter(F.col("batch_selection_date") >= before(as_of, months=1))
    fresh = exclude_keys(cases, called, "case_id")
    return one_per_patient(fresh, recent, wh["case_cube"], newest_case(), admit_missing=True)


def call_list_msn(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    cases = callable_cases(wh["phone_cube"], as_of, ["%msn%"], payer, without_result=True)
    return _call_list(wh, as_of, cases.filter(F.col("inquiry_type") != "second_opinion_before_surgery"))


def _unscored(cases: DataFrame) -> DataFrame:
    return cases.filter(F.col("provider_nps").isNull() & F.col("medic_nps").isNull())


def call_list_pmn(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    cases = callable_cases(wh["phone_cube"], as_of, ["%pmn%"], payer, without_result=False)
    return _call_list(wh, as_of, _unscored(cases))


def call_list_corporate(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    cases = callable_cases(wh["phone_cube"], as_of, ["%msn%", "%pmn%"], payer, without_result=False)
    return _call_list(wh, as_of, _unscored(cases))


def call_list_second_try_surgery(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    """Surgery cases once; second opinions up to twice, a month apart.

    The ledger is reduced to one row of flags per case, joined once, in place of one anti join per
    branch of the rule.
    """
    cases = callable_cases(wh["phone_cube"], as_of, ["%msn%"], payer, without_result=True).filter(
        F.col("inquiry_type").isin("second_opinion_before_surgery", "surgery") & F.col("case_id").isNotNull()
    )
    month_ago = before(as_of, months=1)
    called = contacts(ledger_of(wh, with_category=True), categories=CALL_CATEGORIES)
    per_case = (
        called.filter("case_id IS NOT NULL")
        .groupBy("case_id")
        .agg(
            F.count(F.lit(1)).alias("contacts"),
            F.coalesce(F.bool_or(F.col("batch_selection_date") >= month_ago), F.lit(False)).alias("recent"),
        )
    )
    first_time = F.col("contacts").isNull()
    again = (F.col("inquiry_type") == "second_opinion_before_surgery") & ~F.col("recent") & (F.col("contacts") <= 1)
    fresh = cases.join(per_case, "case_id", "left").filter(first_time | again).drop("contacts", "recent")
    recent = called.filter(F.col("batch_selection_date") >= month_ago)
    return one_per_patient(fresh, recent, wh["case_cube"], newest_case(), admit_missing=True)


def call_msn(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    return case_rows(call_list_msn(wh, as_of, payer), wh, language=True)


def call_pmn(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    return case_rows(call_list_pmn(wh, as_of, payer), wh, language=True)


def call_corporate(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    return case_rows(call_list_corporate(wh, as_of, payer), wh, language=True)


def call_second_try_surgery(wh: Warehouse, as_of: date, payer: str) -> DataFrame:
    return case_rows(call_list_second_try_surgery(wh, as_of, payer), wh, language=True)
