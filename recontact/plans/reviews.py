"""Review requests by mail."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.dates import before
from recontact.functions.nested import with_value
from recontact.functions.pii import decrypt_columns
from recontact.functions.text import (
    all_of,
    email_domain,
    ilike_none_or_null,
    is_false,
    is_true,
    not_blank,
    null_or,
    salutation,
)
from recontact.operators.dedupe import first_per_key
from recontact.operators.ledger import numbered_rows
from recontact.operators.suppress import contacts, exclude_keys
from recontact.plans.common import ledger_of, newest_case, one_per_patient
from recontact.sources.warehouse import Warehouse


def _satisfied(wh: Warehouse, as_of: date, groups: Sequence[str]) -> DataFrame:
    """Recent cases of the payer groups with a regular voucher and good scores, not asked before."""
    voucher, reason = F.col("voucher_code"), F.col("completion_reason")
    cube = wh["case_cube"].filter(
        all_of(
            [
                F.col("result_date") >= before(as_of, months=6),
                F.col("payer_group").isin(*groups),
                not_blank(voucher),
                ~voucher.startswith(fv.VIP_VOUCHER),
                F.col("provider_nps") >= 7,
                null_or(F.col("medic_nps"), F.col("medic_nps") >= 7),
                ilike_none_or_null(reason, fv.REVIEW_EXCLUDED_REASONS),
            ]
        )
    )
    return exclude_keys(cube, contacts(ledger_of(wh), cam_ids=[fv.CAM_REVIEW_REQUEST]), "case_id")


def _reachable(wh: Warehouse, cases: DataFrame, german_only: bool) -> DataFrame:
    """Cases of cooperating payers whose mail provider is one of the wanted."""
    payers = wh["payer_dim"].filter(is_true(F.col("coop_status"))).select("client_id")
    people = wh["pii"].withColumn("domain", email_domain(F.col("email")))
    people = people.filter(F.col("domain").isin(*fv.REVIEW_MAIL_DOMAINS))
    if german_only:
        people = people.filter(F.col("country_code") == "de")
    people = people.select("service_id", "title", "first_name", "last_name", "city", "state", "email", "domain")
    return (
        cases.join(payers, F.col("payer_id") == F.col("client_id"))
        .drop("client_id")
        .join(people, "service_id")
        .withColumn("salutation", salutation(F.col("gender")))
    )


def _mail_list(wh: Warehouse, reachable: DataFrame) -> DataFrame:
    order = [F.col("patient_id").asc_nulls_last(), F.col("result_date").desc_nulls_first(), F.col("service_id")]
    cases = first_per_key(reachable, ["case_id"], order)
    asked = contacts(ledger_of(wh), cam_ids=[fv.CAM_REVIEW_REQUEST])
    return one_per_patient(cases, asked, wh["case_cube"], newest_case())


def review_list_de(wh: Warehouse, as_of: date, excluded_payers: Sequence[str] = fv.REVIEW_EXCLUDED_PAYERS) -> DataFrame:
    """Mail list of the German review request, one row per patient."""
    cases = _satisfied(wh, as_of, ("gkv", "pkv")).filter(
        (F.col("product") == "MSS")
        & is_false(F.col("goodwill"))
        & ~F.col("payer_name").isin(*excluded_payers)
    )
    return _mail_list(wh, _reachable(wh, cases, german_only=True))


def review_list_ch(wh: Warehouse, as_of: date) -> DataFrame:
    """Mail list of the Swiss review request: any product, no payer list, any country."""
    return _mail_list(wh, _reachable(wh, _satisfied(wh, as_of, ("kv",)), german_only=False))


def case_rows(chosen: DataFrame, wh: Warehouse, language: bool = False) -> DataFrame:
    """Ledger rows of cube cases."""
    mapping = {
        "client_name": F.col("payer_name"),
        "first_voucher_code": F.col("voucher_code"),
        "preferred_language": F.col("preferred_language") if language else F.lit(None),
    }
    return numbered_rows(chosen, wh["cam_select"], mapping)


def review_request_de(wh: Warehouse, as_of: date, **rules) -> DataFrame:
    return case_rows(review_list_de(wh, as_of, **rules), wh)


def review_request_ch(wh: Warehouse, as_of: date) -> DataFrame:
    return case_rows(review_list_ch(wh, as_of), wh, language=True)


def review_request_legacy(
    people: DataFrame,
    keyring: DataFrame,
    previous: DataFrame,
    cam_id: int = fv.CAM_EXISTING_CUSTOMER_MAIL,
    columns: Sequence[str] = ("title", "first_name", "last_name", "email"),
) -> DataFrame:
    """Earlier list: decrypt, keep mail of the provider, drop cases of the previous campaign, then
    one row per address. The kept row is the one with the smallest case id.

    The mail decides, so it is opened first; the other columns are opened for chosen rows only.
    """
    provider = decrypt_columns(people, [c for c in columns if c == "email"], keyring).filter(
        with_value(F.col("email"), lambda mail: F.contains(mail, F.lit("@gmail.com")) | F.contains(mail, F.lit("@google")))
    )
    fresh = exclude_keys(
        provider, previous.filter(F.col("cam_id") == cam_id), "case_id", nulls="admit"
    )
    chosen = first_per_key(fresh, ["email"], [F.col("case_id").asc_nulls_last()])
    return decrypt_columns(chosen, [c for c in columns if c != "email"], keyring)
