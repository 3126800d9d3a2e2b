"""Mail to existing customers.

``excluded_channels`` and ``staff_patterns`` name the staff's own channel and clients, which only the
caller knows, so they have no default.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.dates import before, parse_day_first
from recontact.functions.nested import first_item, json_text, score_rank, second_item, with_value
from recontact.functions.pii import decrypt_columns
from recontact.functions.text import (
    all_of,
    concat_skip_nulls,
    flag,
    is_true,
    like_none,
    not_detractor,
    null_or,
    salutation,
)
from recontact.operators.dedupe import first_per_key
from recontact.operators.suppress import contacts, exclude_keys, suppress, suppression_list
from recontact.plans.common import ledger_of, newest_case, one_per_patient
from recontact.sources.history import current_version, not_deleted
from recontact.sources.warehouse import Warehouse


def existing_customer_mail(
    wh: Warehouse, as_of: date, excluded_payers: Sequence[str] = fv.MAIL_EXCLUDED_PAYERS
) -> DataFrame:
    """Customers of the last six years who got no review request within a year; one per patient."""
    people = wh["mail_base"].filter(
        ~F.col("payer_name").isin(*excluded_payers)
        & F.col("result_date").between(before(as_of, years=6), before(as_of, months=3))
    )
    asked = contacts(
        ledger_of(wh),
        cam_ids=[fv.CAM_REVIEW_REQUEST],
        when=F.col("batch_selection_date") > before(as_of, years=1),
    )
    fresh = exclude_keys(people, asked, "case_id")
    return one_per_patient(fresh, asked, wh["case_cube"], newest_case()).orderBy(
        F.col("result_date").asc_nulls_last(), F.col("case_id").asc_nulls_last()
    )


def subsidised_cases(inquiries: DataFrame, insurance: DataFrame) -> DataFrame:
    """Cases whose main insurance carries the supplementary subsidy."""
    subsidised = (
        insurance.filter(is_true(F.col("main")) & is_true(F.col("supplementary")))
        .groupBy("inquiry_id", "supplementary")
        .agg(F.max("inquiry_id").alias("id"))
    )
    return inquiries.join(subsidised.select("id"), "id", "left_semi").select("case_id")


def _cube_customers(
    wh: Warehouse, first_day: date, last_day: date, scores_required: bool, excluded_channels: Sequence[str]
) -> DataFrame:
    reason = F.col("completion_reason")
    cases = (
        wh["case_cube"]
        .filter(F.col("result_date").between(F.lit(first_day), F.lit(last_day)))
        .filter(not_detractor(F.col("medic_nps"), fv.DETRACTOR_SCORES, admit_null=not scores_required))
        .filter(not_detractor(F.col("provider_nps"), fv.DETRACTOR_SCORES, admit_null=not scores_required))
        .filter(~F.col("voucher_code").isin(*fv.GOODWILL_VOUCHERS))
        .filter(~F.contains(F.col("voucher_code"), F.lit(fv.VIP_VOUCHER)))
        .filter(F.col("payer_group").isin("gkv", "pkv") & (F.col("product") != "RSO"))
        .filter(~F.col("admission_channel").isin(*excluded_channels))
        .filter(F.col("country_code") == "de")
        .filter(null_or(reason, reason.isin(*fv.CUBE_ALLOWED_REASONS)))
        .filter(like_none(F.col("payer_name"), fv.CUBE_EXCLUDED_PAYERS))
    )
    partners = current_version(wh["payer_history"]).filter(is_true(F.col("coop_status")))
    cases = cases.join(
        partners.select(F.col("client_name").alias("payer_name"), "coop_status"), "payer_name"
    )
    return exclude_keys(cases, subsidised_cases(wh["inquiries"], wh["insurance_data"]), "case_id", nulls="admit")


CUSTOMER_COLUMNS = [
    "case_id",
    "patient_id",
    "product",
    "result_date",
    "payer_name",
    "payer_group",
    "voucher_code",
    "gender",
    "salutation",
    "country_code",
]


def _customer_rows(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "salutation": salutation(F.col("gender"), keep_unknown=True),
            "om_flag": flag(F.col("admission_channel").isin(*fv.ONLINE_CHANNELS)),
        }
    )


def _case_people(wh: Warehouse) -> DataFrame:
    return wh["patient_facts"].select("case_id", "first_name", "last_name", "email")


def existing_customer_cube(
    wh: Warehouse,
    as_of: date,
    first_day: date,
    last_day: date,
    *,
    excluded_channels: Sequence[str],
    scores_required: bool = False,
    use_ledger: bool = True,
) -> DataFrame:
    """Satisfied customers with an address, not mailed within a year; one row per patient.

    The older variant requires both scores and knows no ledger rule.
    """
    cases = _cube_customers(wh, first_day, last_day, scores_required, excluded_channels)
    people = _case_people(wh).filter((F.length("email") >= 4) & F.col("last_name").isNotNull())
    listed = suppression_list(cases.join(people, "case_id"), wh["suppression"])
    if use_ledger:
        mailed = contacts(
            ledger_of(wh),
            cam_ids=[fv.CAM_EXISTING_CUSTOMER_MAIL],
            when=F.col("batch_selection_date") > before(as_of, years=1),
        )
        fresh = exclude_keys(listed, mailed, "case_id")
        chosen = one_per_patient(fresh, mailed, wh["case_cube"], newest_case())
    else:
        chosen = first_per_key(listed, ["patient_id"], newest_case())
    return _customer_rows(chosen).select(*CUSTOMER_COLUMNS, "om_flag", "first_name", "last_name", "email")


def existing_customer_two_system(
    wh: Warehouse,
    keyring: DataFrame,
    first_day: date,
    last_day: date,
    *,
    excluded_channels: Sequence[str],
) -> DataFrame:
    """The scored variant with a contact in either system; the inquiry system's columns are
    decrypted after the selection, so only chosen rows are opened."""
    cases = _cube_customers(wh, first_day, last_day, True, excluded_channels)
    first = _case_people(wh).select(
        "case_id", *[F.col(c).alias(f"case_{c}") for c in ("first_name", "last_name", "email")]
    )
    second = wh["patient_data"].select(
        "service_id", *[F.col(c).alias(f"inquiry_{c}") for c in ("first_name", "last_name", "email")]
    )
    both = cases.join(first, "case_id", "left").join(second, "service_id", "left")
    reachable = both.filter(
        (F.length(F.coalesce("case_email", "inquiry_email")) >= 4)
        & F.coalesce("case_last_name", "inquiry_last_name").isNotNull()
    )
    listed = suppression_list(reachable, wh["suppression"])
    chosen = _customer_rows(first_per_key(listed, ["patient_id"], newest_case()))
    out = chosen.select(
        *CUSTOMER_COLUMNS,
        *[f"{s}_{c}" for s in ("case", "inquiry") for c in ("first_name", "last_name", "email")],
    )
    return decrypt_columns(out, ["inquiry_first_name", "inquiry_last_name", "inquiry_email"], keyring, strict=True)


# Columns of the union of both case systems; each side fills what it lacks with typed nulls.
UNIFIED = {
    "system": "string",
    "case_id": "string",
    "service_id": "string",
    "product": "string",
    "result_date": "date",
    "first_voucher_code": "string",
    "second_voucher_code": "string",
    "client_1": "string",
    "client_2": "string",
    "insurance": "string",
    "subsidy": "boolean",
    "description": "string",
    "gender": "string",
    "title": "string",
    "first_name": "string",
    "last_name": "string",
    "county": "string",
    "country": "string",
    "email": "string",
    "provider_nps": "string",
    "completion_reason_main": "string",
    "completion_reason_additional": "string",
    "completion_details": "string",
    "exclude": "string",
}


def _aligned(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in UNIFIED.items()]
    )


def inquiry_cases(wh: Warehouse, days: tuple[Column, Column] | None = None) -> DataFrame:
    """Cases of the inquiry system in the unified shape, sent within ``days``; the last day counts until
    its first moment."""
    entries = wh["contact_entries"]
    unhappy = entries.filter(F.col("quality").isin(*fv.DETRACTOR_SCORES) & (F.col("contact_type") != "Q1"))
    sent = wh["inquiries"]
    if days is not None:
        first, last = (d.cast("timestamp_ntz") for d in days)
        sent = sent.filter(F.col("results_sent_at").cast("timestamp_ntz").between(first, last))
    inquiries = exclude_keys(sent, unhappy, "id", "inquiry_id", nulls="sql")
    vouchers = wh["voucher_dim"]
    # One aggregate for both: each insurance of an inquiry with each of its subsidies, missing ones too.
    main = wh["insurance_data"].filter(is_true(F.col("main"))).groupBy(F.col("inquiry_id").alias("id"))
    insured = main.agg(
        F.collect_set(F.struct("insurance")).alias("_insured"), F.collect_set(F.struct(F.col("supplementary").alias("subsidy"))).alias("_paid")
    )
    insured = insured.withColumn("_insured", F.explode("_insured")).withColumn("_paid", F.explode("_paid"))
    insured = insured.select("id", "_insured.insurance", "_paid.subsidy")
    people = wh["patient_data"]
    if days is not None:
        # A condition, unlike a join, moves below the columns of the table: they are computed for these rows alone.
        people = people.filter(F.col("inquiry_id").isin(sent.select("id")))
    people = people.select(
        F.col("inquiry_id").alias("id"),
        "gender",
        "first_name",
        "last_name",
        "email",
        F.lower("country_code").alias("country"),
    )
    v1 = vouchers.select(
        F.col("id").alias("v1"), F.col("value").alias("first_voucher_code"), F.col("client_name").alias("client_1")
    )
    v2 = vouchers.select(
        F.col("id").alias("v2"), F.col("value").alias("second_voucher_code"), F.col("client_name").alias("client_2")
    )
    cases = (
        inquiries.drop("service_id")
        .withColumns({"v1": first_item(F.col("voucher_ids")), "v2": second_item(F.col("voucher_ids"))})
        .join(people, "id", "left")
        .join(v1, "v1", "left")
        .join(v2, "v2", "left")
        .join(insured, "id", "left")
    )
    return _aligned(
        cases.withColumns(
            {
                "system": F.lit("inquiry"),
                "service_id": concat_skip_nulls("case_id", F.lit(":MSS")),
                "product": F.lit("MSS"),
                "result_date": F.col("results_sent_at"),
                "exclude": F.col("exclude_from_reporting"),
            }
        )
    )


def best_known_score(feedbacks: DataFrame) -> DataFrame:
    """Lowest-ranked text score per service, ``not_specified`` after all numbers."""
    ranked = not_deleted(feedbacks).select("service_id", "nps")
    order = [score_rank(F.col("nps")).asc_nulls_last(), F.col("nps").asc_nulls_last()]
    return first_per_key(ranked, ["service_id"], order)


def service_cases(wh: Warehouse, days: tuple[Column, Column] | None = None) -> DataFrame:
    """Services of the case system in the unified shape, each with its latest result within ``days``.

    Result and closing events are one aggregate per service: the latest result, and a closing reason
    that does not forbid contact if there is one.
    """
    bad_visits = not_deleted(wh["visits"]).filter(
        (F.col("visit_timing") == 1) & F.col("visit_nps").isin("0", "1", "2", "3", "4", "5", "6")
    )
    services = exclude_keys(not_deleted(wh["services"]), bad_visits, "case_id", nulls="sql")
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    payers = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("client_1"))
    products = wh["products"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    events = not_deleted(wh["workflow_events"]).withColumn(
        "service_id", concat_skip_nulls("case_id", F.lit(":"), "service")
    )
    day = parse_day_first(json_text(F.col("event_body"), "$.properties.date"))
    final, close = (F.contains("event_type", F.lit(t)) for t in ("DID_SEND_FINAL", "DID_CLOSE"))
    reason = json_text(F.col("event_body"), "$.properties.reason")
    # Results outside of the days leave before the events meet anything; each body is opened once for its day.
    counts = final if days is None else final & with_value(day, lambda d: d.between(*days))
    told = events.filter(counts | close).select(
        "service_id", final.alias("_final"), close.alias("_close"), F.when(final, day).alias("_day"), F.when(close, reason).alias("_reason")
    )
    counted = F.col("_day") if days is None else F.when(F.col("_day").between(*days), F.col("_day"))
    harmless = null_or(F.col("_reason"), ~F.col("_reason").isin(*fv.UNIFIED_MAIN_REASONS))
    # Rows of a null order do not count for the reason.
    told = told.groupBy("service_id").agg(
        F.bool_or("_final").alias("_final"),
        F.max(counted).alias("result_date"),
        F.min_by("_reason", F.when(F.col("_close"), F.when(harmless, 0).otherwise(1))).alias("completion_reason_main"),
    )
    told = told.filter(F.col("_final") if days is None else F.col("result_date").isNotNull()).drop("_final")
    marker = F.col("markers")
    excluded = F.when(
        (json_text(marker, "$.test_case") == "true") | json_text(marker, "$.deleted").isNotNull(), "true"
    ).otherwise("false")
    markers = wh["case_markers"].select("case_id", excluded.alias("exclude"))
    companies = wh["insurance_companies"].select(F.col("id").alias("insurance_company_id"), F.col("title").alias("insurance"))
    insurances = wh["primary_insurance_selections"].join(companies, "insurance_company_id")
    insurances = insurances.groupBy("case_id").agg(F.min("insurance").alias("insurance"))
    people = wh["patient_facts"].select(
        "case_id",
        "gender",
        "title",
        "first_name",
        "last_name",
        "county",
        "email",
        F.col("country_code").alias("country"),
    )
    scores = best_known_score(wh["feedbacks"]).select(
        F.col("service_id").alias("id"), F.col("nps").alias("provider_nps")
    )
    cases = (
        services.join(told, "service_id")
        .join(contracts, "contract_id", "left")
        .join(payers, "payer_id", "left")
        .join(products, "product_id", "left")
        .join(people, "case_id", "left")
        .join(scores, "id", "left")
        .join(markers, "case_id", "left")
        .join(insurances, "case_id", "left")
    )
    return _aligned(
        cases.drop("product")
        .withColumnsRenamed({"product_name": "product", "voucher_code": "first_voucher_code"})
        .withColumns({"system": F.lit("service"), "subsidy": F.lit(False)})
    )


def _client_roles(df: DataFrame, groups: DataFrame) -> DataFrame:
    """The client dimension in three roles: both clients and the insurance."""
    distinct = groups.select("client_name", "client_group", "coop_status").dropDuplicates()
    for role, name in enumerate(("client_1", "client_2", "insurance"), start=1):
        dim = distinct.select(
            F.col("client_name").alias(name),
            F.col("client_group").alias(f"group_{role}"),
            F.col("coop_status").alias(f"coop_{role}"),
        )
        df = df.join(dim, name, "left")
    return df


def _unified_rule(anonymised: str | None, reason_guard: str) -> list[Column]:
    code, main = F.col("first_voucher_code"), F.col("completion_reason_main")
    additional, details = F.col("completion_reason_additional"), F.col("completion_details")
    ordinary_code = (
        ~code.like(fv.EMPLOYEE_VOUCHER)
        & ~F.contains(F.lower(code), F.lit("pilot"))
        & ~F.contains(F.lower(code), F.lit("kulanz"))
        & ~code.isin(*fv.UNIFIED_EXCLUDED_VOUCHERS)
    )
    paid_subsidy = F.col("subsidy") & (
        ~F.contains(F.lower("client_1"), F.lit("axa pkv")) & (F.col("group_1") != "corporate")
    )
    guarded = main if reason_guard == "main" else additional
    rule = [
        F.col("country") == "de",
        F.col("provider_nps").isin(*fv.PROMOTER_TEXT_SCORES),
        null_or(F.col("exclude"), F.col("exclude") == "false"),
        null_or(main, ~main.isin(*fv.UNIFIED_MAIN_REASONS)),
        null_or(guarded, ~additional.isin(*fv.UNIFIED_ADDITIONAL_REASONS)),
        null_or(details, details == ""),
        ~((F.col("system") == "inquiry") & code.isNull()),
        null_or(code, ordinary_code),
        ~F.col("group_1").isin(*fv.UNIFIED_EXCLUDED_GROUPS),
        null_or(F.col("description"), ~F.contains(F.lower("description"), F.lit("vip"))),
        ~F.col("client_1").isin(*fv.UNIFIED_EXCLUDED_CLIENTS),
        null_or(F.col("insurance"), ~F.col("insurance").isin(*fv.UNIFIED_EXCLUDED_INSURANCES)),
        null_or(F.col("group_3"), F.col("group_3").isin(*fv.UNIFIED_INSURANCE_GROUPS)),
        null_or(F.col("coop_3"), F.col("coop_3")),
        ~(paid_subsidy | F.col("subsidy").isNull()),
    ]
    if anonymised is not None:
        rule.append(null_or(F.col("first_name"), F.col("first_name") != anonymised))
    return rule


def existing_customer_unified(
    wh: Warehouse,
    as_of: date,
    keyring: DataFrame | None = None,
    anonymised: str | None = None,
    reason_guard: str = "main",
    nulls: str = "sql",
) -> DataFrame:
    """Promoters of both case systems from the last two to four years; one row per patient.

    ``reason_guard='main'`` keeps the reference's guard of the additional reason by the main reason;
    ``'additional'`` guards it by itself. With a keyring the inquiry system's columns are opened.
    """
    days = before(as_of, months=48), before(as_of, months=24)
    cases = inquiry_cases(wh, days).unionByName(service_cases(wh, days))
    cases = suppression_list(cases, wh["suppression"])
    kept = _client_roles(cases, wh["client_groups"]).filter(all_of(_unified_rule(anonymised, reason_guard)))
    earlier = [fv.CAM_EXISTING_CUSTOMER_CALL, fv.CAM_EXISTING_CUSTOMER_MAIL]
    old = F.col("batch_selection_date") < before(as_of, weeks=4)
    asked = (F.col("cam_id") == fv.CAM_REVIEW_REQUEST) & old
    kept = suppress(kept, ledger_of(wh), when=F.col("cam_id").isin(*earlier) | asked, nulls=nulls)
    people = kept.join(wh["patient_ids"], "case_id", "left")
    order = newest_case() + [F.col("system"), F.col("service_id"), F.col("product").asc_nulls_last()]
    order += [F.col("client_1").asc_nulls_last(), F.col("first_voucher_code").asc_nulls_last()]
    chosen = first_per_key(people, ["patient_id"], order)
    out = chosen.withColumn("salutation", salutation(F.col("gender"), keep_unknown=True)).select(
        "patient_id",
        "system",
        "case_id",
        "gender",
        "salutation",
        "title",
        "first_name",
        "last_name",
        "result_date",
        "county",
        "country",
        "email",
        "client_1",
        "client_2",
    )
    if keyring is None:
        return out
    return decrypt_columns(out, ["title", "first_name", "last_name", "email"], keyring, F.col("system") == "service", strict=True)


def existing_customer_simple_a(wh: Warehouse, staff_patterns: Sequence[str]) -> DataFrame:
    """Case-system list of cases with a primary insurance, by product, payer brand and voucher; one row
    per case, insurance and score."""
    companies = wh["insurance_companies"].select(F.col("id").alias("insurance_company_id"), F.col("title").alias("insurance_name"))
    insured = wh["primary_insurance_selections"].join(companies, "insurance_company_id").select("case_id", "insurance_name")
    codes = wh["voucher_texts"].select("voucher_code", "voucher_description")
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    payers = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("payer_brand"))
    services = wh["services"].select("id", "case_id", "product", "contract_id", "voucher_code")
    finals = wh["workflow_events"].filter(F.contains("event_type", F.lit("DID_SEND_FINAL"))).select("case_id")
    scores = wh["feedbacks"].select(F.col("service_id").alias("id"), "nps", "free_text").distinct()
    brands = fv.SIMPLE_A_EXCLUDED_BRANDS + tuple(staff_patterns)
    return (
        services.filter((F.col("product") == "RSO") | F.contains("product", F.lit("PMS")))
        .filter(like_none(F.col("voucher_code"), fv.SIMPLE_A_EXCLUDED_VOUCHERS))
        .join(contracts, "contract_id")
        .join(payers, "payer_id")
        .filter(like_none(F.col("payer_brand"), brands))
        .join(finals, "case_id", "left_semi")
        .join(insured, "case_id")
        .join(codes, "voucher_code", "left")
        .join(scores, "id", "left")
        .select(
            "case_id",
            "payer_brand",
            "insurance_name",
            "voucher_code",
            "voucher_description",
            F.col("nps").alias("provider_nps"),
            F.col("free_text").alias("provider_nps_reason"),
        )
    )


def existing_customer_simple_b(wh: Warehouse, staff_patterns: Sequence[str]) -> DataFrame:
    """Inquiry-system list by client, voucher, country and score."""
    vouchers = wh["voucher_dim"].select(
        F.col("id").alias("voucher_id"),
        F.col("value").alias("first_voucher_code"),
        F.col("client_name").alias("voucher_client"),
    )
    groups = wh["client_groups"].select(F.col("client_name").alias("voucher_client"), "client_group")
    people = wh["patient_data"].select(F.col("inquiry_id").alias("id"), "country_code")
    code, clients = F.col("first_voucher_code"), fv.SIMPLE_B_EXCLUDED_CLIENTS + tuple(staff_patterns)
    return (
        wh["inquiries"]
        .filter(F.col("results_sent_at").isNotNull())
        .filter(null_or(F.col("provider_nps"), F.col("provider_nps") >= 7))
        .withColumn("voucher_id", first_item(F.col("voucher_ids")))
        .join(vouchers, "voucher_id")
        .filter(like_none(F.col("voucher_client"), clients))
        .filter(~code.isin(*fv.SIMPLE_B_EXCLUDED_VOUCHERS) & ~code.like(fv.EMPLOYEE_VOUCHER))
        .join(groups, "voucher_client")
        .filter(F.col("client_group") != "Corporate")
        .join(people, "id", "left")
        .filter(null_or(F.col("country_code"), F.lower("country_code") == "de"))
        .select("case_id", "voucher_client", "client_group", "first_voucher_code", "country_code", "provider_nps")
    )
