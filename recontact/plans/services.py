"""Follow-up of the case system by surveys and workflow events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.dates import before, days_since, in_iso_week_of, parse_day_first, prom_age_bucket
from recontact.functions.nested import json_text, with_value
from recontact.functions.text import any_of, like_any, null_or
from recontact.operators.dedupe import first_per_key, latest_per_key
from recontact.operators.ledger import numbered_rows
from recontact.operators.suppress import contacts, exclude_any, suppression_list
from recontact.operators.surveys import pivot_events, presence_flag, survey_class_of, titled_links
from recontact.plans.common import ledger_of, weekly_run
from recontact.plans.inquiries import vip_inquiries
from recontact.sources.history import not_deleted
from recontact.sources.warehouse import Warehouse


def links_of(wh: Warehouse) -> DataFrame:
    return titled_links(wh["survey_links"], wh["surveys"])


def responded(links: DataFrame) -> DataFrame:
    """Cases with an answered follow-up survey."""
    return links.filter(F.col("title").like(fv.FOLLOW_UP_TITLE) & F.col("response_status").isNotNull())


def surveyed(links: DataFrame) -> DataFrame:
    """Cases with an answered follow-up or any outcome survey."""
    answered = F.col("title").like(fv.FOLLOW_UP_TITLE) & F.col("response_status").isNotNull()
    return links.filter(answered | F.contains("title", F.lit("PROM")))


def ended(wh: Warehouse) -> DataFrame:
    """Cases closed or with a reply."""
    return events_like(wh, "DID_CLOSE", "DID_RECEIVE")


def refused(wh: Warehouse) -> DataFrame:
    """Cases with a reply or closed for a reason that forbids further questions."""
    reason = json_text(F.col("event_body"), "$.properties.reason")
    event = F.col("event_type")
    closed = F.contains(event, F.lit("DID_CLOSE")) & like_any(reason, fv.CLOSE_REASONS)
    return wh["workflow_events"].filter(F.contains(event, F.lit("DID_RECEIVE")) | closed)


def talked(wh: Warehouse, topic: str) -> DataFrame:
    return wh["conversations_ref"].filter(F.col("topics") == f'["{topic}"]')


def called(wh: Warehouse, not_cam_ids: Sequence[int]) -> DataFrame:
    return contacts(ledger_of(wh), not_cam_ids=not_cam_ids)


def events_like(wh: Warehouse, *parts: str) -> DataFrame:
    return wh["workflow_events"].filter(any_of(F.contains("event_type", F.lit(p)) for p in parts))


STATUS_CLASSES = {"SS": "%Status%", "PREM": "%PREM%"}
PMS_CLASSES = {"Allrounder": "%Allrounder%", "Reha": "%Reha%"}


def service_rows(
    df: DataFrame, wh: Warehouse, batch: str = "new", language: bool = True, key: Sequence[str] = ("case_id",)
) -> DataFrame:
    mapping = {
        "client_name": F.col("payer_name"),
        "first_voucher_code": F.col("voucher_code"),
        "patient_id": F.lit(None),
        "preferred_language": F.col("preferred_language") if language else F.lit(None),
    }
    return numbered_rows(df, wh["cam_select"], mapping, key, batch)


def live_services(wh: Warehouse) -> DataFrame:
    """Live services with payer and language."""
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    payers = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("payer_name"))
    facts = wh["communication_facts"].select("case_id", "preferred_language", "channel_recommendation")
    return (
        not_deleted(wh["services"])
        .select("case_id", "service_id", "contract_id", "voucher_code")
        .join(contracts, "contract_id", "left")
        .join(payers, "payer_id", "left")
        .join(facts, "case_id", "left")
    )


def final_services(wh: Warehouse) -> DataFrame:
    """Live services of cases whose final result was sent."""
    finals = events_like(wh, "DID_SEND_FINAL").select("case_id").distinct()
    return live_services(wh).join(finals, "case_id", "left_semi")


def ledger_state() -> Column:
    """Appointment state by survey class; other classes have none."""
    return F.when(F.col("case_class") == "SS", "call_patient").when(F.col("case_class") == "PREM", "sent")


def _survey_facts(links: DataFrame, as_of: date, oldest_days: int | None = None) -> DataFrame:
    """One row per case: survey class, and the oldest due invitation of the survey that names it.

    Due is a follow-up invitation of at least 16 and at most ``oldest_days`` days. One aggregation
    replaces the join of all invitations, whose number per case has no bound.
    """
    title, age = F.col("title"), days_since(F.col("created_at"), as_of)
    due = title.like(fv.FOLLOW_UP_TITLE) & (age >= 16)
    if oldest_days is not None:
        due = due & (age <= oldest_days)
    status, prem = F.contains(title, F.lit("Status")), F.contains(title, F.lit("PREM"))
    facts = links.groupBy("case_id").agg(
        survey_class_of(STATUS_CLASSES).alias("case_class"),
        F.min(F.when(due & status, F.col("created_at"))).alias("_status_at"),
        F.min(F.when(due & prem, F.col("created_at"))).alias("_prem_at"),
    )
    own = F.when(F.col("case_class") == "SS", F.col("_status_at")).when(
        F.col("case_class") == "PREM", F.col("_prem_at")
    )
    return facts.select("case_id", "case_class", own.alias("invited_at"))


def _per_case(df: DataFrame) -> DataFrame:
    """One service per case: the longest waiting one."""
    order = [F.col("survey_age").desc_nulls_last(), F.col("service_id"), F.col("case_class").asc_nulls_last()]
    return first_per_key(df, ["case_id"], order)


def _mss_follow_up(
    wh: Warehouse, as_of: date, payers: Column, exclusions: Sequence[DataFrame], oldest_days: int | None = None
) -> DataFrame:
    """First-product cases with a due, unanswered invitation, one row per case."""
    links = links_of(wh)
    services = final_services(wh).filter(payers & F.contains("service_id", F.lit(":MSS")))
    services = suppression_list(services, wh["suppression"])
    services = exclude_any(services, [surveyed(links), *exclusions], "case_id", nulls="sql")
    facts = _survey_facts(links, as_of, oldest_days).filter(F.col("invited_at").isNotNull())
    rows = services.join(facts, "case_id").withColumn("survey_age", days_since(F.col("invited_at"), as_of))
    return _per_case(rows).withColumn("app_state", ledger_state())


def ch_survey_legacy(
    wh: Warehouse, as_of: date, payers: Sequence[str] = fv.SWISS_SURVEY_PAYERS, topic: str = "feedback_follow_up_mss"
) -> DataFrame:
    """Swiss cases 16 to 21 days after an unanswered invitation."""
    exclusions = [ended(wh), talked(wh, topic)]
    return service_rows(_mss_follow_up(wh, as_of, like_any(F.col("payer_name"), payers), exclusions, 21), wh)


def ch_postal_legacy(wh: Warehouse, as_of: date, payers: Sequence[str] = fv.SWISS_POSTAL_PAYERS, mode: str = "parity") -> DataFrame:
    """Swiss postal cases in the week of their first visit, or two weeks after the final result.

    One row per case and date. Visits and result events are reduced to dates of the week before they
    meet the cases, so they never multiply. The date goes into the state column, as the ledger's
    older rows have it there.
    """
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    named = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("payer_name"))
    facts = wh["communication_facts"].filter(
        (F.col("channel_recommendation") == "postal") | F.col("email").isNull() | (F.col("email") == "")
    )
    finals = events_like(wh, "DID_SEND_FINAL").filter(F.col("service") == "MSS")
    first_visit = F.coalesce((F.col("visit_timing") == 1) & F.col("visit_date").isNotNull(), F.lit(False))
    only_first = wh["visits"].groupBy("case_id").agg(F.bool_and(first_visit).alias("_only")).filter("_only")
    in_week = in_iso_week_of(F.col("app_date"), F.lit(as_of), mode)
    by_visit = wh["visits"].filter(first_visit).select("case_id", F.col("visit_date").alias("app_date"))
    by_visit = by_visit.filter(in_week).join(finals.select("case_id"), "case_id", "left_semi")
    by_result = finals.select("case_id", F.date_add(F.col("event_time").cast("date"), 14).alias("app_date"))
    by_result = by_result.filter(in_week).join(only_first.select("case_id"), "case_id", "left_anti")
    dates = by_visit.unionByName(by_result).distinct()
    cases = (
        wh["services"]
        .select("case_id", "contract_id", "voucher_code")
        .join(contracts, "contract_id")
        .join(named.filter(like_any(F.col("payer_name"), payers)), "payer_id")
        .join(facts.select("case_id", "preferred_language"), "case_id")
        .join(dates, "case_id")
    )
    chosen = first_per_key(cases, ["case_id", "app_date"], [F.col("payer_name"), F.col("voucher_code").asc_nulls_last()])
    dated = chosen.withColumn("app_state", F.col("app_date").cast("string"))
    return service_rows(dated, wh, "append", key=("case_id", "app_date"))


def _moved_cards(
    wh: Warehouse, board: str, card_list: str, first: str, last: str, case_prefix: str = ""
) -> DataFrame:
    """Cards moved into a list of a board within a time span, of cases whose id starts so."""
    return wh["card_log"].filter(
        (F.col("action_type") == "moveCardToBoard")
        & (F.col("board") == board)
        & (F.col("list") == card_list)
        & F.col("case_id").startswith(case_prefix)
        & F.col("card_create_timestamp").between(
            F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")
        )
    )


def call_services_mss(
    wh: Warehouse,
    as_of: date,
    payer: str,
    topic: str = "feedback_follow_up_mss",
    moved: tuple[str, ...] | None = None,
) -> DataFrame:
    """Calls by payer for first-product cases whose survey stayed unanswered for 16 days."""
    exclusions = [refused(wh), talked(wh, topic), called(wh, [1, 2, 3, 8])]
    if moved is not None:
        exclusions.append(_moved_cards(wh, *moved))
    chosen = _mss_follow_up(wh, as_of, F.col("payer_name").like(payer), exclusions)
    return service_rows(chosen, wh)


def _pms_cases(
    wh: Warehouse,
    as_of: date,
    services: DataFrame,
    not_cam_ids: Sequence[int],
    oldest_months: int,
    topic: str = "feedback_follow_up",
    more_exclusions: Sequence[DataFrame] = (),
) -> DataFrame:
    """Second-product cases without answer, by survey age or, without own survey, result age.

    Cases to be reached by mail count follow-up surveys only, others every survey. Services are those
    of cases with a final result, as the join with its time leaves no others.
    """
    links = links_of(wh)
    finals = wh["workflow_events"].filter(F.col("event_type").startswith("DID_SEND_FINAL"))
    latest = latest_per_key(finals, "case_id", "event_time", F.col("event_time"), "final_at")
    exclusions = [
        surveyed(links),
        refused(wh),
        talked(wh, topic).filter(F.col("product").startswith("PMS")),
        called(wh, not_cam_ids),
        *more_exclusions,
    ]
    rows = services.filter(F.contains("service_id", F.lit(":PMS")))
    rows = exclude_any(rows, exclusions, "case_id", nulls="sql")
    title = F.col("title")
    own, follow_up = F.contains(title, F.lit("PMS")), title.like(fv.FOLLOW_UP_TITLE)
    facts = links.groupBy("case_id").agg(
        survey_class_of(PMS_CLASSES).alias("case_class"),
        F.min(F.when(own, F.col("created_at"))).alias("_any_at"),
        F.min(F.when(own & follow_up, F.col("created_at"))).alias("_follow_up_at"),
        F.bool_or(~own).alias("_any_other"),
        F.bool_or(~own & follow_up).alias("_other_follow_up"),
    )
    not_by_mail = F.col("channel_recommendation") != "email"
    invited = F.when(not_by_mail, F.col("_any_at")).otherwise(F.col("_follow_up_at"))
    other = F.when(not_by_mail, F.col("_any_other")).otherwise(F.col("_other_follow_up"))
    final_age = F.when(other, days_since(F.col("final_at"), as_of))
    joined = (
        rows.join(latest, "case_id")
        .join(facts, "case_id", "left")
        .withColumn("survey_age", F.greatest(days_since(invited, as_of), final_age))
    )
    # The last day counts until its first moment only.
    first, last = before(as_of, months=oldest_months), before(as_of, months=1)
    in_window = F.col("final_at").between(first.cast("timestamp_ntz"), last.cast("timestamp_ntz"))
    return _per_case(joined.filter((F.col("survey_age") > 16) & in_window))


def call_services_pms(wh: Warehouse, as_of: date, payer: str, moved: tuple[str, ...] | None = None) -> DataFrame:
    """Calls by payer for second-product cases; their classes name no state, so it stays empty."""
    services = suppression_list(live_services(wh).filter(F.col("payer_name").like(payer)), wh["suppression"])
    more = [_moved_cards(wh, *moved)] if moved is not None else []
    chosen = _pms_cases(wh, as_of, services, [1, 2, 3, 8], 12, more_exclusions=more)
    return service_rows(chosen.withColumn("app_state", ledger_state()), wh)


def vip_services(wh: Warehouse, as_of: date) -> DataFrame:
    services = live_services(wh).filter(F.contains("voucher_code", F.lit(fv.VIP_VOUCHER)))
    return _pms_cases(wh, as_of, services, [1, 2, 3, 8, -1], 5).withColumn(
        "app_state", ledger_state()
    )


def vip_cases(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """VIP cases of both systems before numbering."""
    columns = ["case_id", "client_name", "first_voucher_code", "app_state", "korb"]
    inquiries = vip_inquiries(wh, as_of, mode).withColumnsRenamed(
        {"voucher_client": "client_name", "voucher_code": "first_voucher_code"}
    )
    services = (
        vip_services(wh, as_of)
        .withColumnsRenamed({"payer_name": "client_name", "voucher_code": "first_voucher_code"})
        .withColumn("korb", F.lit(None).cast("string"))
    )
    both = inquiries.select(*columns).withColumn("branch", F.lit("inquiries"))
    return both.unionByName(services.select(*columns).withColumn("branch", F.lit("services")))


def vip(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """VIP cases of both systems, numbered after the union so that ids stay unique."""
    return numbered_rows(vip_cases(wh, as_of, mode), wh["cam_select"], key=("case_id", "branch"))


def weekly_ch_cases(wh: Warehouse, as_of: date) -> DataFrame:
    """Swiss cases 17 days after their last survey, or postal ones two weeks after the result."""
    cube = wh["case_cube"].filter(
        (F.col("payer_group") == "kv")
        & (F.col("result_date") > before(as_of, months=6))
        & (F.col("product") == "MSS")
        & F.col("inquiry_type").isin(*fv.WEEKLY_TREATMENTS)
    )
    cube = cube.select("case_id", "service_id", "voucher_code", "inquiry_type", "payer_name", "result_date")
    answered = links_of(wh).filter(F.col("title").ilike(fv.FOLLOW_UP_TITLE) & F.col("response_status").isNotNull())
    started = contacts(ledger_of(wh), cam_ids=[fv.CAM_WEEKLY_CH])
    cube = exclude_any(cube, [started, answered, ended(wh)], "case_id")
    sends = pivot_events(
        wh["workflow_events"].filter(F.col("case_id").isNotNull()),
        {"status_sent": "DID_SEND_STATUS_SURVEY", "prem_sent": "DID_SEND_PREM_SURVEY"},
        at="event_date",
    )
    people = wh["pii"].select("service_id", "preferred_channel", "preferred_language")
    joined = (
        cube.join(wh["report_flags"], "service_id", "left")
        .join(people, "service_id", "left")
        .join(sends, "case_id", "left")
    )
    last_sent = F.greatest("status_sent", "prem_sent")
    by_mail = (days_since(last_sent, as_of) >= 17) & null_or(F.col("qualimed"), F.col("qualimed") == "nein")
    by_post = (F.col("preferred_channel") == "postal") & (F.col("result_date") < before(as_of, weeks=2))
    order = [F.col("result_date").desc_nulls_first(), F.col("service_id")]
    return first_per_key(joined.filter(by_mail | by_post), ["case_id"], order)


def weekly_ch(wh: Warehouse, as_of: date) -> DataFrame:
    return service_rows(weekly_ch_cases(wh, as_of), wh)


def weekly_ch_run(wh: Warehouse, root: str, as_of: date) -> tuple[DataFrame, DataFrame] | None:
    """One Swiss weekly run: written ledger rows and the cases of its cards, or None without cases."""
    chosen = weekly_ch_cases(wh, as_of)
    return weekly_run(wh, root, as_of, fv.CAM_WEEKLY_CH, chosen, lambda cases: service_rows(cases, wh), cards="weekly_cards_ch")


def ch_survey_list(
    wh: Warehouse, as_of: date, payers: Sequence[str] = fv.SWISS_LIST_PAYERS, topic: str = "feedback_follow_up_mss"
) -> DataFrame:
    """Oldest form of the Swiss survey list: card rows instead of ledger rows."""
    exclusions = [ended(wh), talked(wh, topic)]
    due = _mss_follow_up(wh, as_of, like_any(F.col("payer_name"), payers), exclusions, 21)
    return due.select(
        "case_id",
        F.col("payer_name").alias("voucher_client_name"),
        F.col("voucher_code").alias("first_voucher_code"),
        "app_state",
        F.col("invited_at").cast("date").alias("app_date"),
        F.lit("Tel. Nachbefragung").alias("parameter"),
        F.lit(as_of).alias("card_created"),
        F.lit("waiting_q3").alias("korb"),
        "preferred_language",
    )


def product_matches_event(product: Column, event_product: Column) -> Column:
    """The result event names the product of the service.

    The body is opened once a row, and only where a rule knows the product. The rule on the product
    alone follows from the whole one; it is named for joins, which apply it before they meet the body.
    """
    known = any_of(product.like(p) for p, _ in fv.PRODUCT_EVENTS)
    names = F.struct(product.alias("product"), event_product.alias("event"))
    return known & with_value(
        names, lambda n: any_of(n["product"].like(p) & n["event"].like(e) for p, e in fv.PRODUCT_EVENTS)
    )


def partial_feedback(wh: Warehouse, product: str = "%MSS%") -> DataFrame:
    """Cases of a product with a final result and neither service nor medic score.

    Each event body is opened once: a case and date get one flag per product name.
    """
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    payers = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("payer_brand"))
    body = F.col("event_body")
    named = F.col("event_product")
    finals = (
        events_like(wh, "DID_SEND_FINAL")
        .select(
            "case_id",
            json_text(body, "$.properties.product").alias("event_product"),
            parse_day_first(json_text(body, "$.properties.date")).alias("results_date"),
        )
        .groupBy("case_id", "results_date")
        .agg(*[F.bool_or(named.like(e)).alias(f"names_{i}") for i, (_, e) in enumerate(fv.PRODUCT_EVENTS)])
    )
    product_named = any_of(
        F.col("product").like(p) & F.col(f"names_{i}") for i, (p, _) in enumerate(fv.PRODUCT_EVENTS)
    )
    services = (
        not_deleted(wh["services"])
        .filter(F.col("product").like(product))
        .select("case_id", "product", "contract_id")
        .join(finals, "case_id")
        .filter(product_named)
        .join(contracts, "contract_id", "left")
        .join(payers, "payer_id", "left")
        .select("case_id", "product", "payer_brand", "results_date")
        .distinct()
    )
    cases = wh["services"].select(F.col("id").alias("service_id"), "case_id")
    scored = wh["feedbacks"].select("service_id", "nps").join(cases, "service_id")
    service_flags = presence_flag(scored, "case_id", "nps", "service_score_flag")
    medic = wh["visits"].filter(F.col("visit_nps").isNotNull())
    medic_flags = presence_flag(medic, "case_id", "visit_nps", "medic_score_flag")
    opinion_flags = presence_flag(wh["opinions"], "case_id", "therapy_decision", "opinion_flag")
    return (
        services.join(service_flags, "case_id", "left")
        .join(medic_flags, "case_id", "left")
        .filter(F.col("service_score_flag").isNull() & F.col("medic_score_flag").isNull())
        .join(opinion_flags, "case_id", "left")
        .orderBy(F.col("results_date").asc_nulls_last(), "case_id")
    )


def latest_prom(wh: Warehouse, payer: str = fv.PROM_PAYER) -> DataFrame:
    """Cases whose latest outcome survey is unanswered, with its age class.

    Surveys and results are cut to the latest per case before they are joined.
    """
    contracts = wh["contracts"].select(F.col("id").alias("contract_id"), "payer_id")
    payers = wh["payers"].select(F.col("id").alias("payer_id"), F.col("name").alias("payer_brand"))
    result_day = parse_day_first(json_text(F.col("event_body"), "$.properties.date"))
    finals = events_like(wh, "DID_SEND_FINAL").groupBy("case_id").agg(F.max(result_day).alias("result_day"))
    order = [F.col("created_at").desc_nulls_first(), F.col("response_status").asc_nulls_last(), F.col("title")]
    newest = first_per_key(links_of(wh).filter(F.contains("title", F.lit("PROM"))), ["case_id"], order)
    latest = (
        not_deleted(wh["services"])
        .filter(F.col("product") == "MSS")
        .select("case_id", "product", "contract_id")
        .join(contracts, "contract_id")
        .join(payers.filter(F.col("payer_brand").like(payer)), "payer_id")
        .join(newest.filter(F.col("response_status").isNull()), "case_id")
        .join(finals, "case_id")
        .withColumn("time_diff", F.datediff(F.col("created_at"), F.col("result_day")))
    )
    kind = prom_age_bucket(F.col("time_diff"))
    return latest.select("case_id", "product", "payer_brand", "time_diff", kind.alias("prom_type"), "title")
