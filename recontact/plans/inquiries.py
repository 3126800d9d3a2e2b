"""Telephone and postal follow-up of the inquiry system.

``excluded_clients`` names the clients that are never called: ``WEEKLY_EXCLUDED_CLIENTS`` and the staff's
own, which only the caller knows, so it has no default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.dates import (
    appointment_date,
    before,
    days_since,
    in_previous_iso_week,
    iso_week_due,
)
from recontact.functions.nested import json_list_empty
from recontact.functions.text import any_of, flag, null_or
from recontact.operators.dedupe import first_per_key
from recontact.operators.ledger import numbered_rows
from recontact.operators.suppress import contacts, exclude_any, exclude_keys, suppress, suppression_list
from recontact.operators.vouchers import allowed_voucher, first_voucher, head_voucher, voucher_columns
from recontact.plans.common import ledger_of, weekly_run
from recontact.sources.history import not_deleted
from recontact.sources.warehouse import Warehouse


def appointments(wh: Warehouse) -> DataFrame:
    return wh["appointments"].select(
        F.col("inquiry_id").alias("id"), "appointment_type", F.col("state").alias("app_state"), "scheduled_date"
    )


def answered(wh: Warehouse) -> DataFrame:
    """Inquiries with an answered third questionnaire."""
    return wh["contact_entries"].filter(F.col("q3_result").isNotNull()).select(F.col("inquiry_id").alias("id"))


def with_open_entry(inquiries: DataFrame, wh: Warehouse) -> DataFrame:
    """Inquiries without any contact entry or with at least one entry that has no result.

    The older lists join the entries and keep rows without result; only the existence matters, so
    the entries are reduced to one flag per inquiry.
    """
    entries = (
        wh["contact_entries"]
        .groupBy(F.col("inquiry_id").alias("id"))
        .agg(F.bool_or(F.col("q3_result").isNull()).alias("_open"))
    )
    return inquiries.join(entries, "id", "left").filter(null_or(F.col("_open"), F.col("_open"))).drop("_open")


def without_completed(df: DataFrame, wh: Warehouse) -> DataFrame:
    done = appointments(wh).filter((F.col("appointment_type") == "3") & (F.col("app_state") == "completed"))
    return exclude_keys(df, done, "id", nulls="sql")


def call_appointments(wh: Warehouse, states: Sequence[str] = ("sent", "call_patient")) -> DataFrame:
    return appointments(wh).filter((F.col("appointment_type") == "3") & F.col("app_state").isin(*states))


def with_result_date(inquiries: DataFrame, wh: Warehouse) -> DataFrame:
    return inquiries.join(wh["inquiry_results"], "service_id", "left")


def weekly_date() -> Column:
    """Reference day of the weekly process: result for calls, scheduled day once sent, else sending."""
    return (
        F.when(F.col("app_state") == "call_patient", F.col("least_result_date"))
        .when(F.col("app_state") == "sent", F.col("scheduled_date"))
        .otherwise(F.col("results_sent_at").cast("date"))
    )


def weekly_due(as_of: date, mode: str) -> Column:
    day = F.col("app_date")
    return ((F.col("app_state") == "sent") & iso_week_due(day, 5, as_of, mode)) | (
        (F.col("app_state") == "call_patient") & iso_week_due(day, 6, as_of, mode)
    )


def appointment_order() -> list[Column]:
    names = ("app_state", "voucher_client", "app_date", "voucher_id")
    return [F.col(n).asc_nulls_last() for n in names]


def inquiry_rows(
    df: DataFrame, wh: Warehouse, batch: str = "new", language: str | None = None, key: Sequence[str] = ("case_id",)
) -> DataFrame:
    """Ledger rows of inquiries; the patient is unknown there."""
    mapping = {
        "client_name": F.col("voucher_client"),
        "first_voucher_code": F.col("voucher_code"),
        "patient_id": F.lit(None),
        "preferred_language": F.lit(language),
    }
    return numbered_rows(df, wh["cam_select"], mapping, key, batch)


def _weekly_candidates(wh: Warehouse, excluded_clients: Sequence[str]) -> DataFrame:
    inquiries = wh["inquiries"].filter(
        (F.col("state") == "waiting_q3") & F.col("treatment_type").isin(*fv.WEEKLY_TREATMENTS)
    )
    open_cases = exclude_keys(inquiries, answered(wh), "id", nulls="admit")
    rows = head_voucher(
        with_result_date(open_cases, wh).join(call_appointments(wh), "id"), wh["voucher_dim"]
    ).filter(allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS))
    dated = rows.withColumns({"app_date": weekly_date(), "korb": F.col("state")})
    return first_per_key(dated, ["case_id"], appointment_order())


def weekly_calls(
    wh: Warehouse,
    as_of: date,
    mode: str = "parity",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Open second-opinion and surgery cases whose call is due this week."""
    return _weekly_candidates(wh, excluded_clients).filter(weekly_due(as_of, mode))


def _postal(wh: Warehouse, in_week: Column, voucher_rule: Column, order: Sequence[Column]) -> DataFrame:
    inquiries = wh["inquiries"].filter(F.col("state").isin(*fv.POSTAL_STATES))
    by_post = wh["patient_data"].filter(F.col("preferred_communication_channel") == "post")
    due = appointments(wh).filter(
        ~F.col("appointment_type").isin("1", "2") & (F.col("app_state") == "ready_to_send_pdf") & in_week
    )
    plain = wh["insurance_data"].filter(json_list_empty(F.col("options")))
    rows = (
        inquiries.join(due, "id")
        .join(by_post.select(F.col("inquiry_id").alias("id")), "id", "left_semi")
        .join(plain.select(F.col("inquiry_id").alias("id")), "id", "left_semi")
    )
    kept = head_voucher(rows, wh["voucher_dim"]).filter(
        voucher_rule & (F.col("voucher_client") != fv.POSTAL_EXCLUDED_CLIENT)
    )
    dated = kept.withColumns({"korb": F.col("state"), "app_date": F.col("scheduled_date")})
    return first_per_key(dated, ["case_id"], order)


def _last_week(as_of: date, mode: str) -> Column:
    return in_previous_iso_week(F.col("scheduled_date"), as_of, mode)


def _postal_order() -> list[Column]:
    names = ("scheduled_date", "appointment_type", "voucher_id")
    return [F.col(n).asc_nulls_last() for n in names]


def postal_cases(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """Cases whose printed questionnaire was due last week: one client in full, else by treatment."""
    rule = F.col("voucher_code").isNotNull() & (
        (F.col("voucher_client") == fv.POSTAL_CLIENT) | F.col("treatment_type").isin(*fv.WEEKLY_TREATMENTS)
    )
    return _postal(wh, _last_week(as_of, mode), rule, _postal_order())


def postal_to_complete(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """The other cases of that week, to be closed by hand."""
    rule = ~F.contains(F.col("voucher_client"), F.lit(fv.POSTAL_CLIENT)) & ~F.col("treatment_type").isin(
        *fv.WEEKLY_TREATMENTS
    )
    order = [F.col("korb").asc_nulls_last(), *_postal_order()]
    rows = _postal(wh, _last_week(as_of, mode), rule, order)
    return rows.select("case_id", F.col("voucher_client").alias("client_name"), "app_state", "treatment_type")


def postal_window(wh: Warehouse, as_of: date, days: int = 8) -> DataFrame:
    """Earlier form: any treatment and client, scheduled within the last days."""
    window = F.col("scheduled_date").between(before(as_of, days=days), before(as_of, days=1))
    rows = _due_letters(wh, window).select(
        "case_id",
        F.col("scheduled_date").alias("app_date"),
        F.col("voucher_client").alias("voucher_client_name"),
        F.col("voucher_code").alias("first_voucher_code"),
        "treatment_type",
        F.col("state").alias("korb"),
        "appointment_type",
        "app_state",
        F.lit("Tel. Nachbefragung").alias("parameter"),
        F.lit(as_of).alias("card_created"),
        F.lit("de").alias("preferred_language"),
        "voucher_id",
    )
    return rows.distinct().drop("voucher_id")


def _due_letters(wh: Warehouse, when: Column) -> DataFrame:
    """Open postal cases with a printed questionnaire due in the time, one row per voucher."""
    inquiries = wh["inquiries"].filter(F.col("state").isin(*fv.POSTAL_STATES))
    by_post = wh["patient_data"].filter(F.col("preferred_communication_channel") == "post")
    plain = wh["insurance_data"].filter(json_list_empty(F.col("options")))
    due = appointments(wh).filter(
        ~F.col("appointment_type").isin("1", "2") & (F.col("app_state") == "ready_to_send_pdf") & when
    )
    rows = (
        inquiries.join(due, "id")
        .join(by_post.select(F.col("inquiry_id").alias("id")), "id", "left_semi")
        .join(plain.select(F.col("inquiry_id").alias("id")), "id", "left_semi")
        .withColumn("voucher_id", F.explode("voucher_ids"))
    )
    named = rows.join(voucher_columns(wh["voucher_dim"]), "voucher_id")
    return named.filter(F.col("voucher_client") != fv.POSTAL_EXCLUDED_CLIENT)


def postal_per_voucher(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """Older postal form: last week's letters of one client or for second opinions, a row per voucher,
    added to the open batch."""
    rule = F.col("voucher_client").like(fv.POSTAL_CLIENT) | (F.col("treatment_type") == "second_opinion_before_surgery")
    keys = ["case_id", "scheduled_date", "voucher_id", "treatment_type", "korb", "appointment_type", "app_state"]
    rows = _due_letters(wh, _last_week(as_of, mode)).filter(rule).withColumn("korb", F.col("state"))
    rows = rows.select(*keys, "voucher_client", "voucher_code").distinct()
    return inquiry_rows(rows, wh, "append", "de", key=keys)


LEDGER_INPUT = ["case_id", "voucher_client", "voucher_code", "app_state", "korb"]


def weekly_de_chosen(
    wh: Warehouse,
    as_of: date,
    mode: str = "parity",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Calls and postal cases of the week, one row per case."""
    none, post = F.lit(None).cast("string").alias("post"), F.lit("post").alias("post")
    calls = weekly_calls(wh, as_of, mode, excluded_clients=excluded_clients).select(*LEDGER_INPUT, none)
    postal = postal_cases(wh, as_of, mode).select(*LEDGER_INPUT, post)
    return first_per_key(calls.unionByName(postal), ["case_id"], [F.col("post").asc_nulls_first()])


def weekly_de(wh: Warehouse, as_of: date, mode: str = "parity", **rules) -> DataFrame:
    return inquiry_rows(weekly_de_chosen(wh, as_of, mode, **rules), wh, language="de")


def weekly_de_cases(
    wh: Warehouse, as_of: date, mode: str = "parity", chosen: DataFrame | None = None, **rules
) -> DataFrame:
    """The week's cases with what their cards need from the cube, which the cases filter first.

    ``chosen`` are cases that were selected before, so ledger and cards of a run agree.
    """
    chosen = weekly_de_chosen(wh, as_of, mode, **rules) if chosen is None else chosen
    cube = wh["case_cube"].filter(F.col("product") == "MSS")
    cube = cube.select("case_id", "admission_channel", "inquiry_type", "service_id")
    cube = cube.join(chosen.select("case_id"), "case_id", "left_semi")
    cube = first_per_key(cube, ["case_id"], [F.col("service_id").asc_nulls_last()]).drop("service_id")
    online = flag(F.col("admission_channel").isin(*fv.ONLINE_CHANNELS))
    return chosen.join(cube, "case_id", "left").withColumn("om_flag", online)


def weekly_de_run(wh: Warehouse, root: str, as_of: date, mode: str = "parity", **rules) -> tuple[DataFrame, DataFrame] | None:
    """One weekly run: written ledger rows and the cases of its cards, or None without cases."""
    return weekly_run(
        wh, root, as_of, fv.CAM_WEEKLY_DE, weekly_de_chosen(wh, as_of, mode, **rules),
        lambda chosen: inquiry_rows(chosen, wh, language="de"),
        lambda chosen: weekly_de_cases(wh, as_of, mode, chosen),
    )


def weekly_de_postal(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """Postal part alone, added to the batch that is open already."""
    return inquiry_rows(postal_cases(wh, as_of, mode), wh, batch="append", language="de")


def voucher_first() -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in ("voucher_id", "app_state", "app_date")]


def dated_by_sending(rows: DataFrame) -> DataFrame:
    """Appointment date with the day of sending as the day of the result."""
    sent = F.col("results_sent_at").cast("date")
    date_column = appointment_date(F.col("app_state"), sent, F.col("scheduled_date"))
    return rows.withColumns({"app_date": date_column, "korb": F.col("state")})


def _by_first_voucher(wh: Warehouse, cases: DataFrame, found: DataFrame, keep: Column) -> DataFrame:
    """First allowed voucher of a case with its first appointment. The voucher is chosen per inquiry
    before the appointments join, so vouchers and appointments never multiply."""
    vouchered = first_voucher(cases, wh["voucher_dim"], keep, key="id")
    return first_per_key(dated_by_sending(vouchered.join(found, "id")), ["case_id"], voucher_first())


def _open_second_opinions(wh: Warehouse) -> DataFrame:
    inquiries = wh["inquiries"].filter(
        (F.col("state") == "waiting_q3") & (F.col("treatment_type") == "second_opinion_before_surgery")
    )
    return without_completed(with_open_entry(inquiries, wh), wh)


def telephone_follow_up(
    wh: Warehouse,
    as_of: date,
    mode: str = "parity",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Earlier weekly form over all vouchers of a case: the first allowed voucher counts."""
    keep = allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS)
    rows = _by_first_voucher(wh, _open_second_opinions(wh), call_appointments(wh), keep)
    return inquiry_rows(rows.filter(weekly_due(as_of, mode)).drop("korb"), wh)


def vip_inquiries(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """VIP cases by the weekly rule, never with a completed appointment."""
    rows = with_result_date(_open_second_opinions(wh), wh).join(call_appointments(wh), "id")
    keep = F.contains("voucher_code", F.lit(fv.VIP_VOUCHER)) & allowed_voucher((), fv.WEEKLY_EXCLUDED_VOUCHERS)
    vip = head_voucher(rows, wh["voucher_dim"]).filter(keep)
    dated = vip.withColumns({"app_date": weekly_date(), "korb": F.col("state")})
    return first_per_key(dated, ["case_id"], appointment_order()).filter(weekly_due(as_of, mode))


def vip_vouchers(wh: Warehouse, as_of: date, mode: str = "parity") -> DataFrame:
    """Earlier VIP form over all vouchers of a case."""
    keep = F.contains("voucher_code", F.lit(fv.VIP_VOUCHER)) & allowed_voucher((), fv.WEEKLY_EXCLUDED_VOUCHERS)
    rows = _by_first_voucher(wh, _open_second_opinions(wh), call_appointments(wh), keep)
    return inquiry_rows(rows.filter(weekly_due(as_of, mode)).drop("korb"), wh)


def cases_with(wh: Warehouse, found: DataFrame) -> DataFrame:
    """Cases of which any inquiry has one of the found appointments."""
    return wh["inquiries"].select("id", "case_id").join(found.select("id"), "id", "left_semi")


FINISHED_STATES = ("ready_to_send_pdf", "send_manually", "sent", "deleted")


def _second_survey_cases(wh: Warehouse, nulls: str) -> DataFrame:
    """Mail cases without answer, later appointments or calls."""
    all_appointments = appointments(wh)
    moved_on = all_appointments.filter(
        (F.col("appointment_type") == "3") & F.col("app_state").isin(*FINISHED_STATES)
    )
    later = all_appointments.filter(F.col("appointment_type").isin("4", "5", "6"))
    mail = wh["patient_data"].filter(
        (F.col("preferred_communication_channel") == "email") & F.col("status_survey_reminder_sent_at").isNull()
    )
    cases = wh["inquiries"].filter(F.col("state") == "waiting_q3")
    cases = exclude_any(cases, [answered(wh), moved_on], "id", nulls="sql")
    called = contacts(ledger_of(wh), not_cam_ids=[1, 2, 3, -1])
    cases = exclude_any(cases, [cases_with(wh, later), called], "case_id", nulls=nulls)
    return cases.join(mail.select(F.col("inquiry_id").alias("id")), "id", "left_semi")


def _unfinished_calls(wh: Warehouse) -> DataFrame:
    return appointments(wh).filter(
        (F.col("appointment_type") == "3") & ~F.col("app_state").isin(*FINISHED_STATES, "completed", "waiting")
    )


def second_status_survey(
    wh: Warehouse,
    as_of: date,
    mode: str = "parity",
    nulls: str = "sql",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Second status survey five weeks after the first result."""
    cases = with_result_date(_second_survey_cases(wh, nulls), wh)
    rows = head_voucher(cases.join(_unfinished_calls(wh), "id"), wh["voucher_dim"])
    rows = rows.filter(allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS))
    order = [F.col(c).asc_nulls_last() for c in ("least_result_date", "app_state", "id")]
    chosen = first_per_key(rows, ["case_id"], order)
    return inquiry_rows(chosen.filter(iso_week_due(F.col("least_result_date"), 5, as_of, mode)), wh)


def reminder_status_survey(
    wh: Warehouse,
    as_of: date,
    mode: str = "parity",
    nulls: str = "sql",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Earlier form of the second survey: first allowed voucher, five weeks after sending."""
    keep = allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS)
    rows = _by_first_voucher(wh, _second_survey_cases(wh, nulls), _unfinished_calls(wh), keep).drop("korb")
    return inquiry_rows(rows.filter(iso_week_due(F.col("results_sent_at").cast("date"), 5, as_of, mode)), wh)


def second_try_weekly(
    wh: Warehouse,
    as_of: date,
    nulls: str = "sql",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Second call for cases of the last six months, nine weeks after their appointment."""
    main, additional = F.col("completion_reason_main"), F.col("completion_reason_additional")
    willing = ~main.isin(*fv.SECOND_TRY_MAIN_REASONS) | ~additional.isin(*fv.SECOND_TRY_ADDITIONAL_REASONS)
    inquiries = wh["inquiries"].filter(
        F.col("state").isin("waiting_q3", "completed")
        & (F.col("treatment_type") == "second_opinion_before_surgery")
        & willing
    )
    fresh = suppress(with_open_entry(inquiries, wh), ledger_of(wh), cam_ids=[fv.CAM_SECOND_TRY], nulls=nulls)
    keep = allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS)
    found = call_appointments(wh, ("completed", "sent", "call_patient"))
    chosen = _by_first_voucher(wh, fresh, found, keep).filter(
        (F.col("app_date") < before(as_of, weeks=9))
        & (F.col("app_date") > before(as_of, months=6))
        & ~F.col("voucher_code").isin(*fv.GOODWILL_VOUCHERS)
    )
    return inquiry_rows(chosen.drop("korb"), wh)


def _callable_inquiries(wh: Warehouse) -> DataFrame:
    """Waiting or completed cases without answer that may be asked."""
    reason = F.col("completion_reason_main")
    inquiries = wh["inquiries"].filter(
        F.col("state").isin("waiting_q3", "completed")
        & (F.col("treatment_type") != "second_opinion_before_surgery")
        & null_or(reason, reason == "internal_reason")
    )
    listed = suppression_list(inquiries, wh["suppression"])
    return exclude_keys(listed, answered(wh), "id", nulls="sql")


def _callable_appointments(wh: Warehouse) -> DataFrame:
    return appointments(wh).filter(
        (F.col("appointment_type") == "3")
        & ~F.col("app_state").isin("ready_to_send_pdf", "send_manually", "completed", "waiting")
    )


def rolling_windows(as_of: date) -> dict[str, tuple[Column, Column]]:
    """Date window per appointment state: deleted to today, calls to six, sent to five weeks ago."""
    start = before(as_of, months=6)
    return {
        "deleted": (start, F.lit(as_of)),
        "call_patient": (start, before(as_of, weeks=6)),
        "sent": (start, before(as_of, weeks=5)),
    }


def fixed_windows(start: date, deleted: date, call_patient: date, sent: date) -> dict[str, tuple[Column, Column]]:
    ends = {"deleted": deleted, "call_patient": call_patient, "sent": sent}
    return {state: (F.lit(start), F.lit(end)) for state, end in ends.items()}


def _in_windows(windows: Mapping[str, tuple[Column, Column]]) -> Column:
    """OR over states of date windows; deleted appointments need a completed case."""
    rules = []
    for state, (first, last) in windows.items():
        rule = (F.col("app_state") == state) & F.col("app_date").between(first, last)
        rules.append(rule & (F.col("korb") == "completed") if state == "deleted" else rule)
    return any_of(rules)


def call_legacy(
    wh: Warehouse,
    as_of: date,
    payer: str,
    windows: Mapping[str, tuple[Column, Column]] | None = None,
    nulls: str = "sql",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Calls by payer with a date window per state, without earlier calls or a second survey this week."""
    rows = head_voucher(_callable_inquiries(wh).join(_callable_appointments(wh), "id"), wh["voucher_dim"])
    rows = rows.filter(allowed_voucher(excluded_clients, fv.CALL_EXCLUDED_VOUCHERS))
    rows = dated_by_sending(rows.filter(F.col("voucher_client").ilike(payer)))
    chosen = first_per_key(rows, ["case_id"], appointment_order()).filter(_in_windows(windows or rolling_windows(as_of)))
    this_week = F.col("batch_selection_date") >= F.trunc(F.lit(as_of), "week")
    surveyed = (F.col("cam_id") == fv.CAM_SECOND_STATUS_SURVEY) & this_week
    taken = contacts(ledger_of(wh), when=~F.col("cam_id").isin(1, 2, 3, -1, 8) | surveyed)
    fresh = exclude_keys(chosen, taken, "case_id", nulls=nulls)
    return inquiry_rows(fresh.drop("korb"), wh)


def call_fixed_dates(
    wh: Warehouse,
    windows: Mapping[str, tuple[Column, Column]],
    payer: str,
    as_of: date,
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Oldest form of the call list: fixed windows, first allowed voucher, no ledger."""
    channel = wh["patient_data"].select(
        F.col("inquiry_id").alias("id"), F.col("preferred_communication_channel").alias("channel")
    )
    keep = allowed_voucher(excluded_clients, fv.CALL_EXCLUDED_VOUCHERS)
    chosen = _by_first_voucher(wh, _callable_inquiries(wh), _callable_appointments(wh), keep)
    chosen = chosen.join(channel, "id", "left")
    return chosen.filter(F.col("voucher_client").like(payer) & _in_windows(windows)).select(
        "case_id",
        F.col("voucher_client").alias("voucher_client_name"),
        F.col("voucher_code").alias("first_voucher_code"),
        "channel",
        "app_state",
        "app_date",
        F.lit(fv.CATEGORY_CALL).alias("parameter"),
        F.lit(as_of).alias("card_created"),
        "korb",
        "completion_reason_main",
        "completion_reason_additional",
        "completion_details",
        F.lit("de").alias("preferred_language"),
    )


def call_q4_q6(wh: Warehouse, payer: str) -> DataFrame:
    """Sent later questionnaires of one payer, added to the open batch."""
    inquiries = wh["inquiries"].filter(F.col("state").isin("waiting_q4", "waiting_q5", "waiting_q6"))
    sent = appointments(wh).filter(~F.col("appointment_type").isin("1", "2") & (F.col("app_state") == "sent"))
    plain = wh["insurance_data"].filter(json_list_empty(F.col("options")))
    people = wh["patient_data"].select(F.col("inquiry_id").alias("id"))
    rows = (
        inquiries.join(sent, "id")
        .join(plain.select(F.col("inquiry_id").alias("id")), "id", "left_semi")
        .join(people, "id", "left_semi")
    )
    named = head_voucher(rows, wh["voucher_dim"]).filter(F.col("voucher_client").like(payer))
    cases = named.select(
        "id",
        "case_id",
        "scheduled_date",
        "voucher_id",
        "treatment_type",
        F.col("state").alias("korb"),
        "appointment_type",
        "app_state",
        "voucher_client",
        "voucher_code",
    ).distinct()
    return inquiry_rows(cases, wh, "append", "de", key=("case_id", "id", "scheduled_date", "appointment_type"))


def weekly_de_fixed_dates(
    wh: Warehouse,
    as_of: date,
    call_week: tuple[date, date],
    sent_week: tuple[date, date],
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Weekly process by given weeks and a minimum age, before it followed the calendar."""
    open_cases = not_deleted(_open_second_opinions(wh))
    rows = head_voucher(open_cases.join(call_appointments(wh), "id"), wh["voucher_dim"])
    rows = rows.filter(allowed_voucher(excluded_clients, fv.CALL_EXCLUDED_VOUCHERS))
    dated = dated_by_sending(rows)
    age, day, state = days_since(F.col("app_date"), as_of), F.col("app_date"), F.col("app_state")
    due = ((state == "call_patient") & (age > 35) & day.between(*map(F.lit, call_week))) | (
        (state == "sent") & (age > 28) & day.between(*map(F.lit, sent_week))
    )
    return (
        dated.filter(due)
        .select(
            "case_id",
            F.col("voucher_client").alias("voucher_client_name"),
            F.col("voucher_code").alias("first_voucher_code"),
            "app_state",
            "app_date",
            F.lit("Tel. Nachbefragung").alias("parameter"),
            F.lit(as_of).alias("card_created"),
            F.col("state").alias("korb"),
            F.lit("de").alias("preferred_language"),
        )
        .distinct()
    )


def status_vs_card_cleaning(
    wh: Warehouse,
    since: date,
    board: str,
    card_list: str,
    transaction: str = "action_create_card",
    *,
    excluded_clients: Sequence[str],
) -> DataFrame:
    """Waiting cases whose appointments are all completed although no card was ever created."""
    every = appointments(wh)
    later = every.filter(F.col("appointment_type").isin("4", "5", "6"))
    unfinished = every.filter(F.col("app_state") != "completed")
    cases = wh["inquiries"].filter(F.col("state") == "waiting_q3")
    created_cards = wh["card_log"].filter(
        (F.col("board") == board) & (F.col("list") == card_list) & (F.col("transaction_name") == transaction)
    )
    gone = [cases_with(wh, later.unionByName(unfinished)), created_cards]
    cases = exclude_any(with_open_entry(cases, wh), gone, "case_id", nulls="sql")
    done = every.filter((F.col("appointment_type") == "3") & (F.col("app_state") == "completed"))
    keep = allowed_voucher(excluded_clients, fv.WEEKLY_EXCLUDED_VOUCHERS)
    chosen = _by_first_voucher(wh, cases, done, keep).drop("korb")
    late = chosen.filter(F.col("results_sent_at").cast("date") > F.lit(since))
    rows = inquiry_rows(late, wh)
    # The list shows the result date beside the ledger row; a case has one row.
    return rows.join(late.select("case_id", F.col("results_sent_at").cast("date").alias("results_sent_at")), "case_id")
