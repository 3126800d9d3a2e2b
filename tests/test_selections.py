"""Selections on small hand-written warehouses, each case named by what happens to it."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.functions.pii import encrypt_text
from recontact.plans import calls, existing, inquiries, reviews, services
from recontact.plans.single_question import single_question, single_question_list
from recontact.sources.warehouse import frame_warehouse

AS_OF = date(2024, 6, 12)


def frame(spark, schema, rows, **defaults):
    """Rows as dicts over defaults; names and types from a DDL text."""
    names = [part.strip().split(" ")[0] for part in schema.replace("array<long>", "array_long").split(",")]
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schema)


def campaign_tables(spark, contacts):
    """contacts: (case id, campaign, selection date)."""
    select = [(i + 1, i + 1, c[0]) for i, c in enumerate(contacts)]
    batch = [(c[1], i + 1, c[2]) for i, c in enumerate(contacts)]
    return {
        "cam_select": spark.createDataFrame(select, "select_id long, batch_id long, case_id string"),
        "cam_batch": spark.createDataFrame(batch, "cam_id int, batch_id long, batch_selection_date date"),
        "cam_cam": spark.createDataFrame(
            [(1, "Mailing"), (4, "Regelprozess"), (97, "Anrufaktion")], "cam_id int, cam_category string"
        ),
    }


def ids(df):
    return sorted(r.case_id for r in df.collect())


PHONE = (
    "case_id string, patient_id long, result_date date, payer_name string, payer_group string, voucher_code string, "
    "inquiry_type string, provider_nps int, medic_nps int, preferred_language string, product_v2 string, "
    "hard_exclusion boolean, questioning_inappropriate boolean, prem_return boolean, prem_result_return boolean, "
    "status_survey_latest_planned_at date, prem_latest_planned_at date, prem_latest_sent_at date, primary_phone string"
)
CALLABLE = dict(
    result_date=date(2024, 3, 1), payer_name="Some Payer", inquiry_type="surgery", product_v2="MSN",
    hard_exclusion=False, questioning_inappropriate=False, prem_return=False, prem_result_return=False,
)


def phone_warehouse(spark, rows, contacts):
    cube = frame(spark, PHONE, rows, **CALLABLE)
    return frame_warehouse(
        spark, {"phone_cube": cube, "case_cube": cube.select("case_id", "patient_id"), **campaign_tables(spark, contacts)}
    )


def test_call_list_rules(spark):
    rows = [
        dict(case_id="older", patient_id=1, result_date=date(2024, 2, 1)),
        dict(case_id="newer", patient_id=1),
        dict(case_id="no patient a"),
        dict(case_id="no patient b"),
        dict(case_id="called long ago", patient_id=2),
        dict(case_id="patient called recently", patient_id=3),
        dict(case_id="called recently", patient_id=3, result_date=date(2023, 1, 1)),
        dict(case_id="patient called long ago", patient_id=2, result_date=date(2024, 2, 2)),
        dict(case_id="mailed only", patient_id=4),
        dict(case_id="flag unknown", patient_id=5, hard_exclusion=None),
        dict(case_id="survey planned", patient_id=6, prem_latest_planned_at=date(2024, 6, 1)),
        dict(case_id="survey planned before", patient_id=7, prem_latest_planned_at=date(2024, 5, 28)),
        dict(case_id="too fresh", patient_id=8, result_date=date(2024, 5, 2)),
        dict(case_id="just old enough", patient_id=9, result_date=date(2024, 5, 1)),
        dict(case_id="second opinion", patient_id=10, inquiry_type="second_opinion_before_surgery"),
        dict(case_id="other payer", patient_id=11, payer_name="Else"),
    ]
    contacts = [
        ("called long ago", 97, date(2024, 1, 1)),
        ("called recently", 4, date(2024, 6, 1)),
        ("mailed only", 1, date(2024, 6, 1)),
        (None, 97, date(2024, 6, 1)),
    ]
    got = ids(calls.call_msn(phone_warehouse(spark, rows, contacts), AS_OF, "%PAYER%"))
    assert got == [
        "just old enough", "mailed only", "newer", "no patient a", "patient called long ago", "survey planned before",
    ]


def test_second_try_allows_one_earlier_call_for_second_opinions(spark):
    second = dict(inquiry_type="second_opinion_before_surgery")
    rows = [
        dict(case_id="surgery new", patient_id=1),
        dict(case_id="surgery called", patient_id=2),
        dict(case_id="opinion called once", patient_id=3, **second),
        dict(case_id="opinion called twice", patient_id=4, **second),
        dict(case_id="opinion called recently", patient_id=5, **second),
        dict(case_id="opinion new", patient_id=6, **second),
    ]
    contacts = [
        ("surgery called", 97, date(2024, 1, 1)),
        ("opinion called once", 97, date(2024, 1, 1)),
        ("opinion called twice", 97, date(2024, 1, 1)),
        ("opinion called twice", 4, date(2024, 2, 1)),
        ("opinion called recently", 97, date(2024, 6, 1)),
    ]
    wh = phone_warehouse(spark, rows, contacts)
    assert ids(calls.call_second_try_surgery(wh, AS_OF, "%")) == ["opinion called once", "opinion new", "surgery new"]


def test_call_list_with_an_empty_ledger(spark):
    wh = phone_warehouse(spark, [dict(case_id="a", patient_id=1)], [("x", 1, date(2020, 1, 1))])
    wh = frame_warehouse(
        spark,
        {n: wh[n] for n in ("phone_cube", "case_cube", "cam_batch", "cam_cam")} | {"cam_select": wh["cam_select"].limit(0)},
    )
    row = calls.call_msn(wh, AS_OF, "%").first()
    assert (row.select_id, row.batch_id, row.patient_id, row.control_flag) == (1, 1, "1", 0)


SINGLE = (
    "case_id string, service_id string, product string, patient_id long, result_date date, payer_name string, "
    "payer_group string, voucher_code string, admission_channel string, preferred_channel string, inquiry_type string, "
    "channel_reach_email boolean, therapy_group string, therapy string, result string, reporting_bool boolean, "
    "op_category int, cases_last_two_years int, inquiries_state string, appointment_type string, appointment_state string"
)
QUESTION = dict(
    product="MSS", result_date=date(2024, 1, 15), payer_group="gkv", preferred_channel="email", inquiry_type="surgery",
    channel_reach_email=True, therapy_group="Knie", therapy="x", reporting_bool=True, op_category=1,
    cases_last_two_years=1, inquiries_state="waiting_q3", appointment_type="3", appointment_state="sent",
)


@pytest.mark.parametrize("rule, kept", [("sql", []), ("guarded", ["fresh"])])
def test_single_question_and_a_contact_without_case(spark, rule, kept):
    cases = frame(spark, SINGLE, [dict(case_id="fresh"), dict(case_id="asked"), dict(case_id="old", therapy_group="Fuß")], **QUESTION)
    contacts = [("asked", 97, date(2024, 6, 1)), (None, 1, date(2024, 6, 1))]
    pii = spark.createDataFrame([], "service_id string, email string")
    wh = frame_warehouse(spark, {"single_question": cases, "pii": pii, **campaign_tables(spark, contacts)})
    assert ids(single_question(wh, AS_OF, nulls=rule)) == kept
    again = [r.random_order for r in single_question_list(wh, AS_OF, nulls="guarded").collect()]
    assert again == [r.random_order for r in single_question_list(wh, AS_OF, nulls="guarded").collect()]


def inquiry_warehouse(spark, cases, appointments, contacts=(("x", 97, date(2020, 1, 1)),), entries=(), mail=(), listed=()):
    schema = (
        "id long, case_id string, service_id string, state string, treatment_type string, results_sent_at date, "
        "voucher_ids array<long>, completion_reason_main string, completion_reason_additional string, deleted_at date"
    )
    defaults = dict(state="waiting_q3", treatment_type="surgery", results_sent_at=date(2024, 5, 1), voucher_ids=[1])
    rows = [dict(id=i, case_id=c["case_id"], service_id=c["case_id"]) | c for i, c in enumerate(cases)]
    number = {c["case_id"]: i for i, c in enumerate(cases)}
    return frame_warehouse(
        spark,
        {
            "inquiries": frame(spark, schema, rows, **defaults),
            "inquiry_results": spark.createDataFrame(
                [(c["case_id"], c.get("result")) for c in cases], "service_id string, least_result_date date"
            ),
            "appointments": spark.createDataFrame(
                [(number[c], t, s, d) for c, t, s, d in appointments],
                "inquiry_id long, appointment_type string, state string, scheduled_date date",
            ),
            "contact_entries": spark.createDataFrame(
                [(number[c], q) for c, q in entries], "inquiry_id long, q3_result string"
            ),
            "voucher_dim": spark.createDataFrame(
                [(1, "A-1", "Client"), (2, "VRTC-2", "Client"), (3, "X-BDTC", "Client"), (4, "A-4", "VIP ROT")],
                "id long, value string, client_name string",
            ),
            "patient_data": spark.createDataFrame(
                [(number[c], "post") for c in mail], "inquiry_id long, preferred_communication_channel string"
            ),
            "insurance_data": spark.createDataFrame([(number[c], "[]") for c in mail], "inquiry_id long, options string"),
            "suppression": spark.createDataFrame([(c, "objection") for c in listed], "case_id string, reason string"),
            "case_cube": spark.createDataFrame(
                [], "case_id string, product string, admission_channel string, inquiry_type string, service_id string"
            ),
            **campaign_tables(spark, list(contacts)),
        },
    )


def test_weekly_process(spark):
    due, later = date(2024, 5, 8), date(2024, 5, 20)
    cases = [
        dict(case_id="sent due"),
        dict(case_id="sent later"),
        dict(case_id="call due", result=date(2024, 5, 1)),
        dict(case_id="call first, not due", result=later),
        dict(case_id="answered"),
        dict(case_id="entry without result"),
        dict(case_id="staff voucher", voucher_ids=[3]),
        dict(case_id="vip client", voucher_ids=[4]),
        dict(case_id="no voucher", voucher_ids=[]),
        dict(case_id="conservative", treatment_type="conservative"),
        dict(case_id="letter"),
    ]
    appointments = [(c["case_id"], "3", "sent", due) for c in cases if c["case_id"] not in ("sent later", "call due", "letter")]
    appointments += [
        ("sent later", "3", "sent", later),
        ("call due", "3", "call_patient", None),
        ("call first, not due", "3", "call_patient", None),
        ("letter", "3", "ready_to_send_pdf", date(2024, 6, 5)),
        ("sent due", "3", "ready_to_send_pdf", date(2024, 6, 5)),
    ]
    entries = [("answered", "ok"), ("answered", None), ("entry without result", None)]
    wh = inquiry_warehouse(spark, cases, appointments, entries=entries, mail=["letter", "sent due"])
    rows = inquiries.weekly_de_cases(wh, AS_OF, excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS).collect()
    assert sorted(r.case_id for r in rows) == ["call due", "entry without result", "letter", "sent due"]
    assert {r.case_id: r.post for r in rows}["letter"] == "post"
    assert {r.case_id: r.post for r in rows}["sent due"] is None
    assert {r.om_flag for r in rows} == {0}
    written = inquiries.weekly_de(wh, AS_OF, excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS).collect()
    assert sorted(r.select_id for r in written) == [2, 3, 4, 5]
    assert {(r.batch_id, r.preferred_language, r.patient_id) for r in written} == {(2, "de", None)}


def test_weekly_process_across_new_year(spark):
    cases = [dict(case_id="before"), dict(case_id="after")]
    appointments = [("before", "3", "sent", date(2024, 11, 26)), ("after", "3", "sent", date(2024, 11, 28))]
    wh = inquiry_warehouse(spark, cases, appointments)
    assert ids(inquiries.weekly_de(wh, date(2024, 12, 30), excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS)) == ["before"]
    assert ids(inquiries.weekly_de(wh, date(2024, 12, 30), mode="week_start", excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS)) == ["after", "before"]


def test_voucher_choice_depends_on_the_form(spark):
    """The list form takes the head of the list, the older form the first allowed voucher."""
    opinion = dict(treatment_type="second_opinion_before_surgery")
    cases = [dict(case_id="head refused", voucher_ids=[3, 1], **opinion), dict(case_id="vip", voucher_ids=[3, 2], **opinion)]
    appointments = [(c["case_id"], "3", "sent", date(2024, 5, 8)) for c in cases]
    wh = inquiry_warehouse(spark, cases, appointments)
    assert ids(inquiries.weekly_de(wh, AS_OF, excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS)) == []
    assert ids(inquiries.telephone_follow_up(wh, AS_OF, excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS)) == ["head refused", "vip"]
    assert ids(inquiries.vip_vouchers(wh, AS_OF)) == ["vip"]


def test_legacy_calls_and_the_survey_of_this_week(spark):
    cases = [dict(case_id=c, results_sent_at=date(2024, 4, 1)) for c in ("free", "called", "surveyed", "surveyed before", "listed")]
    appointments = [(c["case_id"], "3", "call_patient", None) for c in cases]
    contacts = [
        ("called", 97, date(2020, 1, 1)),
        ("surveyed", 8, date(2024, 6, 10)),
        ("surveyed before", 8, date(2024, 6, 9)),
    ]
    wh = inquiry_warehouse(spark, cases, appointments, contacts=contacts, listed=["listed"])
    assert ids(inquiries.call_legacy(wh, AS_OF, "client", excluded_clients=fv.WEEKLY_EXCLUDED_CLIENTS)) == ["free", "surveyed before"]


def test_swiss_weekly_process(spark):
    cube_schema = (
        "case_id string, service_id string, voucher_code string, inquiry_type string, payer_name string, "
        "result_date date, payer_group string, product string"
    )
    names = ["mail due", "mail too fresh", "mail refused", "post due", "replied", "closed", "started", "nothing sent"]
    cube = frame(
        spark, cube_schema, [dict(case_id=n, service_id=n) for n in names],
        inquiry_type="surgery", payer_name="p", result_date=date(2024, 5, 1), payer_group="kv", product="MSS",
    )
    sent = [(n, "did_send_status_survey", date(2024, 5, 20)) for n in names if n not in ("nothing sent", "post due")]
    fresh = [("mail too fresh", "DID_SEND_PREM_SURVEY", date(2024, 6, 1)), ("closed", "CASE_DID_CLOSE", date(2024, 5, 1))]
    wh = frame_warehouse(
        spark,
        {
            "case_cube": cube,
            "report_flags": spark.createDataFrame([("mail refused", "ja"), ("mail due", "nein")], "service_id string, qualimed string"),
            "pii": spark.createDataFrame(
                [(n, "postal" if n == "post due" else "email", "fr") for n in names],
                "service_id string, preferred_channel string, preferred_language string",
            ),
            "workflow_events": spark.createDataFrame(sent + fresh, "case_id string, event_type string, event_date date"),
            "survey_links": spark.createDataFrame(
                [("replied", 1, "done"), ("mail due", 1, None)], "case_id string, survey_id long, response_status string"
            ),
            "surveys": spark.createDataFrame([(1, "MSS Nachbefragung PREM")], "id long, title string"),
            **campaign_tables(spark, [("started", 6, date(2024, 6, 1))]),
        },
    )
    assert ids(services.weekly_ch(wh, AS_OF)) == ["mail due", "post due"]


def unified_rows(spark, rows):
    schema = ", ".join(f"{n} {t}" for n, t in existing.UNIFIED.items())
    defaults = dict(
        system="inquiry", country="de", provider_nps="9", first_voucher_code="A-1", client_1="Payer", subsidy=False,
        result_date=date(2021, 6, 1),
    )
    return frame(spark, schema, rows, **defaults)


@pytest.mark.parametrize("guard, kept", [("main", ["additional, main missing", "plain"]), ("additional", ["plain"])])
def test_guard_of_the_additional_reason(spark, guard, kept):
    rows = [
        dict(case_id="plain"),
        dict(case_id="additional, main missing", completion_reason_additional="rerun"),
        dict(case_id="additional and main", completion_reason_additional="rerun", completion_reason_main="fine"),
        dict(case_id="main refused", completion_reason_main="other"),
        dict(case_id="subsidy unknown", subsidy=None),
        dict(case_id="subsidy", subsidy=True),
        dict(case_id="pilot", first_voucher_code="my-Pilot"),
        dict(case_id="no voucher", first_voucher_code=None),
        dict(case_id="score text", provider_nps="not_specified"),
        dict(case_id="vip text", description="a VIP"),
    ]
    groups = spark.createDataFrame([("Payer", "gkv", True)], "client_name string, client_group string, coop_status boolean")
    df = existing._client_roles(unified_rows(spark, rows), groups)
    for rule in existing._unified_rule(None, guard):
        df = df.filter(rule)
    assert ids(df) == kept


def test_review_list_of_old_form(spark):
    keys = spark.createDataFrame([(b"k" * 16, b"v" * 16)], "key binary, iv binary")
    people = spark.createDataFrame(
        [("b", "x@gmail.com"), ("a", "x@gmail.com"), ("c", "y@web.de"), ("d", "z@googlemail.com"), ("e", None)],
        "case_id string, email string",
    ).withColumn("email", encrypt_text(F.col("email"), keys))
    previous = spark.createDataFrame([("d", 3), ("a", 1), (None, 3)], "case_id string, cam_id int")
    got = reviews.review_request_legacy(people, keys, previous, columns=["email"])
    assert [(r.case_id, r.email) for r in got.collect()] == [("a", "x@gmail.com")]


def test_review_list_of_old_form_opens_a_mail_once_a_step_and_other_columns_of_chosen_rows(spark, tmp_path):
    keys = spark.createDataFrame([(b"k" * 16, b"v" * 16)], "key binary, iv binary")
    rows = [("b", "Bo", "x@gmail.com"), ("a", None, "x@gmail.com"), ("c", "", "y@web.de"), ("d", "Di", None), (None, "No", "z@googlemail.com")]
    people = spark.createDataFrame(rows, "case_id string, first_name string, email string")
    people.withColumns({c: encrypt_text(F.col(c), keys) for c in ("first_name", "email")}).write.parquet(f"{tmp_path}/people")
    previous = spark.createDataFrame([("d", 3)], "case_id string, cam_id int")
    got = reviews.review_request_legacy(spark.read.parquet(f"{tmp_path}/people"), keys, previous, columns=["first_name", "email"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", None, "x@gmail.com"), (None, "No", "z@googlemail.com")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    chosen, before = plan.split("Window", 1)
    assert (chosen.count("aesDecrypt"), before.count("aesDecrypt")) == (1, 2)


def test_latest_unanswered_outcome_survey(spark):
    body = '{"properties":{"date":"01-01-2020"}}'
    wh = frame_warehouse(
        spark,
        {
            "services": spark.createDataFrame(
                [("a", "MSS", 1, None), ("b", "MSS", 1, None)], "case_id string, product string, contract_id long, deleted_at date"
            ),
            "contracts": spark.createDataFrame([(1, 1)], "id long, payer_id long"),
            "payers": spark.createDataFrame([(1, "Assura x")], "id long, name string"),
            "workflow_events": spark.createDataFrame(
                [(c, "DID_SEND_FINAL", body) for c in "ab"], "case_id string, event_type string, event_body string"
            ),
            "survey_links": spark.createDataFrame(
                [("a", 1, "done", datetime(2020, 6, 1)), ("a", 1, None, datetime(2021, 1, 1)), ("b", 1, None, datetime(2020, 6, 1)),
                 ("b", 1, "done", datetime(2022, 6, 1))],
                "case_id string, survey_id long, response_status string, created_at timestamp",
            ),
            "surveys": spark.createDataFrame([(1, "PROM 12")], "id long, title string"),
        },
    )
    assert [(r.case_id, r.prom_type) for r in services.latest_prom(wh).collect()] == [("a", "prom_12")]


def test_product_rule_opens_a_body_once(spark, tmp_path):
    products = ["MSS", "MSS_PMS", "MSSX", "RSO", "SPC", "PMS", "x", None]
    named = ["Spezialist", "Weiteres", "ein Remote", "Frei", "Erst", "Spez", None]
    rows = [(f"{p}-{e}", p, f'{{"product":"{e}"}}' if e else "{}") for p in products for e in named]
    spark.createDataFrame(rows, "case_id string, service string, body string").write.parquet(f"{tmp_path}/events")
    events = spark.read.parquet(f"{tmp_path}/events")
    rule = services.product_matches_event(F.col("service"), F.get_json_object("body", "$.product"))
    each = [F.col("service").like(p) & F.get_json_object("body", "$.product").like(e) for p, e in fv.PRODUCT_EVENTS]
    plain = each[0] | each[1] | each[2] | each[3] | each[4]
    told = events.select("case_id", rule.alias("rule"), plain.alias("plain")).collect()
    assert [r.case_id for r in told if r.rule != r.plain] == []
    got = events.filter(rule)
    assert ids(got) == sorted(
        ["MSS-Spezialist", "MSS_PMS-Weiteres", "MSS_PMS-Erst", "MSSX-Weiteres", "RSO-ein Remote", "SPC-Frei", "PMS-Erst"]
    )
    # Joined to their service, the bodies are not opened on the way either.
    joined = events.drop("service").join(events.select("case_id", "service"), "case_id").filter(rule)
    for df in (got, joined):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def days_of_list():
    return F.lit(date(1996, 1, 1)), F.lit(date(1997, 12, 31))


def test_unified_list_computes_people_of_the_days_only(spark, tmp_path):
    inquiries = [(1, "a", date(1997, 1, 1)), (2, "b", date(1999, 1, 1)), (3, "c", date(1996, 1, 1)), (None, "d", date(1997, 1, 1))]
    people = [(1, "Ann"), (2, "Bo"), (None, "No")]
    spark.createDataFrame(people, "inquiry_id long, first_name string").write.parquet(f"{tmp_path}/people")
    opened = spark.read.parquet(f"{tmp_path}/people").withColumns(
        {"first_name": F.upper("first_name"), **{c: F.lit("x") for c in ("gender", "last_name", "email", "country_code")}}
    )
    frames = {
        "inquiries": spark.createDataFrame(inquiries, "id long, case_id string, results_sent_at date").withColumns(
            {"service_id": F.lit("s"), "voucher_ids": F.array(F.lit(1)), "exclude_from_reporting": F.lit(False)}
        ),
        "contact_entries": spark.createDataFrame([(9, 7, "Q3")], "inquiry_id long, quality int, contact_type string"),
        "voucher_dim": spark.createDataFrame([(1, "V", "client")], "id int, value string, client_name string"),
        "insurance_data": spark.createDataFrame(
            [(1, True, False, "i")], "inquiry_id long, main boolean, supplementary boolean, insurance string"
        ),
        "patient_data": opened,
    }
    got = existing.inquiry_cases(frame_warehouse(spark, frames), days_of_list())
    assert sorted(((r.case_id, r.first_name) for r in got.collect()), key=str) == [("a", "ANN"), ("c", None), ("d", None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("upper(") < plan.index("LeftSemi")


def test_unified_list_drops_results_of_other_days_before_the_events_are_joined(spark, tmp_path):
    body = '{{"properties":{{"date":"{}","reason":"{}"}}}}'.format
    lines = [
        ("a", "DID_SEND_FINAL", body("01-02-1996", "x"), None), ("a", "DID_SEND_FINAL", body("01-03-1997", "x"), None),
        ("a", "DID_CLOSE", body("01-01-1999", "why"), None), ("b", "DID_SEND_FINAL", body("01-01-1999", "x"), None),
        ("c", "DID_SEND_FINAL", body("no day", "x"), None), ("d", "DID_CLOSE", body("01-02-1996", "x"), None),
        ("e", "DID_CLOSE_DID_SEND_FINAL", body("01-01-1999", "late"), None), ("e", "DID_SEND_FINAL", body("31-12-1997", "x"), None),
        ("f", "DID_SEND_FINAL", body("01-02-1996", "x"), date(1999, 1, 1)),
    ]
    spark.createDataFrame(lines, "case_id string, event_type string, event_body string, deleted_at date").write.parquet(f"{tmp_path}/lines")
    spark.createDataFrame([(c, "MSS") for c in "abcdef"], "case_id string, service string").write.parquet(f"{tmp_path}/orders")
    events = spark.read.parquet(f"{tmp_path}/lines").join(spark.read.parquet(f"{tmp_path}/orders"), "case_id")
    none = spark.createDataFrame([], "case_id string, visit_timing int, visit_nps string, deleted_at date, service_id long, nps string, markers string, insurance_company_id int, gender string, title string, first_name string, last_name string, county string, email string, country_code string")
    names = spark.createDataFrame([(1, 1, "n", "n")], "id int, payer_id int, name string, title string")
    services_of = [(i, c, f"{c}:MSS", "MSS", 1, 1, "V", None) for i, c in enumerate("abcdef")]
    frames = dict.fromkeys(["visits", "case_markers", "primary_insurance_selections", "patient_facts", "feedbacks"], none)
    frames |= dict.fromkeys(["contracts", "payers", "products", "insurance_companies"], names)
    frames["workflow_events"] = events
    frames["services"] = spark.createDataFrame(
        services_of,
        "id long, case_id string, service_id string, product string, contract_id int, product_id int, voucher_code string, deleted_at date",
    )
    got = existing.service_cases(frame_warehouse(spark, frames), days_of_list())
    assert sorted((r.case_id, str(r.result_date), r.completion_reason_main) for r in got.collect()) == [
        ("a", "1997-03-01", "why"), ("e", "1997-12-31", "late")
    ]
    plan = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "$.properties.date" in x and "Filter" in x]
    assert len(plan) == 1 and plan[0].count("$.properties.date") == 1
