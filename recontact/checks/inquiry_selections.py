"""Selections from the inquiry system and their twins."""

from __future__ import annotations

from datetime import date

from recontact import fixed_values as fv
from recontact.checks.registry import ledger_columns, numbered_sql, register
from recontact.plans import inquiries as plans

WEEK = date(1999, 2, 10)
SURVEY_WEEK = date(1999, 2, 3)
CALL_WEEK = date(1999, 11, 10)
CALL_DAY = "DATE '1999-11-10'"
POST_WEEK = date(1996, 6, 26)
POST_DAY = "DATE '1996-06-26'"
AS_OF = date(2000, 1, 1)
NOW = "DATE '2000-01-01'"
CLIENTS = (*fv.WEEKLY_EXCLUDED_CLIENTS, "Own Staff")

ALLOWED = """v.client_name NOT IN ('VIP GELB', 'VIP ROT', 'Own Staff')
    AND NOT regexp_matches(v.value, '-MSSNACHRSO$|-BDTC$|AXAP-') AND v.value NOT IN ('NUBU-7777', 'ARAG-CM22')"""
CALL_ALLOWED = """v.client_name NOT IN ('VIP GELB', 'VIP ROT', 'Own Staff')
    AND NOT regexp_matches(v.value, '-MSSNACHRSO$|-BDTC$') AND v.value <> 'NUBU-7777'"""
VIP_ALLOWED = """contains(v.value, 'VRTC') AND v.client_name IS NOT NULL
    AND NOT regexp_matches(v.value, '-MSSNACHRSO$|-BDTC$|AXAP-') AND v.value NOT IN ('NUBU-7777', 'ARAG-CM22')"""
ANSWERED = "i.id IN (SELECT inquiry_id FROM contact_entries WHERE q3_result IS NOT NULL)"
OPEN_ENTRY = """(i.id NOT IN (SELECT inquiry_id FROM contact_entries)
    OR i.id IN (SELECT inquiry_id FROM contact_entries WHERE q3_result IS NULL))"""
NEVER_COMPLETED = """i.id NOT IN (SELECT inquiry_id FROM appointments
    WHERE appointment_type = '3' AND state = 'completed')"""
SENT_DAY = """CASE WHEN a.state = 'sent' THEN a.scheduled_date ELSE cast(i.results_sent_at AS date) END"""


def in_week(day: str, weeks: int, today: str) -> str:
    moved = f"({day} + INTERVAL {weeks} WEEK)"
    return f"(week({moved}) = week({today}) AND year({moved}) = year({today}))"


def due(today: str) -> str:
    return f"""((app_state = 'sent' AND {in_week('app_date', 5, today)})
    OR (app_state = 'call_patient' AND {in_week('app_date', 6, today)}))"""


WEEKLY_DAY = """CASE a.state WHEN 'call_patient' THEN r.least_result_date WHEN 'sent' THEN a.scheduled_date END"""


def weekly_ctes(today: str) -> str:
    return f"""
candidates AS (
  SELECT i.case_id, v.client_name, v.value AS code, a.state AS app_state, i.state AS korb, v.id AS voucher,
    {WEEKLY_DAY} AS app_date
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id
    LEFT JOIN inquiry_results AS r USING (service_id) JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE i.state = 'waiting_q3' AND i.treatment_type IN ('second_opinion_before_surgery', 'surgery')
    AND NOT {ANSWERED} AND a.appointment_type = '3' AND a.state IN ('sent', 'call_patient') AND {ALLOWED}),
first_calls AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY app_state, client_name, app_date NULLS LAST, voucher) = 1),
calls AS (SELECT * FROM first_calls WHERE {due(today)})"""


def postal_ctes(today: str) -> str:
    last_week = f"({today} - INTERVAL 1 WEEK)"
    return f"""
letters AS (
  SELECT i.case_id, i.treatment_type, v.client_name, v.value AS code, a.state AS app_state, i.state AS korb,
    a.scheduled_date, a.appointment_type, v.id AS voucher
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id
    JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE i.state IN ('waiting_q3', 'waiting_q4', 'waiting_q5', 'waiting_q6')
    AND i.id IN (SELECT inquiry_id FROM patient_data WHERE preferred_communication_channel = 'post')
    AND i.id IN (SELECT inquiry_id FROM insurance_data WHERE options = '[]')
    AND a.appointment_type NOT IN ('1', '2') AND a.state = 'ready_to_send_pdf'
    AND {in_week('a.scheduled_date', 0, last_week)} AND v.client_name <> 'AXA Haftpflichtversicherung')"""


POSTAL_CHOICE = """
postal AS (SELECT * FROM letters
  WHERE client_name = 'DAK' OR treatment_type IN ('second_opinion_before_surgery', 'surgery')
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY scheduled_date, appointment_type, voucher) = 1)"""


def weekly_de_sql(today: str) -> str:
    both = f"""{weekly_ctes(today)},{postal_ctes(today)},{POSTAL_CHOICE},
both_parts AS (
  SELECT case_id, client_name, code, app_state, korb, NULL AS post FROM calls
  UNION ALL SELECT case_id, client_name, code, app_state, korb, 'post' FROM postal),
chosen AS (SELECT * FROM both_parts
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY post NULLS FIRST) = 1)"""
    return both


# Weekly process, postal part, postal cases to complete.
DAY = "DATE '1999-02-10'"
register(
    "weekly_de",
    lambda wh: ledger_columns(plans.weekly_de(wh, WEEK, excluded_clients=CLIENTS)),
    numbered_sql(weekly_de_sql(DAY), "chosen", "client_name", "code", "NULL", "app_state", "korb", "'de'"),
)
register(
    "weekly_de_cards_input",
    lambda wh: plans.weekly_de_cases(wh, WEEK, excluded_clients=CLIENTS),
    f"""WITH {weekly_de_sql(DAY)}
SELECT w.case_id, w.client_name AS voucher_client, w.code AS voucher_code, w.app_state, w.korb, c.admission_channel,
  w.post, CASE WHEN c.admission_channel IN ('online_marketing', 'partner_funnel') THEN 1 ELSE 0 END
  AS om_flag, c.inquiry_type
FROM chosen AS w LEFT JOIN (SELECT * FROM case_cube WHERE product = 'MSS') AS c USING (case_id)""",
)
register(
    "weekly_de_week_start",
    lambda wh: ledger_columns(plans.weekly_de(wh, date(1999, 12, 29), mode="week_start", excluded_clients=CLIENTS)),
    numbered_sql(
        weekly_de_sql("DATE '1999-12-29'")
        .replace("(week((app_date + INTERVAL 5 WEEK)) = week(DATE '1999-12-29') AND year((app_date + INTERVAL 5 WEEK))"
                 " = year(DATE '1999-12-29'))",
                 "date_trunc('week', app_date + INTERVAL 5 WEEK) = DATE '1999-12-27'")
        .replace("(week((app_date + INTERVAL 6 WEEK)) = week(DATE '1999-12-29') AND year((app_date + INTERVAL 6 WEEK))"
                 " = year(DATE '1999-12-29'))",
                 "date_trunc('week', app_date + INTERVAL 6 WEEK) = DATE '1999-12-27'"),
        "chosen", "client_name", "code", "NULL", "app_state", "korb", "'de'",
    ),
)
register(
    "weekly_de_postal",
    lambda wh: ledger_columns(plans.weekly_de_postal(wh, POST_WEEK)),
    numbered_sql(
        f"{postal_ctes(POST_DAY)},{POSTAL_CHOICE}",
        "postal", "client_name", "code", "NULL", "app_state", "korb", "'de'", new_batch=0,
    ),
)
register(
    "postal_to_complete",
    lambda wh: plans.postal_to_complete(wh, POST_WEEK),
    f"""WITH {postal_ctes(POST_DAY)}
SELECT case_id, client_name, app_state, treatment_type FROM letters
WHERE client_name NOT LIKE '%DAK%' AND treatment_type NOT IN ('second_opinion_before_surgery', 'surgery')
QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY korb, scheduled_date, appointment_type, voucher) = 1""",
)
register(
    "postal_per_voucher",
    lambda wh: ledger_columns(plans.postal_per_voucher(wh, POST_WEEK)),
    numbered_sql(
        f"""
chosen AS (
  SELECT DISTINCT i.case_id, a.scheduled_date, i.voucher AS voucher_id, i.treatment_type, i.state AS korb,
    a.appointment_type, a.state AS app_state, v.client_name, v.value AS code
  FROM (SELECT *, unnest(voucher_ids) AS voucher FROM inquiries) AS i JOIN appointments AS a ON a.inquiry_id = i.id
    JOIN voucher_dim AS v ON v.id = i.voucher
  WHERE i.state LIKE 'waiting_q%' AND a.appointment_type NOT IN ('1', '2') AND a.state = 'ready_to_send_pdf'
    AND {in_week('a.scheduled_date', 1, POST_DAY)}
    AND EXISTS (FROM patient_data AS p WHERE p.inquiry_id = i.id AND p.preferred_communication_channel = 'post')
    AND EXISTS (FROM insurance_data AS d WHERE d.inquiry_id = i.id AND d.options = '[]')
    AND v.client_name <> 'AXA Haftpflichtversicherung'
    AND (v.client_name = 'DAK' OR i.treatment_type = 'second_opinion_before_surgery'))""",
        "chosen", "client_name", "code", "NULL", "app_state", "korb", "'de'",
        key=("case_id", "scheduled_date", "voucher_id", "treatment_type", "korb", "appointment_type", "app_state"),
        new_batch=0,
    ),
)
register(
    "postal_window",
    lambda wh: plans.postal_window(wh, WEEK),
    f"""
WITH letters AS (
  SELECT DISTINCT i.case_id, a.scheduled_date, unnest(i.voucher_ids) AS voucher, i.treatment_type, i.state AS korb,
    a.appointment_type, a.state AS app_state
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id
  WHERE i.state LIKE 'waiting_q%' AND a.appointment_type NOT IN ('1', '2') AND a.state = 'ready_to_send_pdf'
    AND a.scheduled_date BETWEEN {DAY} - 8 AND {DAY} - 1
    AND EXISTS (FROM patient_data AS p WHERE p.inquiry_id = i.id AND p.preferred_communication_channel = 'post')
    AND EXISTS (FROM insurance_data AS d WHERE d.inquiry_id = i.id AND d.options = '[]'))
SELECT l.case_id, l.scheduled_date AS app_date, v.client_name AS voucher_client_name, v.value AS first_voucher_code,
  l.treatment_type, l.korb, l.appointment_type, l.app_state, 'Tel. Nachbefragung' AS parameter,
  {DAY} AS card_created, 'de' AS preferred_language
FROM letters AS l JOIN voucher_dim AS v ON v.id = l.voucher
WHERE v.client_name <> 'AXA Haftpflichtversicherung'""",
)


def exploded_sql(rules: str, voucher_rule: str, states: str) -> str:
    """First voucher that passes the rule, over all vouchers of a case."""
    return f"""
vouchered AS (
  SELECT i.case_id, v.client_name, v.value AS code, v.id AS voucher, a.state AS app_state, i.state AS korb,
    {SENT_DAY} AS app_date, i.results_sent_at
  FROM (SELECT *, unnest(voucher_ids) AS voucher FROM inquiries) AS i JOIN voucher_dim AS v ON v.id = i.voucher
    JOIN appointments AS a ON a.inquiry_id = i.id
  WHERE a.appointment_type = '3' AND a.state IN ({states}) AND {rules} AND {voucher_rule}),
firsts AS (SELECT * FROM vouchered QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY voucher, app_state, app_date NULLS LAST) = 1)"""


OPEN_SECOND_OPINION = f"""i.state = 'waiting_q3' AND i.treatment_type = 'second_opinion_before_surgery'
    AND {OPEN_ENTRY} AND {NEVER_COMPLETED}"""
register(
    "telephone_follow_up",
    lambda wh: ledger_columns(plans.telephone_follow_up(wh, CALL_WEEK, excluded_clients=CLIENTS)),
    numbered_sql(
        exploded_sql(OPEN_SECOND_OPINION, ALLOWED, "'sent', 'call_patient'")
        + f", chosen AS (SELECT * FROM firsts WHERE {due(CALL_DAY)})",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)
register(
    "vip_vouchers",
    lambda wh: ledger_columns(plans.vip_vouchers(wh, CALL_WEEK)),
    numbered_sql(
        exploded_sql(OPEN_SECOND_OPINION, VIP_ALLOWED, "'sent', 'call_patient'")
        + ", chosen AS (SELECT * FROM firsts WHERE " + due(CALL_DAY) + ")",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)


# Second status survey and its earlier form.
def second_survey_rules() -> str:
    return """i.state = 'waiting_q3'
    AND i.id NOT IN (SELECT inquiry_id FROM contact_entries WHERE q3_result IS NOT NULL)
    AND i.id NOT IN (SELECT inquiry_id FROM appointments WHERE appointment_type = '3'
      AND state IN ('ready_to_send_pdf', 'send_manually', 'sent', 'deleted'))
    AND i.case_id NOT IN (SELECT j.case_id FROM inquiries AS j JOIN appointments AS b ON b.inquiry_id = j.id
      WHERE b.appointment_type IN ('4', '5', '6'))
    AND i.case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id NOT IN (1, 2, 3, -1))
    AND i.id IN (SELECT inquiry_id FROM patient_data
      WHERE preferred_communication_channel = 'email' AND status_survey_reminder_sent_at IS NULL)"""


register(
    "second_status_survey",
    lambda wh: ledger_columns(plans.second_status_survey(wh, SURVEY_WEEK, excluded_clients=CLIENTS)),
    numbered_sql(
        f"""
candidates AS (
  SELECT i.case_id, v.client_name, v.value AS code, a.state AS app_state, r.least_result_date AS app_date, i.id
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id LEFT JOIN inquiry_results AS r USING (service_id)
    JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE a.appointment_type = '3' AND a.state NOT IN ('ready_to_send_pdf', 'send_manually', 'completed', 'waiting',
    'sent', 'deleted') AND {second_survey_rules()} AND {ALLOWED}),
firsts AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY app_date NULLS LAST, app_state, id) = 1),
chosen AS (SELECT * FROM firsts WHERE {in_week('app_date', 5, "DATE '1999-02-03'")})""",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)
register(
    "reminder_status_survey",
    lambda wh: ledger_columns(plans.reminder_status_survey(wh, date(1999, 11, 3), excluded_clients=CLIENTS)),
    numbered_sql(
        exploded_sql(second_survey_rules(), ALLOWED, "'call_patient'")
        + ", chosen AS (SELECT * FROM firsts WHERE "
        + in_week("cast(results_sent_at AS date)", 5, "DATE '1999-11-03'")
        + ")",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)

# C20: second try.
MAIN, MORE = fv.SECOND_TRY_MAIN_REASONS, fv.SECOND_TRY_ADDITIONAL_REASONS
register(
    "second_try_weekly",
    lambda wh: ledger_columns(plans.second_try_weekly(wh, AS_OF, excluded_clients=CLIENTS)),
    numbered_sql(
        exploded_sql(
            f"""i.state IN ('waiting_q3', 'completed') AND i.treatment_type = 'second_opinion_before_surgery'
    AND {OPEN_ENTRY} AND (i.completion_reason_main NOT IN {MAIN} OR i.completion_reason_additional NOT IN {MORE})
    AND i.case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id = 56)""",
            ALLOWED,
            "'completed', 'sent', 'call_patient'",
        )
        + f""", chosen AS (SELECT * FROM firsts WHERE app_date < {NOW} - INTERVAL 9 WEEK
  AND app_date > {NOW} - INTERVAL 6 MONTH AND code NOT IN ('GADS-LF22', 'KULANZ-MSSNICHTKOOPP'))""",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)


# Calls by payer.
CALL_RULES = f"""i.state IN ('waiting_q3', 'completed') AND i.treatment_type <> 'second_opinion_before_surgery'
    AND coalesce(i.completion_reason_main, 'internal_reason') = 'internal_reason' AND NOT {ANSWERED}
    AND i.case_id NOT IN (SELECT case_id FROM suppression)"""


def windows_sql(start: str, deleted: str, call: str, sent: str) -> str:
    return f"""((app_state = 'deleted' AND korb = 'completed' AND app_date BETWEEN {start} AND {deleted})
  OR (app_state = 'call_patient' AND app_date BETWEEN {start} AND {call})
  OR (app_state = 'sent' AND app_date BETWEEN {start} AND {sent}))"""


register(
    "call_legacy",
    lambda wh: ledger_columns(plans.call_legacy(wh, AS_OF, "%CLIENT%", excluded_clients=CLIENTS)),
    numbered_sql(
        f"""
candidates AS (
  SELECT i.case_id, v.client_name, v.value AS code, v.id AS voucher, a.state AS app_state, i.state AS korb,
    {SENT_DAY} AS app_date
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE a.appointment_type = '3' AND a.state IN ('call_patient', 'sent', 'deleted') AND {CALL_RULES}
    AND {CALL_ALLOWED} AND lower(v.client_name) LIKE '%client%'),
firsts AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY app_state, client_name, app_date NULLS LAST, voucher) = 1),
chosen AS (SELECT * FROM firsts
  WHERE {windows_sql(f'{NOW} - INTERVAL 6 MONTH', NOW, f'{NOW} - INTERVAL 6 WEEK', f'{NOW} - INTERVAL 5 WEEK')}
    AND case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id NOT IN (1, 2, 3, -1, 8))
    AND case_id NOT IN (SELECT case_id FROM contact_ledger
      WHERE cam_id = 8 AND batch_selection_date >= date_trunc('week', {NOW})))""",
        "chosen", "client_name", "code", "NULL", "app_state",
    ),
)
register(
    "call_fixed_dates",
    lambda wh: plans.call_fixed_dates(
        wh,
        plans.fixed_windows(date(1999, 1, 1), date(1999, 10, 30), date(1999, 9, 25), date(1999, 10, 2)),
        "%Client%",
        AS_OF,
        excluded_clients=CLIENTS,
    ),
    f"""
WITH {exploded_sql(CALL_RULES, CALL_ALLOWED, "'call_patient', 'sent', 'deleted'")}
SELECT f.case_id, f.client_name AS voucher_client_name, f.code AS first_voucher_code,
  p.preferred_communication_channel AS channel, f.app_state, f.app_date, 'Anrufaktion' AS parameter,
  {NOW} AS card_created, f.korb, i.completion_reason_main, i.completion_reason_additional, i.completion_details,
  'de' AS preferred_language
FROM firsts AS f JOIN inquiries AS i USING (case_id) LEFT JOIN patient_data AS p ON p.inquiry_id = i.id
WHERE f.client_name LIKE '%Client%'
  AND {windows_sql("DATE '1999-01-01'", "DATE '1999-10-30'", "DATE '1999-09-25'", "DATE '1999-10-02'")}""",
)

# Later questionnaires of one payer, in the open batch.
register(
    "call_q4_q6",
    lambda wh: ledger_columns(plans.call_q4_q6(wh, "%Client%")),
    numbered_sql(
        """
chosen AS (
  SELECT DISTINCT i.id, i.case_id, a.scheduled_date, i.voucher_ids[1] AS voucher, i.treatment_type, i.state AS korb,
    a.appointment_type, a.state AS app_state, v.client_name, v.value AS code
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id
    JOIN insurance_data AS d ON d.inquiry_id = i.id AND d.options = '[]'
    JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE i.state IN ('waiting_q4', 'waiting_q5', 'waiting_q6') AND a.appointment_type NOT IN ('1', '2')
    AND a.state = 'sent' AND v.client_name LIKE '%Client%')""",
        "chosen", "client_name", "code", "NULL", "app_state", "korb", "'de'",
        key=("case_id", "id", "scheduled_date", "appointment_type"), new_batch=0,
    ),
)

# Completed appointments without a card.
register(
    "status_vs_card_cleaning",
    lambda wh: ledger_columns(
        plans.status_vs_card_cleaning(wh, date(1997, 1, 1), "intake board", "inbox", excluded_clients=CLIENTS)
    ),
    numbered_sql(
        exploded_sql(
            f"""i.state = 'waiting_q3' AND {OPEN_ENTRY}
    AND i.id NOT IN (SELECT inquiry_id FROM appointments WHERE appointment_type IN ('4', '5', '6'))
    AND i.id NOT IN (SELECT inquiry_id FROM appointments WHERE state <> 'completed')""",
            ALLOWED,
            "'completed'",
        )
        + """, chosen AS (SELECT * FROM firsts WHERE cast(results_sent_at AS date) > DATE '1997-01-01'
  AND case_id NOT IN (SELECT case_id FROM card_log WHERE board = 'intake board' AND list = 'inbox'
    AND transaction_name = 'action_create_card'))""",
        "chosen", "client_name", "code", "NULL", "app_state",
    ).replace("AS new_case_id\nFROM", "AS new_case_id, cast(results_sent_at AS date) AS results_sent_at\nFROM"),
)

# Weekly process by given dates.
register(
    "weekly_de_fixed_dates",
    lambda wh: plans.weekly_de_fixed_dates(
        wh, AS_OF, (date(1999, 9, 27), date(1999, 11, 14)), (date(1999, 11, 1), date(1999, 11, 28)), excluded_clients=CLIENTS
    ),
    f"""
SELECT DISTINCT i.case_id, v.client_name AS voucher_client_name, v.value AS first_voucher_code,
  a.state AS app_state, {SENT_DAY} AS app_date, i.state AS korb, 'Tel. Nachbefragung' AS parameter,
  {NOW} AS card_created, 'de' AS preferred_language
FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
WHERE {OPEN_SECOND_OPINION} AND i.deleted_at IS NULL AND a.appointment_type = '3' AND {CALL_ALLOWED}
  AND ((a.state = 'call_patient' AND {NOW} - {SENT_DAY} > 35
      AND {SENT_DAY} BETWEEN DATE '1999-09-27' AND DATE '1999-11-14')
    OR (a.state = 'sent' AND {NOW} - {SENT_DAY} > 28
      AND {SENT_DAY} BETWEEN DATE '1999-11-01' AND DATE '1999-11-28'))""",
)
