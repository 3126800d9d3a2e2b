"""Selections from surveys and workflow events and their twins."""

from __future__ import annotations

from datetime import date

from recontact.checks.inquiry_selections import VIP_ALLOWED, OPEN_SECOND_OPINION, WEEKLY_DAY, due, in_week
from recontact.checks.registry import ledger_columns, numbered_sql, register
from recontact.plans import services as plans

AS_OF = date(2000, 1, 1)
VIP_WEEK = date(1999, 2, 10)
NOW = "DATE '2000-01-01'"

LINKS = "links AS (SELECT l.*, s.title FROM survey_links AS l LEFT JOIN surveys AS s ON s.id = l.survey_id)"
SERVICES = """
live AS (
  SELECT s.case_id, s.service_id, s.voucher_code, p.name AS payer, f.preferred_language, f.channel_recommendation
  FROM services AS s LEFT JOIN contracts AS c ON c.id = s.contract_id LEFT JOIN payers AS p ON p.id = c.payer_id
    LEFT JOIN communication_facts AS f ON f.case_id = s.case_id
  WHERE s.deleted_at IS NULL
    AND s.case_id IN (SELECT case_id FROM workflow_events WHERE event_type LIKE '%DID_SEND_FINAL%'))"""
UNANSWERED = """x.case_id NOT IN (SELECT case_id FROM links
      WHERE title LIKE '%Nachbefragung%' AND response_status IS NOT NULL)
    AND x.case_id NOT IN (SELECT case_id FROM links WHERE title LIKE '%PROM%')"""
CLOSED_FOR_GOOD = """x.case_id NOT IN (SELECT case_id FROM workflow_events WHERE event_type LIKE '%DID_CLOSE%'
      AND regexp_matches(json_extract_string(event_body, '$.properties.reason'),
        'Keine weitere Befragung|Befragung unangebracht|Kontaktadresse'))"""
NOT_RECEIVED = "x.case_id NOT IN (SELECT case_id FROM workflow_events WHERE event_type LIKE '%DID_RECEIVE%')"
NOT_ENDED = """x.case_id NOT IN (SELECT case_id FROM workflow_events
      WHERE event_type LIKE '%DID_CLOSE%' OR event_type LIKE '%DID_RECEIVE%')"""


def not_talked(topic: str, extra: str = "") -> str:
    return f"x.case_id NOT IN (SELECT case_id FROM conversations_ref WHERE topics = '[\"{topic}\"]' {extra})"


def not_called(cams: str) -> str:
    return f"x.case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id NOT IN ({cams}))"


STATE = "CASE class WHEN 'SS' THEN 'call_patient' WHEN 'PREM' THEN 'sent' END"
CLASSES = f"""
classes AS (SELECT case_id, CASE WHEN count(*) FILTER (title LIKE '%Status%') > 0 THEN 'SS'
    WHEN count(*) FILTER (title LIKE '%PREM%') > 0 THEN 'PREM' END AS class FROM links GROUP BY case_id)"""


def mss_ctes(payers: str, rules: str, age_rule: str) -> str:
    return f"""{LINKS},{SERVICES},{CLASSES},
waiting AS (
  SELECT x.*, l.title, k.class, l.created_at, {NOW} - cast(l.created_at AS date) AS age
  FROM live AS x JOIN links AS l ON l.case_id = x.case_id AND l.title LIKE '%Nachbefragung%'
    LEFT JOIN classes AS k ON k.case_id = x.case_id
  WHERE {payers} AND x.case_id NOT IN (SELECT case_id FROM suppression) AND x.service_id LIKE '%:MSS%' AND {UNANSWERED} AND {rules}),
chosen AS (
  SELECT * FROM waiting
  WHERE ((title LIKE '%PREM%' AND class = 'PREM') OR (title LIKE '%Status%' AND class = 'SS')) AND {age_rule}
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY age DESC NULLS LAST, service_id, class) = 1)"""


SWISS = "regexp_matches(x.payer, 'NATION|^CSS')"
MSS_TOPIC = not_talked("feedback_follow_up_mss")

# Swiss weekly process.
WEEKLY_CH_CTES = f"""{LINKS},
sends AS (
  SELECT case_id, greatest(max(event_date) FILTER (upper(event_type) = 'DID_SEND_STATUS_SURVEY'),
    max(event_date) FILTER (upper(event_type) = 'DID_SEND_PREM_SURVEY')) AS last_sent
  FROM workflow_events GROUP BY case_id),
chosen AS (
  SELECT c.case_id, c.payer_name, c.voucher_code, p.preferred_language, c.inquiry_type
  FROM case_cube AS c LEFT JOIN report_flags AS r USING (service_id) LEFT JOIN pii AS p USING (service_id)
    LEFT JOIN sends AS s USING (case_id)
  WHERE c.payer_group = 'kv' AND c.result_date > {NOW} - INTERVAL 6 MONTH AND c.product = 'MSS'
    AND c.inquiry_type IN ('second_opinion_before_surgery', 'surgery')
    AND c.case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id = 6 AND case_id IS NOT NULL)
    AND c.case_id NOT IN (SELECT case_id FROM links
      WHERE lower(title) LIKE '%nachbefragung%' AND response_status IS NOT NULL)
    AND c.case_id NOT IN (SELECT case_id FROM workflow_events
      WHERE event_type LIKE '%DID_CLOSE%' OR event_type LIKE '%DID_RECEIVE%')
    AND (({NOW} - s.last_sent >= 17 AND coalesce(r.qualimed, 'nein') = 'nein')
      OR (p.preferred_channel = 'postal' AND c.result_date < {NOW} - INTERVAL 2 WEEK))
  QUALIFY row_number() OVER (PARTITION BY c.case_id ORDER BY c.result_date DESC NULLS FIRST, c.service_id) = 1)"""
register(
    "weekly_ch",
    lambda wh: ledger_columns(plans.weekly_ch(wh, AS_OF)),
    numbered_sql(
        WEEKLY_CH_CTES,
        "chosen", "payer_name", "voucher_code", language="preferred_language",
    ),
)

# Swiss surveys 16 to 21 days old, and the older card list of the same cases.
register(
    "ch_survey_legacy",
    lambda wh: ledger_columns(plans.ch_survey_legacy(wh, AS_OF, payers=["%NATION%", "CSS%"])),
    numbered_sql(
        mss_ctes(SWISS, f"{NOT_ENDED} AND {MSS_TOPIC}", "age BETWEEN 16 AND 21"),
        "chosen", "payer", "voucher_code", app_state=STATE, language="preferred_language",
    ),
)
register(
    "ch_survey_list",
    lambda wh: plans.ch_survey_list(wh, AS_OF, payers=["%NATION%"]),
    f"""WITH {mss_ctes("x.payer LIKE '%NATION%'", f"{NOT_ENDED} AND {MSS_TOPIC}", "age BETWEEN 16 AND 21")}
SELECT case_id, payer AS voucher_client_name, voucher_code AS first_voucher_code, {STATE} AS app_state,
  cast(created_at AS date) AS app_date, 'Tel. Nachbefragung' AS parameter, {NOW} AS card_created,
  'waiting_q3' AS korb, preferred_language FROM chosen""",
)

# C17: Swiss postal cases.
register(
    "ch_postal_legacy",
    lambda wh: ledger_columns(plans.ch_postal_legacy(wh, date(1999, 6, 23))),
    numbered_sql(
        f"""
cases AS (
  SELECT s.case_id, p.name AS payer, s.voucher_code, v.visit_date, e.event_time, f.preferred_language,
    CASE WHEN v.visit_timing = 1 AND v.visit_date IS NOT NULL THEN v.visit_date
      ELSE cast(e.event_time + INTERVAL 2 WEEK AS date) END AS app_date
  FROM services AS s JOIN contracts AS c ON c.id = s.contract_id JOIN payers AS p ON p.id = c.payer_id
    JOIN workflow_events AS e ON e.case_id = s.case_id JOIN communication_facts AS f ON f.case_id = s.case_id
    LEFT JOIN visits AS v ON v.case_id = s.case_id
  WHERE regexp_matches(p.name, 'Assura|ÖKK|EGK|Helsana|Atupri|^Aquilana|^CSS|^Agrisano|^KPT|Visana')
    AND e.event_type LIKE '%DID_SEND_FINAL%' AND e.service = 'MSS'
    AND (f.channel_recommendation = 'postal' OR coalesce(f.email, '') = '')),
chosen AS (SELECT DISTINCT case_id, payer, voucher_code, preferred_language, app_date FROM cases WHERE {in_week('app_date', 0, "DATE '1999-06-23'")})""",
        "chosen", "payer", "voucher_code", app_state="app_date", language="preferred_language",
        key=("case_id", "app_date"), new_batch=0,
    ),
)

# Calls by payer, both products.
MOVED = ("follow-up board", "inbox", "1999-01-01 00:00:00", "1999-12-31 00:00:00", "1")
NOT_MOVED = """x.case_id NOT IN (SELECT case_id FROM card_log WHERE action_type = 'moveCardToBoard'
      AND board = 'follow-up board' AND list = 'inbox' AND case_id LIKE '1%'
      AND card_create_timestamp BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31')"""
register(
    "call_services_mss",
    lambda wh: ledger_columns(plans.call_services_mss(wh, AS_OF, "%NATION%", moved=MOVED)),
    numbered_sql(
        mss_ctes(
            "x.payer LIKE '%NATION%'",
            f"{NOT_RECEIVED} AND {CLOSED_FOR_GOOD} AND {MSS_TOPIC} AND {not_called('1, 2, 3, 8')} AND {NOT_MOVED}",
            "age >= 16",
        ),
        "chosen", "payer", "voucher_code", app_state=STATE, language="preferred_language",
    ),
)


def pms_ctes(rules: str, cams: str, months: int) -> str:
    talk = not_talked("feedback_follow_up", "AND product LIKE 'PMS%'")
    return f"""{LINKS},{SERVICES},
finals AS (SELECT case_id, max(event_time) AS final_at FROM workflow_events
  WHERE event_type LIKE 'DID_SEND_FINAL%' GROUP BY case_id),
classes AS (SELECT case_id, CASE WHEN bool_or(title LIKE '%Allrounder%') THEN 'Allrounder'
    WHEN bool_or(title LIKE '%Reha%') THEN 'Reha' END AS class FROM links GROUP BY case_id),
waiting AS (
  SELECT x.*, k.class, t.final_at,
    CASE WHEN l.title LIKE '%PMS%' THEN {NOW} - cast(l.created_at AS date)
      WHEN l.title NOT LIKE '%PMS%' THEN {NOW} - cast(t.final_at AS date) END AS age
  FROM live AS x LEFT JOIN links AS l ON l.case_id = x.case_id LEFT JOIN finals AS t ON t.case_id = x.case_id
    LEFT JOIN classes AS k ON k.case_id = x.case_id
  WHERE x.service_id LIKE '%:PMS%' AND {rules} AND {UNANSWERED} AND {NOT_RECEIVED} AND {CLOSED_FOR_GOOD}
    AND {talk} AND {not_called(cams)}
    AND (l.title LIKE '%Nachbefragung%' OR x.channel_recommendation NOT LIKE 'email')),
pms AS (
  SELECT * FROM waiting WHERE age > 16
    AND final_at BETWEEN {NOW} - INTERVAL {months} MONTH AND {NOW} - INTERVAL 1 MONTH
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY age DESC NULLS LAST, service_id, class) = 1)"""


register(
    "call_services_pms",
    lambda wh: ledger_columns(plans.call_services_pms(wh, AS_OF, "%NATION%", moved=MOVED)),
    numbered_sql(
        pms_ctes(f"x.payer LIKE '%NATION%' AND {NOT_MOVED} AND x.case_id NOT IN (SELECT case_id FROM suppression)", "1, 2, 3, 8", 12),
        "pms", "payer", "voucher_code", language="preferred_language",
    ),
)

# VIP cases of both systems. The inquiry part follows the week, the service part the months.
register(
    "vip",
    lambda wh: ledger_columns(plans.vip(wh, VIP_WEEK)),
    numbered_sql(
        f"""{pms_ctes("x.voucher_code LIKE '%VRTC%'", "1, 2, 3, 8, -1", 5)},
candidates AS (
  SELECT i.case_id, v.client_name, v.value AS code, a.state AS app_state, i.state AS korb, v.id AS voucher,
    {WEEKLY_DAY} AS app_date
  FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id LEFT JOIN inquiry_results AS r USING (service_id)
    JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  WHERE {OPEN_SECOND_OPINION} AND a.appointment_type = '3' AND a.state IN ('sent', 'call_patient')
    AND {VIP_ALLOWED}),
firsts AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY app_state, client_name, app_date NULLS LAST, voucher) = 1),
chosen AS (
  SELECT case_id, client_name, code, app_state, korb, 'inquiries' AS branch FROM firsts WHERE {due(NOW)}
  UNION ALL SELECT case_id, payer, voucher_code, NULL, NULL, 'services' FROM pms)""",
        "chosen", "client_name", "code", app_state="app_state", korb="korb", key=("case_id", "branch"),
    ).replace(NOW, "DATE '1999-02-10'"),
)
# Final result, but no score.
register(
    "partial_feedback",
    lambda wh: plans.partial_feedback(wh),
    """
WITH finals AS (
  SELECT DISTINCT s.case_id, s.product, p.name AS payer_brand,
    cast(strptime(json_extract_string(e.event_body, '$.properties.date'), '%d-%m-%Y') AS date) AS results_date
  FROM services AS s JOIN workflow_events AS e ON e.case_id = s.case_id AND e.event_type LIKE '%DID_SEND_FINAL%'
    LEFT JOIN contracts AS c ON c.id = s.contract_id LEFT JOIN payers AS p ON p.id = c.payer_id
  WHERE s.deleted_at IS NULL AND s.product LIKE '%MSS%'
    AND ((s.product = 'MSS' AND json_extract_string(e.event_body, '$.properties.product') LIKE 'Spezi%')
      OR (s.product LIKE 'MSS_%' AND json_extract_string(e.event_body, '$.properties.product') LIKE 'Weit%'))),
scored AS (SELECT s.case_id, b.nps FROM feedbacks AS b JOIN services AS s ON s.id = b.service_id)
SELECT f.case_id, f.product, f.payer_brand, f.results_date, cast(NULL AS string) AS service_score_flag,
  cast(NULL AS string) AS medic_score_flag, o.flag AS opinion_flag
FROM finals AS f LEFT JOIN (SELECT DISTINCT case_id, CASE WHEN therapy_decision IS NULL THEN NULL ELSE 'yes' END AS flag
  FROM opinions) AS o USING (case_id)
WHERE (f.case_id NOT IN (SELECT case_id FROM scored) OR f.case_id IN (SELECT case_id FROM scored WHERE nps IS NULL))
  AND f.case_id NOT IN (SELECT case_id FROM visits WHERE visit_nps IS NOT NULL)""",
)

# Latest outcome survey unanswered.
register(
    "latest_prom",
    lambda wh: plans.latest_prom(wh),
    """
WITH rows_ AS (
  SELECT s.case_id, s.product, p.name AS payer_brand, v.title, l.created_at, l.response_status,
    cast(l.created_at AS date) - cast(strptime(json_extract_string(e.event_body, '$.properties.date'), '%d-%m-%Y') AS date)
      AS time_diff
  FROM services AS s JOIN contracts AS c ON c.id = s.contract_id JOIN payers AS p ON p.id = c.payer_id
    JOIN workflow_events AS e ON e.case_id = s.case_id AND e.event_type LIKE '%DID_SEND_FINAL%'
    JOIN survey_links AS l ON l.case_id = s.case_id JOIN surveys AS v ON v.id = l.survey_id
  WHERE s.deleted_at IS NULL AND s.product = 'MSS' AND p.name LIKE '%Assura%' AND v.title LIKE '%PROM%'),
latest AS (SELECT * FROM rows_ QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY created_at DESC NULLS FIRST, time_diff NULLS LAST, response_status NULLS LAST, title) = 1)
SELECT case_id, product, payer_brand, cast(time_diff AS int) AS time_diff,
  CASE WHEN time_diff < 364 THEN 'prom_6' WHEN time_diff > 720 THEN 'prom_24' ELSE 'prom_12' END AS prom_type, title
FROM latest WHERE response_status IS NULL""",
)
