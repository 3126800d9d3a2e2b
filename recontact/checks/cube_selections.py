"""Selections from the case cube and their twins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from recontact import fixed_values as fv
from recontact.checks.registry import ledger_columns, numbered_sql, register
from recontact.checks.sample import keyring
from recontact.functions.pii import encrypt_text
from recontact.plans import calls, existing, reviews
from recontact.plans.single_question import single_question, single_question_list
from recontact.sources.warehouse import Warehouse

AS_OF = date(2000, 1, 1)
NOW = "DATE '2000-01-01'"
EXCLUDED = ("NATION_11", "NATION_13")
EXCLUDED_SQL = "('NATION_11', 'NATION_13')"


# Review requests.
def review_sql(groups: str, rules: str, people: str, language: str) -> str:
    ctes = f"""
asked AS (SELECT DISTINCT case_id FROM contact_ledger WHERE cam_id = 1 AND case_id IS NOT NULL),
asked_patients AS (SELECT patient_id FROM case_cube JOIN asked USING (case_id) WHERE patient_id IS NOT NULL),
eligible AS (
  SELECT cc.*, lower(p.email) AS mail
  FROM case_cube AS cc
    JOIN payer_dim AS d ON d.client_id = cc.payer_id AND d.coop_status
    JOIN pii AS p ON p.service_id = cc.service_id {people}
  WHERE cc.result_date >= {NOW} - INTERVAL 6 MONTH AND cc.payer_group IN ({groups}) {rules}
    AND cc.voucher_code <> '' AND NOT starts_with(cc.voucher_code, 'VRTC')
    AND cc.provider_nps >= 7 AND coalesce(cc.medic_nps, 7) >= 7
    AND NOT regexp_matches(coalesce(cc.completion_reason, ''),
      'Keine weitere Befragung|Befragung unangebracht|Interner Grund|Sonstig', 'i')
    AND NOT EXISTS (FROM asked AS a WHERE a.case_id = cc.case_id)
    AND cc.patient_id IS NOT NULL
    AND NOT EXISTS (FROM asked_patients AS a WHERE a.patient_id = cc.patient_id)
    AND regexp_extract(lower(p.email), '@.*$') IN ('@gmail.com', '@googlemail.com')),
cases AS (
  SELECT * FROM eligible QUALIFY row_number() OVER (PARTITION BY case_id
    ORDER BY patient_id NULLS LAST, result_date DESC NULLS FIRST, service_id) = 1),
chosen AS (
  SELECT * FROM cases QUALIFY row_number() OVER (PARTITION BY patient_id
    ORDER BY result_date DESC NULLS FIRST, case_id) = 1)"""
    return numbered_sql(ctes, "chosen", "payer_name", "voucher_code", "patient_id", language=language)


register(
    "review_request_de",
    lambda wh: ledger_columns(reviews.review_request_de(wh, AS_OF, excluded_payers=EXCLUDED)),
    review_sql(
        "'gkv', 'pkv'",
        f"AND cc.product = 'MSS' AND cc.goodwill = false AND cc.payer_name NOT IN {EXCLUDED_SQL}",
        "AND p.country_code = 'de'",
        "NULL",
    ),
)
register(
    "review_request_ch",
    lambda wh: ledger_columns(reviews.review_request_ch(wh, AS_OF)),
    review_sql("'kv'", "", "", "preferred_language"),
)


# Decrypt, provider filter, previous campaign, one row per address.
def run_review_legacy(wh: Warehouse):
    keys = keyring(wh.spark)
    people = wh["mail_base"].select("case_id", "first_name", "last_name", F.lower("email").alias("email"))
    sealed = people.withColumns({c: encrypt_text(F.col(c), keys) for c in ("first_name", "last_name", "email")})
    previous = wh["cam_select"].join(wh["cam_batch"], "batch_id", "left").select("case_id", "cam_id")
    return reviews.review_request_legacy(sealed, keys, previous, columns=("first_name", "last_name", "email"))


register(
    "review_request_legacy",
    run_review_legacy,
    """
SELECT case_id, first_name, last_name, lower(email) AS email FROM mail_base
WHERE (contains(lower(email), '@gmail.com') OR contains(lower(email), '@google'))
  AND NOT EXISTS (FROM contact_ledger AS l WHERE l.cam_id = 3 AND l.case_id = mail_base.case_id)
QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY case_id) = 1""",
)

# C4: single question.
QUESTIONED = f"""SELECT * FROM single_question
  WHERE payer_group IN ('gkv', 'pkv') AND product = 'MSS'
    AND result_date BETWEEN {NOW} - INTERVAL 7 MONTH AND {NOW} - INTERVAL 3 MONTH
    AND coalesce(reporting_bool, false) AND result IS NULL
    AND therapy_group IN ('Knie', 'Hüfte', 'Schulter') AND therapy <> 'Sonstige Operation'
    AND op_category = 1 AND cases_last_two_years = 1
    AND inquiry_type IN ('surgery', 'second_opinion_before_surgery')
    AND inquiries_state = 'waiting_q3' AND appointment_type = '3'
    AND appointment_state IN ('sent', 'call_patient')
    AND coalesce(channel_reach_email, false) AND preferred_channel = 'email'"""
RECENT = f"(SELECT batch_id FROM cam_batch WHERE batch_selection_date > {NOW} - INTERVAL 1 MONTH)"
register(
    "single_question",
    lambda wh: ledger_columns(single_question(wh, AS_OF)),
    numbered_sql(
        f"chosen AS ({QUESTIONED} AND case_id NOT IN (SELECT case_id FROM cam_select WHERE batch_id IN {RECENT}))",
        "chosen",
        "payer_name",
        "voucher_code",
        "patient_id",
    ),
)


def questioned_beside_a_nameless_contact(wh: Warehouse):
    """How many cases each null rule chooses once a recent contact has no case."""
    nameless = Warehouse(wh.spark, lambda name: wh["cam_select_nameless" if name == "cam_select" else name])
    counts = [
        single_question_list(nameless, AS_OF, rule).agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("cases"))
        for rule in ("sql", "guarded")
    ]
    return counts[0].unionByName(counts[1])


register(
    "single_question_nameless_contact",
    questioned_beside_a_nameless_contact,
    f"""SELECT 'sql' AS rule, count(*) AS cases FROM ({QUESTIONED}
  AND case_id NOT IN (SELECT case_id FROM cam_select_nameless WHERE batch_id IN {RECENT}))
UNION ALL SELECT 'guarded', count(*) FROM ({QUESTIONED}
  AND case_id NOT IN (SELECT case_id FROM cam_select_nameless WHERE batch_id IN {RECENT} AND case_id IS NOT NULL))""",
)

# Existing customers by mail.
MAIL_COLUMNS = "case_id, patient_id, product, result_date, payer_name, voucher_code, email".split(", ")
register(
    "existing_customer_mail",
    lambda wh: existing.existing_customer_mail(wh, AS_OF, excluded_payers=EXCLUDED).select(*MAIL_COLUMNS),
    f"""
WITH asked AS (SELECT case_id FROM contact_ledger
  WHERE cam_id = 1 AND batch_selection_date > {NOW} - INTERVAL 1 YEAR AND case_id IS NOT NULL)
SELECT {', '.join(MAIL_COLUMNS)} FROM mail_base
WHERE payer_name NOT IN {EXCLUDED_SQL}
  AND result_date BETWEEN {NOW} - INTERVAL 6 YEAR AND {NOW} - INTERVAL 3 MONTH
  AND case_id NOT IN (FROM asked)
  AND patient_id NOT IN (SELECT c.patient_id FROM case_cube AS c JOIN asked USING (case_id)
    WHERE c.patient_id IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY result_date DESC NULLS FIRST, case_id) = 1""",
)

# Existing customers of the cube, with and without the ledger rule.
FIRST, LAST = date(1995, 6, 1), date(1999, 9, 30)
CHANNELS = (*fv.CUBE_EXCLUDED_CHANNELS, "staff_program")


def cube_ctes(score: str) -> str:
    return f"""
subsidised AS (
  SELECT i.case_id FROM inquiries AS i JOIN insurance_data AS d ON d.inquiry_id = i.id
  WHERE d.main AND d.supplementary),
customers AS (
  SELECT c.*, CASE WHEN c.gender IN ('F', 'female') THEN 'Frau' WHEN c.gender IN ('M', 'male') THEN 'Herr'
      ELSE c.gender END AS salutation,
    CASE WHEN c.admission_channel IN ('online_marketing', 'partner_funnel') THEN 1 ELSE 0 END AS om_flag
  FROM case_cube AS c JOIN payer_history AS h ON h.client_name = c.payer_name
  WHERE h.valid_to = DATE '2999-12-31' AND h.coop_status
    AND c.result_date BETWEEN DATE '1995-06-01' AND DATE '1999-09-30'
    AND {score}
    AND c.voucher_code NOT IN ('KULANZ-MSSNICHTKOOPP', 'GADS-LF22') AND c.voucher_code NOT LIKE '%VRTC%'
    AND c.payer_group IN ('gkv', 'pkv') AND c.product <> 'RSO' AND c.admission_channel NOT IN ('proactive_steering', 'staff_program')
    AND c.country_code = 'de'
    AND (c.completion_reason IS NULL OR c.completion_reason IN {fv.CUBE_ALLOWED_REASONS})
    AND NOT regexp_matches(c.payer_name, 'Allianz|BIG|Generali|Audi BKK') AND c.payer_name <> 'AOK Plus'
    AND c.case_id NOT IN (SELECT case_id FROM subsidised)
    AND c.case_id NOT IN (SELECT case_id FROM suppression))"""


ANY_SCORE = """coalesce(c.medic_nps, 10) NOT IN (0, 2, 3, 4, 5, 6)
    AND coalesce(c.provider_nps, 10) NOT IN (0, 2, 3, 4, 5, 6)"""
BOTH_SCORES = "c.medic_nps IN (1, 7, 8, 9, 10) AND c.provider_nps IN (1, 7, 8, 9, 10)"
CUSTOMER_SQL = ", ".join(f"c.{name}" for name in existing.CUSTOMER_COLUMNS)


def cube_sql(score: str, ledger_rule: str) -> str:
    return f"""
WITH {cube_ctes(score)},
mailed AS (SELECT case_id FROM contact_ledger
  WHERE cam_id = 3 AND batch_selection_date > {NOW} - INTERVAL 1 YEAR AND case_id IS NOT NULL)
SELECT {CUSTOMER_SQL}, c.om_flag, p.first_name, p.last_name, p.email
FROM customers AS c JOIN patient_facts AS p USING (case_id)
WHERE length(p.email) >= 4 AND p.last_name IS NOT NULL {ledger_rule}
QUALIFY row_number() OVER (PARTITION BY c.patient_id ORDER BY c.result_date DESC NULLS FIRST, c.case_id) = 1"""


register(
    "existing_customer_cube",
    lambda wh: existing.existing_customer_cube(wh, AS_OF, FIRST, LAST, excluded_channels=CHANNELS),
    cube_sql(
        ANY_SCORE,
        """AND c.case_id NOT IN (FROM mailed) AND c.patient_id NOT IN (
    SELECT k.patient_id FROM case_cube AS k JOIN mailed USING (case_id) WHERE k.patient_id IS NOT NULL)""",
    ),
)
register(
    "existing_customer_cube_scored",
    lambda wh: existing.existing_customer_cube(wh, AS_OF, FIRST, LAST, excluded_channels=CHANNELS, scores_required=True, use_ledger=False),
    cube_sql(BOTH_SCORES, ""),
)

# Contact in either case system, decrypted after the selection.
register(
    "existing_customer_two_system",
    lambda wh: existing.existing_customer_two_system(wh, keyring(wh.spark), FIRST, LAST, excluded_channels=CHANNELS),
    f"""
WITH {cube_ctes(BOTH_SCORES)}
SELECT {CUSTOMER_SQL}, p.first_name AS case_first_name, p.last_name AS case_last_name, p.email AS case_email,
  i.first_name AS inquiry_first_name, i.last_name AS inquiry_last_name, i.email AS inquiry_email
FROM customers AS c LEFT JOIN patient_facts AS p USING (case_id)
  LEFT JOIN patient_data AS i ON i.service_id = c.service_id
WHERE CASE WHEN p.email IS NOT NULL THEN length(p.email) >= 4 ELSE length(i.email) >= 4 END
  AND (p.last_name IS NOT NULL OR i.last_name IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY c.patient_id ORDER BY c.result_date DESC NULLS FIRST, c.case_id) = 1""",
)

# Both case systems in one list.
UNIFIED_SQL = f"""
WITH happy_inquiries AS (
  SELECT * FROM inquiries WHERE NOT EXISTS (FROM contact_entries AS e
    WHERE e.inquiry_id = inquiries.id AND e.quality IN (0, 2, 3, 4, 5, 6) AND e.contact_type <> 'Q1')),
main_insurance AS (SELECT DISTINCT inquiry_id, insurance, supplementary FROM insurance_data WHERE main),
inquiry_side AS (
  SELECT 'inquiry' AS system, i.case_id, i.case_id || ':MSS' AS service_id, 'MSS' AS product,
    cast(i.results_sent_at AS date) AS result_date, v1.value AS code, v1.client_name AS client_1,
    v2.client_name AS client_2, m.insurance, m.supplementary AS subsidy, i.description, p.gender,
    cast(NULL AS string) AS title, p.first_name, p.last_name, cast(NULL AS string) AS county,
    lower(p.country_code) AS country, p.email, cast(i.provider_nps AS string) AS nps,
    i.completion_reason_main AS main_reason, i.completion_reason_additional AS more_reason,
    i.completion_details AS details, cast(i.exclude_from_reporting AS string) AS exclude
  FROM happy_inquiries AS i LEFT JOIN patient_data AS p ON p.inquiry_id = i.id
    LEFT JOIN voucher_dim AS v1 ON v1.id = i.voucher_ids[1]
    LEFT JOIN voucher_dim AS v2 ON v2.id = i.voucher_ids[2]
    LEFT JOIN main_insurance AS m ON m.inquiry_id = i.id),
scores AS (
  SELECT service_id, nps FROM feedbacks WHERE deleted_at IS NULL
  QUALIFY row_number() OVER (PARTITION BY service_id
    ORDER BY coalesce(try_cast(nps AS int), CASE nps WHEN 'not_specified' THEN 11 END) NULLS LAST, nps) = 1),
live_events AS (
  SELECT case_id || ':' || service AS service_id, event_type, json_extract_string(event_body, '$.properties.date') AS day,
    json_extract_string(event_body, '$.properties.reason') AS reason
  FROM workflow_events WHERE deleted_at IS NULL),
service_side AS (
  SELECT 'service' AS system, s.case_id, s.service_id, pr.name AS product,
    cast(strptime(f.day, '%d-%m-%Y') AS date) AS result_date, s.voucher_code AS code, pa.name AS client_1,
    cast(NULL AS string) AS client_2, co.title AS insurance, false AS subsidy,
    cast(NULL AS string) AS description, q.gender, q.title, q.first_name, q.last_name, q.county,
    q.country_code AS country, q.email, n.nps, x.reason AS main_reason, cast(NULL AS string) AS more_reason,
    cast(NULL AS string) AS details,
    CASE WHEN json_extract_string(k.markers, '$.test_case') = 'true'
      OR json_extract_string(k.markers, '$.deleted') IS NOT NULL THEN 'true' ELSE 'false' END AS exclude
  FROM services AS s JOIN live_events AS f ON f.service_id = s.service_id AND f.event_type LIKE '%DID_SEND_FINAL%'
    LEFT JOIN contracts AS c ON c.id = s.contract_id LEFT JOIN payers AS pa ON pa.id = c.payer_id
    LEFT JOIN products AS pr ON pr.id = s.product_id LEFT JOIN patient_facts AS q ON q.case_id = s.case_id
    LEFT JOIN scores AS n ON n.service_id = s.id
    LEFT JOIN live_events AS x ON x.service_id = s.service_id AND x.event_type LIKE '%DID_CLOSE%'
    LEFT JOIN case_markers AS k ON k.case_id = s.case_id
    LEFT JOIN primary_insurance_selections AS ps ON ps.case_id = s.case_id
    LEFT JOIN insurance_companies AS co ON co.id = ps.insurance_company_id
  WHERE s.deleted_at IS NULL AND NOT EXISTS (FROM visits AS v WHERE v.case_id = s.case_id
    AND v.deleted_at IS NULL AND v.visit_timing = 1 AND v.visit_nps IN ('0', '1', '2', '3', '4', '5', '6'))),
groups AS (SELECT DISTINCT client_name, client_group, coop_status FROM client_groups),
united AS (SELECT * FROM inquiry_side UNION ALL SELECT * FROM service_side),
kept AS (
  SELECT u.* FROM united AS u JOIN groups AS g1 ON g1.client_name = u.client_1
    LEFT JOIN groups AS g3 ON g3.client_name = u.insurance
  WHERE u.result_date BETWEEN {NOW} - INTERVAL 48 MONTH AND {NOW} - INTERVAL 24 MONTH
    AND u.case_id NOT IN (SELECT case_id FROM suppression) AND u.country = 'de' AND u.nps IN ('7', '8', '9', '10') AND coalesce(u.exclude, 'false') = 'false'
    AND coalesce(u.main_reason, '') NOT IN {fv.UNIFIED_MAIN_REASONS}
    AND (u.main_reason IS NULL OR u.more_reason NOT IN {fv.UNIFIED_ADDITIONAL_REASONS})
    AND coalesce(u.details, '') = '' AND (u.system <> 'inquiry' OR u.code IS NOT NULL)
    AND NOT (regexp_matches(coalesce(u.code, ''), 'MA4L') OR regexp_matches(coalesce(u.code, ''), 'pilot|kulanz', 'i')
      OR coalesce(u.code, '') IN {fv.UNIFIED_EXCLUDED_VOUCHERS})
    AND g1.client_group NOT IN ('vip', 'other', 'swiss_kv')
    AND NOT contains(lower(coalesce(u.description, '')), 'vip')
    AND u.client_1 NOT IN {fv.UNIFIED_EXCLUDED_CLIENTS}
    AND coalesce(u.insurance, '') NOT IN {fv.UNIFIED_EXCLUDED_INSURANCES}
    AND coalesce(g3.client_group, 'gkv') IN ('gkv', 'pkv', 'corporate') AND coalesce(g3.coop_status, true)
    AND u.subsidy IS NOT NULL
    AND NOT (u.subsidy AND NOT contains(lower(u.client_1), 'axa pkv') AND g1.client_group <> 'corporate')
    AND NOT EXISTS (FROM contact_ledger AS l WHERE l.case_id = u.case_id AND (l.cam_id IN (2, 3)
      OR (l.cam_id = 1 AND l.batch_selection_date < {NOW} - INTERVAL 4 WEEK))))
SELECT p.patient_id, k.system, k.case_id, k.gender,
  CASE WHEN k.gender IN ('female', 'F') THEN 'Frau' WHEN k.gender IN ('male', 'M') THEN 'Herr' ELSE k.gender END
    AS salutation, k.title, k.first_name, k.last_name, k.result_date, k.county, k.country, k.email, k.client_1, k.client_2
FROM kept AS k LEFT JOIN patient_ids AS p USING (case_id)
QUALIFY row_number() OVER (PARTITION BY p.patient_id ORDER BY k.result_date DESC NULLS FIRST, k.case_id, k.system,
  k.service_id, k.product NULLS LAST, k.client_1 NULLS LAST, k.code NULLS LAST) = 1"""

register(
    "existing_customer_unified",
    lambda wh: existing.existing_customer_unified(wh, AS_OF, keyring(wh.spark)),
    UNIFIED_SQL,
)

# Simple lists.
register(
    "existing_customer_simple_a",
    lambda wh: existing.existing_customer_simple_a(wh, ["%NATION_7%"]),
    """
SELECT DISTINCT s.case_id, p.name AS payer_brand, co.title AS insurance_name, s.voucher_code, x.voucher_description,
  f.nps AS provider_nps, f.free_text AS provider_nps_reason
FROM services AS s JOIN contracts AS c ON c.id = s.contract_id JOIN payers AS p ON p.id = c.payer_id
  JOIN workflow_events AS e USING (case_id) LEFT JOIN feedbacks AS f ON f.service_id = s.id
  JOIN primary_insurance_selections AS ps ON ps.case_id = s.case_id
  JOIN insurance_companies AS co ON co.id = ps.insurance_company_id
  LEFT JOIN voucher_texts AS x ON x.voucher_code = s.voucher_code
WHERE e.event_type LIKE '%DID_SEND_FINAL%' AND (s.product = 'RSO' OR s.product LIKE '%PMS%')
  AND NOT regexp_matches(p.name, 'Allianz|BKK24|IKK - Die Inno|Patientenclub|VIP|HDI|NATION_7')
  AND s.voucher_code NOT LIKE '%MA4L%'
  AND s.voucher_code NOT IN ('DAK1-LA3F', 'DAK-RZM-LEAD', 'DAKG-MSSNACHRSO')""",
)
register(
    "existing_customer_simple_b",
    lambda wh: existing.existing_customer_simple_b(wh, ["%Staff%"]),
    """
SELECT i.case_id, v.client_name AS voucher_client, g.client_group, v.value AS first_voucher_code,
  p.country_code, i.provider_nps
FROM inquiries AS i JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  JOIN client_groups AS g ON g.client_name = v.client_name LEFT JOIN patient_data AS p ON p.inquiry_id = i.id
WHERE i.results_sent_at IS NOT NULL AND g.client_group <> 'Corporate'
  AND NOT regexp_matches(v.client_name, 'Allianz|Assura|VIP|Promo|Test|Patient|Staff')
  AND v.value NOT IN ('B1-L7 KULANZ', 'AX91-FLA3', 'ARAG-CM22', 'AXAU-22GS', 'AXAP-22GS')
  AND v.value NOT LIKE '%MA4L%' AND (upper(p.country_code) = 'DE' OR p.country_code IS NULL)
  AND coalesce(i.provider_nps, 7) >= 7""",
)


# Telephone reviews of the phone cube.
def call_sql(rules: str, ledger_rule: str) -> str:
    ctes = f"""
called AS (SELECT case_id, batch_selection_date FROM contact_ledger
  WHERE cam_category IN ('Anrufaktion', 'Regelprozess') AND case_id IS NOT NULL),
recent AS (SELECT case_id FROM called WHERE batch_selection_date >= {NOW} - INTERVAL 1 MONTH),
recent_patients AS (SELECT patient_id FROM case_cube WHERE patient_id IS NOT NULL AND case_id IN (FROM recent)),
chosen AS (
  SELECT * FROM phone_cube
  WHERE result_date BETWEEN {NOW} - INTERVAL 6 MONTH AND {NOW} - INTERVAL 6 WEEK
    AND NOT coalesce(hard_exclusion, true) AND NOT coalesce(questioning_inappropriate, true)
    AND NOT coalesce(prem_return, true)
    AND coalesce(status_survey_latest_planned_at < {NOW} - INTERVAL 1 WEEK, true)
    AND coalesce(prem_latest_planned_at < {NOW} - INTERVAL 2 WEEK, true)
    AND coalesce(prem_latest_sent_at < {NOW} - INTERVAL 2 WEEK, true)
    AND {rules} AND {ledger_rule}
    AND (patient_id IS NULL OR patient_id NOT IN (FROM recent_patients))
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY result_date DESC NULLS FIRST, case_id) = 1)"""
    return numbered_sql(
        ctes, "chosen", "payer_name", "voucher_code", "patient_id", language="preferred_language"
    )


NEVER = "case_id NOT IN (SELECT case_id FROM called)"
register(
    "call_msn",
    lambda wh: ledger_columns(calls.call_msn(wh, AS_OF, "%nation_1%")),
    call_sql(
        """lower(product_v2) LIKE '%msn%' AND prem_result_return = false
    AND inquiry_type <> 'second_opinion_before_surgery' AND lower(payer_name) LIKE '%nation_1%'""",
        NEVER,
    ),
)
register(
    "call_pmn",
    lambda wh: ledger_columns(calls.call_pmn(wh, AS_OF, "%NATION%")),
    call_sql(
        """lower(product_v2) LIKE '%pmn%' AND payer_name LIKE '%NATION%' AND provider_nps IS NULL
    AND medic_nps IS NULL""",
        NEVER,
    ),
)


register(
    "call_corporate",
    lambda wh: ledger_columns(calls.call_corporate(wh, AS_OF, "%nation%")),
    call_sql(
        """(lower(product_v2) LIKE '%msn%' OR lower(product_v2) LIKE '%pmn%')
    AND lower(payer_name) LIKE '%nation%' AND medic_nps IS NULL AND provider_nps IS NULL""",
        NEVER,
    ),
)
register(
    "call_second_try_surgery",
    lambda wh: ledger_columns(calls.call_second_try_surgery(wh, AS_OF, "%nation%")),
    call_sql(
        """lower(product_v2) LIKE '%msn%' AND prem_result_return = false
    AND lower(payer_name) LIKE '%nation%'""",
        """((inquiry_type = 'surgery' AND case_id NOT IN (SELECT case_id FROM called))
      OR (inquiry_type = 'second_opinion_before_surgery' AND case_id NOT IN (FROM recent)
        AND case_id NOT IN (SELECT case_id FROM called GROUP BY case_id HAVING count(*) > 1)))""",
    ),
)
