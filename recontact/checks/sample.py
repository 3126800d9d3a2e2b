"""A case warehouse derived from the given tables.

Each view is one SELECT over the given tables or other views. The text runs in Spark and in the SQL
check alike, so both sides start from the same rows; only the selections are written twice. An order
plays the case, a customer the patient, a nation the payer, a part the voucher, a supplier the survey,
a line item the appointment, survey link, workflow event or ledger row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.functions.pii import encrypt_text
from recontact.sources.warehouse import Warehouse

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

PAYER_GROUP = """CASE r_name WHEN 'AMERICA' THEN 'gkv' WHEN 'EUROPE' THEN 'pkv' WHEN 'ASIA' THEN 'kv'
    WHEN 'AFRICA' THEN 'corporate' ELSE 'other' END"""

# Half of the cases have their result in 1999, on the day of the year of their order.
IN_1999 = """CASE year(o_orderdate) WHEN 1995 THEN o_orderdate + interval '48' month
    WHEN 1996 THEN o_orderdate + interval '36' month WHEN 1997 THEN o_orderdate + interval '24' month
    WHEN 1998 THEN o_orderdate + interval '12' month WHEN 2000 THEN o_orderdate - interval '12' month
    WHEN 2001 THEN o_orderdate - interval '24' month ELSE o_orderdate END"""
RESULT_DAY = f"cast(CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate ELSE {IN_1999} END AS date)"


def some_days(first: str, days: int) -> str:
    """SQL for a time on one of a few days, by the number of a line."""
    step = " ".join(f"WHEN {i} THEN interval '{i}' day" for i in range(days))
    return f"cast('{first}' AS timestamp) + CASE l_linenumber % {days} {step} END"


# When something happened to a line. Some cases had theirs in the weeks that short windows look at.
LINE_TIME = f"""CASE WHEN l_orderkey % 8 = 1 THEN {some_days('1999-06-07 00:00:00', 5)}
    WHEN l_orderkey % 8 = 3 THEN {some_days('1998-11-02 00:00:00', 7)} ELSE l_shipdate END"""
LINE_DAY = f"""lpad(cast(day({LINE_TIME}) AS string), 2, '0') || '-' ||
    lpad(cast(month({LINE_TIME}) AS string), 2, '0') || '-' || cast(year({LINE_TIME}) AS string)"""
INVITED_TIME = f"CASE WHEN l_orderkey % 8 = 5 THEN {some_days('1999-12-11 00:00:00', 6)} ELSE l_shipdate END"

APPOINTED_TIME = f"""CASE WHEN l_orderkey % 8 = 7 THEN {some_days('1999-01-04 00:00:00', 7)}
    WHEN l_orderkey % 16 = 5 THEN {some_days('1996-06-17 00:00:00', 7)} ELSE l_shipdate END"""

VIEWS: dict[str, str] = {}

VIEWS["case_wide"] = f"""
SELECT o_orderkey AS id, cast(o_orderkey AS string) AS case_id, o_custkey, o_orderstatus, o_orderpriority,
  o_totalprice, o_orderdate, c_mktsegment, c_name, c_nationkey, n_name, r_name,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE o_custkey END AS patient_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MSS' WHEN '2-HIGH' THEN 'MSS' WHEN '3-MEDIUM' THEN 'PMS'
    WHEN '4-NOT SPECIFIED' THEN 'MSN' ELSE 'RSO' END AS product,
  CASE WHEN o_totalprice > 490000 THEN NULL ELSE {RESULT_DAY} END AS result_date,
  cast(c_nationkey AS bigint) AS payer_id, n_name AS payer_name, {PAYER_GROUP} AS payer_group,
  CASE WHEN o_totalprice < 10000 THEN NULL WHEN o_totalprice < 15000 THEN ''
    WHEN o_totalprice < 40000 OR (o_orderkey % 8 = 3 AND o_totalprice < 300000) THEN 'VRTC-' || cast(c_nationkey AS string)
    WHEN o_totalprice < 50000 THEN 'GADS-LF22'
    ELSE 'STD-' || cast(c_nationkey AS string) END AS voucher_code,
  CASE WHEN o_totalprice > 450000 THEN true WHEN o_totalprice > 440000 THEN NULL ELSE false END AS goodwill,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderstatus = 'P' THEN NULL
    WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') AND o_orderstatus = 'F' THEN NULL
    ELSE cast(cast(floor(o_totalprice) AS bigint) % 11 AS int) END AS provider_nps,
  CASE WHEN o_orderstatus = 'F' OR c_mktsegment = 'HOUSEHOLD' THEN NULL
    ELSE cast(cast(floor(o_totalprice / 7) AS bigint) % 11 AS int) END AS medic_nps,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Befragung vollständig durchgeführt'
    WHEN 'BUILDING' THEN CASE o_orderstatus WHEN 'F' THEN 'Interner Grund - Sonstige'
      WHEN 'O' THEN 'keine weitere befragung gewünscht' ELSE 'Patient mehrfach nicht erreicht' END
    ELSE NULL END AS completion_reason,
  CASE o_orderstatus WHEN 'F' THEN 'online_marketing' WHEN 'O' THEN 'partner_funnel'
    ELSE CASE WHEN o_totalprice > 400000 THEN 'proactive_steering' WHEN o_totalprice > 350000 THEN 'staff_program' ELSE 'hotline' END
    END AS admission_channel,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'second_opinion_before_surgery' WHEN '2-HIGH' THEN 'surgery'
    WHEN '3-MEDIUM' THEN 'surgery' WHEN '4-NOT SPECIFIED' THEN 'conservative' ELSE 'other'
    END AS inquiry_type,
  CASE r_name WHEN 'MIDDLE EAST' THEN 'at' ELSE 'de' END AS country_code,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'F' WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN 'female'
    WHEN 'FURNITURE' THEN 'male' ELSE 'diverse' END AS gender,
  CASE WHEN r_name <> 'ASIA' THEN 'de' WHEN c_mktsegment = 'MACHINERY' THEN 'fr'
    WHEN c_mktsegment = 'BUILDING' THEN 'it' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'en'
    ELSE 'de' END AS preferred_language,
  CASE WHEN o_totalprice < 60000 THEN NULL
    WHEN c_mktsegment = 'FURNITURE' THEN c_name || '@googlemail.com'
    WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_name || '@Gmail.com'
    WHEN o_orderstatus = 'F' THEN c_name WHEN o_orderstatus = 'O' THEN ''
    ELSE c_name || '@example.org' END AS email,
  CASE o_orderstatus WHEN 'F' THEN 'email' WHEN 'O' THEN 'phone' ELSE 'postal' END AS preferred_channel
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

VIEWS["case_cube"] = """
SELECT case_id, case_id || ':' || product AS service_id, patient_id, product, result_date, payer_id,
  payer_name, payer_group, voucher_code, goodwill, provider_nps, medic_nps, completion_reason,
  admission_channel, inquiry_type, country_code, gender, preferred_language
FROM case_wide"""

VIEWS["pii"] = """
SELECT case_id || ':' || product AS service_id, CASE o_orderstatus WHEN 'P' THEN 'Dr.' ELSE NULL END AS title,
  c_name AS first_name, c_mktsegment AS last_name, n_name AS city, r_name AS state, email, country_code,
  preferred_channel, preferred_language
FROM case_wide"""

VIEWS["phone_cube"] = """
SELECT case_id, patient_id, result_date, payer_name, payer_group, voucher_code, inquiry_type,
  provider_nps, medic_nps, preferred_language,
  CASE o_orderstatus WHEN 'F' THEN 'MSN Basis' WHEN 'O' THEN 'Plus msn' ELSE 'PMN Start' END AS product_v2,
  o_totalprice > 480000 AS hard_exclusion,
  CASE WHEN o_totalprice > 470000 THEN NULL ELSE o_totalprice > 460000 END AS questioning_inappropriate,
  CASE WHEN o_totalprice > 455000 THEN NULL ELSE o_totalprice > 430000 END AS prem_return,
  o_totalprice > 420000 AS prem_result_return,
  CASE c_mktsegment WHEN 'MACHINERY' THEN NULL
    ELSE cast(o_orderdate + interval '60' day AS date) END AS status_survey_latest_planned_at,
  CASE c_mktsegment WHEN 'BUILDING' THEN NULL
    ELSE cast(o_orderdate + interval '45' day AS date) END AS prem_latest_planned_at,
  CASE c_mktsegment WHEN 'FURNITURE' THEN NULL
    ELSE cast(o_orderdate + interval '50' day AS date) END AS prem_latest_sent_at,
  '+49-' || cast(o_custkey AS string) AS primary_phone
FROM case_wide"""

VIEWS["single_question"] = f"""
SELECT case_id, case_id || ':' || product AS service_id, product, patient_id, cast({IN_1999} AS date) AS result_date, payer_name,
  payer_group, voucher_code, admission_channel, preferred_channel, inquiry_type,
  CASE preferred_channel WHEN 'email' THEN true WHEN 'phone' THEN NULL ELSE false END AS channel_reach_email,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Fuß' WHEN 'BUILDING' THEN 'Hüfte' WHEN 'MACHINERY' THEN 'Schulter'
    ELSE 'Knie' END AS therapy_group,
  CASE WHEN o_totalprice > 470000 THEN 'Sonstige Operation' ELSE 'Endoprothese' END AS therapy,
  CASE WHEN o_totalprice < 60000 THEN 'answered' ELSE NULL END AS result,
  o_totalprice < 460000 AS reporting_bool,
  CASE WHEN o_totalprice < 70000 THEN 2 ELSE 1 END AS op_category,
  CASE WHEN o_totalprice < 90000 THEN 2 ELSE 1 END AS cases_last_two_years,
  CASE WHEN o_totalprice < 95000 THEN 'completed' ELSE 'waiting_q3' END AS inquiries_state,
  '3' AS appointment_type,
  CASE WHEN o_totalprice < 200000 THEN 'sent' WHEN o_totalprice < 420000 THEN 'call_patient'
    ELSE 'completed' END AS appointment_state
FROM case_wide"""

VIEWS["mail_base"] = """
SELECT case_id, case_id || ':' || product AS service_id, patient_id, product, result_date,
  admission_channel, payer_name, payer_group, voucher_code, gender, c_name AS first_name,
  c_mktsegment AS last_name, email, country_code, provider_nps, medic_nps
FROM case_wide"""

VIEWS["payer_dim"] = f"""
SELECT cast(n_nationkey AS bigint) AS client_id, n_name AS client_name, {PAYER_GROUP} AS client_group,
  CASE n_name WHEN 'NATION_4' THEN false WHEN 'NATION_6' THEN false WHEN 'NATION_8' THEN NULL ELSE true END
    AS coop_status
FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["payer_history"] = """
SELECT client_id, client_name, client_group, coop_status, cast('2999-12-31' AS date) AS valid_to FROM payer_dim
UNION ALL
SELECT client_id, client_name, client_group, NOT coop_status, cast('1998-12-31' AS date) FROM payer_dim"""

# Clients with up to three versions: changed once or twice, ended, or of one day that ends two of them.
VIEWS["client_history"] = """
SELECT c_custkey AS client_id, c_name AS client_name, c_mktsegment AS client_group, c_acctbal > 0 AS coop_status,
  CASE WHEN c_nationkey < 5 THEN cast('1999-12-31' AS date) ELSE cast('2999-12-31' AS date) END AS valid_to FROM customer
UNION ALL
SELECT c_custkey, c_name || ' old', c_mktsegment, NULL, cast('1999-06-30' AS date) FROM customer WHERE c_nationkey < 20
UNION ALL
SELECT c_custkey, c_name || ' new', c_mktsegment, true,
  CASE WHEN c_acctbal < 0 THEN cast('2000-01-01' AS date) WHEN c_acctbal < 5000 THEN cast('2000-01-02' AS date)
    WHEN c_acctbal < 7000 THEN cast('2999-12-31' AS date) END
FROM customer WHERE c_nationkey > 10"""

# Ledger: returned line items. The line number names the campaign, the ship month the batch.
CAM_OF_LINE = """CASE WHEN l_linenumber = 5 THEN 8 WHEN l_linenumber = 6 AND l_linestatus = 'O' THEN 56
    WHEN l_linenumber = 7 THEN 97 ELSE l_linenumber END"""
BATCH_OF_LINE = f"(year(l_shipdate) * 12 + month(l_shipdate)) * 100 + {CAM_OF_LINE}"

# Rows without case lie in a batch that no campaign opened.
NAMELESS = "l_linenumber = 1 AND l_quantity = 1 AND l_shipdate > cast('2000-06-01' AS date)"

VIEWS["cam_select"] = f"""
SELECT cast(l_orderkey * 10 + l_linenumber AS bigint) AS select_id,
  CASE WHEN {NAMELESS} THEN cast(7 AS bigint) ELSE cast({BATCH_OF_LINE} AS bigint) END AS batch_id,
  CASE WHEN {NAMELESS} THEN NULL ELSE cast(l_orderkey AS string) END AS case_id
FROM lineitem WHERE l_returnflag = 'R'"""

# The ledger with a contact of no known case in its last batch.
VIEWS["cam_select_nameless"] = """
SELECT select_id, batch_id, case_id FROM cam_select
UNION ALL SELECT cast(0 AS bigint), max(batch_id), cast(NULL AS string) FROM cam_batch WHERE cam_id = 97"""

VIEWS["cam_batch"] = f"""
SELECT DISTINCT {CAM_OF_LINE} AS cam_id, cast({BATCH_OF_LINE} AS bigint) AS batch_id,
  cast(date_trunc('month', l_shipdate) AS date) AS batch_selection_date
FROM lineitem WHERE l_returnflag = 'R'"""

VIEWS["cam_cam"] = """
SELECT cam_id, cam_name,
  CASE WHEN cam_id = 97 THEN 'Anrufaktion' WHEN cam_id IN (4, 6) THEN 'Regelprozess' ELSE 'Mailing' END
    AS cam_category
FROM (SELECT CASE n_nationkey WHEN 20 THEN 56 WHEN 21 THEN 97 WHEN 22 THEN 76 ELSE n_nationkey END AS cam_id,
  'call ' || n_name AS cam_name FROM nation) AS campaigns"""

# Read by the SQL checks only.
VIEWS["contact_ledger"] = """
SELECT case_id, cam_id, batch_id, batch_selection_date, cam_category
FROM cam_select LEFT JOIN cam_batch USING (batch_id) LEFT JOIN cam_cam USING (cam_id)"""

VIEWS["suppression"] = """
SELECT cast(o_orderkey AS string) AS case_id,
  CASE o_orderstatus WHEN 'F' THEN 'objection' ELSE 'contact person' END AS reason
FROM orders WHERE o_totalprice BETWEEN 200000 AND 220000"""

# Inquiry system. The vouchers of a case are its parts in the order of the seven line numbers.
VOUCHER_SLOTS = ", ".join(f"max(CASE WHEN l_linenumber = {i} THEN l_partkey END)" for i in range(1, 8))

VIEWS["inquiries"] = {
    engine: f"""
SELECT id, case_id, case_id || ':' || product AS service_id,
  CASE o_orderstatus WHEN 'F' THEN 'waiting_q3' WHEN 'P' THEN 'completed'
    ELSE CASE c_mktsegment WHEN 'MACHINERY' THEN 'waiting_q3' WHEN 'BUILDING' THEN 'waiting_q4'
      WHEN 'FURNITURE' THEN 'waiting_q5' ELSE 'waiting_q6' END END AS state,
  inquiry_type AS treatment_type, voucher_ids,
  CASE c_mktsegment WHEN 'MACHINERY' THEN cast(date_trunc('year', o_orderdate) + interval '9' month AS date)
    ELSE cast(o_orderdate AS date) END AS results_sent_at,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'internal_reason' WHEN 'AUTOMOBILE' THEN 'survey_inappropriate'
    ELSE NULL END AS completion_reason_main,
  CASE WHEN o_totalprice > 450000 THEN 'patient_difficult' WHEN o_totalprice > 300000 THEN 'none'
    ELSE NULL END AS completion_reason_additional,
  CASE WHEN o_totalprice > 470000 THEN 'note' WHEN o_totalprice > 400000 THEN '' ELSE NULL END
    AS completion_details,
  CASE WHEN o_totalprice > 485000 THEN 'a Vip case' ELSE NULL END AS description,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE cast(cast(floor(o_totalprice) AS bigint) % 11 AS int) END
    AS provider_nps,
  CASE WHEN o_totalprice > 230000 AND o_totalprice < 260000 THEN true
    WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE false END AS exclude_from_reporting,
  CASE WHEN o_totalprice > 495000 THEN o_orderdate ELSE NULL END AS deleted_at
FROM case_wide LEFT JOIN (SELECT l_orderkey, {array} AS voucher_ids FROM lineitem GROUP BY l_orderkey)
  AS lines ON l_orderkey = id"""
    for engine, array in (
        ("spark", f"array_compact(array({VOUCHER_SLOTS}))"),
        ("duckdb", f"list_filter([{VOUCHER_SLOTS}], lambda x: x IS NOT NULL)"),
    )
}

VIEWS["inquiry_results"] = """
SELECT case_id || ':' || product AS service_id, cast(date_trunc('year', o_orderdate) AS date)
  AS least_result_date FROM case_wide"""

VIEWS["appointments"] = f"""
SELECT l_orderkey AS inquiry_id,
  CASE WHEN l_linenumber = 7 THEN CASE l_linestatus WHEN 'O' THEN '4' ELSE '2' END
    WHEN l_linenumber IN (3, 4) THEN '3' ELSE '1' END AS appointment_type,
  CASE WHEN l_returnflag = 'A' THEN CASE l_linestatus WHEN 'F' THEN 'call_patient' ELSE 'sent' END
    WHEN l_returnflag = 'N' THEN CASE l_linestatus WHEN 'F' THEN 'sent' ELSE 'ready_to_send_pdf' END
    ELSE CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'deleted' END END AS state,
  CASE WHEN l_tax = 0 THEN NULL ELSE cast({APPOINTED_TIME} AS date) END AS scheduled_date
FROM lineitem"""

VIEWS["contact_entries"] = """
SELECT l_orderkey AS inquiry_id, CASE WHEN l_quantity > 45 THEN 'answered' ELSE NULL END AS q3_result,
  CASE WHEN l_quantity > 40 THEN cast(round(l_discount * 100) AS int) ELSE NULL END AS quality,
  CASE l_linenumber WHEN 1 THEN 'Q1' ELSE 'Q3' END AS contact_type
FROM lineitem"""

VIEWS["patient_data"] = """
SELECT id AS inquiry_id, case_id || ':' || product AS service_id,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'email' WHEN 'AUTOMOBILE' THEN 'email' WHEN 'HOUSEHOLD' THEN 'phone'
    ELSE 'post' END AS preferred_communication_channel,
  CASE WHEN o_totalprice > 400000 THEN o_orderdate ELSE NULL END AS status_survey_reminder_sent_at,
  gender, c_name AS first_name, c_mktsegment AS last_name,
  CASE o_orderstatus WHEN 'F' THEN '' ELSE email END AS email, country_code
FROM case_wide"""

VIEWS["insurance_data"] = """
SELECT id AS inquiry_id, true AS main, o_totalprice < 120000 AS supplementary, n_name AS insurance,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '["app"]' WHEN 'MACHINERY' THEN NULL ELSE '[]' END AS options
FROM case_wide
UNION ALL
SELECT id, false, true, n_name, NULL FROM case_wide WHERE o_totalprice > 250000"""

VIEWS["voucher_dim"] = """
SELECT p_partkey AS id,
  CASE WHEN p_type = 'PROMO' THEN 'VRTC-' || p_brand
    WHEN p_type = 'SMALL' AND p_size < 10 THEN 'X-BDTC' WHEN p_type = 'SMALL' AND p_size < 20 THEN 'NUBU-7777'
    ELSE p_brand || '-' || cast(p_size AS string) END AS value,
  CASE WHEN p_size = 46 THEN 'Own Staff' WHEN p_size < 5 THEN 'VIP ROT' WHEN p_size < 8 THEN 'VIP GELB' WHEN p_type = 'LARGE' THEN 'DAK'
    WHEN p_size > 47 THEN 'AXA Haftpflichtversicherung' ELSE 'Client ' || p_type END AS client_name
FROM part"""

# Case system.
VIEWS["services"] = """
SELECT id, case_id, case_id || ':' || product AS service_id, product, c_nationkey AS contract_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 1
    WHEN '4-NOT SPECIFIED' THEN 2 ELSE 3 END AS product_id, voucher_code,
  CASE WHEN o_totalprice > 480000 THEN o_orderdate ELSE NULL END AS deleted_at
FROM case_wide"""

VIEWS["contracts"] = "SELECT n_nationkey AS id, n_nationkey AS payer_id FROM nation"

VIEWS["payers"] = """
SELECT n_nationkey AS id,
  CASE WHEN r_name = 'ASIA' AND n_nationkey < 10 THEN 'Assura ' || n_name WHEN r_name = 'ASIA' THEN 'ÖKK ' || n_name
    ELSE n_name END AS name
FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["products"] = """
SELECT r_regionkey AS id, CASE r_regionkey WHEN 0 THEN 'MSS' WHEN 1 THEN 'PMS' WHEN 2 THEN 'MSN'
  WHEN 3 THEN 'RSO' ELSE 'SPC' END AS name FROM region"""

VIEWS["workflow_events"] = f"""
SELECT cast(l_orderkey AS string) AS case_id,
  CASE WHEN l_linenumber < 4 THEN 'DID_SEND_FINAL_RESULT' WHEN l_linenumber = 4 THEN 'DID_SEND_STATUS_SURVEY'
    WHEN l_linenumber = 5 THEN 'did_send_prem_survey'
    WHEN l_linenumber = 6 THEN CASE l_returnflag WHEN 'R' THEN 'DID_RECEIVE_FEEDBACK' ELSE 'DID_VIEW' END
    ELSE CASE l_returnflag WHEN 'A' THEN 'DID_CLOSE_CASE' ELSE 'DID_NOTE' END END AS event_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MSS' WHEN '2-HIGH' THEN 'MSS' WHEN '3-MEDIUM' THEN 'PMS'
    WHEN '4-NOT SPECIFIED' THEN 'MSN' ELSE 'RSO' END AS service,
  cast({LINE_TIME} AS date) AS event_date, {LINE_TIME} AS event_time,
  '{{"properties":{{"date":"' || {LINE_DAY} || '","reason":"' ||
    CASE WHEN l_quantity < 10 THEN 'Keine weitere Befragung gewünscht' WHEN l_quantity < 20 THEN 'Sonstige'
      ELSE 'Kontaktadresse fehlt' END || '","product":"' ||
    CASE l_linestatus WHEN 'F' THEN 'Spezialistensuche' ELSE 'Erstmeinung' END || '"}}}}' AS event_body,
  CASE WHEN l_discount > 0.095 THEN l_shipdate ELSE NULL END AS deleted_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# Events as they arrive: of some cases long after they happened.
VIEWS["arrived_events"] = """
SELECT case_id, event_type, event_time, CASE WHEN case_id LIKE '%7' THEN cast(event_time + interval '500' day AS date)
    ELSE cast(event_time + interval '1' day AS date) END AS arrived_on
FROM workflow_events"""

# Tries to deliver the cards of the ledger, some cards once, some twice, some never.
VIEWS["card_attempts"] = """
SELECT 'first' AS run, batch_id, case_id AS name, CASE WHEN select_id % 3 = 0 THEN 'failed' WHEN select_id % 3 = 1 THEN 'delivered'
    ELSE 'lost' END AS state, cast('1999-01-04' AS date) AS attempted_on FROM cam_select WHERE select_id % 5 <> 0
UNION ALL
SELECT 'second', batch_id, case_id, CASE WHEN select_id % 4 = 0 THEN 'given up' WHEN select_id % 7 = 1 THEN 'delivered'
    ELSE 'failed' END, cast('1999-01-05' AS date) FROM cam_select WHERE select_id % 2 = 0"""

VIEWS["survey_links"] = f"""
SELECT cast(l_orderkey AS string) AS case_id, l_suppkey AS survey_id, {INVITED_TIME} AS created_at,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'complete' ELSE NULL END AS response_status
FROM lineitem"""

VIEWS["surveys"] = """
SELECT s_suppkey AS id,
  CASE WHEN s_nationkey < 5 THEN 'MSS Nachbefragung Status' WHEN s_nationkey < 10 THEN 'MSS Nachbefragung PREM'
    WHEN s_nationkey < 13 THEN 'PMS Nachbefragung Allrounder' WHEN s_nationkey < 16 THEN 'PMS Nachbefragung Reha'
    WHEN s_nationkey < 18 THEN 'PROM Fragebogen' ELSE 'Rundbrief' END AS title
FROM supplier"""

VIEWS["communication_facts"] = """
SELECT case_id, preferred_language, email,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'postal' WHEN 'HOUSEHOLD' THEN NULL ELSE 'email' END
    AS channel_recommendation
FROM case_wide"""

VIEWS["conversations_ref"] = """
SELECT case_id, product, CASE product WHEN 'PMS' THEN '["feedback_follow_up"]'
  ELSE '["feedback_follow_up_mss"]' END AS topics
FROM case_wide WHERE o_totalprice > 400000"""

VIEWS["feedbacks"] = """
SELECT l_orderkey AS service_id, CASE WHEN l_quantity > 48 THEN 'not_specified' WHEN l_quantity > 28 THEN NULL
  ELSE cast(cast(l_quantity AS int) % 11 AS string) END AS nps,
  CASE WHEN l_quantity > 48 THEN 'free words' ELSE NULL END AS free_text,
  CASE WHEN l_discount > 0.095 THEN l_shipdate ELSE NULL END AS deleted_at
FROM lineitem"""

VIEWS["case_markers"] = """
SELECT case_id, CASE WHEN o_totalprice < 15000 THEN '{"test_case":"true"}'
  WHEN o_totalprice < 25000 THEN '{"deleted":"1999"}' ELSE '{"test_case":"false"}' END AS markers
FROM case_wide"""

VIEWS["visits"] = """
SELECT cast(l_orderkey AS string) AS case_id, l_linenumber AS visit_timing, cast(l_shipdate AS date) AS visit_date,
  CASE WHEN l_quantity > 25 THEN NULL ELSE cast(cast(l_quantity AS int) % 11 AS string) END AS visit_nps,
  CASE WHEN l_discount > 0.095 THEN l_shipdate ELSE NULL END AS deleted_at
FROM lineitem"""

VIEWS["opinions"] = """
SELECT cast(l_orderkey AS string) AS case_id, CASE WHEN l_tax > 0.04 THEN 'conservative' ELSE NULL END
  AS therapy_decision
FROM lineitem WHERE l_linenumber = 1"""

VIEWS["card_log"] = """
SELECT cast(l_orderkey AS string) AS case_id, CASE l_linestatus WHEN 'F' THEN 'follow-up board' ELSE 'intake board' END
  AS board, CASE l_linenumber WHEN 1 THEN 'other' ELSE 'inbox' END AS list,
  CASE l_returnflag WHEN 'R' THEN 'moveCardToBoard' ELSE 'createCard' END AS action_type,
  CASE l_returnflag WHEN 'R' THEN 'action_move_card' ELSE 'action_create_card' END AS transaction_name,
  l_shipdate AS card_create_timestamp
FROM lineitem WHERE l_tax > 0.06"""

VIEWS["report_flags"] = """
SELECT case_id || ':' || product AS service_id,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'ja' WHEN 'MACHINERY' THEN 'nein' ELSE NULL END AS qualimed
FROM case_wide"""

VIEWS["patient_facts"] = """
SELECT case_id, c_name AS first_name, CASE WHEN o_totalprice < 55000 THEN NULL ELSE c_mktsegment END AS last_name,
  email, country_code, gender, CASE o_orderstatus WHEN 'P' THEN 'Dr.' ELSE NULL END AS title, r_name AS county
FROM case_wide"""

VIEWS["primary_insurance_selections"] = """
SELECT case_id, o_custkey % 25 AS insurance_company_id FROM case_wide WHERE o_totalprice > 100000"""

VIEWS["insurance_companies"] = """
SELECT n_nationkey AS id, CASE n_nationkey WHEN 3 THEN 'BIG direkt gesund' ELSE n_name END AS title FROM nation"""

VIEWS["voucher_texts"] = """
SELECT voucher_code, 'voucher of ' || voucher_code AS voucher_description
FROM (SELECT DISTINCT voucher_code FROM case_wide WHERE voucher_code IS NOT NULL) AS codes"""

VIEWS["patient_ids"] = "SELECT case_id, patient_id FROM case_wide"

VIEWS["client_groups"] = """
SELECT client_name, client_group, coop_status FROM payer_dim
UNION ALL
SELECT name, 'swiss_kv', true FROM payers WHERE name LIKE 'Assura%'
UNION ALL
SELECT DISTINCT client_name, CASE WHEN client_name LIKE 'VIP%' THEN 'vip' WHEN client_name = 'DAK' THEN 'gkv'
  WHEN client_name LIKE 'Client%' THEN 'corporate' ELSE 'pkv' END, true FROM voucher_dim"""

# Columns that are stored encrypted; the SQL check reads them in clear.
ENCRYPTED = {"patient_data": ["first_name", "last_name", "email"]}


def view_text(name: str, engine: str) -> str:
    text = VIEWS[name]
    return (text[engine] if isinstance(text, dict) else text).strip()


def _needed(text: str, engine: str, found: dict[str, str]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", text):
            body = view_text(name, engine)
            _needed(body, engine, found)
            found[name] = body


def with_views(sql: str, engine: str = "duckdb") -> str:
    """Prefix a query with the views it reads, in order of dependence."""
    found: dict[str, str] = {}
    _needed(sql, engine, found)
    if not found:
        return sql
    views = ",\n".join(f"{name} AS ({body})" for name, body in found.items())
    sql = sql.strip()
    if sql[:5].upper() == "WITH ":
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"


def keyring(spark: SparkSession) -> DataFrame:
    """A throw-away key, made for this session's sample data only."""
    digest = F.unhex(F.sha2(F.lit("sample data key"), 256))
    return spark.range(1).select(
        F.substring(digest, 1, 16).alias("key"), F.substring(digest, 17, 16).alias("iv")
    )


_OPEN: dict[tuple[str, str], Warehouse] = {}


def sample_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The derived tables as frames over the Parquet files in ``sf_dir``, opened once per session."""
    opened = (spark.sparkContext.applicationId, sf_dir)
    if opened not in _OPEN:
        _OPEN[opened] = _open_warehouse(spark, sf_dir)
    return _OPEN[opened]


def _open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    def load(name: str) -> DataFrame:
        if name in GIVEN:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        text = view_text(name, "spark").replace("{", "{{").replace("}", "}}")
        views = {v: warehouse[v] for v in (*GIVEN, *VIEWS) if re.search(rf"\b(FROM|JOIN)\s+{v}\b", text)}
        for view in views:
            text = re.sub(rf"\b(FROM|JOIN)(\s+){view}\b", rf"\1\2{{{view}}}", text)
        df = spark.sql(text, **views)
        if name in ENCRYPTED:
            keys = keyring(spark)
            df = df.withColumns(
                {c: F.when(F.col(c) == "", "").otherwise(encrypt_text(F.col(c), keys)) for c in ENCRYPTED[name]}
            )
        return df

    warehouse = Warehouse(spark, load)
    return warehouse
