"""One query per operator of the library and its SQL twin."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.checks.inquiry_selections import (
    CLIENTS,
    DAY,
    POST_DAY,
    POST_WEEK,
    WEEK,
    postal_ctes,
    weekly_de_sql,
)
from recontact.checks.registry import ledger_columns, numbered_sql, register
from recontact.checks.sample import keyring
from recontact.checks.service_selections import WEEKLY_CH_CTES
from recontact.functions import dates as d
from recontact.functions import nested as n
from recontact.functions import text as t
from recontact.functions.pii import decrypt_columns, encrypt_text
from recontact.operators import (
    dedupe,
    delivery,
    event_facts,
    ledger,
    outbox,
    suppress,
    surveys,
    vouchers,
)
from recontact.plans import common, existing, services
from recontact.plans import inquiries as weekly
from recontact.sources import bucketed
from recontact.sources.history import (
    current_version,
    ledger_as_of,
    not_deleted,
    version_as_of,
    warehouse_as_of,
)
from recontact.sources.schemas import CAM_CAM, CAM_SELECT
from recontact.sources.storage import fresh_path
from recontact.sources.warehouse import Warehouse, parquet_warehouse

c = F.col
AS_OF = date(2000, 1, 1)
NOW = "DATE '2000-01-01'"


def from_view(view: str, build):
    return lambda wh: build(wh[view])


def columns(view: str, sql: str, **out):
    """A projection of one view: named expressions beside the key, with the SQL twin."""
    return lambda wh: wh[view].select("case_id", *[build().alias(k) for k, build in out.items()]), sql


# Sources.
register(
    "scan_table",
    from_view("orders", lambda df: df.select("o_orderkey", "o_orderstatus", "o_totalprice")),
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
register(
    "scan_sql_with_parameters",
    lambda wh: wh.query(
        "SELECT o_orderkey, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_totalprice > :floor",
        ["orders", "customer"],
        {"floor": 400000.0},
    ),
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000",
)
register(
    "current_version",
    from_view("payer_history", lambda df: current_version(df).drop("valid_to")),
    "SELECT client_id, client_name, client_group, coop_status FROM payer_history WHERE valid_to = '2999-12-31'",
)
register(
    "version_as_of",
    from_view("client_history", lambda df: version_as_of(df, ["client_id"], AS_OF)),
    f"""SELECT client_id, client_name, client_group, coop_status, valid_to FROM client_history WHERE valid_to > {NOW}
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY valid_to, client_name, client_group, coop_status) = 1""",
)
register(
    "not_deleted",
    from_view("services", lambda df: not_deleted(df).select("case_id", "product")),
    "SELECT case_id, product FROM services WHERE deleted_at IS NULL",
)
register(
    "not_deleted_as_of",
    from_view("feedbacks", lambda df: not_deleted(df, as_of=AS_OF).select("service_id", "nps")),
    f"SELECT service_id, nps FROM feedbacks WHERE deleted_at IS NULL OR deleted_at >= {NOW}",
)
register(
    "ledger_as_of",
    lambda wh: ledger_as_of(wh["cam_select"], wh["cam_batch"], AS_OF)[0],
    f"""SELECT select_id, batch_id, case_id FROM cam_select
WHERE batch_id IN (SELECT batch_id FROM cam_batch WHERE batch_selection_date < {NOW})""",
)


# Sinks, read back after the write.
def case_rows(cases: DataFrame, cam_select: DataFrame, batch: str = "new") -> DataFrame:
    mapping = {"client_name": c("payer_name"), "first_voucher_code": c("voucher_code")}
    return ledger.numbered_rows(cases, cam_select, mapping, batch=batch)


def ledger_round_trip(wh: Warehouse) -> DataFrame:
    path = fresh_path(wh.spark, "cam_select")
    ledger.append_select(case_rows(wh["case_cube"], wh["cam_select"]), path)
    return ledger_columns(wh.spark.read.schema(CAM_SELECT).parquet(path))


def new_then_append(wh: Warehouse) -> DataFrame:
    """Two commits into one batch that hold the whole view, read back through the ledger view."""
    root, spark = fresh_path(wh.spark, "warehouse"), wh.spark
    ledger.create_tables(spark, root)
    first = c("payer_group").eqNullSafe("gkv")
    for chosen, batch in ((first, "new"), (~first, "append")):
        rows = case_rows(wh["case_cube"].filter(chosen), parquet_warehouse(spark, root)["cam_select"], batch)
        ledger.commit(spark, rows, root, 97, "bd_nachtelefonie", AS_OF)
    written = parquet_warehouse(spark, root)
    seen = suppress.campaign_ledger(written["cam_select"], written["cam_batch"])
    return seen.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("contacts"), F.max("batch_id").alias("batch_id"), F.max("cam_id").alias("cam_id"),
        F.max("batch_selection_date").alias("batch_selection_date"),
    )


def after_stop(wh: Warehouse) -> DataFrame:
    """The ledger after a run that stopped before its batch row, and a later run of all cases.

    The stopped run had written every case twice, under the same batch."""
    root, spark = fresh_path(wh.spark, "warehouse"), wh.spark
    ledger.create_tables(spark, root)
    stopped = case_rows(wh["case_cube"], parquet_warehouse(spark, root)["cam_select"])
    ledger.write_batch(stopped.unionByName(stopped).withColumn("client_name", F.lit("stopped")), f"{root}/cam_select")
    rows = case_rows(wh["case_cube"], parquet_warehouse(spark, root)["cam_select"])
    ledger.commit(spark, rows, root, 97, "bd_nachtelefonie", AS_OF)
    return ledger_columns(parquet_warehouse(spark, root)["cam_select"])


def registered_parts(wh: Warehouse) -> DataFrame:
    """The registry of the warehouse after one campaign for each part was appended to it."""
    root, names = fresh_path(wh.spark, "warehouse"), [f.name for f in CAM_CAM.fields]
    known = wh["cam_cam"]
    known.select(*[
        (c(f.name) if f.name in known.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CAM_CAM.fields
    ]).write.parquet(f"{root}/cam_cam")
    parts = wh["part"].select(F.concat(F.lit("call part "), c("p_partkey").cast("string")).alias("cam_name"))
    return ledger.append_campaigns(wh.spark, root, parts, channel="mail").select(*names)


register(
    "ledger_append",
    ledger_round_trip,
    numbered_sql(
        "chosen AS (SELECT * FROM case_cube)",
        "chosen", "payer_name", "voucher_code", "patient_id", language="preferred_language",
    ),
)
register(
    "commit_new_then_append",
    new_then_append,
    f"""SELECT case_id, 1 AS contacts, cast(1 AS bigint) AS batch_id, cast(97 AS int) AS cam_id,
  {NOW} AS batch_selection_date FROM case_cube""",
)
register(
    "commit_after_stop",
    after_stop,
    numbered_sql(
        "chosen AS (SELECT * FROM case_cube)",
        "chosen", "payer_name", "voucher_code", "patient_id", language="preferred_language", empty_ledger=True,
    ),
)
register(
    "registry_append",
    registered_parts,
    """SELECT cast(cam_id AS int) AS cam_id, cast(NULL AS string) AS cam_channel, cam_name,
  cast(NULL AS string) AS cam_description, cast(NULL AS string) AS cam_audience, cast(NULL AS string) AS cam_type,
  cast(NULL AS date) AS valid_from, cast(NULL AS date) AS valid_to, cam_category FROM cam_cam
UNION ALL SELECT cast((SELECT max(cam_id) FROM cam_cam) + row_number() OVER (ORDER BY md5(name), name) AS int), 'mail', name,
  'extra call campaign for our follow ups - ' || name, 'bd_patients', 'information', DATE '2022-01-01',
  DATE '2999-12-31', 'Anrufaktion' FROM (SELECT 'call part ' || p_partkey AS name FROM part)""",
)
register(
    "open_batch",
    lambda wh: ledger.open_batch(wh.spark, wh["cam_select"], 97, "bd_nachtelefonie", AS_OF),
    f"""SELECT cast(97 AS int) AS cam_id, max(batch_id) AS batch_id, 'bd_nachtelefonie' AS batch_acceptor,
  {NOW} AS batch_selection_date, {NOW} AS batch_transfer_date, {NOW} AS batch_start,
  DATE '2000-01-31' AS batch_stop FROM cam_select""",
)
register(
    "register_campaign",
    lambda wh: ledger.register_campaign(wh.spark, wh["cam_cam"], "spring calls"),
    """SELECT cast(max(cam_id) + 1 AS int) AS cam_id, 'phone' AS cam_channel, 'spring calls' AS cam_name,
  'extra call campaign for our follow ups - spring calls' AS cam_description, 'bd_patients' AS cam_audience,
  'information' AS cam_type, DATE '2022-01-01' AS valid_from, DATE '2999-12-31' AS valid_to,
  'Anrufaktion' AS cam_category FROM cam_cam""",
)
register(
    "list_campaigns",
    from_view("cam_cam", ledger.list_campaigns),
    "SELECT cam_id, cam_name, cam_category FROM cam_cam ORDER BY cam_name",
)


def csv_round_trip(wh: Warehouse) -> DataFrame:
    rows = wh["case_cube"].select("case_id", "payer_name", "voucher_code")
    path = delivery.export_csv(rows, fresh_path(wh.spark, "csv"), "second_survey", AS_OF)
    return wh.spark.read.schema(rows.schema).option("header", True).csv(path)


register(
    "export_csv",
    csv_round_trip,
    "SELECT case_id, payer_name, nullif(voucher_code, '') AS voucher_code FROM case_cube",
)
register(
    "export_sheets",
    lambda wh: delivery.export_sheets(wh["pii"].select("service_id", "email"), fresh_path(wh.spark, "sheets")),
    """SELECT service_id, email, 'all' AS sheet FROM pii
UNION ALL SELECT service_id, email, 'provider' FROM pii WHERE email LIKE '%gmail%' OR email LIKE '%googlemail%'""",
)
LABELS = {
    "follow_up": "L-call",
    "q3": "L-q3",
    "q4_q6": "L-q4",
    "online": "L-online",
    "post": "L-post",
    "second_opinion": "L-second",
    "surgery": "L-surgery",
    "fr": "L-fr",
    "en": "L-en",
    "it": "L-it",
    "pms": "L-pms",
    "complete": "L-complete",
}


def cards(df: DataFrame, labels) -> DataFrame:
    out = delivery.card_payloads(df, "board", "pipeline", labels, LABELS)
    return out.withColumn("label_ids", F.array_join("label_ids", ","))


register(
    "card_payloads_weekly_de",
    lambda wh: cards(
        wh["inquiries"]
        .join(wh["case_cube"].select("case_id", "admission_channel", "inquiry_type", "payer_name"), "case_id")
        .select(
            "case_id",
            c("payer_name").alias("client_name"),
            c("state").alias("korb"),
            t.flag(c("admission_channel") == "online_marketing").alias("om_flag"),
            F.when(c("completion_reason_main") == "internal_reason", "post").alias("post"),
            "inquiry_type",
        ),
        delivery.weekly_de_labels(),
    ),
    """SELECT i.case_id AS name, k.payer_name AS description, 'board' AS board_id, 'pipeline' AS list_id,
  'L-call' || CASE WHEN i.state = 'waiting_q3' THEN ',L-q3' ELSE ',L-q4' END
    || CASE WHEN k.admission_channel = 'online_marketing' THEN ',L-online' ELSE '' END
    || CASE WHEN i.completion_reason_main = 'internal_reason' THEN ',L-post' ELSE '' END
    || CASE k.inquiry_type WHEN 'second_opinion_before_surgery' THEN ',L-second' WHEN 'surgery' THEN ',L-surgery'
      ELSE '' END AS label_ids
FROM inquiries AS i JOIN case_cube AS k USING (case_id)""",
)
def weekly_run_cards(wh: Warehouse) -> DataFrame:
    """Cards of one weekly run; each is checked against the ledger row of the same run."""
    root = fresh_path(wh.spark, "warehouse")
    ledger.create_tables(wh.spark, root)
    written, cases = weekly.weekly_de_run(wh, root, WEEK, excluded_clients=CLIENTS)
    told = cards(cases.withColumnRenamed("voucher_client", "client_name"), delivery.weekly_de_labels())
    return told.join(written.select(c("case_id").alias("name"), "korb"), "name")


def weekly_ch_run_cards(wh: Warehouse) -> DataFrame:
    """Cards of one Swiss run; each is checked against the ledger row of the same run."""
    root = fresh_path(wh.spark, "warehouse")
    ledger.create_tables(wh.spark, root)
    written, cases = services.weekly_ch_run(wh, root, AS_OF)
    told = cards(cases.withColumnRenamed("payer_name", "client_name"), delivery.weekly_ch_labels())
    return told.join(written.select(c("case_id").alias("name"), "first_voucher_code"), "name")


register(
    "weekly_ch_run_cards",
    weekly_ch_run_cards,
    f"""WITH {WEEKLY_CH_CTES}
SELECT case_id AS name, payer_name AS description, 'board' AS board_id, 'pipeline' AS list_id, voucher_code AS first_voucher_code,
  'L-call,L-q3' || CASE WHEN preferred_language IN ('fr', 'en', 'it') THEN ',L-' || preferred_language ELSE '' END
    || CASE inquiry_type WHEN 'second_opinion_before_surgery' THEN ',L-second' WHEN 'surgery' THEN ',L-surgery'
      ELSE '' END AS label_ids
FROM chosen""",
)
register(
    "weekly_de_run_cards",
    weekly_run_cards,
    f"""WITH {weekly_de_sql(DAY)}
SELECT w.case_id AS name, w.client_name AS description, 'board' AS board_id, 'pipeline' AS list_id, w.korb,
  'L-call' || CASE WHEN w.korb = 'waiting_q3' THEN ',L-q3' ELSE ',L-q4' END
    || CASE WHEN k.admission_channel IN ('online_marketing', 'partner_funnel') THEN ',L-online' ELSE '' END
    || CASE WHEN w.post = 'post' THEN ',L-post' ELSE '' END
    || CASE k.inquiry_type WHEN 'second_opinion_before_surgery' THEN ',L-second' WHEN 'surgery' THEN ',L-surgery'
      ELSE '' END AS label_ids
FROM chosen AS w LEFT JOIN (SELECT * FROM case_cube WHERE product = 'MSS') AS k USING (case_id)""",
)
register(
    "postal_to_complete_cards",
    lambda wh: cards(weekly.postal_to_complete(wh, POST_WEEK), delivery.postal_complete_labels()),
    f"""WITH {postal_ctes(POST_DAY)}
SELECT case_id AS name, client_name AS description, 'board' AS board_id, 'pipeline' AS list_id,
  'L-complete' AS label_ids FROM letters
WHERE client_name NOT LIKE '%DAK%' AND treatment_type NOT IN ('second_opinion_before_surgery', 'surgery')
QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY korb, scheduled_date, appointment_type, voucher) = 1""",
)
register(
    "card_payloads_weekly_ch",
    lambda wh: cards(
        wh["case_cube"].filter("payer_group = 'kv'").withColumnRenamed("payer_name", "client_name"),
        delivery.weekly_ch_labels(),
    ),
    """SELECT case_id AS name, payer_name AS description, 'board' AS board_id, 'pipeline' AS list_id,
  'L-call,L-q3' || CASE WHEN preferred_language IN ('fr', 'en', 'it') THEN ',L-' || preferred_language ELSE '' END
    || CASE inquiry_type WHEN 'second_opinion_before_surgery' THEN ',L-second' WHEN 'surgery' THEN ',L-surgery'
      ELSE '' END AS label_ids
FROM case_cube WHERE payer_group = 'kv'""",
)
register(
    "card_payloads_vip",
    lambda wh: cards(
        wh["inquiries"].select("case_id", c("service_id").alias("client_name"), c("state").alias("korb")),
        delivery.vip_labels(),
    ),
    """SELECT case_id AS name, service_id AS description, 'board' AS board_id, 'pipeline' AS list_id,
  CASE state WHEN 'waiting_q3' THEN 'L-call,L-q3' ELSE 'L-call,L-pms' END AS label_ids FROM inquiries""",
)
register(
    "dialer_view",
    lambda wh: delivery.dialer_view(wh["phone_cube"], "cases.example/open?case_id="),
    """SELECT case_id, product_v2, result_date, payer_name, payer_group, primary_phone AS primary_phone_number,
  'cases.example/open?case_id=' || case_id AS case_link FROM phone_cube""",
)


def open_after_two_runs(wh: Warehouse) -> DataFrame:
    """Cards still open after two runs of the sender, the first of which was recorded twice."""
    path = fresh_path(wh.spark, "attempts")
    for run in ("first", "second", "first"):
        outbox.record(wh["card_attempts"].filter(c("run") == run).drop("run"), path, run)
    cards = wh["cam_select"].select("batch_id", c("case_id").alias("name"))
    return outbox.cards_still_open(cards, outbox.attempts(wh.spark, path), most_attempts=2)


STATE_SQL = """states AS (SELECT batch_id, name, arg_max(state, attempted_on) AS state, max(attempted_on) AS attempted_on,
    count(*) AS attempts, count(*) FILTER (state = 'failed') AS failures, bool_or(state = 'delivered') AS delivered
  FROM card_attempts WHERE name IS NOT NULL GROUP BY batch_id, name)"""
register(
    "cards_still_open",
    open_after_two_runs,
    f"""WITH {STATE_SQL}
SELECT DISTINCT l.batch_id, l.case_id AS name, coalesce(attempts, 0) AS attempts FROM cam_select AS l
  LEFT JOIN states AS s ON s.batch_id = l.batch_id AND s.name = l.case_id
WHERE l.case_id IS NOT NULL AND (s.name IS NULL OR NOT (delivered OR state = 'given up' OR attempts >= 2))""",
)
register(
    "card_states",
    lambda wh: outbox.latest_state(wh["card_attempts"].withColumn("detail", F.lit(None).cast("string")).filter("name IS NOT NULL")).drop("detail"),
    f"WITH {STATE_SQL} SELECT * FROM states",
)

# Projections.
register(
    "project_rename_constant",
    from_view(
        "case_cube",
        lambda df: df.select("case_id", c("payer_name").alias("client_name"), F.lit(0).alias("control_flag")),
    ),
    "SELECT case_id, payer_name AS client_name, 0 AS control_flag FROM case_cube",
)
register(
    "typed_nulls",
    from_view(
        "case_cube",
        lambda df: df.select(
            "case_id", F.lit(None).cast("string").alias("refusal_reason"), F.lit(None).cast("date").alias("reached_date")
        ),
    ),
    "SELECT case_id, cast(NULL AS string) AS refusal_reason, cast(NULL AS date) AS reached_date FROM case_cube",
)
register(
    "star_plus_email_domain",
    from_view("pii", lambda df: df.select("service_id", "email", t.email_domain(c("email")).alias("domain"))),
    """SELECT service_id, email, CASE WHEN contains(email, '@') THEN regexp_extract(lower(email), '@.*$')
  ELSE lower(email) END AS domain FROM pii""",
)
register(
    "salutation_codes",
    *columns(
        "case_cube",
        """SELECT case_id, CASE gender WHEN 'F' THEN 'Frau' WHEN 'M' THEN 'Herr' END AS short_form,
  CASE WHEN gender IN ('F', 'female') THEN 'Frau' WHEN gender IN ('M', 'male') THEN 'Herr' ELSE gender END AS long_form
FROM case_cube""",
        short_form=lambda: t.salutation(c("gender")),
        long_form=lambda: t.salutation(c("gender"), keep_unknown=True),
    ),
)
register(
    "online_flag",
    *columns(
        "case_cube",
        """SELECT case_id, CASE WHEN admission_channel IN ('online_marketing', 'partner_funnel') THEN 1 ELSE 0 END
  AS om_flag FROM case_cube""",
        om_flag=lambda: t.flag(c("admission_channel").isin("online_marketing", "partner_funnel")),
    ),
)
register(
    "appointment_date_choice",
    lambda wh: wh["inquiries"]
    .select("id", "case_id", "results_sent_at")
    .join(wh["appointments"].withColumnRenamed("inquiry_id", "id"), "id")
    .select("case_id", "state", d.appointment_date(c("state"), c("results_sent_at"), c("scheduled_date")).alias("app_date")),
    """SELECT i.case_id, a.state, CASE a.state WHEN 'sent' THEN a.scheduled_date ELSE i.results_sent_at END AS app_date
FROM inquiries AS i JOIN appointments AS a ON a.inquiry_id = i.id""",
)


# Filters: each keeps the case ids that pass.
def kept(name: str, view: str, condition, where: str, key: str = "case_id") -> None:
    register(name, lambda wh: wh[view].filter(condition()).select(key), f"SELECT {key} FROM {view} WHERE {where}")


kept("filter_equality", "case_cube", lambda: (c("product") == "MSS") & (c("payer_group") != "other"),
     "product = 'MSS' AND payer_group <> 'other'")
kept("filter_in_lists", "case_cube", lambda: c("payer_group").isin("gkv", "pkv") & ~c("voucher_code").isin("GADS-LF22", "STD-3"),
     "payer_group IN ('gkv', 'pkv') AND voucher_code NOT IN ('GADS-LF22', 'STD-3')")
kept("filter_like", "case_cube", lambda: t.like_none(c("voucher_code"), ["VRTC%", "%-11"]) & c("payer_name").like("%ION_1%"),
     "NOT starts_with(voucher_code, 'VRTC') AND NOT ends_with(voucher_code, '-11') AND contains(payer_name, 'ION_1')")
kept("filter_ilike", "phone_cube", lambda: c("product_v2").ilike("%MSN%"), "contains(lower(product_v2), 'msn')")
kept("filter_ilike_any_or_null", "case_cube",
     lambda: t.ilike_none_or_null(c("completion_reason"), ["%keine weitere%", "%Interner GRUND%"]),
     "completion_reason IS NULL OR NOT regexp_matches(completion_reason, 'keine weitere|interner grund', 'i')")
kept("filter_boolean_tests", "phone_cube",
     lambda: t.is_false(c("hard_exclusion")) & t.is_not_true(c("questioning_inappropriate")) & t.is_false(c("prem_return")),
     "NOT hard_exclusion AND coalesce(questioning_inappropriate, false) = false AND coalesce(prem_return, true) = false")
kept("filter_null_tolerant", "phone_cube",
     lambda: t.null_or(c("prem_latest_sent_at"), c("prem_latest_sent_at") < d.before(AS_OF, weeks=2)),
     f"coalesce(prem_latest_sent_at < {NOW} - 14, true)")
kept("filter_score_bands", "case_cube",
     lambda: (c("provider_nps") >= 7) & t.not_detractor(c("medic_nps"), [0, 2, 3, 4, 5, 6]),
     "provider_nps BETWEEN 7 AND 10 AND (medic_nps IS NULL OR medic_nps IN (1, 7, 8, 9, 10))")
kept("filter_text_scores", "feedbacks", lambda: c("nps").isin("10", "9", "8", "7"), "try_cast(nps AS int) >= 7", "service_id")
kept("filter_static_dates", "case_cube", lambda: c("result_date").between(F.lit(date(1996, 1, 1)), F.lit(date(1997, 9, 30))),
     "result_date >= DATE '1996-01-01' AND result_date < DATE '1997-10-01'")
kept("filter_rolling_window", "case_cube",
     lambda: c("result_date").between(d.before(AS_OF, months=6), d.before(AS_OF, weeks=6)),
     "result_date BETWEEN DATE '1999-07-01' AND DATE '1999-11-20'")
kept("filter_age_in_days", "case_cube", lambda: d.days_since(c("result_date"), AS_OF).between(16, 210),
     f"date_diff('day', result_date, {NOW}) BETWEEN 16 AND 210")
kept("filter_week_due_calendar_year", "case_cube", lambda: d.iso_week_due(c("result_date"), 5, AS_OF),
     f"""weekofyear(result_date + INTERVAL 35 DAY) = weekofyear({NOW})
  AND year(result_date + INTERVAL 35 DAY) = year({NOW})""")
kept("filter_week_due_monday", "case_cube", lambda: d.iso_week_due(c("result_date"), 5, AS_OF, mode="week_start"),
     "result_date + INTERVAL 35 DAY BETWEEN DATE '1999-12-27' AND DATE '2000-01-02'")
kept("filter_previous_week", "appointments", lambda: d.in_previous_iso_week(c("scheduled_date"), date(1999, 6, 16)),
     "scheduled_date BETWEEN DATE '1999-06-07' AND DATE '1999-06-13'", "inquiry_id")
kept("filter_current_week", "appointments", lambda: d.in_iso_week_of(c("scheduled_date"), F.lit(date(1999, 6, 16))),
     "scheduled_date BETWEEN DATE '1999-06-14' AND DATE '1999-06-20'", "inquiry_id")
kept("filter_state_ranges", "appointments",
     lambda: ((c("state") == "sent") & c("scheduled_date").between(d.before(AS_OF, months=6), d.before(AS_OF, weeks=5)))
     | ((c("state") == "call_patient") & (c("scheduled_date") < d.before(AS_OF, weeks=6))),
     f"""CASE state WHEN 'sent' THEN scheduled_date BETWEEN {NOW} - INTERVAL 6 MONTH AND {NOW} - 35
  WHEN 'call_patient' THEN scheduled_date < {NOW} - 42 ELSE false END""", "inquiry_id")
kept("filter_not_blank", "case_cube", lambda: t.not_blank(c("voucher_code")) & (F.length("voucher_code") >= 5),
     "voucher_code <> '' AND length(voucher_code) >= 5")
kept("filter_json_list_empty", "insurance_data", lambda: n.json_list_empty(c("options")), "options = '[]'", "inquiry_id")
kept("filter_substring", "pii", lambda: F.contains("email", F.lit("googlemail")), "email LIKE '%googlemail%'", "service_id")
kept("filter_product_event", "workflow_events",
     lambda: services.product_matches_event(c("service"), n.json_text(c("event_body"), "$.properties.product")),
     """CASE WHEN service = 'MSS' THEN event_body LIKE '%"product":"Spezi%'
  WHEN service LIKE '%PMS%' THEN event_body LIKE '%"product":"Erst%' ELSE false END""")

# Joins.
register(
    "join_left",
    lambda wh: wh["case_cube"].select("case_id", "service_id")
    .join(wh["report_flags"], "service_id", "left").select("case_id", "qualimed"),
    "SELECT case_id, qualimed FROM case_cube LEFT JOIN report_flags USING (service_id)",
)
register(
    "join_left_made_inner",
    lambda wh: wh["case_cube"].join(
        wh["payer_dim"].withColumnRenamed("client_id", "payer_id"), "payer_id", "left"
    ).filter(t.is_true(c("coop_status"))).select("case_id", "client_group"),
    "SELECT case_id, client_group FROM case_cube JOIN payer_dim ON client_id = payer_id AND coop_status",
)
register(
    "join_inner_derived",
    lambda wh: wh["services"].select("service_id").join(
        not_deleted(wh["workflow_events"])
        .filter(F.contains("event_type", F.lit("DID_SEND_FINAL")))
        .select(t.concat_skip_nulls("case_id", F.lit(":"), "service").alias("service_id"), "event_time"),
        "service_id",
    ),
    """SELECT s.service_id, e.event_time FROM services AS s JOIN workflow_events AS e
  ON s.service_id = e.case_id || ':' || e.service
WHERE e.deleted_at IS NULL AND e.event_type LIKE '%DID_SEND_FINAL%'""",
)
register(
    "join_using",
    lambda wh: wh["cam_select"].join(wh["cam_batch"], on="batch_id"),
    "SELECT batch_id, select_id, case_id, cam_id, batch_selection_date FROM cam_select JOIN cam_batch USING (batch_id)",
)
register(
    "join_chain_then_first",
    lambda wh: dedupe.first_per_key(
        services.final_services(wh).join(
            dedupe.first_per_key(
                services.links_of(wh), ["case_id"], [c("created_at").desc_nulls_last(), c("survey_id").asc_nulls_last()]
            ),
            "case_id",
            "left",
        ),
        ["case_id"],
        [c("created_at").desc_nulls_last(), c("survey_id").asc_nulls_last(), c("service_id")],
    ).select("case_id", "payer_name", "title", "created_at"),
    """SELECT s.case_id, p.name AS payer_name, v.title, l.created_at
FROM services AS s LEFT JOIN contracts AS c ON c.id = s.contract_id LEFT JOIN payers AS p ON p.id = c.payer_id
  LEFT JOIN survey_links AS l ON l.case_id = s.case_id LEFT JOIN surveys AS v ON v.id = l.survey_id
WHERE s.deleted_at IS NULL
  AND EXISTS (FROM workflow_events AS e WHERE e.case_id = s.case_id AND e.event_type LIKE '%DID_SEND_FINAL%')
QUALIFY row_number() OVER (PARTITION BY s.case_id ORDER BY l.created_at DESC NULLS LAST, l.survey_id NULLS LAST) = 1""",
)
register(
    "join_dimension_roles",
    lambda wh: existing._client_roles(
        existing.inquiry_cases(wh).select("case_id", "client_1", "client_2", "insurance"), wh["client_groups"]
    ).select("case_id", "group_1", "group_2", "group_3"),
    """SELECT i.case_id, g1.client_group AS group_1, g2.client_group AS group_2, g3.client_group AS group_3
FROM inquiries AS i LEFT JOIN voucher_dim AS v1 ON v1.id = i.voucher_ids[1]
  LEFT JOIN voucher_dim AS v2 ON v2.id = i.voucher_ids[2]
  LEFT JOIN (SELECT DISTINCT inquiry_id, insurance, supplementary FROM insurance_data WHERE main) AS m
    ON m.inquiry_id = i.id
  LEFT JOIN client_groups AS g1 ON g1.client_name = v1.client_name
  LEFT JOIN client_groups AS g2 ON g2.client_name = v2.client_name
  LEFT JOIN client_groups AS g3 ON g3.client_name = m.insurance
WHERE i.id NOT IN (SELECT inquiry_id FROM contact_entries
  WHERE quality IN (0, 2, 3, 4, 5, 6) AND contact_type <> 'Q1')""",
)
register(
    "join_preaggregated",
    lambda wh: existing.subsidised_cases(wh["inquiries"], wh["insurance_data"]),
    """SELECT case_id FROM inquiries WHERE id IN (SELECT inquiry_id FROM insurance_data WHERE main AND supplementary)""",
)
register(
    "semi_join_flag",
    lambda wh: suppress.in_set_flag(
        wh["case_cube"].select("case_id"), services.responded(services.links_of(wh)), "case_id", "has_answered"
    ),
    """SELECT case_id, case_id IN (SELECT l.case_id FROM survey_links AS l JOIN surveys AS s ON s.id = l.survey_id
  WHERE s.title LIKE '%Nachbefragung%' AND l.response_status IS NOT NULL) AS has_answered FROM case_cube""",
)
register(
    "anti_join_guarded",
    lambda wh: suppress.exclude_keys(
        wh["case_cube"].select("case_id", "patient_id"), wh["cam_select"], "case_id"
    ),
    """SELECT case_id, patient_id FROM case_cube
WHERE case_id NOT IN (SELECT case_id FROM cam_select WHERE case_id IS NOT NULL)""",
)


def nameless(wh: Warehouse) -> Warehouse:
    """The warehouse with a contact of no known case in its ledger."""
    return Warehouse(wh.spark, lambda name: wh["cam_select_nameless" if name == "cam_select" else name])


def suppressed_by_buckets(wh: Warehouse) -> DataFrame:
    """The guarded suppression against a copy of the ledger that is kept in buckets of the case."""
    table = f"ledger_{uuid.uuid4().hex}"
    bucketed.store(wh["cam_select"].filter("case_id IS NOT NULL"), table, buckets=16, path=fresh_path(wh.spark, table))
    copies = bucketed.bucketed_warehouse(wh.spark, wh, {"cam_select": table})
    return suppress.exclude_keys(copies["case_cube"].select("case_id", "patient_id"), copies["cam_select"], "case_id")


register(
    "anti_join_bucketed",
    suppressed_by_buckets,
    """SELECT case_id, patient_id FROM case_cube
WHERE case_id NOT IN (SELECT case_id FROM cam_select WHERE case_id IS NOT NULL)""",
)
register(
    "anti_join_unguarded",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id"), common.ledger_of(wh), cam_ids=[97], nulls="sql"
    ),
    "SELECT case_id FROM case_cube WHERE case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id = 97)",
)
register(
    "anti_join_unguarded_null",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id"), common.ledger_of(nameless(wh)), cam_ids=[97], nulls="sql"
    ).agg(F.count("case_id").alias("cases_kept")),
    """SELECT count(*) AS cases_kept FROM case_cube WHERE case_id NOT IN (SELECT case_id FROM cam_select_nameless
  WHERE batch_id IN (SELECT batch_id FROM cam_batch WHERE cam_id = 97))""",
)
register(
    "anti_join_union_of_sets",
    lambda wh: suppress.exclude_any(
        wh["case_cube"].select("case_id", "product"),
        [wh["suppression"], services.ended(wh), suppress.contacts(common.ledger_of(wh), cam_ids=[97])],
        "case_id",
        nulls="sql",
    ),
    """SELECT case_id, product FROM case_cube
WHERE case_id NOT IN (SELECT case_id FROM suppression)
  AND case_id NOT IN (SELECT case_id FROM workflow_events
    WHERE event_type LIKE '%DID_CLOSE%' OR event_type LIKE '%DID_RECEIVE%')
  AND case_id NOT IN (SELECT case_id FROM contact_ledger WHERE cam_id = 97)""",
)
register(
    "anti_join_patient",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id", "patient_id"), common.ledger_of(wh), "patient_id",
        cam_ids=[1], when=c("batch_selection_date") > d.before(AS_OF, years=1), cube=wh["case_cube"],
    ),
    f"""SELECT case_id, patient_id FROM case_cube WHERE patient_id NOT IN (
  SELECT k.patient_id FROM contact_ledger AS l JOIN case_cube AS k USING (case_id)
  WHERE l.cam_id = 1 AND l.batch_selection_date > {NOW} - INTERVAL 1 YEAR AND k.patient_id IS NOT NULL)""",
)
register(
    "anti_join_cooldown",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id"), common.ledger_of(wh, with_category=True),
        categories=["Anrufaktion", "Regelprozess"], when=c("batch_selection_date") >= d.before(AS_OF, months=1),
    ),
    f"""SELECT case_id FROM case_cube WHERE NOT EXISTS (FROM contact_ledger AS l WHERE l.case_id = case_cube.case_id
  AND l.cam_category IN ('Anrufaktion', 'Regelprozess') AND l.batch_selection_date >= {NOW} - INTERVAL 1 MONTH)""",
)
register(
    "anti_join_as_of",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id"), common.ledger_of(warehouse_as_of(wh, AS_OF)),
        cam_ids=[1, 97], when=c("batch_selection_date") >= d.before(AS_OF, years=2),
    ),
    f"""SELECT case_id FROM case_cube WHERE NOT EXISTS (FROM contact_ledger AS l WHERE l.case_id = case_cube.case_id
  AND l.cam_id IN (1, 97) AND l.batch_selection_date >= {NOW} - INTERVAL 2 YEAR AND l.batch_selection_date < {NOW})""",
)
register(
    "anti_join_null_admitted",
    lambda wh: suppress.suppress(
        wh["case_cube"].select("case_id", "patient_id"), common.ledger_of(wh), "patient_id",
        cam_ids=[97], when=c("batch_selection_date") >= d.before(AS_OF, months=3), nulls="admit",
        cube=wh["case_cube"],
    ),
    f"""SELECT case_id, patient_id FROM case_cube WHERE patient_id IS NULL OR patient_id NOT IN (
  SELECT k.patient_id FROM contact_ledger AS l JOIN case_cube AS k USING (case_id)
  WHERE l.cam_id = 97 AND l.batch_selection_date >= {NOW} - INTERVAL 3 MONTH AND k.patient_id IS NOT NULL)""",
)
register(
    "anti_join_own_children",
    lambda wh: suppress.exclude_keys(
        wh["inquiries"].select("id", "case_id"), wh["appointments"].filter(c("state") == "completed"), "id",
        "inquiry_id", nulls="sql",
    ),
    """SELECT id, case_id FROM inquiries WHERE id NOT IN (SELECT inquiry_id FROM appointments WHERE state = 'completed')""",
)
register(
    "anti_join_max_contacts",
    lambda wh: suppress.exclude_keys(
        wh["case_cube"].select("case_id"),
        suppress.selected_more_than(wh["cam_select"].filter(c("case_id").isNotNull()), 1),
        "case_id",
    ),
    """SELECT case_id FROM case_cube WHERE case_id NOT IN (SELECT case_id FROM cam_select
  WHERE case_id IS NOT NULL GROUP BY case_id HAVING count(*) > 1)""",
)
register(
    "anti_join_index",
    lambda wh: suppress.exclude_keys(wh["mail_base"].select("case_id", "email"), wh["suppression"], "case_id", nulls="admit"),
    "SELECT case_id, email FROM mail_base ANTI JOIN suppression USING (case_id)",
)
register(
    "scalar_subquery",
    lambda wh: wh["case_cube"].select(
        "case_id", (ledger.max_id(wh["cam_select"], "batch_id") + 1).alias("batch_id")
    ),
    "SELECT case_id, (SELECT max(batch_id) + 1 FROM cam_select) AS batch_id FROM case_cube",
)

# Aggregation.
register(
    "global_max",
    from_view("cam_select", lambda df: df.agg(F.max("select_id").alias("last_id"), F.max("batch_id").alias("last_batch"))),
    "SELECT max(select_id) AS last_id, max(batch_id) AS last_batch FROM cam_select",
)
register(
    "grouped_max",
    from_view("survey_links", lambda df: df.groupBy("case_id").agg(F.max("created_at").alias("last_link"))),
    "SELECT case_id, max(created_at) AS last_link FROM survey_links GROUP BY case_id",
)
register(
    "pivot_events",
    from_view(
        "workflow_events",
        lambda df: surveys.pivot_events(
            df, {"status_sent": "DID_SEND_STATUS_SURVEY", "prem_sent": "DID_SEND_PREM_SURVEY"}, at="event_date"
        ),
    ),
    """SELECT case_id, max(event_date) FILTER (upper(event_type) = 'DID_SEND_STATUS_SURVEY') AS status_sent,
  max(event_date) FILTER (upper(event_type) = 'DID_SEND_PREM_SURVEY') AS prem_sent
FROM workflow_events WHERE upper(event_type) IN ('DID_SEND_STATUS_SURVEY', 'DID_SEND_PREM_SURVEY') GROUP BY case_id""",
)
FACTS = {
    "status_sent": ("latest", event_facts.of_type("DID_SEND_STATUS_SURVEY", "event_time")),
    "prem_sent": ("latest", event_facts.of_type("DID_SEND_PREM_SURVEY", "event_time")),
    "first_final": ("first", event_facts.of_type("DID_SEND_FINAL_RESULT", "event_time")),
    "closed": ("any", event_facts.of_type("DID_CLOSE_CASE")),
    "n_events": ("count", lambda: c("event_type")),
}


def advanced_facts(wh: Warehouse) -> DataFrame:
    """The table of facts after three runs; the events of many cases came long after they happened."""
    path = fresh_path(wh.spark, "event_facts")
    for day in (date(1997, 12, 31), date(1999, 12, 31), date(2003, 12, 31)):
        told = event_facts.advance(wh.spark, path, wh["arrived_events"], FACTS, day)
    return told.withColumn("closed", F.coalesce("closed", F.lit(False)))


register(
    "event_facts_advanced",
    advanced_facts,
    """SELECT case_id, max(event_time) FILTER (upper(event_type) = 'DID_SEND_STATUS_SURVEY') AS status_sent,
  max(event_time) FILTER (upper(event_type) = 'DID_SEND_PREM_SURVEY') AS prem_sent,
  min(event_time) FILTER (upper(event_type) = 'DID_SEND_FINAL_RESULT') AS first_final,
  bool_or(upper(event_type) = 'DID_CLOSE_CASE') AS closed, count(event_type) AS n_events
FROM workflow_events GROUP BY case_id""",
)
register(
    "count_having",
    from_view("cam_select", lambda df: suppress.selected_more_than(df.filter("case_id IS NOT NULL"), 1)),
    """SELECT case_id, count(*) AS contacts FROM cam_select WHERE case_id IS NOT NULL GROUP BY case_id
HAVING count(*) > 1""",
)
register(
    "group_without_aggregate",
    from_view("insurance_data", lambda df: df.filter("main").select("inquiry_id", "insurance").dropDuplicates()),
    "SELECT inquiry_id, insurance FROM insurance_data WHERE main GROUP BY ALL",
)
register(
    "select_distinct",
    from_view("appointments", lambda df: df.select("inquiry_id", "appointment_type", "state").distinct()),
    "SELECT inquiry_id, appointment_type, state FROM appointments GROUP BY ALL",
)
register(
    "presence_flag",
    from_view("visits", lambda df: surveys.presence_flag(df, "case_id", "visit_nps", "scored")),
    "SELECT DISTINCT case_id, CASE WHEN visit_nps IS NOT NULL THEN 'yes' END AS scored FROM visits",
)

# Windows and sorts.
register(
    "row_number_first",
    from_view(
        "card_log",
        lambda df: dedupe.row_numbers(
            df, ["case_id"], [c("card_create_timestamp").asc_nulls_last(), c("board"), c("list"), c("action_type")]
        ).filter("rn = 1").select("case_id", "card_create_timestamp", "board"),
    ),
    """SELECT case_id, card_create_timestamp, board FROM card_log QUALIFY row_number() OVER (PARTITION BY case_id
  ORDER BY card_create_timestamp NULLS LAST, board, list, action_type) = 1""",
)
register(
    "latest_event",
    from_view(
        "workflow_events",
        lambda df: dedupe.latest_per_key(
            df.filter(c("event_type").startswith("DID_SEND_FINAL")), "case_id", "event_time", c("event_time"), "final_at"
        ),
    ),
    "SELECT case_id, max(event_time) AS final_at FROM workflow_events WHERE event_type LIKE 'DID_SEND_FINAL%' GROUP BY 1",
)
register(
    "custom_rank_order",
    from_view("feedbacks", existing.best_known_score),
    """SELECT service_id, nps FROM feedbacks WHERE deleted_at IS NULL QUALIFY row_number() OVER (PARTITION BY service_id
  ORDER BY CASE WHEN nps = 'not_specified' THEN 11 ELSE try_cast(nps AS int) END NULLS LAST, nps) = 1""",
)
register(
    "running_number",
    lambda wh: ledger.assign_ids(
        wh["case_cube"].select("case_id", "payer_name"), wh["cam_select"], ["case_id"]
    ),
    """SELECT case_id, payer_name, (SELECT max(batch_id) + 1 FROM cam_select) AS batch_id,
  (SELECT max(select_id) FROM cam_select)
    + row_number() OVER (ORDER BY md5(case_id), case_id) AS select_id FROM case_cube""",
)
register(
    "running_number_append",
    lambda wh: ledger.assign_ids(
        wh["phone_cube"].select("case_id", "product_v2"), wh["cam_select"], ["product_v2", "case_id"], batch="append"
    ),
    """SELECT case_id, product_v2, (SELECT max(batch_id) FROM cam_select) AS batch_id,
  (SELECT max(select_id) FROM cam_select) + row_number() OVER (ORDER BY
    md5(product_v2 || '|' || case_id), product_v2, case_id) AS select_id FROM phone_cube""",
)
register(
    "random_order",
    from_view("case_cube", lambda df: df.select("case_id", dedupe.stable_shuffle_order(7, "case_id").alias("random_order"))),
    "SELECT case_id, md5('7|' || case_id) AS random_order FROM case_cube",
)
register(
    "row_number_tie_broken",
    from_view(
        "cam_select",
        lambda df: dedupe.row_numbers(
            df.filter("case_id IS NOT NULL").distinct(), ["case_id"], [c("select_id").asc(), c("batch_id").asc()]
        ),
    ),
    """SELECT *, cast(row_number() OVER (PARTITION BY case_id ORDER BY select_id, batch_id) AS int) AS rn
FROM (SELECT DISTINCT * FROM cam_select WHERE case_id IS NOT NULL)""",
)
register(
    "latest_unanswered",
    lambda wh: dedupe.first_per_key(
        services.links_of(wh),
        ["case_id"],
        [c("created_at").desc_nulls_first(), c("response_status").asc_nulls_last(), c("title")],
    ).filter(c("response_status").isNull()).select("case_id", "created_at", "title"),
    """SELECT case_id, created_at, title FROM (
  SELECT l.*, s.title FROM survey_links AS l LEFT JOIN surveys AS s ON s.id = l.survey_id
  QUALIFY row_number() OVER (PARTITION BY l.case_id ORDER BY l.created_at DESC NULLS FIRST,
    l.response_status NULLS LAST, s.title) = 1) WHERE response_status IS NULL""",
)
register(
    "order_by_mixed",
    from_view(
        "case_cube",
        lambda df: df.select("case_id", "patient_id", "result_date").orderBy(
            c("patient_id").asc_nulls_last(), c("result_date").desc_nulls_first(), "case_id"
        ),
    ),
    """SELECT case_id, patient_id, result_date FROM case_cube
ORDER BY patient_id NULLS LAST, result_date DESC NULLS FIRST, case_id""",
)
register(
    "first_per_patient",
    from_view(
        "case_cube",
        lambda df: dedupe.first_per_key(df, ["patient_id"], common.newest_case()).select(
            "patient_id", "case_id", "result_date"
        ),
    ),
    """SELECT DISTINCT ON (patient_id) patient_id, case_id, result_date FROM case_cube
ORDER BY patient_id, result_date DESC NULLS FIRST, case_id""",
)
register(
    "first_per_patient_keep_missing",
    from_view(
        "case_cube",
        lambda df: dedupe.first_per_key(df, ["patient_id"], common.newest_case(), keep_null_keys=True).select(
            "patient_id", "case_id", "result_date"
        ),
    ),
    """SELECT patient_id, case_id, result_date FROM case_cube QUALIFY patient_id IS NULL OR row_number() OVER (
  PARTITION BY patient_id ORDER BY result_date DESC NULLS FIRST, case_id) = 1""",
)
register(
    "first_per_case_tie_broken",
    from_view(
        "appointments",
        lambda df: dedupe.first_per_key(
            df, ["inquiry_id"], [c("state").asc(), c("appointment_type").asc(), c("scheduled_date").asc_nulls_last()]
        ),
    ),
    """SELECT DISTINCT ON (inquiry_id) * FROM appointments
ORDER BY inquiry_id, state, appointment_type, scheduled_date NULLS LAST""",
)
register(
    "drop_duplicates_keep_first",
    from_view(
        "mail_base",
        lambda df: dedupe.first_per_key(df.select("case_id", "email"), ["email"], [c("case_id").asc()]),
    ),
    "SELECT min(case_id) AS case_id, email FROM mail_base GROUP BY email",
)

# Unions.
register(
    "union_two_systems",
    lambda wh: existing.inquiry_cases(wh)
    .unionByName(existing.service_cases(wh))
    .select("system", "case_id", "service_id", "product", "result_date", "client_1", "subsidy"),
    """
SELECT 'inquiry' AS system, i.case_id, i.case_id || ':MSS' AS service_id, 'MSS' AS product, i.results_sent_at AS result_date,
  v.client_name AS client_1, m.supplementary AS subsidy
FROM inquiries AS i LEFT JOIN voucher_dim AS v ON v.id = i.voucher_ids[1]
  LEFT JOIN (SELECT DISTINCT inquiry_id, supplementary FROM insurance_data WHERE main) AS m ON m.inquiry_id = i.id
WHERE i.id NOT IN (SELECT inquiry_id FROM contact_entries WHERE quality IN (0, 2, 3, 4, 5, 6) AND contact_type <> 'Q1')
UNION ALL
SELECT 'service', s.case_id, s.service_id, pr.name, f.result_date, pa.name, false
FROM services AS s JOIN (
    SELECT case_id || ':' || service AS service_id,
      max(cast(strptime(json_extract_string(event_body, '$.properties.date'), '%d-%m-%Y') AS date)) AS result_date
    FROM workflow_events WHERE event_type LIKE '%DID_SEND_FINAL%' AND deleted_at IS NULL GROUP BY ALL) AS f
    USING (service_id)
  LEFT JOIN contracts AS c ON c.id = s.contract_id LEFT JOIN payers AS pa ON pa.id = c.payer_id
  LEFT JOIN products AS pr ON pr.id = s.product_id
WHERE s.deleted_at IS NULL AND s.case_id NOT IN (SELECT case_id FROM visits
  WHERE deleted_at IS NULL AND visit_timing = 1 AND visit_nps IN ('0', '1', '2', '3', '4', '5', '6'))""",
)
register(
    "union_branches",
    lambda wh: wh["case_cube"].select("case_id", F.lit("mail").alias("branch")).unionByName(
        wh["phone_cube"].select("case_id", F.lit("phone").alias("branch"))
    ),
    """SELECT case_id, 'mail' AS branch FROM case_cube UNION ALL SELECT case_id, 'phone' FROM phone_cube""",
)
register(
    "union_then_number",
    lambda wh: ledger.assign_ids(
        wh["case_cube"].select("case_id", F.lit("mail").alias("branch")).unionByName(
            wh["phone_cube"].select("case_id", F.lit("phone").alias("branch"))
        ),
        wh["cam_select"],
        ["case_id", "branch"],
    ).select("select_id", "case_id", "branch"),
    """SELECT (SELECT max(select_id) FROM cam_select) + row_number() OVER (ORDER BY
  md5(case_id || '|' || branch), case_id, branch) AS select_id, case_id, branch
FROM (SELECT case_id, 'mail' AS branch FROM case_cube UNION ALL SELECT case_id, 'phone' FROM phone_cube)""",
)

# Scalar functions.
register(
    "lower_upper",
    *columns("case_cube", "SELECT case_id, lower(payer_name) AS low, upper(inquiry_type) AS up FROM case_cube",
             low=lambda: F.lower("payer_name"), up=lambda: F.upper("inquiry_type")),
)
register(
    "concat_both_ways",
    *columns(
        "case_cube",
        """SELECT case_id, coalesce(voucher_code, '') || ':' || product AS skipping,
  voucher_code || ':' || product AS strict FROM case_cube""",
        skipping=lambda: t.concat_skip_nulls("voucher_code", F.lit(":"), "product"),
        strict=lambda: t.concat_strict(c("voucher_code"), F.lit(":"), c("product")),
    ),
)
register(
    "coalesce_values",
    *columns("case_cube", "SELECT case_id, ifnull(completion_reason, ifnull(voucher_code, '-')) AS value FROM case_cube",
             value=lambda: F.coalesce("completion_reason", "voucher_code", F.lit("-"))),
)
register(
    "greatest_of_dates",
    *columns(
        "phone_cube",
        """SELECT case_id, CASE WHEN prem_latest_sent_at IS NULL OR prem_latest_planned_at > prem_latest_sent_at
  THEN prem_latest_planned_at ELSE prem_latest_sent_at END AS latest FROM phone_cube""",
        latest=lambda: F.greatest("prem_latest_planned_at", "prem_latest_sent_at"),
    ),
)
register(
    "casts",
    lambda wh: wh["feedbacks"].select(
        "service_id", c("nps").try_cast("int").alias("score"), c("service_id").cast("string").alias("service_text"),
        c("deleted_at").cast("date").alias("deleted_on"),
    ),
    """SELECT service_id, try_cast(nps AS int) AS score, cast(service_id AS string) AS service_text,
  cast(deleted_at AS date) AS deleted_on FROM feedbacks""",
)
register(
    "day_first_dates",
    *columns(
        "workflow_events",
        """SELECT case_id, event_date AS result_date FROM workflow_events""",
        result_date=lambda: d.parse_day_first(n.json_text(c("event_body"), "$.properties.date")),
    ),
)
register(
    "date_text",
    *columns("case_cube", "SELECT case_id, strftime(result_date, '%Y-%m-%d') AS day_text FROM case_cube",
             day_text=lambda: F.date_format("result_date", "yyyy-MM-dd")),
)
register(
    "week_and_year",
    *columns(
        "case_cube",
        """SELECT case_id, cast(week(result_date) AS int) AS week, cast(year(result_date) AS int) AS year,
  cast(date_trunc('week', result_date) AS date) AS monday FROM case_cube""",
        week=lambda: F.weekofyear("result_date"), year=lambda: F.year("result_date"), monday=lambda: F.trunc("result_date", "week"),
    ),
)
register(
    "date_arithmetic",
    *columns(
        "case_cube",
        f"""SELECT case_id, cast(result_date + 30 AS date) AS stop, cast(result_date - INTERVAL 6 MONTH AS date) AS earlier,
  cast({NOW} - result_date AS int) AS age FROM case_cube""",
        stop=lambda: F.date_add("result_date", 30), earlier=lambda: F.add_months("result_date", -6), age=lambda: d.days_since(c("result_date"), AS_OF),
    ),
)
register(
    "prom_age_bucket",
    *columns(
        "case_cube",
        f"""SELECT case_id, CASE WHEN {NOW} - result_date < 364 THEN 'prom_6' WHEN {NOW} - result_date > 720 THEN 'prom_24'
  ELSE 'prom_12' END AS kind FROM case_cube""",
        kind=lambda: d.prom_age_bucket(d.days_since(c("result_date"), AS_OF)),
    ),
)
register(
    "json_paths",
    lambda wh: wh["events"].select("event_id", n.json_text(c("props"), "$.k").cast("int").alias("k")),
    "SELECT event_id, cast(json_extract_string(props, '$.k') AS int) AS k FROM events",
)
register(
    "array_items",
    *columns(
        "inquiries",
        "SELECT case_id, voucher_ids[1] AS first_id, voucher_ids[2] AS second_id FROM inquiries",
        first_id=lambda: n.first_item(c("voucher_ids")), second_id=lambda: n.second_item(c("voucher_ids")),
    ),
)
register(
    "unnest_array",
    from_view("inquiries", lambda df: df.select("case_id", F.explode("voucher_ids").alias("voucher_id"))),
    "SELECT case_id, unnest(voucher_ids) AS voucher_id FROM inquiries",
)


def sealed_names(wh: Warehouse) -> DataFrame:
    keys = keyring(wh.spark)
    people = wh["customer"].select(
        c("c_custkey").alias("person"),
        F.when(c("c_acctbal") < 0, "").when(c("c_acctbal") > 9000, F.concat("c_name", F.lit("@example.org")))
        .when(c("c_acctbal") > 8000, "Dr.").when(c("c_acctbal") > 7000, "Anna").when(c("c_acctbal") > 6000, F.lit(None))
        .when(c("c_acctbal") > 5000, F.lit("AAAAAAAAAAAAAAAAAAAAAA=="))
        .otherwise(encrypt_text(c("c_name"), keys)).alias("name"),
        encrypt_text(c("c_mktsegment"), keys).alias("segment"),
        c("c_mktsegment").isin("BUILDING").alias("clear"),
    ).withColumn("segment", F.when(c("clear"), "open").otherwise(c("segment")))
    return decrypt_columns(decrypt_columns(people, ["name"], keys), ["segment"], keys, c("clear"))


register(
    "decrypt_columns",
    sealed_names,
    """SELECT c_custkey AS person, CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal > 9000 THEN c_name || '@example.org'
  WHEN c_acctbal > 8000 THEN 'Dr.' WHEN c_acctbal > 7000 THEN 'Anna' WHEN c_acctbal > 6000 THEN NULL
  WHEN c_acctbal > 5000 THEN 'AAAAAAAAAAAAAAAAAAAAAA==' ELSE c_name END AS name, CASE c_mktsegment WHEN 'BUILDING' THEN 'open' ELSE c_mktsegment END AS segment,
  c_mktsegment = 'BUILDING' AS clear FROM customer""",
)

# Composite operators.
register(
    "ledger_row",
    lambda wh: ledger.to_ledger(
        wh["case_cube"].withColumn("select_id", c("case_id").cast("long")).withColumn("batch_id", F.lit(1)),
        {"client_name": c("payer_name"), "first_voucher_code": c("voucher_code")},
    ).withColumns({k: c(k).cast("int") for k in ("reached_patient_flag", "opt_out")}),
    """SELECT cast(NULL AS int) AS reached_patient_flag, cast(NULL AS int) AS opt_out, cast(case_id AS bigint) AS select_id, cast(1 AS bigint) AS batch_id, case_id, payer_name AS client_name,
  voucher_code AS first_voucher_code, cast(patient_id AS string) AS patient_id, 0 AS control_flag,
  1 AS count_cases_patient, cast(NULL AS date) AS reached_date, cast(NULL AS string) AS refusal_reason,
  cast(NULL AS string) AS new_case_id, cast(NULL AS string) AS app_state, cast(NULL AS string) AS korb,
  preferred_language FROM case_cube""",
)
register(
    "first_voucher",
    lambda wh: vouchers.first_voucher(
        wh["inquiries"].select("case_id", "voucher_ids"),
        wh["voucher_dim"],
        vouchers.allowed_voucher(("VIP ROT", "VIP GELB"), ("%-BDTC", "NUBU-7777")),
    ),
    """SELECT i.case_id, v.id AS voucher_id, v.value AS voucher_code, v.client_name AS voucher_client
FROM (SELECT case_id, unnest(voucher_ids) AS voucher FROM inquiries) AS i JOIN voucher_dim AS v ON v.id = i.voucher
WHERE v.client_name NOT IN ('VIP ROT', 'VIP GELB') AND v.value NOT LIKE '%-BDTC' AND v.value <> 'NUBU-7777'
QUALIFY row_number() OVER (PARTITION BY i.case_id ORDER BY v.id) = 1""",
)
register(
    "survey_class",
    lambda wh: surveys.survey_class(services.links_of(wh)),
    """SELECT case_id, CASE WHEN bool_or(title LIKE '%Status%') THEN 'SS' WHEN bool_or(title LIKE '%PREM%') THEN 'PREM' END
  AS case_class FROM survey_links LEFT JOIN surveys ON id = survey_id GROUP BY case_id""",
)
register(
    "survey_class_other_titles",
    lambda wh: surveys.survey_class(services.links_of(wh), {"Allrounder": "%Allrounder%", "Reha": "%Reha%"}),
    """SELECT case_id, CASE WHEN bool_or(title LIKE '%Allrounder%') THEN 'Allrounder' WHEN bool_or(title LIKE '%Reha%')
  THEN 'Reha' END AS case_class FROM survey_links LEFT JOIN surveys ON id = survey_id GROUP BY case_id""",
)
register(
    "suppression_list",
    lambda wh: suppress.suppression_list(wh["case_cube"].select("case_id"), wh["suppression"], ["objection"]),
    "SELECT case_id FROM case_cube WHERE case_id NOT IN (SELECT case_id FROM suppression WHERE reason = 'objection')",
)
register(
    "current_week_guard",
    lambda wh: ledger.batches_this_week(wh["cam_batch"], 4, date(1999, 6, 2)),
    """SELECT cam_id, batch_id, batch_selection_date FROM cam_batch WHERE cam_id = 4
  AND batch_selection_date >= date_trunc('week', DATE '1999-06-02')""",
)
