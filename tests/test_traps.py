"""Null, order, week and id rules, each on hand-written rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from recontact.functions import dates as d
from recontact.functions import nested as n
from recontact.functions import text as t
from recontact.operators import dedupe, ledger, suppress, surveys, vouchers


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def one(spark, expr, **fields):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()])
    return row.select(expr.alias("x")).first().x


def test_missing_date_wins_when_sorted_down(spark):
    df = spark.createDataFrame(
        [("a", 1, date(2020, 1, 1)), ("b", 1, None), ("c", 2, date(2020, 1, 1)), ("d", 2, date(2021, 1, 1))],
        "case_id string, patient_id long, result_date date",
    )
    order = [F.col("result_date").desc_nulls_first(), F.col("case_id")]
    assert values(dedupe.first_per_key(df, ["patient_id"], order), "case_id") == [("b",), ("d",)]


@pytest.mark.parametrize(
    "rule, expected",
    [("guarded", ["b"]), ("admit", ["b", None]), ("sql", ["b"])],
)
def test_null_rules_of_suppression(spark, rule, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "case_id string")
    gone = spark.createDataFrame([("a",)], "case_id string")
    kept = [r.case_id for r in suppress.exclude_keys(df, gone, "case_id", nulls=rule).collect()]
    assert sorted(kept, key=str) == sorted(expected, key=str)


def test_null_in_the_exclusion_set(spark):
    df = spark.createDataFrame([("a",), ("b",)], "case_id string")
    gone = spark.createDataFrame([("a",), (None,)], "case_id string")
    assert suppress.exclude_keys(df, gone, "case_id", nulls="sql").count() == 0
    assert suppress.exclude_keys(df, gone, "case_id", nulls="guarded").count() == 1
    assert suppress.exclude_keys(df, gone, "case_id", nulls="admit").count() == 1


def test_empty_exclusion_set_keeps_all_under_sql_rule(spark):
    df = spark.createDataFrame([("a",), (None,)], "case_id string")
    nothing = spark.createDataFrame([], "case_id string")
    assert suppress.exclude_keys(df, nothing, "case_id", nulls="sql").count() == 2


@pytest.mark.parametrize("rule", ["guarded", "admit", "sql"])
@pytest.mark.parametrize("null_in_set", [False, True])
def test_union_of_sets_equals_chain(spark, rule, null_in_set):
    df = spark.range(50).select(F.when(F.col("id") != 7, F.col("id").cast("string")).alias("k"))
    first = spark.range(0, 20).select(F.col("id").cast("string").alias("k"))
    second = spark.range(15, 30).select(
        F.when(F.lit(not null_in_set) | (F.col("id") != 20), F.col("id").cast("string")).alias("k")
    )
    chain = suppress.exclude_keys(suppress.exclude_keys(df, first, "k", nulls=rule), second, "k", nulls=rule)
    union = suppress.exclude_any(df, [first, second], "k", nulls=rule)
    assert values(chain, "k") == values(union, "k")


def test_unknown_rule_is_refused(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        suppress.exclude_keys(df, df, "k", nulls="other")


def test_cases_without_patient_form_one_group_unless_kept(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", 1)], "case_id string, patient_id long")
    order = [F.col("case_id").asc()]
    assert values(dedupe.first_per_key(df, ["patient_id"], order), "case_id") == [("a",), ("c",)]
    assert dedupe.first_per_key(df, ["patient_id"], order, keep_null_keys=True).count() == 3


def test_two_ways_to_concatenate(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(
        t.concat_skip_nulls("x", F.lit(":"), "y").alias("skip"), t.concat_strict(F.col("x"), F.col("y")).alias("strict")
    ).first()
    assert (row.skip, row.strict) == ("a:", None)


@pytest.mark.parametrize(
    "day, mode, due",
    [
        (date(2025, 11, 25), "parity", True),
        (date(2025, 11, 28), "parity", False),
        (date(2025, 11, 28), "week_start", True),
        (date(2025, 12, 1), "week_start", False),
        (None, "parity", None),
    ],
)
def test_week_number_with_calendar_year(spark, day, mode, due):
    df = spark.createDataFrame([(day,)], "day date")
    got = df.select(d.iso_week_due(F.col("day"), 5, date(2025, 12, 30), mode).alias("x")).first().x
    assert got is due


def test_unknown_week_mode_is_refused(spark):
    with pytest.raises(ValueError):
        d.in_iso_week_of(F.lit(date(2025, 1, 1)), F.lit(date(2025, 1, 1)), "other")


def test_span_before_a_day(spark):
    assert one(spark, d.before(date(2024, 8, 31), months=6)) == date(2024, 2, 29)
    assert one(spark, d.before(date(2024, 3, 1), years=1, weeks=1, days=1)) == date(2023, 2, 21)
    assert one(spark, d.days_since(F.lit(date(2024, 2, 28)), date(2024, 3, 1))) == 2


@pytest.mark.parametrize("text, day", [("31-12-2024", date(2024, 12, 31)), ("2024-12-31", None), ("", None), (None, None)])
def test_day_first_text(spark, text, day):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(d.parse_day_first(F.col("s")).alias("x")).first().x == day


@pytest.mark.parametrize("days, kind", [(363, "prom_6"), (364, "prom_12"), (720, "prom_12"), (721, "prom_24"), (None, "prom_12")])
def test_age_class(spark, days, kind):
    df = spark.createDataFrame([(days,)], "n int")
    assert df.select(d.prom_age_bucket(F.col("n")).alias("x")).first().x == kind


@pytest.mark.parametrize(
    "mail, domain", [("A@B.de", "@b.de"), ("plain", "plain"), ("@x", "@x"), ("a@", "@"), ("", ""), (None, None)]
)
def test_mail_domain(spark, mail, domain):
    df = spark.createDataFrame([(mail,)], "m string")
    assert df.select(t.email_domain(F.col("m")).alias("x")).first().x == domain


def test_boolean_tests_on_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    out = df.select(t.is_true(F.col("b")), t.is_false(F.col("b")), t.is_not_true(F.col("b"))).collect()
    assert [tuple(r) for r in out] == [(True, False, False), (False, True, True), (False, False, True)]


def test_text_score_order(spark):
    df = spark.createDataFrame([(s,) for s in ("10", "not_specified", "2", "11", None, "x")], "s string")
    ranked = {r.s: r.k for r in df.select("s", n.score_rank(F.col("s")).alias("k")).collect()}
    assert ranked == {"10": 10, "not_specified": 11, "2": 2, "11": None, None: None, "x": None}


def test_json_list_and_first_items(spark):
    df = spark.createDataFrame([("[]", [5, 4]), ('["a"]', [7]), (None, []), ("[]", None)], "j string, v array<long>")
    rows = df.select(n.json_list_empty(F.col("j")), n.first_item(F.col("v")), n.second_item(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [(True, 5, 4), (False, 7, None), (None, None, None), (True, None, None)]


def test_first_voucher_is_ranked_among_the_allowed(spark):
    cases = spark.createDataFrame(
        [("a", [9, 1, 2]), ("b", [1]), ("c", []), ("d", None)], "case_id string, voucher_ids array<long>"
    )
    dim = spark.createDataFrame(
        [(1, "X-BDTC", "Client"), (2, "OK-2", "Client"), (9, "OK-9", "Client")], "id long, value string, client_name string"
    )
    keep = vouchers.allowed_voucher(("VIP ROT",), ("%-BDTC",))
    assert values(vouchers.first_voucher(cases, dim, keep), "case_id", "voucher_id") == [("a", 2)]


def test_survey_class_prefers_status(spark):
    links = spark.createDataFrame(
        [("a", "PREM x"), ("a", "Status y"), ("b", "PREM"), ("c", "other"), ("d", None)], "case_id string, title string"
    )
    assert values(surveys.survey_class(links), "case_id", "case_class") == [
        ("a", "SS"), ("b", "PREM"), ("c", None), ("d", None)
    ]


def test_event_pivot_ignores_case(spark):
    events = spark.createDataFrame(
        [("a", "did_x", date(2024, 1, 1)), ("a", "DID_X", date(2024, 2, 1)), ("a", "DID_Y", None), ("b", "Z", None)],
        "case_id string, event_type string, day date",
    )
    out = surveys.pivot_events(events, {"x": "DID_X", "y": "DID_Y"}, at="day").collect()
    assert [tuple(r) for r in out] == [("a", date(2024, 2, 1), None)]


def test_ids_after_an_empty_ledger_start_at_one(spark):
    empty = spark.createDataFrame([], "select_id long, batch_id long")
    df = spark.range(5).select(F.col("id").cast("string").alias("case_id"))
    rows = ledger.assign_ids(df, empty, ["case_id"]).collect()
    assert sorted(r.select_id for r in rows) == [1, 2, 3, 4, 5]
    assert {r.batch_id for r in rows} == {1}


def test_shared_case_in_two_branches_gets_two_ids(spark):
    empty = spark.createDataFrame([(10, 3)], "select_id long, batch_id long")
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "case_id string, branch string")
    rows = ledger.assign_ids(df, empty, ["case_id", "branch"], batch="append").collect()
    assert sorted(r.select_id for r in rows) == [11, 12]
    assert {r.batch_id for r in rows} == {3}
