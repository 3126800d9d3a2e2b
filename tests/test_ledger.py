"""Ids, the ledger on disk, the weekly guard, and repeated runs."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from recontact.functions.pii import decrypt_columns, encrypt_text
from recontact.operators import delivery, ledger
from recontact.operators.suppress import campaign_ledger, suppress
from recontact.sources.history import version_as_of, warehouse_as_of
from recontact.sources.schemas import CAM_SELECT
from recontact.sources.warehouse import frame_warehouse, parquet_warehouse

AS_OF = date(2024, 5, 15)


@pytest.fixture()
def store(spark, tmp_path):
    root = str(tmp_path)
    ledger.create_tables(spark, root)
    return root


def cases(spark, n=100):
    return spark.range(n).select(F.col("id").cast("string").alias("case_id"), F.lit("payer").alias("client_name"))


def choose(spark, root):
    wh = parquet_warehouse(spark, root)
    fresh = suppress(cases(spark), campaign_ledger(wh["cam_select"], wh["cam_batch"]), cam_ids=[4])
    return ledger.numbered_rows(fresh, wh["cam_select"])


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_ids_do_not_depend_on_partitions(spark, partitions):
    last = spark.createDataFrame([(7, 2)], "select_id long, batch_id long")
    df = cases(spark, 500)
    want = {r.case_id: r.select_id for r in ledger.assign_ids(df, last, ["case_id"]).collect()}
    have = {r.case_id: r.select_id for r in ledger.assign_ids(df.repartition(partitions), last, ["case_id"]).collect()}
    assert want == have
    assert sorted(want.values()) == list(range(8, 508))


def test_commit_then_second_run_selects_nothing(spark, store):
    written = ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF)
    assert written.count() == 100
    wh = parquet_warehouse(spark, store)
    assert wh["cam_select"].count() == 100
    batch = wh["cam_batch"].collect()
    assert [(r.cam_id, r.batch_id, r.batch_stop) for r in batch] == [(4, 1, date(2024, 6, 14))]
    assert ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF) is None
    ledger.create_tables(spark, store)
    assert parquet_warehouse(spark, store)["cam_batch"].count() == 1


def contents(spark, root):
    wh = parquet_warehouse(spark, root)
    return sorted((r.select_id, r.batch_id, r.case_id) for r in wh["cam_select"].collect())


def stop(*_, **__):
    raise OSError("stopped")


def test_a_run_that_stops_before_its_batch_row_leaves_no_rows(spark, store, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(ledger, "mark_batch", stop)
        with pytest.raises(OSError, match="stopped"):
            ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF)
    assert spark.read.parquet(f"{store}/cam_select").count() == 100
    assert contents(spark, store) == [] and parquet_warehouse(spark, store)["cam_batch"].count() == 0
    fewer = choose(spark, store).filter("case_id < '5'")
    ledger.commit(spark, fewer, store, 4, "phone", AS_OF)
    rows = contents(spark, store)
    assert {b for _, b, _ in rows} == {1} and len(rows) == fewer.count() < 100
    assert spark.read.parquet(f"{store}/cam_select").count() == len(rows)
    ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF)
    assert sorted(s for s, _, _ in contents(spark, store)) == sorted(set(s for s, _, _ in contents(spark, store)))
    assert len(contents(spark, store)) == 100


def added(spark, root):
    rows = cases(spark).withColumn("case_id", F.concat(F.lit("x"), "case_id"))
    return ledger.numbered_rows(rows, parquet_warehouse(spark, root)["cam_select"], batch="append")


@pytest.mark.parametrize("place", ["write_batch", "mark_prepared"])
def test_a_stopped_addition_is_finished_or_dropped(spark, store, monkeypatch, place):
    ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF)
    before = contents(spark, store)
    with monkeypatch.context() as m:
        m.setattr(ledger, place, stop)
        with pytest.raises(OSError, match="stopped"):
            ledger.commit(spark, added(spark, store), store, 4, "phone", AS_OF)
    assert contents(spark, store) == before
    if place == "write_batch":
        with pytest.raises(RuntimeError, match="select again"):
            ledger.commit(spark, added(spark, store), store, 4, "phone", AS_OF)
    else:
        ledger.commit(spark, added(spark, store), store, 4, "phone", AS_OF)
    rows = contents(spark, store)
    assert [s for s, _, _ in rows] == list(range(1, 201)) and {b for _, b, _ in rows} == {1}
    assert rows[:100] == before
    assert ledger.finish_appends(spark, store) == []
    assert parquet_warehouse(spark, store)["cam_batch"].count() == 1


def test_a_batch_is_of_one_campaign_and_a_commit_of_one_batch(spark, store):
    ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF)
    with pytest.raises(ValueError, match="another campaign"):
        ledger.commit(spark, added(spark, store), store, 5, "phone", AS_OF)
    two = added(spark, store).withColumn("batch_id", F.col("select_id"))
    with pytest.raises(ValueError, match="in one commit"):
        ledger.commit(spark, two, store, 4, "phone", AS_OF)
    assert len(contents(spark, store)) == 100


def test_campaigns_are_found_by_name(spark, store):
    ledger.append_campaign(spark, store, "spring")
    more = spark.createDataFrame([("autumn",), ("winter",)], "cam_name string")
    rows = {r.cam_name: r.cam_id for r in ledger.append_campaigns(spark, store, more, channel="mail").collect()}
    assert rows["spring"] == 1 and sorted(rows.values()) == [1, 2, 3]
    ledger.commit(spark, choose(spark, store), store, "winter", "phone", AS_OF)
    assert parquet_warehouse(spark, store)["cam_batch"].first().cam_id == rows["winter"]
    for names in (["spring"], ["new", "new"], ["fresh", None]):
        with pytest.raises(ValueError, match="registered already|needs a name"):
            ledger.append_campaigns(spark, store, spark.createDataFrame([(n,) for n in names], "cam_name string"))
    with pytest.raises(ValueError, match="nowhere"):
        ledger.commit(spark, added(spark, store), store, "summer", "phone", AS_OF)
    assert spark.read.parquet(f"{store}/cam_cam").count() == 3


def test_a_repeated_day_chooses_the_same(spark, store):
    ledger.commit(spark, choose(spark, store).filter("case_id < '3'"), store, 4, "phone", date(2024, 5, 1))

    def chosen(wh):
        fresh = suppress(cases(spark), campaign_ledger(wh["cam_select"], wh["cam_batch"]), cam_ids=[4])
        return ledger.numbered_rows(fresh, wh["cam_select"])

    first = chosen(warehouse_as_of(parquet_warehouse(spark, store), AS_OF)).collect()
    ledger.commit(spark, spark.createDataFrame(first, CAM_SELECT), store, 4, "phone", AS_OF)
    ledger.commit(spark, added(spark, store).withColumn("batch_id", F.lit(3).cast("long")), store, 9, "phone", date(2024, 6, 1))
    again = chosen(warehouse_as_of(parquet_warehouse(spark, store), AS_OF))
    assert sorted(again.collect()) == sorted(first)
    assert chosen(parquet_warehouse(spark, store)).isEmpty()
    later = warehouse_as_of(parquet_warehouse(spark, store), date(2024, 6, 1), before_batch=2)
    assert sorted(chosen(later).collect()) == sorted(first)
    assert chosen(warehouse_as_of(parquet_warehouse(spark, store), AS_OF, before_batch=3)).isEmpty()


def test_versions_valid_on_a_day(spark):
    rows = [
        ("changed", "new", "2999-12-31"), ("changed", "old", "2024-05-16"), ("changed", "older", "2024-05-15"),
        ("ended", "x", "2024-05-15"), ("open", None, "2999-12-31"), (None, "n", "2999-12-31"), ("tie", "b", "2025-01-01"),
        ("tie", "a", "2025-01-01"), ("no end", "x", None),
    ]
    df = spark.createDataFrame(rows, "client string, label string, valid_to string").withColumn("valid_to", F.col("valid_to").cast("date"))
    got = {(r.client, r.label) for r in version_as_of(df, ["client"], AS_OF).collect()}
    assert got == {("changed", "old"), ("open", None), (None, "n"), ("tie", "a")}
    assert version_as_of(df, ["client"], AS_OF).columns == df.columns
    began = df.withColumn("valid_from", F.when(F.col("label") == "old", F.lit(date(2024, 5, 16))))
    got = {(r.client, r.label) for r in version_as_of(began, ["client"], AS_OF, valid_from="valid_from").collect()}
    assert ("changed", "new") in got
    wh = warehouse_as_of(frame_warehouse(spark, {"history": df}), AS_OF, versions={"history": ["client"]})
    assert wh["history"].count() == 4


@pytest.mark.parametrize("digits", [1, 2, 3, 5])
def test_buckets_grow_and_ids_stay(spark, digits):
    last = spark.createDataFrame([(0, 0)], "select_id long, batch_id long")
    df = cases(spark, 3000)
    ids = {r.case_id: r.select_id for r in ledger.assign_ids(df, last, ["case_id"], digits=digits).collect()}
    want = sorted(ids, key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))
    assert [ids[k] for k in want] == list(range(1, 3001))


def test_weekly_run_is_refused_in_the_same_week(spark, store):
    ledger.commit(spark, choose(spark, store), store, 4, "phone", AS_OF, weekly=True)
    with pytest.raises(RuntimeError):
        ledger.commit(spark, choose(spark, store), store, 4, "phone", date(2024, 5, 19), weekly=True)
    assert ledger.commit(spark, choose(spark, store), store, 4, "phone", date(2024, 5, 20), weekly=True) is None


def test_narrow_rows_of_older_writers_are_widened(spark):
    old = spark.createDataFrame([(1, 1, "a")], "select_id long, batch_id long, case_id string")
    wide = ledger.as_ledger_width(old)
    assert wide.schema.names == CAM_SELECT.names
    assert [f.dataType for f in wide.schema.fields] == [f.dataType for f in CAM_SELECT.fields]
    assert wide.first().preferred_language is None


def test_registry_row_and_listing(spark):
    campaigns = spark.createDataFrame([(3, "b"), (9, None), (5, "a")], "cam_id int, cam_name string")
    row = ledger.register_campaign(spark, campaigns, "new", category=None).first()
    assert (row.cam_id, row.valid_to, row.cam_category) == (10, date(2999, 12, 31), None)
    assert [r.cam_id for r in ledger.list_campaigns(campaigns).collect()] == [5, 3, 9]


def test_cards_drop_labels_without_condition(spark):
    df = spark.createDataFrame(
        [("a", "p", "waiting_q3", 1, None, "surgery"), ("b", "p", None, 0, "post", None)],
        "case_id string, client_name string, korb string, om_flag int, post string, inquiry_type string",
    )
    ids = {k: k for k in ("follow_up", "q3", "q4_q6", "online", "post", "second_opinion", "surgery")}
    rows = delivery.card_payloads(df, "B", "L", delivery.weekly_de_labels(), ids).orderBy("name").collect()
    assert rows[0].label_ids == ["follow_up", "q3", "online", "surgery"]
    assert rows[1].label_ids == ["follow_up", "q4_q6", "post"]


def test_protected_columns(spark):
    keys = spark.createDataFrame([(b"k" * 16, b"v" * 16)], "key binary, iv binary")
    df = spark.createDataFrame([("äöü",), ("x" * 40,)], "plain string").withColumn(
        "sealed", encrypt_text(F.col("plain"), keys)
    )
    opened = decrypt_columns(df, ["sealed"], keys)
    assert all(r.plain == r.sealed for r in opened.collect())
    odd = spark.createDataFrame([(None,), ("",), ("a@b",)], "mail string")
    assert [r.mail for r in decrypt_columns(odd, ["mail"], keys).collect()] == [None, "", "a@b"]
    bad = spark.createDataFrame([("Anna",), ("Dr.",), ("AAAA",), ("A" * 22 + "==",)], "name string")
    assert [r.name for r in decrypt_columns(bad, ["name"], keys).collect()] == [r.name for r in bad.collect()]
    with pytest.raises(Exception, match="(?i)base64|decrypt|unbase64|CONVERSION|AES|length"):
        decrypt_columns(bad, ["name"], keys, strict=True).collect()
    plan = opened._jdf.queryExecution().toString()
    assert "kkkk" not in plan and "6b6b6b6b" not in plan.lower()


def test_query_text_over_named_tables(spark):
    wh = frame_warehouse(spark, {"cases": cases(spark, 10)})
    out = wh.query("SELECT count(*) AS n FROM {cases} WHERE case_id > :low", ["cases"], {"low": "5"})
    assert out.first().n == 4


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", "x@gmail.com"), ("b", "y@z.de")], "case_id string, email string")
    path = delivery.export_csv(df, str(tmp_path), "list", AS_OF)
    assert path.endswith("list_2024-05-15")
    assert spark.read.option("header", True).csv(path).count() == 2
    sheets = delivery.export_sheets(df, str(tmp_path / "sheets"))
    assert {(r.sheet, r["count"]) for r in sheets.groupBy("sheet").count().collect()} == {("all", 2), ("provider", 1)}
