"""Shape of the plans, and results under skew."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry  # noqa: F401  registers the queries
from recontact.checks import registry
from recontact.checks.sample import sample_warehouse
from recontact.functions import dates as d
from recontact.operators import dedupe, event_facts, ledger, outbox, suppress
from recontact.sources import bucketed
from recontact.sources.history import warehouse_as_of
from recontact.sources.warehouse import (
    frame_warehouse,
    hash_predicates,
    jdbc_warehouse,
    parquet_warehouse,
)

QUERIES = registry.QUERIES
SINKS = (
    "ledger_append", "export_", "commit_", "registry_append", "weekly_de_run", "weekly_ch_run", "cards_still_open", "event_facts_advanced",
    "anti_join_bucketed",
)
LIGHT = [n for n in sorted(QUERIES) if not n.startswith(SINKS)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


@pytest.mark.parametrize("name", LIGHT)
def test_building_runs_nothing_and_needs_no_python_or_cross_join(spark, name):
    sample_warehouse(spark, "/root/testdata/sf0.001")["orders"]
    QUERIES[name](spark, "/root/testdata/sf0.001")  # opens the files of its tables
    before = jobs(spark)
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert jobs(spark) == before
    plan = plan_of(df)
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_suppression_reads_its_sets_once_to_look_for_nulls(spark, tmp_path):
    spark.createDataFrame([("a",), (None,)], "case_id string").write.parquet(str(tmp_path / "x"))
    df = spark.createDataFrame([("a",), ("b",)], "case_id string")
    out = suppress.exclude_keys(df, spark.read.parquet(str(tmp_path / "x")), "case_id", nulls="sql")
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("count_if") <= 2 and tree.count("GlobalLimit") == 0
    assert out.count() == 0


class Reader:
    """Stands in for a session's reader and notes its options."""

    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        return self.option("format", name)

    def options(self, **more):
        self.seen |= more
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self):
        return dict(self.seen)


def test_live_tables_are_read_in_parts(spark):
    wh = jdbc_warehouse(Reader(), {"url": "u"}, {"cases": ("id", 1, 900, 30)}, unsplit=["tiny"])
    got = wh["cases"]
    assert (got["dbtable"], got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("cases", "id", 1, 900, 30)
    with pytest.raises(ValueError, match="other"):
        wh["other"]
    assert wh["tiny"]["dbtable"] == "tiny"


def test_live_tables_are_split_by_a_hash_of_a_text_key(spark):
    class Jdbc(Reader):
        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    wh = jdbc_warehouse(Jdbc(), {"url": "u", "user": "me"}, {}, hashed={"cases": ("case_id", 5)})
    url, table, predicates, properties = wh["cases"]
    assert (url, table, len(predicates), properties) == ("u", "cases", 5, {"user": "me"})
    keys = [None, "", *map(str, range(2000))]
    for parts in (1, 5, 16, 40, 256):
        for run in (
            lambda sql: spark.sql(sql, df=spark.createDataFrame([(k,) for k in keys], "case_id string")).collect(),
            duckdb_rows(keys),
        ):
            conditions = hash_predicates("case_id", parts)
            counted = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in conditions)
            assert {r[0] for r in run(f"SELECT {counted} AS n FROM {{df}}")} == {1}
    sizes = [spark.range(4096).selectExpr("cast(id AS string) AS case_id").filter(p).count() for p in hash_predicates("case_id", 16)]
    assert max(sizes) < 1.3 * 256
    with pytest.raises(ValueError, match="twice"):
        jdbc_warehouse(Reader(), {}, {"a": ("id", 1, 2, 3)}, hashed={"a": ("k", 2)})
    with pytest.raises(ValueError, match="parts"):
        hash_predicates("k", 5000)


def duckdb_rows(keys):
    con = duckdb.connect()
    con.execute("CREATE TABLE df (case_id VARCHAR)")
    con.executemany("INSERT INTO df VALUES (?)", [(k,) for k in keys])
    return lambda sql: con.execute(sql.format(df="df")).fetchall()


def test_rolling_window_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.lit(date(2024, 1, 1)).alias("day"), F.lit("x").alias("unused")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(F.col("day") >= d.before(date(2024, 5, 1), months=6)).select("day")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(day,2023-11-01)" in plan
    assert "unused" not in plan


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    plan = plan_of(dedupe.first_per_key(df, ["k"], [F.col("o").asc()]))
    assert "row_number(), 1, Partial" in plan


def test_numbering_uses_no_single_partition_sort_of_rows(spark):
    last = spark.createDataFrame([(1, 1)], "select_id long, batch_id long")
    df = spark.range(1000).select(F.col("id").cast("string").alias("case_id"))
    plan = plan_of(ledger.assign_ids(df, last, ["case_id"]))
    window = plan[plan.index("row_number()"):]
    assert "hashpartitioning(_bucket" in window


@pytest.mark.parametrize("rule", ["guarded", "admit", "sql"])
def test_skewed_suppression_against_brute_force(spark, rule):
    """A third of the rows without key, a third with one key."""
    rows = [(None, i) if i % 3 == 0 else (1, i) if i % 3 == 1 else (i, i) for i in range(3000)]
    gone = set(range(2, 1500))
    df = spark.createDataFrame(rows, "k long, i long")
    exclusion = spark.createDataFrame([(x,) for x in gone], "k long")
    got = {r.i for r in suppress.exclude_keys(df, exclusion, "k", nulls=rule).collect()}
    want = {i for k, i in rows if (k is None and rule == "admit") or (k is not None and k not in gone)}
    assert got == want


@pytest.mark.parametrize("spread", [None, ["i"]])
def test_rows_without_key_are_spread(spark, spread):
    df = spark.range(2000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("i"))
    exclusion = spark.createDataFrame([(1,)], "k long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = suppress.exclude_keys(df, exclusion, "k", nulls="admit", spread=spread)
        tasks = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 4 and out.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("partitions", [1, 5])
def test_first_row_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("o"), "id")
    order = [F.col("o").asc(), F.col("id").asc()]
    want = {(r.k, r.id) for r in dedupe.first_per_key(df, ["k"], order).collect()}
    have = {(r.k, r.id) for r in dedupe.first_per_key(df.repartition(partitions), ["k"], order).collect()}
    assert want == have


def test_suppression_against_a_bucketed_ledger_does_not_shuffle_it(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("case_id"), (F.col("id") % 9).alias("batch_id"))
    bucketed.store(rows.filter("id % 3 = 0"), "ledger_in_buckets", buckets=8, path=str(tmp_path / "b"))
    copies = bucketed.bucketed_warehouse(spark, frame_warehouse(spark, {}), {"cam_select": "ledger_in_buckets"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = suppress.exclude_keys(rows, copies["cam_select"], "case_id")
        plan = plan_of(out)
        # Of the two sides the selection is dealt to the buckets; the ledger is read as it lies.
        assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan
        ledger_side = plan[plan.index("ledger_in_buckets") - 3000 : plan.index("ledger_in_buckets")]
        assert "HashAggregate" in ledger_side
        assert out.count() == 5000 - len(range(0, 5000, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sql("DROP TABLE ledger_in_buckets")


def test_batches_of_a_time_prune_the_folders_of_the_ledger(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("case_id"), (F.col("id") % 40).alias("batch_id"))
    as_rows = ledger.to_ledger(rows)
    ledger.write_batch(as_rows, f"{root}/cam_select")
    batches = spark.range(40).selectExpr(
        "4 AS cam_id", "id AS batch_id", "'phone' AS batch_acceptor", "date_add(date'2024-01-01', cast(id AS int)) AS batch_selection_date",
        "date'2024-01-01' AS batch_transfer_date", "date'2024-01-01' AS batch_start", "date'2024-01-01' AS batch_stop",
    )
    batches.write.parquet(f"{root}/cam_batch")
    wh = parquet_warehouse(spark, root)
    seen = suppress.campaign_ledger(wh["cam_select"], wh["cam_batch"])
    recent = suppress.contacts(seen, when=F.col("batch_selection_date") > F.lit(date(2024, 2, 4)))
    plan = plan_of(recent.select("case_id"))
    scan = plan[plan.index("PartitionFilters"):]
    assert "dynamicpruning" in scan
    assert recent.count() == 5 * 100
    past = warehouse_as_of(wh, date(2024, 1, 11))
    assert "dynamicpruning" in plan_of(past["cam_select"].select("case_id"))
    assert past["cam_select"].count() == 10 * 100


def test_new_days_of_events_alone_are_read(spark, tmp_path):
    facts = {"last": ("latest", event_facts.of_type("X", "at")), "n": ("count", lambda: F.col("at"))}
    rows = [("a", "x", 5, date(2024, 1, 1)), ("a", "X", 3, date(2024, 1, 9)), ("b", "y", 1, date(2024, 1, 2)), ("c", "x", 9, None)]
    events = spark.createDataFrame(rows, "case_id string, event_type string, at int, arrived_on date")
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    path = str(tmp_path / "facts")
    assert event_facts.current(spark, path) == (None, None)
    first = event_facts.advance(spark, path, events, facts, date(2024, 1, 5))
    assert sorted(map(tuple, first.collect())) == [("a", 5, 1), ("b", None, 1)]
    again = event_facts.advance(spark, path, events, facts, date(2024, 1, 4))
    assert sorted(map(tuple, again.collect())) == [("a", 5, 1), ("b", None, 1)]
    # A stopped run left a folder without its mark.
    spark.range(1).write.parquet(f"{path}/through=2024-02-01")
    late = event_facts.advance(spark, path, events, facts, date(2024, 1, 31))
    assert sorted(map(tuple, late.collect())) == [("a", 5, 2), ("b", None, 1)]
    full = event_facts.event_facts(events.filter("arrived_on IS NOT NULL"), facts)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, late.collect()))
    assert event_facts.current(spark, path)[1] == date(2024, 1, 31)
    new = events.filter((F.col("arrived_on") <= F.lit(date(2024, 1, 31))) & (F.col("arrived_on") > F.lit(date(2024, 1, 5))))
    assert "GreaterThan(arrived_on,2024-01-05)" in plan_of(event_facts.event_facts(new, facts))


def test_cards_are_sent_until_delivered_or_given_up(spark, tmp_path):
    path, day = str(tmp_path / "attempts"), date(2024, 5, 1)

    def outcomes(*rows):
        return spark.createDataFrame([(1, n, s, d) for n, s, d in rows], "batch_id long, name string, state string, attempted_on date")

    cards = spark.createDataFrame([(1, n) for n in ("a", "b", "c", "d", "d")] + [(None, "e"), (2, "a"), (1, None)], "batch_id long, name string")
    outbox.record(outcomes(("a", "delivered", day), ("b", "failed", day), ("c", "failed", day)), path, "1")

    def due(**most):
        return {(r.batch_id, r.name): r.attempts for r in outbox.cards_still_open(cards, outbox.attempts(spark, path), **most).collect()}

    first = due()
    assert first == {(1, "b"): 1, (1, "c"): 1, (1, "d"): 0, (2, "a"): 0}
    outbox.record(outcomes(("a", "delivered", day), ("b", "failed", day), ("c", "failed", day)), path, "1")
    assert due() == first
    outbox.record(outcomes(("b", "delivered", day), ("c", "failed", date(2024, 5, 2)), ("a", "failed", date(2024, 5, 2))), path, "2")
    assert due() == {(1, "c"): 2, (1, "d"): 0, (2, "a"): 0} and (1, "c") not in due(most_attempts=2)
    ends = outbox.give_up(outbox.attempts(spark, path), 2, date(2024, 5, 3))
    assert [(r.name, r.detail) for r in ends.collect()] == [("c", "failed 2 times")]
    outbox.record(ends, path, "3")
    assert due() == {(1, "d"): 0, (2, "a"): 0}
