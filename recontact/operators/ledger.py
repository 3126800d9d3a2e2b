"""The campaign ledger: ids, rows, batches, registry and the weekly guard."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recontact.fixed_values import CAMPAIGN_DESCRIPTION, CATEGORY_CALL, OPEN_END
from recontact.sources.schemas import CAM_BATCH, CAM_CAM, CAM_SELECT, CAMPAIGN_TABLES
from recontact.sources.storage import delete, folders, is_prepared, mark_prepared

# Hex digits of the order hash that name a numbering bucket: as many buckets as rows, up to a million.
BUCKET_DIGITS = 5


def max_id(df: DataFrame, col: str) -> Column:
    """Largest id as a scalar subquery, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(col), F.lit(0)).cast("long")).scalar()


def numbered(df: DataFrame, key: Sequence[str], digits: int = BUCKET_DIGITS) -> DataFrame:
    """``df`` with ``_number``, dense from 1, in the order of the MD5 of ``key`` and then ``key``.

    Rows fall into even buckets by the first digits of that hash, which are numbered in parallel and
    shifted by the sizes before them. Buckets are as many as their rows need, up to 16^digits, and the
    numbers do not depend on them. Sizes are summed in two levels: at most 256 groups meet in one task,
    and the buckets of a group in another. Recomputed tasks give the same numbers.
    """
    hashed = df.withColumn("_order", F.md5(F.concat_ws("|", *key))).withColumn("_bucket", F.substring("_order", 1, digits))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_group", F.substring("_bucket", 1, 2))
    groups = sizes.groupBy("_group").agg(F.sum("_n").alias("_all"))
    groups = groups.select("_group", (F.sum("_all").over(Window.orderBy("_group")) - F.col("_all")).alias("_before"))
    within = F.sum("_n").over(Window.partitionBy("_group").orderBy("_bucket")) - F.col("_n")
    shifts = sizes.withColumn("_within", within).join(groups, "_group")
    shifts = shifts.select("_bucket", (F.col("_before") + F.col("_within")).alias("_shift"))
    order = [F.col("_order"), *[F.col(k).asc_nulls_last() for k in key]]
    step = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    rows = hashed.withColumn("_step", step).join(shifts, "_bucket")
    return rows.withColumn("_number", F.col("_shift") + F.col("_step")).select(*df.columns, "_number")


def assign_ids(
    df: DataFrame, ledger: DataFrame, key: Sequence[str], batch: str = "new", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Dense ``select_id`` above the ledger's maximum, and the ``batch_id``.

    The order of ids is open, so it is the one of ``numbered``. Nothing is written here; the input
    is read for sizes and for rows.
    """
    new = 1 if batch == "new" else 0
    return numbered(df, key, digits).withColumns(
        {
            "select_id": max_id(ledger, "select_id") + F.col("_number"),
            "batch_id": max_id(ledger, "batch_id") + F.lit(new),
        }
    ).drop("_number")


def to_ledger(
    df: DataFrame, mapping: Mapping[str, Column] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Project to the 16 ledger columns: mapped or equally named input, else the default.

    Columns named in ``keep`` that the ledger lacks stay behind the ledger columns.
    """
    mapping = dict(mapping or {})
    defaults = {"control_flag": F.lit(0), "count_cases_patient": F.lit(1)}
    given = set(df.columns)
    out = []
    for field in CAM_SELECT.fields:
        name = field.name
        if name in mapping:
            col = mapping[name]
        elif name in given:
            col = F.col(name)
        else:
            col = defaults.get(name, F.lit(None))
        out.append(col.cast(field.dataType).alias(name))
    return df.select(*out, *[k for k in keep if k not in CAM_SELECT.names])


def numbered_rows(
    df: DataFrame,
    cam_select: DataFrame,
    mapping: Mapping[str, Column] | None = None,
    key: Sequence[str] = ("case_id",),
    batch: str = "new",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Chosen rows as ledger rows with their ids. Building them runs and writes nothing."""
    rows = to_ledger(df, mapping, keep=key).drop("select_id", "batch_id")
    return assign_ids(rows, cam_select, key, batch, digits).select(*CAM_SELECT.names)


def as_ledger_width(df: DataFrame) -> DataFrame:
    """Rows of an older, narrower writer (14 or 15 columns) widened by name with nulls."""
    return to_ledger(df)


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty ledger, batch and registry tables where none exist."""
    for name, schema in CAMPAIGN_TABLES.items():
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        if name == "cam_select":
            writer = writer.partitionBy("batch_id")
        writer.parquet(f"{root}/{name}")


def append_select(rows: DataFrame, path: str) -> bool:
    """Append ledger rows, one folder per batch; nothing is written for an empty selection."""
    if rows.isEmpty():
        return False
    rows.write.mode("append").partitionBy("batch_id").parquet(path)
    return True


def write_batch(rows: DataFrame, path: str) -> None:
    """Put the rows of a batch into its folder, in place of whatever a stopped run left there."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(path)


def mark_batch(row: DataFrame, root: str) -> None:
    """Append the batch row. From here on readers see the rows of the batch."""
    row.write.mode("append").parquet(f"{root}/cam_batch")


def open_batch(
    spark: SparkSession, cam_select: DataFrame, cam_id: int, acceptor: str, as_of: date, run_days: int = 30
) -> DataFrame:
    """The batch row of the newest ledger batch; it runs for ``run_days``."""
    today = F.lit(as_of)
    row = spark.range(1).select(
        F.lit(cam_id).alias("cam_id"),
        max_id(cam_select, "batch_id").alias("batch_id"),
        F.lit(acceptor).alias("batch_acceptor"),
        today.alias("batch_selection_date"),
        today.alias("batch_transfer_date"),
        today.alias("batch_start"),
        F.date_add(today, run_days).alias("batch_stop"),
    )
    return row.select(*[F.col(f.name).cast(f.dataType) for f in CAM_BATCH.fields])


def _registry_row(
    name: Column,
    cam_id: Column,
    *,
    channel: str = "phone",
    audience: str = "bd_patients",
    kind: str = "information",
    valid_from: str = "2022-01-01",
    category: str | None = CATEGORY_CALL,
) -> list[Column]:
    described = [F.lit(part) for part in CAMPAIGN_DESCRIPTION.split("{}")]
    values = {
        "cam_id": cam_id,
        "cam_channel": F.lit(channel),
        "cam_name": name,
        "cam_description": F.concat(described[0], name, *described[1:]),
        "cam_audience": F.lit(audience),
        "cam_type": F.lit(kind),
        "valid_from": F.lit(valid_from),
        "valid_to": F.lit(OPEN_END),
        "cam_category": F.lit(category),
    }
    return [values[f.name].cast(f.dataType).alias(f.name) for f in CAM_CAM.fields]


def register_campaign(spark: SparkSession, cam_cam: DataFrame, name: str, **fields) -> DataFrame:
    """Registry row of a new campaign, numbered after the largest id."""
    return spark.range(1).select(*_registry_row(F.lit(name), max_id(cam_cam, "cam_id") + F.lit(1), **fields))


def append_campaigns(spark: SparkSession, root: str, campaigns: DataFrame, **fields) -> DataFrame:
    """Write one registry row for each row of ``campaigns`` (``cam_name``), in one write, numbered after
    the largest id in the order of ``numbered``. ``fields`` are those of ``register_campaign``.

    A name that is registered already, given twice or missing is refused, and nothing is written.
    """
    path = f"{root}/cam_cam"
    registry = spark.read.schema(CAM_CAM).parquet(path)
    with staged(campaigns.select("cam_name"), root) as names:
        known = registry.select("cam_name").unionByName(names).groupBy("cam_name").agg(F.count(F.lit(1)).alias("n"))
        bad = known.join(names.distinct(), "cam_name", "left_semi").filter("n > 1").orderBy("cam_name").first()
        if bad is not None:
            raise ValueError(f"campaign {bad.cam_name!r} is registered already")
        if not names.filter("cam_name IS NULL").isEmpty():
            raise ValueError("a campaign needs a name")
        rows = numbered(names, ["cam_name"]).select(
            *_registry_row(F.col("cam_name"), max_id(registry, "cam_id") + F.col("_number"), **fields))
        # Ids are read from the registry that grows, so the rows are computed before the append.
        with staged(rows, root) as ready:
            ready.write.mode("append").parquet(path)
    return spark.read.schema(CAM_CAM).parquet(path)


def append_campaign(spark: SparkSession, root: str, name: str, **fields) -> DataFrame:
    """Write the registry row of one new campaign."""
    return append_campaigns(spark, root, spark.range(1).select(F.lit(name).alias("cam_name")), **fields)


def campaign_id(cam_cam: DataFrame, name: str) -> int:
    """Id of a registered campaign; an unknown name, and one that is registered twice, are refused."""
    found = cam_cam.filter(F.col("cam_name") == name).select("cam_id").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"campaign {name!r} is registered {'twice' if found else 'nowhere'}")
    return found[0].cam_id


def list_campaigns(cam_cam: DataFrame, order: str = "cam_name") -> DataFrame:
    return cam_cam.orderBy(F.col(order).asc_nulls_last(), F.col("cam_id").asc_nulls_last())


def batches_this_week(cam_batch: DataFrame, cam_id: int, as_of: date) -> DataFrame:
    """Batches of the campaign selected since Monday."""
    monday = F.trunc(F.lit(as_of), "week")
    return cam_batch.filter((F.col("cam_id") == cam_id) & (F.col("batch_selection_date") >= monday))


def current_week_guard(cam_batch: DataFrame, cam_id: int, as_of: date) -> None:
    """Refuse a second run of a weekly campaign."""
    if not batches_this_week(cam_batch, cam_id, as_of).isEmpty():
        raise RuntimeError(f"campaign {cam_id} already ran in the week of {as_of}")


@contextmanager
def staged(rows: DataFrame, root: str) -> Iterator[DataFrame]:
    """Rows computed once into a folder below ``root``, which all executors see; gone afterwards."""
    spark, path = rows.sparkSession, f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        delete(spark, path)


def commit(
    spark: SparkSession,
    chosen: DataFrame,
    root: str,
    cam_id: int | str,
    acceptor: str,
    as_of: date,
    weekly: bool = False,
) -> DataFrame | None:
    """Write a selection: ledger rows first, then the batch row. Returns the ledger rows of the batch.

    ``chosen`` are ledger rows of one batch; ``cam_id`` is the number of the campaign or its registered
    name. The rows are written aside before, because their ids read the very ledger that grows.
    One writer per ledger is assumed, as ids are read as maxima. Without rows nothing is written.

    A run may stop anywhere. Rows of a new batch count from its batch row on, which is written last;
    until then readers do not see them, and the next batch takes their id and their place. Rows
    added to an open batch are written aside together with those it has, marked as prepared, and then
    take its place; a stopped one is finished by the next commit, which then asks to select again.
    """
    if finished := finish_appends(spark, root):
        raise RuntimeError(f"a stopped addition to batch {finished} was finished; select again")
    if isinstance(cam_id, str):
        cam_id = campaign_id(spark.read.schema(CAM_CAM).parquet(f"{root}/cam_cam"), cam_id)
    batches = spark.read.schema(CAM_BATCH).parquet(f"{root}/cam_batch")
    if weekly:
        current_week_guard(batches, cam_id, as_of)
    path = f"{root}/cam_select"
    with staged(chosen, root) as rows:
        low, batch_id = rows.agg(F.min("batch_id"), F.max("batch_id")).first()
        if batch_id is None:
            return None
        if low != batch_id:
            raise ValueError(f"rows of batches {low} to {batch_id} in one commit")
        opened = batches.filter(F.col("batch_id") == batch_id).select("cam_id").distinct().collect()
        if opened and [r.cam_id for r in opened] != [cam_id]:
            raise ValueError(f"batch {batch_id} belongs to another campaign")
        if opened:
            _prepare_append(rows, root, batch_id)
            finish_appends(spark, root)
        else:
            write_batch(rows, path)
            mark_batch(open_batch(spark, rows, cam_id, acceptor, as_of), root)
    return spark.read.schema(CAM_SELECT).parquet(path).filter(F.col("batch_id") == batch_id)


def _prepare_append(rows: DataFrame, root: str, batch_id: int) -> None:
    spark, path = rows.sparkSession, f"{root}/_appends/{batch_id}"
    known = spark.read.schema(CAM_SELECT).parquet(f"{root}/cam_select").filter(F.col("batch_id") == batch_id)
    known.unionByName(rows.select(*CAM_SELECT.names)).write.mode("overwrite").parquet(path)
    mark_prepared(spark, path)


def finish_appends(spark: SparkSession, root: str) -> list[int]:
    """Finish prepared additions to open batches and drop unprepared ones; the batches finished."""
    finished = []
    for name in folders(spark, f"{root}/_appends"):
        path = f"{root}/_appends/{name}"
        if is_prepared(spark, path):
            write_batch(spark.read.schema(CAM_SELECT).parquet(path), f"{root}/cam_select")
            finished.append(int(name))
        delete(spark, path)
    return finished
