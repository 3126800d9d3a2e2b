"""Named tables of a warehouse, wherever they are stored."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.sources.schemas import CAMPAIGN_TABLES


class Warehouse:
    """Looks tables up by name and keeps the frame, so one plan reads each table once per name."""

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame]):
        self.spark = spark
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def query(self, sql: str, tables: list[str], args: dict | None = None) -> DataFrame:
        """SQL text over named tables, each written ``{name}`` in the text, with ``:arg`` parameters."""
        return self.spark.sql(sql, args=args, **{t: self[t] for t in tables})


def marked(cam_select: DataFrame, cam_batch: DataFrame) -> DataFrame:
    """Ledger rows whose batch has its batch row. Others belong to a run that stopped or still writes."""
    batches = cam_batch.select(F.col("batch_id").alias("_batch")).distinct()
    return cam_select.join(batches, F.col("batch_id") == F.col("_batch"), "left_semi")


def parquet_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """One Parquet dataset per table below ``root``; campaign tables are read with their schema, and of
    the ledger the rows of batches that have their batch row."""

    def read(name: str) -> DataFrame:
        reader = spark.read
        if name in CAMPAIGN_TABLES:
            reader = reader.schema(CAMPAIGN_TABLES[name])
        return reader.parquet(f"{root.rstrip('/')}/{name}")

    return Warehouse(spark, lambda name: marked(read(name), read("cam_batch")) if name == "cam_select" else read(name))


def catalog_warehouse(spark: SparkSession, names: Mapping[str, str] | None = None) -> Warehouse:
    """Tables of the session catalog; ``names`` maps a logical to a qualified table name."""
    return Warehouse(spark, lambda name: spark.table((names or {}).get(name, name)))


def frame_warehouse(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Warehouse:
    return Warehouse(spark, frames.__getitem__)


def hash_predicates(column: str, parts: int, cast: str = "varchar(4000)") -> list[str]:
    """Conditions of which every row meets exactly one, by the first hex digits of the MD5 of a key.

    They split text keys, which have no range of numbers, and need nothing of the database but
    ``md5`` in lower case, ``substr`` and ``IN``. Rows without key meet the first.
    """
    digits = next(d for d in (1, 2, 3) if 16**d >= parts or d == 3)
    names = [f"{i:0{digits}x}" for i in range(16**digits)]
    if not 1 <= parts <= len(names):
        raise ValueError(f"between 1 and {len(names)} parts, not {parts}")
    out = []
    for i in range(parts):
        own = ", ".join(f"'{n}'" for n in names[len(names) * i // parts : len(names) * (i + 1) // parts])
        out.append(f"substr(md5(cast({column} AS {cast})), 1, {digits}) IN ({own})")
    out[0] = f"({out[0]} OR {column} IS NULL)"
    return out


def jdbc_warehouse(
    spark: SparkSession,
    options: Mapping[str, str],
    partitions: Mapping[str, tuple[str, int, int, int]],
    unsplit: Collection[str] = (),
    hashed: Mapping[str, tuple[str, int]] | None = None,
) -> Warehouse:
    """Live database tables. ``partitions[name] = (column, lower, upper, count)`` splits the read by
    ranges of a number or date, ``hashed[name] = (column, count)`` by a hash of a text key. A table
    without a split comes through one connection, so it is refused unless it is in ``unsplit``."""
    hashed = hashed or {}
    if both := set(hashed) & set(partitions):
        raise ValueError(f"tables split twice: {sorted(both)}")

    def load(name: str) -> DataFrame:
        if name not in partitions and name not in unsplit and name not in hashed:
            raise ValueError(f"table {name!r} needs a split, or has to be named in unsplit")
        if name in hashed:
            rest = {k: str(v) for k, v in options.items() if k != "url"}
            return spark.read.jdbc(options["url"], name, predicates=hash_predicates(*hashed[name]), properties=rest)
        reader = spark.read.format("jdbc").options(**options).option("dbtable", name)
        if name in partitions:
            column, lower, upper, count = partitions[name]
            reader = (
                reader.option("partitionColumn", column)
                .option("lowerBound", lower)
                .option("upperBound", upper)
                .option("numPartitions", count)
            )
        return reader.load()

    return Warehouse(spark, load)
