"""Tables kept in buckets of a key, so that joins and groupings by it do not shuffle them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from recontact.sources.warehouse import Warehouse

BUCKETS = 256


def store(
    df: DataFrame, table: str, key: Sequence[str] = ("case_id",), buckets: int = BUCKETS, path: str | None = None
) -> None:
    """Write a catalog table in buckets of ``key``, sorted within; an existing one is replaced. Its files
    lie in the warehouse folder or at ``path``.

    Rows are dealt to the buckets before they are written, so a bucket is one file; with more data,
    choose the number so that a bucket fits a task. Rows without key are one bucket: where they are
    many, keep them out, as suppression by key never needs them.
    """
    dealt = df.repartition(buckets, *key)
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def bucketed_warehouse(spark: SparkSession, base: Warehouse, names: Mapping[str, str]) -> Warehouse:
    """The warehouse with some tables read from their bucketed copies; ``names`` maps table to copy."""
    return Warehouse(spark, lambda name: spark.table(names[name]) if name in names else base[name])
