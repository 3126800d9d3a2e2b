"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_null_keys: bool = False
) -> DataFrame:
    """First row of every key in a total ``order`` with explicit null placement.

    Rows with null keys form one group, of which one row survives, as ``DISTINCT ON`` does;
    ``keep_null_keys`` keeps them all. The ``rn == 1`` filter lets Spark cut each key to its best row
    before the shuffle, so a key that owns a large share of the rows arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    if not keep_null_keys:
        return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    named = df.filter(~missing).withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
    return named.unionByName(df.filter(missing))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest_per_key(df: DataFrame, key: str, at: str, value: Column, name: str) -> DataFrame:
    """Latest value of ``value`` per key by one aggregation with map-side combine."""
    return df.groupBy(key).agg(F.max_by(value, F.col(at)).alias(name))


def stable_shuffle_order(seed: int, *cols: str) -> Column:
    """A repeatable random-looking order: the same seed gives the same order on every retry."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cols))
