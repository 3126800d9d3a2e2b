"""Delivery of cards: what was tried, how it ended, and which cards are still open.

Attempts are only appended, one row for each try of a card of a batch. The state of a card is that of
its last attempt. The table holds a folder for each run of the sender, which a repeated run replaces.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIVERED, FAILED, GIVEN_UP = "delivered", "failed", "given up"

ATTEMPTS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("attempted_on", T.DateType()),
        T.StructField("detail", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)
CARD = ["batch_id", "name"]


def record(outcomes: DataFrame, path: str, run: str) -> None:
    """Append the outcomes of one run of the sender (``batch_id``, ``name``, ``state``, ``attempted_on`` and,
    if there, ``detail``). A run that is recorded again takes the place of its first record."""
    own = outcomes.withColumn("run", F.lit(run))
    rows = own.select(*[
        (F.col(f.name) if f.name in own.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ATTEMPTS.fields
    ])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run").parquet(path)


def attempts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ATTEMPTS).parquet(path)


def latest_state(tried: DataFrame) -> DataFrame:
    """One row for each card that was tried: its last state with day and detail, and how often it was
    tried and failed.

    The last attempt is that of the latest day, a missing day before all; of one day a delivery
    counts before other ends, then the greater state and detail. One aggregate with map-side combine.
    """
    delivered = F.col("state").eqNullSafe(DELIVERED)
    last = F.max(F.struct("attempted_on", delivered.alias("delivered"), "state", "detail"))
    told = tried.groupBy(*CARD).agg(
        last.alias("last"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("state") == FAILED).alias("failures"),
        F.bool_or(delivered).alias("delivered"),
    )
    return told.select(*CARD, "last.state", "last.attempted_on", "last.detail", "attempts", "failures", "delivered")


def cards_still_open(cards: DataFrame, tried: DataFrame, most_attempts: int | None = None) -> DataFrame:
    """Cards to be sent: never delivered, not given up and, given a number, tried less often.

    A card that was once delivered is closed whatever came after, so no rerun sends it twice; repeated
    cards of a batch are one. Cards come with ``attempts`` so far; those without batch or name are
    left out, as their delivery could not be recorded.
    """
    state = latest_state(tried.filter("batch_id IS NOT NULL AND name IS NOT NULL"))
    closed = F.col("delivered") | (F.col("state") == GIVEN_UP)
    if most_attempts is not None:
        closed = closed | (F.col("attempts") >= most_attempts)
    flagged = state.select(*CARD, "attempts", F.coalesce(closed, F.lit(False)).alias("_closed"))
    due = cards.filter("batch_id IS NOT NULL AND name IS NOT NULL").dropDuplicates(CARD)
    out = due.join(flagged, CARD, "left").filter("_closed IS NULL OR NOT _closed").drop("_closed")
    return out.withColumn("attempts", F.coalesce("attempts", F.lit(0)))


def give_up(tried: DataFrame, after: int, as_of: date) -> DataFrame:
    """Outcome rows that close the cards which failed ``after`` times or more and are still open."""
    state = latest_state(tried).filter(~F.col("delivered") & ~F.col("state").eqNullSafe(GIVEN_UP))
    return state.filter(F.col("failures") >= after).select(
        *CARD, F.lit(GIVEN_UP).alias("state"), F.lit(as_of).alias("attempted_on"),
        F.concat(F.lit("failed "), F.col("failures").cast("string"), F.lit(" times")).alias("detail"),
    )
