"""Mixing sources to target weights by Poisson replication, in column expressions only.

A source with target weight ``w`` and size ``s`` among ``S`` has the mean repetition rate ``w * S / s``.
Each document inverts the Poisson distribution at a number in [0, 1) hashed from its id, is
exploded by that count, and the copies are ordered by another hash. No join touches the texts: the
rates of the named sources, as many as the weights, are one scalar subquery.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rate is split into equal parts of at most 1, each inverted with its own number; the sum is
# Poisson again. Beyond 20 the tail of such a part is below the step of the numbers, 2^-52.
LAST_COUNT = 20
OTHER = "*"
#: Production weights: a large web-like source is cut to a fifth, the rest share alike.
WEIGHTS = {"src0": 0.2, **{f"src{i}": 0.04 for i in range(1, 20)}, OTHER: 0.04}


def uniform(*parts: Column | str) -> Column:
    """Number in [0, 1) from the first 52 bits of the MD5 of the parts; null counts as empty."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: Mapping[str, float], size: Column) -> DataFrame:
    """One row ``r``: source name to parts and cumulative probabilities of one part.

    Rows are summed before they are shuffled. Sources without a weight, and null ones, count as
    ``*``. At most ``len(weights) + 1`` entries come out.
    """
    share = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    total = sum(weights.values())
    sums = docs.groupBy(_named(weights).alias("source")).agg(F.sum(size).alias("size"))
    whole = sums.select(F.sum("size").alias("all")).scalar()
    rate = F.when(F.col("size") > 0, F.coalesce(share[F.col("source")], F.lit(0.0)) / total * whole / F.col("size"))
    parts = sums.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    parts = parts.withColumn("parts", F.greatest(F.ceil("rate").cast("int"), F.lit(1)))
    parts = parts.withColumn("p", F.col("rate") / F.col("parts"))
    below = F.expr(
        f"transform(sequence(0, {LAST_COUNT}), k -> aggregate(sequence(0, k), 0D, "
        "(s, j) -> s + exp(-p) * pow(p, j) / factorial(j)))"
    )
    entry = F.struct("source", F.struct("parts", "rate", below.alias("below")).alias("of"))
    return parts.agg(F.map_from_entries(F.collect_list(entry)).alias("r"))


def _named(weights: Mapping[str, float]) -> Column:
    return F.when(F.col("source").isin(*[w for w in weights if w != OTHER]), F.col("source")).otherwise(F.lit(OTHER))


def replicated(
    docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, seed: str = "mix", size: Column | None = None
) -> DataFrame:
    """Rows of ``docs`` as often as drawn, with ``_copy`` (from 1) and ``_at``, their shuffled place.

    ``size`` is what the weights share out, by default the characters of ``text``. Null and empty
    texts have size 0 and are drawn at the rate of their source; a source of size 0 is dropped, as
    is one of weight 0. Rows that repeat an id draw alike. ``doc_id`` null hashes as an empty id.
    """
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long") if size is None else size
    rate = rates(docs.select("source", "text"), weights, size).scalar()
    key = F.col("doc_id").cast("string")
    drawn = docs.withColumn("_r", F.element_at(rate, _named(weights)))
    # A part's count is how many cumulative probabilities lie at or below its number.
    part = F.transform(
        F.sequence(F.lit(1), F.col("_r.parts")),
        lambda i: F.size(F.filter("_r.below", lambda c: c <= uniform(F.lit(seed), key, i.cast("string")))),
    )
    count = F.when(F.col("_r.rate") > 0, F.aggregate(part, F.lit(0), lambda a, b: a + b)).otherwise(0)
    drawn = drawn.withColumn("_count", count).drop("_r").filter("_count > 0")
    copies = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_count")))).drop("_count")
    return copies.withColumn("_at", uniform(F.lit(seed), key, F.concat(F.lit("at"), F.col("_copy").cast("string"))))


def mixed_sources(docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """The replicated rows in shuffled order, by ranges of ``_at``; ties fall by id and copy."""
    return replicated(docs, weights, seed).orderBy("_at", "doc_id", "_copy")


def mixing_sql(weights: Mapping[str, float] = WEIGHTS, seed: str = "mix") -> str:
    """The same rows in DuckDB."""
    names = ", ".join(f"'{w}'" for w in weights if w != OTHER)
    rows = ", ".join(f"('{k}', {v / sum(weights.values())!r}::DOUBLE)" for k, v in weights.items())
    number = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"
    return f"""
WITH d AS (SELECT doc_id, source, text, CASE WHEN source IN ({names}) THEN source ELSE '*' END AS s FROM documents),
sums AS (SELECT s, sum(length(coalesce(text, '')))::DOUBLE AS size FROM d GROUP BY s),
rate AS (SELECT s, CASE WHEN size > 0 THEN coalesce(w, 0) * (SELECT sum(size) FROM sums) / size ELSE 0 END AS rate
  FROM sums LEFT JOIN (VALUES {rows}) AS t(name, w) ON s = name),
part AS (SELECT s, rate, greatest(ceil(rate)::INT, 1) AS parts FROM rate),
mass AS (SELECT s, k, exp(-rate / parts) * pow(rate / parts, k) / factorial(k::INT)::DOUBLE AS m
  FROM part, range(0, {LAST_COUNT + 1}) AS t(k)),
below AS (SELECT s, k, sum(m) OVER (PARTITION BY s ORDER BY k) AS c FROM mass),
cut AS (SELECT s, list(c ORDER BY k) AS c FROM below GROUP BY s),
draw AS (SELECT d.doc_id, d.source, length(coalesce(d.text, '')) AS n_text, i, c, rate,
    {number.format(f"'{seed}|' || coalesce(d.doc_id::VARCHAR, '') || '|' || i")} AS u
  FROM d JOIN part USING (s) JOIN cut USING (s), range(1, parts + 1) AS t(i) WHERE rate > 0),
n AS (SELECT doc_id, source, n_text, sum(len(list_filter(c, lambda x: x <= u)))::INT AS n FROM draw GROUP BY ALL)
SELECT doc_id, source, copy::INT AS copy, {number.format(f"'{seed}|' || coalesce(doc_id::VARCHAR, '') || '|at' || copy")} AS at,
  n_text::BIGINT AS n_text
FROM n, range(1, n + 1) AS t(copy)"""
