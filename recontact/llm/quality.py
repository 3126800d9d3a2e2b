"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

All steps are column expressions. Votes of a text form a pattern; as there are at most 3^6 patterns,
one row holds their counts, and the expectation-maximisation runs over that row inside a scalar
subquery. Texts are read once, and only pattern counts are shuffled. No labels are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import WORD_GAP
from recontact.sources.storage import written_once

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ROUNDS = 20
# Start values: share of good texts, bad votes among the bad, good votes among the good; and the
# pseudo-votes by which a rule that votes seldom keeps to its start.
PRIOR, CAUGHT, SPARED, SMOOTH = 0.8, 0.5, 0.95, 10.0
# Bounds of the estimates, so no rule is silenced or turned round.
BOUNDS = {"prior": (0.5, 0.95), "caught": (0.1, 0.99), "spared": (0.9, 0.999)}

# Each rule: votes bad where the first holds, good where the second holds, else abstains.
RULES: list[tuple[str, str, str]] = [
    ("symbols_per_char", "20 * n_symbols > word_chars", "100 * n_symbols <= word_chars"),
    ("symbols_per_word", "4 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("repeats", "20 * n_repeat_words > 3 * n_words", "50 * n_repeat_words <= n_words"),
    ("lines", "5 * n_dup_lines > 2 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    ("capitals", "5 * n_upper > word_chars", "20 * n_upper < word_chars"),
    ("length", "n_words < 10", "n_words >= 20"),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole text that the rules read.

    Windows of five words are compared by their hashes within the text. Only a text that has a
    repeated window sorts them; neighbours in that order mark the covered words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        words_of(text).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    base = base.select(
        "doc_id", "n_symbols", "n_upper",
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    grams = F.expr(
        "CASE WHEN size(h) > 5 THEN transform(sequence(0, size(h) - 5), "
        "i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])) END"
    )
    base = base.select("*", grams.alias("grams")).drop("h")
    sort = "sort_array(transform(grams, (g, i) -> named_struct('g', g, 'i', i)))"
    base = base.select("*", F.expr(
        f"CASE WHEN size(array_distinct(grams)) < size(grams) THEN {sort} END").alias("runs")).drop("grams")
    base = base.select("*", F.expr(
        "sort_array(transform(filter(runs, (x, k) -> (k > 0 AND x.g = get(runs, k - 1).g) "
        "OR x.g <=> get(runs, k + 1).g), x -> x.i))").alias("starts")).drop("runs")
    covered = F.expr(
        "coalesce(aggregate(starts, named_struct('n', 0L, 'end', 0), (a, s) -> named_struct("
        "'n', a.n + s + 5 - greatest(a.end, s), 'end', s + 5), a -> a.n), 0L)"
    )
    return base.select(
        "doc_id", *STATS[:4], covered.alias("n_repeat_words"), "n_upper", "n_lines"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def votes() -> Column:
    """Array of 1 (good), -1 (bad) and 0 (abstains), in the order of ``RULES``."""
    return F.array(*[
        F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for _, bad, good in RULES
    ])


def posterior_sql(model: str, votes: str) -> str:
    """Probability that a text is good, given a model struct and a vote array."""
    told = (
        f"aggregate(sequence(0, {len(RULES) - 1}), 0D, (s, j) -> s + CASE {votes}[j] "
        f"WHEN 1 THEN ln({model}.spared[j] / (1 - {model}.caught[j])) "
        f"WHEN -1 THEN ln((1 - {model}.spared[j]) / {model}.caught[j]) ELSE 0D END)"
    )
    return f"1 / (1 + exp(-(ln({model}.prior / (1 - {model}.prior)) + {told})))"


def _between(name: str, value: str) -> str:
    low, high = BOUNDS[name]
    return f"least({high}D, greatest({low}D, {value}))"


def _rate(weight: str, vote: int, start: float) -> str:
    """Share of one vote among the cast votes of rule ``j``, weighed by ``weight``."""
    hits = f"aggregate(e, {SMOOTH * start}D, (s, p) -> s + IF(p.v[j] = {vote}, {weight}, 0D))"
    cast = f"aggregate(e, {SMOOTH}D, (s, p) -> s + IF(p.v[j] != 0, {weight}, 0D))"
    return f"{hits} / {cast}"


def fitted(stats: DataFrame) -> DataFrame:
    """One row ``m`` after ``ROUNDS`` rounds of EM: prior, and for each rule the share of the bad
    texts it votes on that it catches and of the good ones that it spares.

    The pattern counts fit one row, as six rules make 729 patterns at most. Without texts the rates
    keep their start.
    """
    patterns = stats.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    row = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("c"))
    rules = f"sequence(0, {len(RULES) - 1})"
    start = (
        f"named_struct('prior', {PRIOR}D, 'caught', array_repeat({CAUGHT}D, {len(RULES)}), "
        f"'spared', array_repeat({SPARED}D, {len(RULES)}))"
    )
    expect = f"transform(c, p -> named_struct('v', p.v, 'n', p.n, 'q', {posterior_sql('m', 'p.v')}))"
    good = "aggregate(e, 0D, (s, p) -> s + p.n * p.q) / greatest(1D, aggregate(e, 0D, (s, p) -> s + p.n))"
    caught, spared = _rate("p.n * (1 - p.q)", -1, CAUGHT), _rate("p.n * p.q", 1, SPARED)
    step = (
        f"named_struct('prior', {_between('prior', good)}, "
        f"'caught', transform({rules}, j -> {_between('caught', caught)}), "
        f"'spared', transform({rules}, j -> {_between('spared', spared)}))"
    )
    # The one-item array names the weighed patterns, so each round computes them once.
    once = f"transform(array({expect}), e -> {step})[0]"
    return row.select(F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (m, r) -> {once})").alias("m"))


def judged(docs: DataFrame) -> DataFrame:
    """Every text with its counts, ``base_failed``, its posterior ``p_good`` and ``kept``.

    A text is kept if the base rules pass and its posterior is at least 0.5. Nulls and empty texts
    have no words and fail; repeated rows are judged alike and each returned; ``doc_id`` may be null.
    Other columns of ``docs`` are not read. The counts are written once to the shared folder, where
    the model and the verdicts read them.
    """
    stats = written_once(text_stats(docs).withColumn("v", votes()), "votes")
    told = stats.withColumn("m", fitted(stats).scalar())
    told = told.withColumns({"p_good": F.expr(posterior_sql("m", "v")), "base_failed": base_failed()})
    kept = ~F.col("base_failed") & (F.col("p_good") >= 0.5)
    return told.select("doc_id", *STATS, "base_failed", "p_good", kept.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, without a join.

    Each row is written with its counts and read back with its verdict, so texts are not shuffled.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc_id"), F.col("text"))
    return judged(rows).filter("kept").select("doc_id.*")
