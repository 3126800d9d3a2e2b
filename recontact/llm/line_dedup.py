"""Removal of line runs that occurred before, by a suffix array over lines built by prefix doubling.

The lines of all documents are one sequence of line numbers (hashes). Suffixes are ranked by their
first line, then by 2, 4, ... lines: a suffix's rank for twice the length comes from sorting pairs of
its rank and the rank of the suffix that far behind it. Only suffixes whose rank is shared stay in the
array, as a unique one can repeat nothing, and the array doubles until none is left. Suffixes of equal
rank are an interval of the array with that longest common prefix; the first place of an interval is
the earliest copy, and all others are later copies. Lengths between two powers, where a rule asks for
them, are ranked by two overlapping halves.

A start knows its deepest interval and that interval's first place. Starts next to each other whose
first places are next to each other, too, make one maximal run, which occurs there as a whole.

Sorted keys are distinct, so no range is hot, and rows of a frequent line are met by joins that Spark
can split. Nothing but counts and keys is aggregated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recontact.sources.storage import release, written_once

#: A run is deleted if it has so many lines, or so many words, or is the whole document.
MIN_LINES, MIN_WORDS = 3, 10
#: A document goes if that share of its words, or more, lies in deleted lines: it is a near copy.
COPIED = 0.8
# Words of a run of fewer lines in the form for long passages alone.
PASSAGE_WORDS = 50
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_KEY = ["_doc", "_text"]
# Of a suffix: its place, the words before it in the document, those of its run, the document's lines.
_SUFFIX = [*_KEY, "at", "before", "words", "size"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a document: its id, or a hash of its text, and the hash."""
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.withColumns({"_doc": F.coalesce("doc_id", own), "_text": own})


def ranked(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` whose key occurs more than once, with ``rank``, the key's place in the sorted order,
    and ``first``, its earliest start. Ranks rise with the keys but leave gaps."""
    start = F.struct(*_KEY, "at")
    keys = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("first"))
    keys = keys.filter("n > 1").drop("n").orderBy(*by).withColumn("_rank", F.monotonically_increasing_id())
    keys = written_once(keys, "ranks")
    out = written_once(rows.join(keys, list(by)).select(*_SUFFIX, F.col("_rank").alias("rank"), "first"), "suffixes")
    release(keys)
    return out


def _ahead(rows: DataFrame, lines: int) -> DataFrame:
    """Rows with ``next``, the rank of the suffix some lines behind; those without are dropped.

    ``words`` become those of both runs together. If a line between is missing from the array, no run
    goes across it.
    """
    order = Window.partitionBy(*_KEY).orderBy("at")
    end = F.lead(F.struct("rank", "at", (F.col("before") + F.col("words")).alias("upto")), lines).over(order)
    rows = rows.withColumn("_to", end).filter(F.col("_to.at") == F.col("at") + lines)
    rows = rows.withColumns({"next": F.col("_to.rank"), "words": F.col("_to.upto") - F.col("before")})
    return rows.select(*_SUFFIX, "rank", "next")


def repeated_windows(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``_doc``, ``_text`` and ``_windows``: runs that came before, as start, lines and the first place.

    A run has ``min_lines`` lines, or fewer with ``min_words`` words, or is a whole document. Places
    count lines with a word. Documents come in the order of their ids. Of each start the longest
    run among those of 1 to ``min_lines`` lines and of powers of two is told.
    """
    word = F.lit(r"[^\x20\x09-\x0D]+")
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: F.struct(F.xxhash64(x).alias("rank"), F.regexp_count(x, word).cast("long").alias("words")),
    )
    rows = _keyed(docs.select("doc_id", "text")).select(*_KEY, F.filter(lines, lambda x: x.words > 0).alias("l"))
    # Rows that repeat a document are one document.
    rows = rows.dropDuplicates(_KEY).filter(F.size("l") > 0)
    rows = rows.select(*_KEY, F.size("l").alias("size"), F.posexplode("l").alias("at", "x"))
    # The rows of a document lie together, so the running sum shuffles nothing.
    above = Window.partitionBy(*_KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("x.words").over(above), F.lit(0)).cast("long")
    rows = rows.select(*_KEY, "at", before.alias("before"), "x.words", "size", "x.rank")
    powers, length = {1: ranked(rows, ["rank"])}, 1
    found = [_later(powers[1], 1, min_lines, min_words)]
    for n in range(2, min_lines + 1):
        if n == 2 * length:
            length = n
            powers[n] = ranked(_ahead(powers[n // 2], n // 2), ["rank", "next"])
            found.append(_later(powers[n], n, min_lines, min_words))
        else:
            # The first and the last ``length`` lines of a run overlap and tell it.
            found.append(_later(ranked(_ahead(powers[length], n - length), ["rank", "next"]), n, min_lines, min_words))
    while not powers[length].isEmpty():
        powers[2 * length] = ranked(_ahead(powers[length], length), ["rank", "next"])
        length *= 2
        found.append(_later(powers[length], length, min_lines, min_words))
    windows = found[0]
    for more in found[1:]:
        windows = windows.union(more)
    # Dealt by document once; within, the longest run of each start stays.
    windows = windows.repartition(*_KEY).groupBy(*_KEY, "at").agg(F.max(F.struct("n", "first")).alias("w"))
    window = F.struct(F.col("at").cast("long").alias("at"), F.col("w.n").alias("n"), F.xxhash64("w.first._doc", "w.first._text").alias("source"), (F.col("w.first.at") - F.col("at")).cast("long").alias("shift"))
    return windows.groupBy(*_KEY).agg(F.sort_array(F.collect_list(window)).alias("_windows"))


def _later(rows: DataFrame, lines: int, min_lines: int, min_words: int | None) -> DataFrame:
    """Where runs of so many lines begin that qualify, other than the first of their kind."""
    rows = rows.filter(F.struct(*_KEY, "at") != F.col("first"))
    if lines < min_lines:
        whole = (F.col("at") == 0) & (F.col("size") == lines)
        rows = rows.filter(whole if min_words is None else whole | (F.col("words") >= min_words))
    return rows.select(*_KEY, "at", F.lit(lines).cast("long").alias("n"), "first")


def deduped(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated runs cut from ``text``, ``_n_lines``, ``_n_deleted``, ``_n_gaps``, ``_n_words``,
    ``_n_cut`` and ``_runs``.

    A line with a word is deleted if it lies in a run of such lines, in one document, that also
    starts at an earlier place (in an earlier document by id, or further up in the same one,
    overlapping or not) and has at least ``min_lines`` lines, or at least ``min_words`` words (None:
    whatever its words), or is all lines of its document. The first copy stays. Lines without words
    take no part and stay; a text that loses its last line with a word becomes empty. A null text stays
    null. Documents without id go by a hash of their text, and rows that repeat a document are cut alike.
    ``_runs`` holds the maximal deleted runs as ranges of places; each occurs earlier as a whole, and they
    may overlap. ``_n_gaps`` counts the stretches that they leave out of the text, ``_n_words`` and ``_n_cut``
    the words of a document that loses lines and those it loses.
    """
    names = docs.columns
    windows = repeated_windows(docs, min_lines, min_words)
    rows = _keyed(docs).join(windows, _KEY, "left").drop(*_KEY)
    run_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    counts = ["_n_lines", "_n_deleted", "_n_gaps", "_n_words", "_n_cut"]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in counts), T.StructField("_runs", run_type)])
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                at = {n: part.schema.get_field_index(n) for n in (*names, "_windows")}
                told = list(map(_cut, *(part.column(at[n]).to_pylist() for n in ("text", "_windows"))))
                columns = [part.column(at[n]) if n != "text" else pa.array([x[0] for x in told], pa.string()) for n in names]
                more = [pa.array([x[k] for x in told], pa.int64()) for k in range(1, 6)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *more, pa.array([x[6] for x in told], pa.list_(span))], names=[*names, *counts, "_runs"])

    return rows.mapInArrow(cut, schema)


def maximal_runs(windows: list[dict]) -> list[tuple[int, int]]:
    """Runs out of windows sorted by start: those that follow each other in a place where their first
    copies do, too, join; runs inside others are left out."""
    runs: list[list[int]] = []
    last = None
    for w in windows:
        place = (w["source"], w["shift"], w["at"])
        if last == (w["source"], w["shift"], w["at"] - 1):
            runs[-1][1] = max(runs[-1][1], w["at"] + w["n"])
        else:
            runs.append([w["at"], w["at"] + w["n"]])
        last = place
    out: list[tuple[int, int]] = []
    for start, end in runs:
        if not out or end > out[-1][1]:
            out.append((start, end))
    return out


def _cut(text: str | None, windows: list[dict] | None) -> tuple:
    lines = (text or "").split("\n")
    full = np.array([bool(_WORD.search(x)) for x in lines])
    n = int(full.sum())
    if not windows:
        return text, n, 0, 0, 0, 0, []
    runs = maximal_runs(windows)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, [r[0] for r in runs], 1)
    np.add.at(depth, [r[1] for r in runs], -1)
    gone = np.cumsum(depth[:-1]) > 0
    gaps = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1))
    keep = np.ones(len(lines), bool)
    keep[np.flatnonzero(full)[gone]] = False
    kept = "" if gone.all() else "\n".join(x for x, k in zip(lines, keep, strict=True) if k)
    words = np.array([len(x.encode().split()) for x, f in zip(lines, full, strict=True) if f])
    return kept, n, int(gone.sum()), gaps, int(words.sum()), int(words[gone].sum()), [{"start": a, "end": b} for a, b in runs]


def without_repeats(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS, copied: float = COPIED
) -> DataFrame:
    """``docs`` with cut texts. Documents that lose ``copied`` of their words or more go: they are copies or
    near copies, and what is left of them is no document."""
    rows = deduped(docs, min_lines, min_words).filter(F.col("_n_cut") < F.greatest(F.lit(1.0), copied * F.col("_n_words")))
    return rows.select(*docs.columns)


def digests(docs: DataFrame, min_words: int | None = MIN_WORDS) -> DataFrame:
    """Counts of each document, among them ``n_runs``, the stretches cut out, and what is left."""
    rows = deduped(docs.select("doc_id", "text"), min_words=min_words)
    return rows.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_deleted").alias("n_deleted"),
        F.col("_n_gaps").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def digests_sql(min_words: int = MIN_WORDS) -> str:
    """The rows of ``digests`` in DuckDB, where ids are unique: runs of three lines, and shorter ones."""
    return rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS q FROM documents),
nb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY q) AS p, count(*) OVER (PARTITION BY doc_id) AS size,
    len(list_filter(regexp_split_to_array(line, '[ 	-
]+'), lambda x: x <> '')) AS words
  FROM l WHERE regexp_matches(line, '[^ 	-
]')),
w AS (SELECT doc_id, p, size, 1 AS n, [line] AS run, words FROM nb
  UNION ALL SELECT a.doc_id, a.p, a.size, 2, [a.line, b.line], a.words + b.words
  FROM nb a JOIN nb b ON b.doc_id = a.doc_id AND b.p = a.p + 1
  UNION ALL SELECT a.doc_id, a.p, a.size, 3, [a.line, b.line, c.line], a.words + b.words + c.words
  FROM nb a JOIN nb b ON b.doc_id = a.doc_id AND b.p = a.p + 1 JOIN nb c ON c.doc_id = a.doc_id AND c.p = a.p + 2),
later AS (SELECT doc_id, p, n FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS k FROM w)
  WHERE k > 1 AND (n = 3 OR words >= {min_words} OR (p = 1 AND n = size))),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM later, range(3) AS t(i) WHERE i < n),
r AS (SELECT doc_id, count(*) AS n_runs FROM gone g
  WHERE NOT EXISTS (SELECT 1 FROM gone h WHERE h.doc_id = g.doc_id AND h.p = g.p - 1) GROUP BY doc_id),
k AS (SELECT l.doc_id, l.q, l.line, nb.p IS NOT NULL AS has_word, gone.p IS NOT NULL AS cut FROM l
  LEFT JOIN nb USING (doc_id, q) LEFT JOIN gone ON gone.doc_id = nb.doc_id AND gone.p = nb.p),
t AS (SELECT doc_id, count_if(has_word) AS n_lines, count_if(cut) AS n_deleted,
  coalesce(string_agg(line, chr(10) ORDER BY q) FILTER (WHERE NOT cut), '') AS kept FROM k GROUP BY doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_deleted::BIGINT AS n_deleted, coalesce(n_runs, 0)::BIGINT AS n_runs,
  sha256(CASE WHEN n_deleted > 0 AND n_deleted = n_lines THEN '' ELSE kept END) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id)"""
