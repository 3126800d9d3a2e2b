"""Shared parts of the training-data operators: sizes, packed hash sets, whole groups, components."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.sources.storage import release, written_once

# A word is a run of characters other than these six; equal to what ``bytes.split()`` cuts at.
WORD_GAP = r"[\x20\x09-\x0D]+"
CHUNK_BYTES = 8 << 20
#: Chunks and buckets exchange a cell each, so there are fewer, larger buckets than chunks beyond these.
LEAST_BUCKETS, CHUNKS_A_BUCKET = 16, 4
#: Rows of a table that is sent to all tasks, at about 40 bytes.
MOST_SENT = 200_000


def whole_text(name: str = "text") -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def chunk_count(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> int:
    """Number of chunks of about ``chunk_bytes`` that the texts fill; grows with the input."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0]
    return max(1, -(-(total or 0) // chunk_bytes))


def bucket_count(chunks: int) -> int:
    """Number of hash buckets that the chunks exchange cells with."""
    return max(min(chunks, LEAST_BUCKETS), -(-chunks // CHUNKS_A_BUCKET))


def with_times(docs: DataFrame, *more: str, group_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``text`` and the columns named of all rows, where rows that repeat both and would fill
    ``group_bytes`` alone are one row; ``times`` says of how many.

    Sizes of groups come from hashes, without shuffling texts; most tables have no such group and
    are returned as they are. There are at most as many as the texts have ``group_bytes``.
    """
    own = docs.select("doc_id", "text", *more)
    text_hash = F.xxhash64("text").alias("_h")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64)
    groups = docs.groupBy("doc_id", text_hash).agg(F.count(F.lit(1)).alias("times"), size.alias("_size"))
    large = written_once(groups.filter((F.col("_size") > group_bytes) & (F.col("times") > 1)).drop("_size"), "groups")
    n = large.count()
    if not n:
        release(large)
        return own.withColumn("times", F.lit(1).cast("long"))
    large = large.select(F.col("doc_id").alias("_id"), F.col("_h").alias("_large"), "times")
    if n <= MOST_SENT:
        large = F.broadcast(large)
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_large"))
    rest = own.join(large, on, "left_anti").withColumn("times", F.lit(1).cast("long"))
    # Equal rows are put together before they are shuffled. Equal hashes of unequal texts stay apart.
    met = own.join(large, on).groupBy("doc_id", "text", *more).agg(F.count(F.lit(1)).alias("times"))
    return rest.unionByName(met.select(rest.columns))


def chunked(docs: DataFrame, chunks: int, *more: str) -> DataFrame:
    """Columns ``doc_id``, ``text`` (bytes), those named, and ``chunk``, which the row alone decides.

    Copies of a text spread over the chunks by their ids, and rows without id by their texts.
    """
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    return docs.select("doc_id", whole_text().alias("text"), *more, chunk.alias("chunk"))


def as_often(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``times`` says, without that column."""
    return rows.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("_k", "times")


class WordHashes(dict):
    """64-bit hash of each word seen; emptied by the caller when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit value spread over the whole word, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned values as differences in byte planes, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype=np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    steps = np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(dtype).reshape(-1)
    return np.cumsum(steps, dtype=dtype)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash, in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of a sorted array, one for each bucket that has rows."""
    own = bucket_of(hashes, buckets)
    edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)] if len(own) else []
    for start, end in pairwise(edges):
        yield int(own[start]), slice(start, end)


def at_most_twice(values: np.ndarray) -> np.ndarray:
    """A sorted array with each value kept twice at most: enough to tell once from more."""
    keep = np.ones(len(values), bool)
    keep[2:] = values[2:] != values[:-2]
    return values[keep]


def found_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: Sequence[str], rows: int = 50_000
) -> Iterator[pa.Table]:
    """Tables of some rows each that never cut a group; batches come sorted by ``key``."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < rows:
            continue
        table = pa.Table.from_batches(waiting)
        cuts = group_starts(table, key)
        last = int(cuts[-1])
        if last:
            yield table.slice(0, last)
            waiting = table.slice(last).to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting)


def group_starts(table: pa.Table, key: Sequence[str]) -> np.ndarray:
    """First row of each run of equal keys; keys hold no nulls."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in key:
        col = table.column(name).combine_chunks()
        change |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(change) + 1))


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and links a-b, the smallest node of each component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (jump := label[label] != label).any():
            label[jump] = label[label[jump]]
        if (label == before).all():
            break
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node for each node of undirected edges: columns ``node``, ``label``.

    Labels travel along edges and then jump to the label of their label, so the rounds grow with the
    logarithm of the longest chain. Each round is written to the shared folder, so a lost executor
    costs a reread. All steps are joins and ``min`` aggregates; a hub is a key that Spark splits.
    """
    both = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = written_once(both.union(both.select("dst", "src")).filter("src != dst").distinct(), "edges")
    table = written_once(both.groupBy(F.col("src").alias("node")).agg(
        F.least(F.col("node"), F.min("dst")).alias("label")), "labels")
    while True:
        label = table.select("node", "label")
        near = both.join(label, both.src == label.node).groupBy("dst").agg(F.min("label").alias("low"))
        step = label.join(near, label.node == near.dst, "left").select(
            "node", F.col("label").alias("was"), F.least("label", F.coalesce("low", "label")).alias("label")
        )
        step = written_once(step, "labels")
        to = step.select(F.col("node").alias("at"), F.col("label").alias("next"))
        jumped = written_once(
            step.join(to, step.label == to["at"], "left").select(
                "node", "was", F.least("label", F.coalesce("next", "label")).alias("label")
            ),
            "labels",
        )
        release(table, step)
        table = jumped
        if table.filter("label != was").isEmpty():
            release(both)
            return table.select("node", "label")


def looked_up(
    rows: DataFrame, table: DataFrame, key: Sequence[str], count: str, spread: str, share: int = 256
) -> DataFrame:
    """``rows`` with the columns of ``table``, which has each key once and in ``count`` how many rows have it.

    At most ``share`` keys can hold more than that part of all rows; these come by broadcast. The rest
    is a join on the key, and rows already served are spread over it by the column ``spread``.
    """
    most = table.agg((F.coalesce(F.sum(count), F.lit(0)) / share).alias("n")).scalar()
    values = [c for c in table.columns if c not in key]
    of = F.struct(*values).alias("_of")
    flagged = table.withColumn("_hot", F.col(count) > most)
    hot = flagged.filter("_hot").select(*[F.col(k).alias(f"_h{k}") for k in key], of)
    cold = flagged.filter("NOT _hot").select(*[F.col(k).alias(f"_c{k}") for k in key], F.lit(0).alias("_c"), of.alias("_cold"))
    served = rows.join(F.broadcast(hot), [F.col(k).eqNullSafe(F.col(f"_h{k}")) for k in key], "left")
    salt = F.when(F.col("_of").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(4096)))
    served = served.withColumn("_salt", salt.cast("int"))
    met = served.join(cold, [F.col(k).eqNullSafe(F.col(f"_c{k}")) for k in key] + [F.col("_salt") == F.col("_c")], "left")
    return met.select(*rows.columns, *[F.coalesce(f"_of.{v}", f"_cold.{v}").alias(v) for v in values if v != count])


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
