"""Removal of word windows that occur elsewhere, by fixed-block anchors.

Every window of 35 words holds a whole block of 18 words that starts at a multiple of 18 in its
document. These non-overlapping blocks are the index; every rolling window of 18 words is a probe.
A block that is met at a second place is an anchor. Around anchors, and only there, whole windows are
compared; windows met twice join to the maximal exact repeats, whose words are removed.

Documents form chunks of a few MB by a hash of id and text; many equal rows are one row that counts
as often. Chunks and hash buckets exchange sorted,
packed hash sets in which a chunk names each hash twice at most, so a passage that a third of all
documents share costs a bucket a few bytes for each chunk. A bucket answers each chunk with the hashes
that it asked about and that occur twice. Texts are shuffled once; the exchange is reused.

Windows are compared by 64-bit hashes, blocks by 32 bits more than their bucket number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import (
    WordHashes,
    as_often,
    at_most_twice,
    bucket_count,
    by_bucket,
    chunk_count,
    chunked,
    found_in,
    mixed,
    pack,
    unpack,
    with_times,
)

WINDOW = 35
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_STEP, -1, 1 << 64)

_ASK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("probes", pa.binary()), ("blocks", pa.binary())])
_TOLD = pa.schema([("chunk", pa.int32()), ("hits", pa.binary())])
_SQL = {_ASK: "bucket int, chunk int, probes binary, blocks binary", _TOLD: "chunk int, hits binary"}


class Words:
    """Word hashes of the documents of a chunk, end to end."""

    def __init__(self, texts: list[bytes], times: np.ndarray | None = None):
        known = WordHashes()
        hashes = [known.of(t.split()) for t in texts]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.own = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        n = len(self.own)
        self.again = np.zeros(n, bool) if times is None else np.repeat(times > 1, self.sizes)
        # Position and words left of each word within its document.
        self.at = np.arange(n) - np.repeat(self.starts[:-1], self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.at
        powers = np.cumprod(np.full(n, _STEP, np.uint64)) if n else self.own
        self.back = np.cumprod(np.full(n, _BACK, np.uint64)) if n else self.own
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.own * powers, dtype=np.uint64)))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of some words within one document, and their hashes."""
        start = np.flatnonzero(self.left >= width)
        return start, mixed((self.sums[start + width] - self.sums[start]) * self.back[start])


def _cut(buckets: int) -> np.uint64:
    """Bits dropped from block hashes: 32 stay beside those that tell the bucket."""
    return np.uint64(max(0, 32 - buckets.bit_length()))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _asking(
    hashes: np.ndarray, again: np.ndarray, wanted: np.ndarray, chunk: int, buckets: int, cut: np.uint64
) -> pa.Table:
    """For each bucket the hashes that occur in a chunk and those it wants to know about. Hashes of rows
    that count several times occur twice."""
    hashes, wanted = np.sort(np.concatenate((hashes, hashes[again]))), np.unique(wanted)
    asked = {b: wanted[s] for b, s in by_bucket(wanted, buckets)}
    none = wanted[:0]
    rows = [
        (b, chunk, pack(at_most_twice(hashes[s] >> cut)), pack(np.unique(asked.get(b, none) >> cut)))
        for b, s in by_bucket(hashes, buckets)
    ]
    return _rows(_ASK, rows)


def _answers(table: pa.Table) -> pa.Table:
    """For each chunk the wanted hashes that occur twice in the bucket."""
    probes = np.sort(np.concatenate([unpack(b.as_py()) for b in table["probes"]]))
    twice = np.unique(probes[1:][probes[1:] == probes[:-1]])
    rows = []
    for chunk, blob in zip(table["chunk"].to_pylist(), table["blocks"].to_pylist(), strict=True):
        wanted = unpack(blob)
        if len(hits := wanted[found_in(wanted, twice)]):
            rows.append((chunk, pack(hits)))
    return _rows(_TOLD, rows)


def _told(table: pa.Table) -> np.ndarray:
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *[unpack(b.as_py()) for b in table["hits"]]]))


def _candidates(words: Words, anchors: np.ndarray, width: int, cut: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Windows all of whose own blocks are anchors: their starts and hashes."""
    block = (width + 1) // 2
    start, hashes = words.windows(block)
    own = words.at[start] % block == 0
    missing = np.zeros(len(words.own) + 1, np.int64)
    missing[start[own][~found_in(hashes[own] >> cut, anchors)] + 1] = 1
    missing = np.cumsum(missing)
    start, hashes = words.windows(width)
    # Blocks that lie within the window start at most width - block after it.
    clear = missing[start + width - block + 1] == missing[start]
    return start[clear], hashes[clear]


def repeated_words(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Each document with ``n_words``, ``removed`` (ranges of word positions) and ``kept_text``.

    A word is removed if a window of ``width`` words that covers it has a word sequence that also
    starts at another place, in this document or another; windows are judged on the input. Kept
    words are joined by one space. A null text has no words and gives an empty text; texts of fewer
    words than a window lose nothing; rows that repeat a document count as places of their own.
    Only ``doc_id`` (null allowed) and ``text`` are read, so other columns cannot clash.
    """
    chunks = chunk_count(docs)
    buckets, block = bucket_count(chunks), (width + 1) // 2
    cut = _cut(buckets)
    texts = chunked(with_times(docs), chunks, "times")

    def ask_blocks(key: tuple, table: pa.Table) -> pa.Table:
        words = Words(table["text"].to_pylist(), table["times"].to_numpy())
        start, hashes = words.windows(block)
        return _asking(hashes, words.again[start], hashes[words.at[start] % block == 0], key[0].as_py(), buckets, cut)

    def ask_windows(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        words = Words(table["text"].to_pylist(), table["times"].to_numpy())
        start, hashes = _candidates(words, _told(told), width, cut)
        return _asking(hashes, words.again[start], hashes, key[0].as_py(), buckets, np.uint64(0))

    def remove(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_removed(table, _told(told), width), schema=_RESULT)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        return _answers(table)

    asked = texts.groupBy("chunk").applyInArrow(ask_blocks, _SQL[_ASK])
    anchors = asked.groupBy("bucket").applyInArrow(answer, _SQL[_TOLD])
    by_chunk = texts.groupBy("chunk")
    asked = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(ask_windows, _SQL[_ASK])
    repeats = asked.groupBy("bucket").applyInArrow(answer, _SQL[_TOLD])
    told = by_chunk.cogroup(repeats.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept_text string, times long"
    )
    return as_often(told)


_RANGE = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(_RANGE)), ("kept_text", pa.string()), ("times", pa.int64())]
)


def _removed(table: pa.Table, repeats: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    texts, times = table["text"].to_pylist(), table["times"].to_numpy()
    words = Words(texts, times)
    start, hashes = words.windows(width)
    hit = start[found_in(hashes, repeats)]
    depth = np.zeros(len(words.own) + 1, np.int64)
    np.add.at(depth, hit, 1)
    np.add.at(depth, hit + width, -1)
    gone = np.cumsum(depth[:-1]) > 0
    ids = table["doc_id"].to_pylist()
    for first in range(0, len(texts), 200):
        rows: list[tuple] = []
        for i in range(first, min(first + 200, len(texts))):
            own = gone[words.starts[i] : words.starts[i + 1]]
            split = texts[i].split()
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0]))))
            ranges = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
            kept = split if not ranges else [split[k] for k in np.flatnonzero(~own)]
            rows.append((ids[i], len(split), ranges, b" ".join(kept).decode(), int(times[i])))
        yield from _rows(_RESULT, rows).to_batches()


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the digest of the kept words."""
    spans = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return repeated_words(docs).select(
        "doc_id", "n_words", spans.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )
