"""Self-join of documents by the Jaccard similarity of their word 5-grams, with Bayesian pruning.

Documents of one shingle set form a class, and classes are joined. Bands of MinHash values propose
pairs. A pair's signatures are compared a few values at a time; it is dropped as soon as the
posterior probability that its similarity reaches the threshold, given the matches so far, falls
below a tolerance. What is left links candidates to groups. Only texts of such groups are read again:
within a group every pair is pruned in the same way and the rest is verified on the sets themselves.

A large bucket or group is dealt into blocks of bounded size, and each pair of blocks is a task of its
own; tasks return counts and spanning links, never all pairs. A pair at the threshold is missed with
probability 4e-6 by the bands and about ten times the tolerance by the pruning.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import components, group_starts, mixed, smallest_reachable, whole_groups, whole_text
from recontact.llm.substring import Words
from recontact.sources.storage import written_once

WIDTH = 5
# Similarity of at least 4/5, compared in whole numbers.
OVER, UNDER = 4, 5
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
# Values compared between two looks at the posterior, and its tolerance.
LOOK, TOLERANCE = 8, 1e-6
# Classes of a block, and shingles of its classes together.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
PAIRS = 1 << 20


def least_matches(threshold: float = OVER / UNDER, tolerance: float = TOLERANCE) -> list[int]:
    """For each look, the fewest matches with which a pair stays.

    Signatures keep a byte of each value, so unequal values match with 1/256. With a uniform prior
    the posterior of the match rate is a beta distribution, and its tail a binomial sum.
    """
    rate = threshold + (1 - threshold) / 256
    out = []
    for n in range(LOOK, HASHES + 1, LOOK):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * rate**m * (1 - rate) ** (n + 1 - m)
        out.append(m)
    return out


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle make one together."""
    words = Words(texts)
    start, hashes = words.windows(width)
    of = np.searchsorted(words.starts, start, "right") - 1
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for short in range(1, width):
        own = np.flatnonzero(words.sizes == short)
        if len(own):
            first, value = words.windows(short)
            for i, at in zip(own, np.searchsorted(first, words.starts[own]), strict=True):
                sets[i] = value[at : at + 1] ^ np.uint64(short)
    return sets


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A byte of each of ``HASHES`` minima, and a 64-bit key of each band; sets are not empty."""
    flat = np.concatenate(sets)
    offsets = np.cumsum([0, *[len(s) for s in sets]])[:-1]
    low = (flat & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    minima = np.empty((len(sets), HASHES), np.uint64)
    for j in range(HASHES):
        values = (low ^ np.uint32(seeds[2 * j] >> np.uint64(32))) * np.uint32((seeds[2 * j + 1] >> np.uint64(32)) | np.uint64(1))
        minima[:, j] = np.minimum.reduceat(values, offsets)
    spread = mixed(minima * np.uint64(0x9E3779B97F4A7C15) + np.arange(HASHES, dtype=np.uint64))
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mixed(keys ^ spread[:, r::ROWS]) + np.arange(BANDS, dtype=np.uint64)
    return (spread >> np.uint64(56)).astype(np.uint8), keys.view(np.int64)


def row_key() -> Column:
    """The id of a document; without one, a hash of its text."""
    return F.coalesce(F.col("doc_id"), text_key())


def text_key() -> Column:
    """A hash of the text, to tell apart the rows of one id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _signed(docs: DataFrame) -> DataFrame:
    """Narrow rows: ``row_key``, ``doc_id``, ``text_key`` (a hash of the text), ``cls`` (a 128-bit digest
    of the shingle set, null without words), ``size``, ``sig`` and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = shingle_sets(part.column(3).to_pylist())
                full = [i for i, s in enumerate(sets) if len(s)]
                cls, sigs, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    sig, keys = signatures([sets[i] for i in full])
                    for k, i in enumerate(full):
                        cls[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                        sigs[i], bands[i] = sig[k].tobytes(), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.array(cls, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sigs, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["row_key", "doc_id", "text_key", "cls", "size", "sig", "bands"],
                )

    rows = docs.select(row_key().alias("row_key"), "doc_id", text_key().alias("text_key"), whole_text().alias("text"))
    return rows.mapInArrow(
        run, "row_key long, doc_id long, text_key long, cls binary, size long, sig binary, bands array<long>"
    )


def blocks(rows: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Rows dealt into pairs of blocks ``i <= j`` of their group, with ``side``, the row's own block.

    ``sizes`` has the number of ``parts`` of each group. A row goes to each pair that its block is in.
    """
    side = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    dealt = rows.join(sizes, group).withColumn("side", side)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
    dealt = dealt.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})
    return dealt.drop("parts", "other")


def gathered(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "cls")


def candidate_pairs(table: pa.Table, key: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group whose blocks allow it, about ``PAIRS`` at a time."""
    n = table.num_rows
    starts = group_starts(table, key)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    size = np.diff(np.append(starts, n))[group]
    left = starts[group] + size - np.arange(n) - 1  # rows after this one in its group
    side = table["side"].to_numpy()
    within = table["i"].to_numpy() == table["j"].to_numpy()
    waiting, total = [], 0
    rows = np.flatnonzero(left >= 1)
    distance = 1
    while len(rows):
        ok = within[rows] | (side[rows] != side[rows + distance])
        a = rows[ok]
        waiting.append((a, a + distance))
        total += len(a)
        distance += 1
        rows = rows[left[rows] >= distance]
        if total >= PAIRS or not len(rows):
            yield np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
            waiting, total = [], 0


def pruned(a: np.ndarray, b: np.ndarray, sigs: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no look at the posterior drops."""
    matches = np.zeros(len(a), np.int64)
    for look, most in enumerate(least):
        own = slice(look * LOOK, (look + 1) * LOOK)
        matches += (sigs[a, own] == sigs[b, own]).sum(1)
        stay = matches >= most
        a, b, matches = a[stay], b[stay], matches[stay]
    return a, b


def _sig_rows(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(table.num_rows, HASHES)


def _forest(a: np.ndarray, b: np.ndarray, cls: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Links that join each class with one of its component, as few as reach all."""
    nodes, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = smallest_reachable(where[: len(a)], where[len(a) :], len(nodes))
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return [cls[nodes[k]] for k in own], [cls[nodes[root[k]]] for k in own]


def _link_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least, key = least_matches(), ["band", "i", "j"]
    for table in whole_groups(batches, key):
        sigs, cls = _sig_rows(table), table["cls"].to_pylist()
        for a, b in candidate_pairs(table, key):
            a, b = pruned(a, b, sigs, least)
            one, two = _forest(a, b, cls)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.binary()), pa.array(two, pa.binary())], names=["a", "b"])


def similar(a: np.ndarray, b: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which pairs of sets reach the threshold; set ``k`` is ``flat[offsets[k]:offsets[k + 1]]``."""
    _, local = np.unique(flat, return_inverse=True)
    sizes = np.diff(offsets)
    width = np.int64(len(flat) + 1)
    member = np.sort(np.repeat(np.arange(len(sizes)), sizes) * width + local)
    out = np.zeros(len(a), bool)
    # Sizes alone rule out many pairs; of the rest the smaller set is looked up in the larger.
    small, large = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
    open_ = np.flatnonzero(UNDER * sizes[small] >= OVER * sizes[large])
    start = 0
    loads = np.cumsum(sizes[small[open_]])
    while start < len(open_):
        end = max(start + 1, int(np.searchsorted(loads, (loads[start - 1] if start else 0) + 2_000_000, "right")))
        own = open_[start:end]
        n = sizes[small[own]]
        pair = np.repeat(np.arange(len(own)), n)
        item = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[small[own]], n)
        wanted = large[own][pair] * width + local[item]
        at = np.minimum(np.searchsorted(member, wanted), len(member) - 1)
        both = np.bincount(pair, weights=member[at] == wanted, minlength=len(own)).astype(np.int64)
        out[own] = UNDER * both >= OVER * (n + sizes[large[own]] - both)
        start = end
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least, key = least_matches(), ["label", "i", "j"]
    for table in whole_groups(batches, key, rows=2_000):
        # Rows that repeat a document bring its class twice; one of them is enough.
        both = group_starts(table, [*key, "cls"])
        table = table.take(pa.array(both))
        cls, column = table["cls"].to_pylist(), table["shingles"].combine_chunks()
        flat = column.flatten().to_numpy().view(np.uint64)
        offsets = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
        sigs = _sig_rows(table)
        for a, b in candidate_pairs(table, key):
            a, b = pruned(a, b, sigs, least)
            yes = similar(a, b, flat, offsets) if len(a) else np.zeros(0, bool)
            a, b = a[yes], b[yes]
            links = np.bincount(np.concatenate((a, b)), minlength=len(cls))
            own = np.flatnonzero(links)
            one, two = _forest(a, b, cls)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*[cls[k] for k in own], *one], pa.binary()),
                    pa.array([*links[own].tolist(), *[0] * len(one)], pa.int64()),
                    pa.array([*[None] * len(own), *two], pa.binary()),
                ],
                names=["cls", "links", "other"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            sets = shingle_sets(batch.slice(start, 256).column(0).to_pylist())
            full = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in full], pa.binary()),
                    pa.array([s.view(np.int64) for s in full], pa.list_(pa.int64())),
                ],
                names=["cls", "shingles"],
            )


def joined(docs: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id``, ``row_key``, ``copy_id``, ``n_links``, ``class_id``, ``kept``.

    ``copy_id`` is the smallest key of the documents with the same shingle set, ``n_links`` the number
    of other such sets at a similarity of at least 0.8, ``class_id`` the smallest key that links reach,
    and ``kept`` marks that document. Texts of one to four words have one shingle, all their words;
    empty and null texts link with nothing. A document without id goes by a hash of its text. Rows
    that repeat a document share its class. Only ``doc_id`` and ``text`` are read.
    """
    return _grouped(docs).drop("text_key", "label")


def _grouped(docs: DataFrame) -> DataFrame:
    """The rows of ``joined`` with ``text_key`` and ``label``, the group itself, null without words."""
    signed = written_once(_signed(docs), "signed")
    classes = written_once(
        signed.filter("cls IS NOT NULL").groupBy("cls").agg(
            F.min("row_key").alias("copy_id"), F.max("size").alias("size"),
            F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("cls", F.explode("bands").alias("band"))
    parts = F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")
    full = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", parts)
    rows = blocks(banded, "band", full).join(classes.select("cls", "sig"), "cls")
    edges = gathered(rows, "band").mapInArrow(_link_candidates, "a binary, b binary")
    label = components(edges)

    members = label.withColumnRenamed("node", "cls").join(classes.drop("bands"), "cls")
    members = written_once(members, "members")
    load = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    sizes = members.groupBy("label").agg(load.cast("int").alias("parts"))
    texts = docs.select(row_key().alias("copy_id"), whole_text().alias("text"))
    texts = texts.join(members.select("copy_id"), "copy_id", "left_semi").select("text")
    sets = texts.mapInArrow(_sets, "cls binary, shingles array<long>")
    rows = blocks(members.select("cls", "label", "sig"), "label", sizes).join(sets, "cls")
    found = gathered(rows, "label").mapInArrow(_verify, "cls binary, links long, other binary")
    found = written_once(found, "links")

    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    group = components(found.filter("other IS NOT NULL"), "cls", "other").withColumnRenamed("node", "cls")
    known = classes.select("cls", "copy_id").join(links, "cls", "left").join(group, "cls", "left")
    known = known.withColumn("label", F.coalesce("label", "cls"))
    smallest = known.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    known = known.join(smallest, "label").select("cls", "label", "copy_id", "n_links", "class_id")
    out = signed.select("row_key", "doc_id", "text_key", "cls").join(known, "cls", "left")
    out = out.withColumns({
        "copy_id": F.coalesce("copy_id", "row_key"), "class_id": F.coalesce("class_id", "row_key"),
        "n_links": F.coalesce("n_links", F.lit(0)).cast("long"),
    })
    kept = (F.col("row_key") == F.col("class_id")).alias("kept")
    return out.select("doc_id", "row_key", "text_key", "label", "copy_id", "n_links", "class_id", kept)


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one document of each group; rows that repeat it count as one.

    Rows of one id go by their own texts: each stays or goes with the group of its text. Texts
    without words have no group, and one of them stays for each key.
    """
    kept = _grouped(docs).filter("kept").select(
        F.col("row_key").alias("_key"), F.col("text_key").alias("_text"), F.col("label").alias("_label")
    ).distinct()
    rows = docs.withColumns({"_key": row_key(), "_text": text_key()})
    rows = rows.join(kept, ["_key", "_text"]).withColumn(
        "_row", F.expr("row_number() OVER (PARTITION BY _key, _label ORDER BY text)")
    )
    return rows.filter("_row = 1").select(*docs.columns)
