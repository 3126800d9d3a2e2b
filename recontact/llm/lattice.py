"""Language-model scores of documents: marginal likelihood over a lattice of subword pieces.

The pieces come from a public vocabulary file; their probabilities are trained here. The file's own
scores are merge ranks, no probabilities, so each training word is cut by the file's rules and the
pieces are counted, weighed by the word's count. A word's probability sums over all ways to cut it:
the forward recursion adds them in log space. A text is a run of words and one end piece.

Documents form chunks of a few MB. A chunk sends each of its distinct words once, with its training
count, to the bucket of the word's hash; a bucket sums the counts over all chunks, scores each word
once, and answers every chunk. Frequent words are thus summed before the shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import (
    as_often,
    bucket_count,
    bucket_of,
    by_bucket,
    chunk_count,
    chunked,
    with_times,
)
from recontact.sources.storage import written_once

SPACE = "▁"
SMOOTH = 0.5
#: Characters whose lattices are built at a time.
BATCH_CHARS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))
WORDS, TYPES = -1, -2  # rows beside the pieces: training words, distinct ones


def words_of(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased."""
    return text.lower().split()


def _zip(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unzip(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _in_order(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words by their hashes, and the hashes; every pass over a chunk gets the same order."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    return [words[i] for i in order.tolist()], hashes[order]


def _distinct(texts: list[bytes]) -> set[bytes]:
    seen: set[bytes] = set()
    for text in texts:
        seen.update(words_of(text))
    return seen


class Pieces:
    """Log probabilities of the pieces of a vocabulary, by length and hash."""

    def __init__(self, path: str, counts: dict[int, float], ends: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
        byte = {i for i in ids if model.is_byte(i)}
        # A piece with the space mark inside spans words and is never used.
        plain = [i for i in ids if i not in byte and SPACE not in model.id_to_piece(i)[1:]]
        used = [*sorted(byte), *plain]
        total = sum(counts.get(i, 0) for i in used) + ends + SMOOTH * (len(used) + 1)
        log = {i: float(np.log((counts.get(i, 0) + SMOOTH) / total)) for i in used}
        self.end = float(np.log((ends + SMOOTH) / total))
        self.bytes = np.array([log[i] for i in sorted(byte, key=lambda i: int(model.id_to_piece(i)[1:-1], 16))])
        by_length: dict[int, list[tuple[int, float]]] = {}
        for i in plain:
            codes = np.frombuffer(model.id_to_piece(i).encode("utf-32-le"), np.uint32)
            by_length.setdefault(len(codes), []).append((int(_hashes(codes)[1][-1]), log[i]))
        self.tables = {}
        for length, rows in sorted(by_length.items()):
            rows.sort()
            keys = np.array([k for k, _ in rows], np.uint64)
            self.tables[length] = (keys, np.array([p for _, p in rows]))

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the summed probability of all cuts of each word."""
        out = np.zeros(len(words))
        texts = [SPACE + w.decode() for w in words]
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        start = 0
        while start < len(order):
            end, chars = start, 0
            while end < len(order) and (end == start or chars + len(texts[order[end]]) <= BATCH_CHARS):
                chars += len(texts[order[end]])
                end += 1
            own = order[start:end]
            out[own] = self._forward([texts[i] for i in own])
            start = end
        return out

    def _forward(self, texts: list[str]) -> np.ndarray:
        """Texts come longest first. Cell ``e`` holds the weight of all cuts of what lies before it."""
        sizes = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))  # of each text among the characters
        at = np.arange(len(codes)) - np.repeat(first, sizes) + 1  # characters up to this one
        sums, _ = _hashes(codes)
        back = np.cumprod(np.full(len(codes), _BACK))
        edges = [(1, self._spelled(codes, at))]
        for length, (keys, logs) in self.tables.items():
            last = np.flatnonzero(at >= length)
            if not len(last):
                continue
            begin = last + 1 - length
            own = (sums[last + 1] - sums[begin]) * back[begin]
            found = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[found] == own
            weight = np.full(len(codes), -np.inf)
            weight[last[hit]] = logs[found[hit]]
            edges.append((length, weight))
        cells = np.full(len(codes) + 1, -np.inf)  # after each character; the last one is the start
        result = np.zeros(len(texts))
        active = len(texts)
        for step in range(1, int(sizes[0]) + 1):
            while active and sizes[active - 1] < step:
                active -= 1
            last = first[:active] + step - 1
            total = np.full(active, -np.inf)
            for length, weight in edges:
                if length < step:
                    total = np.logaddexp(total, cells[last - length] + weight[last])
                elif length == step:
                    total = np.logaddexp(total, weight[last])
            cells[last] = total
            ended = sizes[:active] == step
            result[:active][ended] = total[ended]
        return result

    def _spelled(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Weight of each character spelled by its bytes; the mark before a word is no character."""
        kinds, which = np.unique(codes, return_inverse=True)
        weight = [self.bytes[np.frombuffer(chr(c).encode(), np.uint8)].sum() for c in kinds.tolist()]
        out = np.array(weight)[which]
        out[at == 1] = -np.inf
        return out


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of weighed codes, and the hash of each prefix from the first code on."""
    powers = np.cumprod(np.full(len(codes), _ODD))
    spread = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    spread ^= spread >> np.uint64(32)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread * powers, dtype=np.uint64)))
    return sums, sums[1:] * _BACK


def scored(docs: DataFrame, path: str, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of every whole text; ``path`` is a piece vocabulary that every executor has.

    ``held_out`` is ``crc32(doc_id as text) mod folds = held``; the others train. A null id trains.
    ``base_score`` is the add-one unigram word model, ``score`` the lattice model, both log10. A null
    or empty text is its end alone. Rows that repeat a document count and train as often. Only
    ``doc_id`` and ``text`` are read. Without training rows all counts are 0.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    docs = docs.select("doc_id", "text", F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    chunks = chunk_count(docs)
    buckets = bucket_count(chunks)
    texts = chunked(with_times(docs, "held_out"), chunks, "held_out", "times")

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        held_out, times, counts = table["held_out"].to_pylist(), table["times"].to_pylist(), Counter()
        all_texts = table["text"].to_pylist()
        for text, out, n in zip(all_texts, held_out, times, strict=True):
            if not out and n == 1:
                counts.update(words_of(text))
            elif not out:
                counts.update({w: k * n for w, k in Counter(words_of(text)).items()})
        words, hashes = _in_order(list(_distinct(all_texts)))
        rows = {"bucket": [], "chunk": [], "words": [], "counts": []}
        for bucket, own in by_bucket(hashes, buckets):
            rows["bucket"].append(bucket)
            rows["chunk"].append(key[0].as_py())
            rows["words"].append(_zip(b"\n".join(words[own])))
            rows["counts"].append(_zip(np.array([counts[w] for w in words[own]], np.int64).tobytes()))
        return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())]))

    asked = texts.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, words binary, counts binary")
    asked = written_once(asked, "words")

    def summed(table: pa.Table) -> dict[bytes, int]:
        total: Counter[bytes] = Counter()
        for words, counts in zip(table["words"], table["counts"], strict=True):
            own = np.frombuffer(_unzip(counts.as_py()), np.int64).tolist()
            for word, n in zip(_unzip(words.as_py()).split(b"\n"), own, strict=True):
                total[word] += n
        return total

    def count_pieces(key: tuple, table: pa.Table) -> pa.Table:
        known = {w: n for w, n in summed(table).items() if n}
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(model.get_piece_size(), np.int64)
        words = list(known)
        for i in range(0, len(words), 10_000):
            part = words[i : i + 10_000]
            cut = model.encode([w.decode() for w in part], num_threads=1)
            times = np.repeat([known[w] for w in part], [len(c) for c in cut])
            np.add.at(total, np.array([p for c in cut for p in c], np.int64), times)
        ids = np.flatnonzero(total)
        return pa.table({
            "piece": pa.array([*ids.tolist(), WORDS, TYPES], pa.int32()),
            "n": pa.array([*total[ids].tolist(), sum(known.values()), len(known)], pa.int64()),
        })

    pieces = asked.groupBy("bucket").applyInArrow(count_pieces, "piece int, n long")
    # One row for each piece of the vocabulary at most.
    counts = {r.piece: r.n for r in pieces.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    ends = docs.filter("NOT held_out").count()
    tokens = counts.pop(WORDS, 0) + ends
    types = counts.pop(TYPES, 0) + (ends > 0)
    # The pieces' probabilities, about a megabyte, go to the tasks with the functions below.
    model = Pieces(path, counts, ends)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        total = summed(table)
        index = {w: i for i, w in enumerate(total)}
        logs = model.score(list(total))
        numbers = np.fromiter(total.values(), np.int64, len(total))
        rows = {"chunk": table["chunk"].to_pylist(), "bucket": table["bucket"].to_pylist(), "counts": [], "logs": []}
        for words in table["words"]:
            own = np.fromiter(map(index.__getitem__, _unzip(words.as_py()).split(b"\n")), np.int64)
            rows["counts"].append(_zip(numbers[own].tobytes()))
            rows["logs"].append(_zip(logs[own].tobytes()))
        return pa.table(rows, schema=pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("logs", pa.binary())]))

    answers = asked.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, counts binary, logs binary")

    def score(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        all_texts = table["text"].to_pylist()
        words, hashes = _in_order(list(_distinct(all_texts)))
        count, log = np.zeros(len(words), np.int64), np.zeros(len(words))
        own = bucket_of(hashes, buckets).astype(np.int64)
        for bucket, c, g in zip(told["bucket"].to_pylist(), told["counts"], told["logs"], strict=True):
            mine = slice(np.searchsorted(own, bucket), np.searchsorted(own, bucket, "right"))
            count[mine] = np.frombuffer(_unzip(c.as_py()), np.int64)
            log[mine] = np.frombuffer(_unzip(g.as_py()))
        index = {w: i for i, w in enumerate(words)}
        base = np.log10((count + 1) / (tokens + types + 1))
        base_end = np.log10((ends + 1) / (tokens + types + 1))
        rows = []
        for text in all_texts:
            at = np.fromiter(map(index.__getitem__, words_of(text)), np.int64)
            rows.append((
                len(at) + 1, int((count[at] > 0).sum()) + (ends > 0),
                float(base[at].sum() + base_end), float((log[at].sum() + model.end) / np.log(10)),
            ))
        n_tokens, n_known, base_score, own_score = zip(*rows, strict=True)
        return pa.table({
            "doc_id": table["doc_id"], "held_out": table["held_out"],
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([tokens] * len(rows), pa.int64()),
            "base_score": pa.array(base_score), "score": pa.array(own_score), "times": table["times"],
        })

    told = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, times long"
    )
    return as_often(told)
