"""Byte-pair encoding and decoding with a public vocabulary, by batched merge rounds.

Symbols of many words lie in one flat array. In each round the ranks of all neighbouring pairs are
found by binary search over the sorted pair keys, each word takes its lowest rank, and all pairs of
that rank in the word are merged from the left. A word needs a round for each rank that it uses.
Ranks of pairs with a new symbol are above the rank that made it, so a round never has to go back.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase
from tokenizers.normalizers import Sequence as Sequence_
from tokenizers.pre_tokenizers import Split

# White space of the vocabulary's normalizer; U+001C..U+001F, at which str.split() cuts, are not in it.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")


@cache
def young() -> tuple[re.Pattern, re.Pattern]:
    """Characters that Python's tables do not know, and letters and digits that the tokenizers
    library's tables do not know, which its patterns take for symbols."""
    text = "".join(c for c in map(chr, range(0x370, 0x110000)) if unicodedata.category(c) in ("Cn", "Lo"))
    symbols = Split(Regex(r"[\p{L}\p{N}]+"), "removed").pre_tokenize_str(text)
    found = regex.findall(r"[\p{L}\p{N}]", "".join(s for s, _ in symbols))
    return _one_of(c for c in text if unicodedata.category(c) == "Cn"), _one_of(found)


def _one_of(chars: Iterable[str]) -> re.Pattern:
    codes = np.array([ord(c) for c in chars])
    runs = np.split(codes, np.flatnonzero(np.diff(codes) != 1) + 1)
    return re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in runs) + "]")


#: Characters of text that are encoded at a time, and pieces of text in a generation of a task's memory.
SLICE, MEMORY = 1 << 20, 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and rules of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(*ids.values(), *self.special.values()) + 1
        self.tokens = np.full(self.size, "", object)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        end = spec["model"]["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.final = np.array([ids[s + end] for s in symbols], np.int64)
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")

    def pair_ranks(self, symbols: np.ndarray) -> np.ndarray:
        """Rank of each symbol with the one after it; one past the last rank where there is none."""
        keys = symbols[:-1] * self.size + symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def encode_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each. No word is empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        none = len(self.keys)
        while len(symbols):
            rank = np.append(self.pair_ranks(symbols), none)
            rank[:-1][word[1:] != word[:-1]] = none
            starts = np.concatenate(([0], np.flatnonzero(word[1:] != word[:-1]) + 1))
            size = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = lowest == none
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, lowest = symbols[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbols):
                    break
            hit = rank == lowest
            # In a run of overlapping hits (a symbol with itself) every second one merges.
            at = np.arange(len(hit))
            before = np.maximum.accumulate(np.where(hit, -1, at))
            hit &= (at - before) % 2 == 1
            symbols[hit] = self.made[rank[hit]]
            gone = np.zeros(len(hit), bool)
            gone[1:] = hit[:-1]
            symbols, word = symbols[~gone], word[~gone]
        if not done_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        ids = np.concatenate(done_symbols)[order].astype(np.int32)
        return ids, np.bincount(word, minlength=len(words))

    def words_of(self, piece: str) -> list[bytes]:
        """Words of a piece without white space: composed, lower-cased by character, then cut."""
        if piece.isascii():
            plain = piece.lower()
            return [plain.encode()] if plain.isalpha() else [w.encode() for w in self.pattern.findall(plain)]
        # The capital sigma is lowered without regard to its place in the word.
        plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        # Below U+0370 all tables agree on what a letter is, and letters alone are one word.
        if max(plain) < "\u0370":
            return [plain.encode()] if plain.isalpha() else [w.encode() for w in self.pattern.findall(plain)]
        unknown, symbols = young()
        if unknown.search(piece):
            plain = Sequence_([NFC(), Lowercase()]).normalize_str(piece)
        seen = symbols.sub("\ue000", plain)
        return [plain[m.start() : m.end()].encode() for m in self.pattern.finditer(seen)]


class Encoder:
    """Ids of texts. Remembers the ids of pieces between white space in two generations of ``MEMORY``
    pieces: a full one becomes the old one, and what is met again moves to the young one."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return SPACE.split(text) if ODD_SPACE.search(text) else text.split()

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the words of unseen pieces together."""
        vocabulary = self.vocabulary
        words: dict[bytes, int] = {}
        whole: list[tuple[str, int]] = []
        parts: list[tuple[str, list[int]]] = []
        for piece in pieces:
            if "<|" in piece:
                own = []
                for part in vocabulary.cut.split(piece):
                    if part in vocabulary.special:
                        own.append(-1 - vocabulary.special[part])
                    elif part:
                        own += [words.setdefault(w, len(words)) for w in vocabulary.words_of(part)]
                parts.append((piece, own))
                continue
            cut = vocabulary.words_of(piece) if piece else []
            if len(cut) == 1:
                whole.append((piece, words.setdefault(cut[0], len(words))))
            else:
                parts.append((piece, [words.setdefault(w, len(words)) for w in cut]))
        ids, counts = vocabulary.encode_words(list(words))
        ends = np.cumsum(counts)
        raw = ids.tobytes()
        blobs = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
        known = self.known
        for piece, w in whole:
            known[piece] = blobs[w]
        for piece, own in parts:
            known[piece] = b"".join([blobs[w] if w >= 0 else np.int32(-1 - w).tobytes() for w in own])

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as bytes of 32-bit numbers."""
        if len(self.known) > MEMORY:
            self.known, self.old = {}, self.known
        split = [self.pieces(t) for t in texts]
        new = set().union(*split)
        new -= self.known.keys()
        old = self.old
        again = [p for p in new if p in old]
        self.known.update(zip(again, map(old.__getitem__, again), strict=True))
        new.difference_update(again)
        self.learn(new)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def encode_lists(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text of a column; null counts as empty."""
        blobs = self.encode([t or "" for t in texts.to_pylist()])
        offsets = np.concatenate(([0], np.cumsum([len(b) // 4 for b in blobs]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), np.int32)))


def decode_lists(lists: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The tokens of each list of ids joined by one space; unknown ids are skipped, null is empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    numbers = lists.flatten()
    known = pc.and_kleene(pc.greater_equal(numbers, 0), pc.less(numbers, len(tokens)))
    names = tokens.take(pc.if_else(known, numbers, None))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if names.null_count:
        keep = names.is_valid().to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        names = names.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), names), " ")


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to ``most`` or a little more."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= most or i + 1 == len(sizes):
            yield start, i + 1
            start, total = i + 1, 0


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ``ids``, an array of token ids of each whole text.

    ``path`` is a vocabulary file that every executor has. Texts are read in slices, so memory does
    not grow with the partition. Null and empty texts get an empty array; repeated rows encode
    alike. An existing column of the name ``ids`` is replaced. No shuffle.
    """
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for start, end in _runs(sizes, SLICE):
                part = batch.slice(start, end - start)
                lists = encoder.encode_lists(column.slice(start, end - start))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*batch.schema.names, ids])

    return kept.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and ``out``: the tokens of the ids joined by one space, special ones included.

    This is what the vocabulary asks for, as it names no decoder. Ids outside the vocabulary are
    skipped; a null array decodes to an empty text.
    """
    kept = rows.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(Vocabulary(path).tokens, pa.string())
        for batch in batches:
            whole = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(whole), 0).to_numpy(zero_copy_only=False)
            for start, end in _runs(sizes, SLICE):
                part = batch.slice(start, end - start)
                text = decode_lists(whole.slice(start, end - start), tokens)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, out])

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text of each document.

    A slice of texts is encoded, decoded from its ids and digested in one pass, so neither ids nor
    decoded texts leave the task.
    """

    def hashed(joined: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(b).hexdigest() for b in joined.cast(pa.binary()).to_pylist()], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        tokens = pa.array(encoder.vocabulary.tokens, pa.string())
        for batch in batches:
            column = batch["text"]
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for start, end in _runs(sizes, SLICE):
                lists = encoder.encode_lists(column.slice(start, end - start))
                numbers = pa.ListArray.from_arrays(lists.offsets, lists.values.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(start, end - start), pc.list_value_length(lists).cast(pa.int64()),
                     hashed(pc.binary_join(numbers, " ")), hashed(decode_lists(lists, tokens))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    own = docs.select("doc_id", "text")
    schema = T.StructType([own.schema["doc_id"], *(T.StructField(n, t) for n, t in (
        ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())))])
    return own.mapInArrow(run, schema)
