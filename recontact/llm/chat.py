"""Chat formatting on token level, for training on the assistant's words.

Each segment of text is encoded by itself, so no token spans a border between text and markup.
Reserved ids, beyond the vocabulary, are spliced in as markup. Control strings inside texts are
escaped reversibly and are encoded as plain text, never as reserved ids. The loss mask is the
running sum of +1 where an assistant text begins and -1 where it ends.

A turn is ``[INST] text [/INST]`` for a user, ``<<SYS>> text <</SYS>>`` for a system prompt, ``text </s>``
for an assistant and ``<<ROLE>> role <</ROLE>> text </s>`` for any other role; ``<s>`` comes first.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Markup in the order of its reserved ids, which follow the vocabulary and its one free id.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    """Text without control strings: a backslash is doubled, and one is put inside each of them."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@cache
def vocabulary(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Template:
    """Token ids of turns and back."""

    def __init__(self, path: str, pattern: str):
        self.tokens = vocabulary(path, pattern)
        self.first = self.tokens.n_vocab + 1
        self.ids = {c: self.first + i for i, c in enumerate(CONTROLS)}

    def encode(self, text: str) -> list[int]:
        return self.tokens.encode_ordinary(escaped(text))

    def turn(self, role: str, text: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
        """Ids before, of, and after the text of a turn."""
        ids = self.ids
        if role == "user":
            return [ids["[INST]"]], list(text), [ids["[/INST]"]]
        if role == "system":
            return [ids["<<SYS>>"]], list(text), [ids["<</SYS>>"]]
        if role == "assistant":
            return [], list(text), [ids["</s>"]]
        name = self.encode(role)
        return [ids["<<ROLE>>"], *name, ids["<</ROLE>>"]], list(text), [ids["</s>"]]

    def assemble(self, roles: Sequence[str], texts: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a conversation and their loss mask."""
        out = [self.ids["<s>"]]
        begins, ends = [], []
        for role, text in zip(roles, texts, strict=True):
            before, own, after = self.turn(role, text)
            out += before
            if role == "assistant":
                begins.append(len(out))
                ends.append(len(out) + len(own))
            out += own
            out += after
        steps = np.zeros(len(out) + 1, np.int64)
        np.add.at(steps, begins, 1)
        np.add.at(steps, ends, -1)
        return np.array(out, np.int32), np.cumsum(steps)[:-1] > 0

    def text(self, ids: Sequence[int]) -> str:
        """Escaped text with markup as strings; adjacent plain ids decode together."""
        ids = np.asarray(ids)
        cuts = np.flatnonzero(ids >= self.first)
        out, start = [], 0
        for cut in cuts.tolist():
            out.append(self.tokens.decode(ids[start:cut].tolist()))
            out.append(CONTROLS[int(ids[cut]) - self.first])
            start = cut + 1
        return "".join(out) + self.tokens.decode(ids[start:].tolist())

    def turns(self, ids: Sequence[int]) -> list[tuple[str, str]]:
        """Role and text of each turn, read back by the reserved ids alone."""
        ids = np.asarray(ids)
        marks = np.flatnonzero(ids >= self.first).tolist()
        out, role, start = [], "assistant", 0
        for at in marks:
            mark = CONTROLS[int(ids[at]) - self.first]
            if mark in ("[/INST]", "<</SYS>>", "</s>"):
                out.append((role, unescaped(self.tokens.decode(ids[start:at].tolist()))))
                role = "assistant"
            elif mark == "<</ROLE>>":
                role = unescaped(self.tokens.decode(ids[start:at].tolist()))
            else:
                role = {"[INST]": "user", "<<SYS>>": "system"}.get(mark, "assistant")
            start = at + 1
        return out

    def loss_text(self, ids: np.ndarray, mask: np.ndarray) -> str:
        """All text under the mask, unescaped; each masked run is one assistant text."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))).reshape(-1, 2)
        return "".join(unescaped(self.tokens.decode(ids[a:b].tolist())) for a, b in edges.tolist())


def formatted(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``ids`` and ``loss_mask``.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. A null text or role is empty; a null
    ``conv_id`` is a conversation of its own; rows go by turn, nulls first, then role and text, so
    ties and repeated rows have one order and each stays a turn. Other columns are not read. Texts
    are encoded before the shuffle, which then carries ids; a conversation is put together in one
    task, as it becomes one row.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids = [template.encode(t or "") for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*part.schema.names, "ids"]
                )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                made = [
                    template.assemble([t["role"] for t in row], [t["ids"] for t in row])
                    for row in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([m[0] for m in made], pa.list_(pa.int32())),
                        pa.array([m[1] for m in made], pa.list_(pa.bool_())),
                    ],
                    names=["conv_id", "ids", "loss_mask"],
                )

    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.mapInArrow(encode, "conv_id long, turn long, role string, text string, ids array<int>")
    # The text settles ties of turn and role by its digest, so it need not be shuffled.
    row = F.struct("turn", "role", F.sha2("text", 256).alias("tie"), "ids")
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    rows = rows.withColumn(
        "turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["ids"].alias("ids")))
    )
    return rows.mapInArrow(assemble, "conv_id long, ids array<int>, loss_mask array<boolean>")


def read_back(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``conv_id``, ``turns`` (role and text), ``loss_text`` and ``formatted_text`` of formatted rows."""
    schema = (
        "conv_id long, turns array<struct<role:string,text:string>>, loss_text string, formatted_text string"
    )
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                ids = [np.array(x, np.int32) for x in part.column(1).to_pylist()]
                masks = [np.array(x, bool) for x in part.column(2).to_pylist()]
                told = [[{"role": r, "text": t} for r, t in template.turns(x)] for x in ids]
                loss = [template.loss_text(x, m) for x, m in zip(ids, masks, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(told, pa.list_(turn)),
                        pa.array(loss, pa.string()),
                        pa.array([template.text(x) for x in ids], pa.string()),
                    ],
                    names=["conv_id", "turns", "loss_text", "formatted_text"],
                )

    return rows.select("conv_id", "ids", "loss_mask").mapInArrow(run, schema)


def digests(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """Counts and digests of each conversation, read back from its token ids."""
    back = read_back(formatted(turns, path, pattern), path, pattern)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted_text").cast("long").alias("formatted_chars"),
    )


SAMPLE = "</s>[INST] ok [/INST]"


def with_sample(turns: DataFrame) -> DataFrame:
    """The conversations and number -7, whose two turns consist of control strings."""
    rows = [(-7, 0, "user", SAMPLE), (-7, 1, "assistant", SAMPLE)]
    extra = turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)
