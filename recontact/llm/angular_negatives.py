"""Hard negatives of anchors by angular triangle filtering.

Every vector stores its angles to a few reference directions. By the triangle inequality on the
sphere the angle of two vectors lies between the difference and the sum of their angles to each
direction, so their cosine lies in an interval; multiplied by the norms and rounded outwards it bounds
the integer score. Only pairs whose interval overlaps the scores looked for are scored.

Rows are dealt into blocks of bounded size by a hash, so a label that holds many rows is spread.
Every anchor is sent to every block: the block's rows come first and stay, the anchors stream past. A
block returns an anchor's best positives; once the best of all blocks are known, a second pass returns
the best rows of other labels in the score windows of these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recontact.sources.storage import written_once

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Score window of a negative, in percent of the positive's score.
LEAST, MOST = 50, 95
#: Integer components are held within these, so that scores of up to 32,768 of them fit 64 bits.
LIMIT = 1 << 24
DIRECTIONS, SAMPLE = 8, 1024
#: Rows of a block at most on average; and how far smaller tables are split, so that tasks share the work.
BLOCK, SPLIT, SMALL = 1 << 17, 64, 2048
_ROWS = 256
_ANCHOR = "anchor_id long, ah long"
_FOUND = f"{_ANCHOR}, vec_id long, h long, score long"


def integer_rows(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label``, integers ``x`` and a hash ``h`` of the rows that take part, each once."""
    sound = F.expr(
        "label IS NOT NULL AND embedding IS NOT NULL AND "
        "forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('Infinity'))"
    )
    scaled = F.expr(
        f"transform(embedding, e -> cast(floor(greatest({-LIMIT}D, least({LIMIT}D, cast(e AS double) * {scale}))) AS int))"
    )
    rows = table.filter(sound).select("vec_id", F.col("label").cast("long").alias("label"), scaled.alias("x")).distinct()
    return rows.withColumn("h", F.xxhash64("vec_id", "label", "x"))


def directions(sample: list[list[int]], count: int = DIRECTIONS) -> list[np.ndarray]:
    """Unit vectors out of the sample, each the furthest in angle from those before."""
    width = max(map(len, sample), default=0)
    points = np.zeros((len(sample), width))
    for i, x in enumerate(sample):
        points[i, : len(x)] = x
    norms = np.sqrt((points * points).sum(1))
    points = points[norms > 0] / norms[norms > 0, None]
    chosen: list[np.ndarray] = []
    nearest = np.full(len(points), -1.0)
    while len(chosen) < min(count, len(points)) and nearest.min(initial=1.0) < 1 - 1e-6:
        chosen.append(points[int(nearest.argmin())])
        nearest = np.maximum(nearest, points @ chosen[-1])
    return chosen


def fitted(refs: list[np.ndarray], width: int) -> np.ndarray:
    """The directions cut or padded to a width; one that vanishes becomes the first axis."""
    out = np.zeros((len(refs), width))
    for r, ref in enumerate(refs):
        part = ref[:width]
        norm = np.sqrt(part @ part)
        if norm > 0:
            out[r, : len(part)] = part / norm
        elif width:
            out[r, 0] = 1.0
    return out


def measured(x: pa.ListArray, refs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Norms of vectors of any lengths, and their angles to the directions; a right one for zero."""
    sizes = x.value_lengths().to_numpy()
    flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    norms, angles = np.zeros(len(x)), np.full((len(x), len(refs)), np.pi / 2)
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        own = flat[(ends[rows] - width)[:, None] + np.arange(width)]
        norms[rows] = np.sqrt((own * own).sum(1))
        some = rows[norms[rows] > 0]
        unit = own[norms[rows] > 0] / norms[some, None]
        angles[some] = np.arccos(np.clip(unit @ fitted(refs, width).T, -1, 1))
    return norms, angles


class Rows:
    """Vectors of one length, with the sines and cosines of their angles."""

    def __init__(self, table: pa.Table):
        def column(name: str, kind: type) -> np.ndarray:
            return table[name].to_numpy().astype(kind)

        self.missing = table["vec_id"].is_null().to_numpy()
        self.ids = table["vec_id"].fill_null(0).to_numpy()
        self.h, self.label, self.norm = column("h", np.int64), column("label", np.int64), column("norm", np.float64)
        n = table.num_rows
        self.x = _flat(table["x"]).reshape(n, -1).astype(np.int64)
        angles = _flat(table["angles"]).reshape(n, -1)
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        self.real = self.x.astype(np.float64)

    def intervals(self, rows: slice, others: Rows, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each pair, safe against rounding."""
        size = self.norm[rows, None] * others.norm[None, cols]
        low, high = -np.ones(size.shape), np.ones(size.shape)
        for r in range(self.cos.shape[1]):
            even = self.cos[rows, r, None] * others.cos[None, cols, r]
            odd = self.sin[rows, r, None] * others.sin[None, cols, r]
            np.maximum(low, even - odd, out=low)
            np.minimum(high, even + odd, out=high)
        blur = 1e-6 * size + 1e-6
        return np.floor(low * size - blur), np.ceil(high * size + blur)

    def scores(self, cols: np.ndarray, anchor: Rows, row: int, exact: bool) -> np.ndarray:
        """Integer scores of some rows; in floats where all partial sums are integers below 2^53."""
        if exact:
            return (self.real[cols] @ anchor.real[row]).astype(np.int64)
        return self.x[cols] @ anchor.x[row]


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def streamed(visit: Callable[[Rows, pa.Table], Iterator[tuple]], schema: pa.Schema):
    """Function for ``mapInArrow`` over rows sorted by block and kind: rows of the block are kept, and
    anchors pass in slices. ``visit`` gets block rows of one length, by label, and anchors of that length."""

    def built(parts: list[pa.RecordBatch]) -> dict[int, Rows]:
        if not parts:
            return {}
        table = pa.Table.from_batches(parts).sort_by([("label", "ascending"), ("h", "ascending")])
        widths = np.array(table["width"])
        return {int(w): Rows(table.filter(pa.array(widths == w))) for w in np.unique(widths)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, kept = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch["block"].to_numpy() * 2 + batch["kind"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                number, kind = divmod(int(code[start]), 2)
                if number != block:
                    block, parts, kept = number, [], None
                if kind == 0:
                    parts.append(batch.slice(start, end - start))
                    continue
                if kept is None:
                    kept, parts = built(parts), []
                anchors = pa.Table.from_batches([batch.slice(start, end - start)])
                widths = np.array(anchors["width"])
                for w in np.unique(widths).tolist():
                    if w not in kept:
                        continue
                    own = anchors.filter(pa.array(widths == w)).sort_by("label")
                    for at in range(0, own.num_rows, _ROWS):
                        for found in visit(kept[w], own.slice(at, _ROWS)):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)

    return run


def exact_in_floats(a: Rows, b: Rows) -> bool:
    return a.norm.max(initial=0) * b.norm.max(initial=0) < 2.0**52


def _best(scores: np.ndarray, block: Rows, cols: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count``: by score, then smaller id, nulls last, then hash."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        place = np.flatnonzero(scores >= least)
    else:
        place = np.arange(len(scores))
    at = cols[place]
    return place[np.lexsort((block.h[at], block.ids[at], block.missing[at], -scores[place]))[:count]]


def _nullable(ids: np.ndarray, missing: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=missing)


def _gathered(found: list[tuple[int, np.ndarray, np.ndarray]], anchors: Rows, block: Rows, more: list[pa.Array]):
    if found:
        row = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
        at = np.concatenate([f[1] for f in found])
        score = np.concatenate([f[2] for f in found])
        yield (anchors.ids[row], anchors.h[row], *more, _nullable(block.ids[at], block.missing[at]), block.h[at], score)


def positives_of(count: int):
    """Visit that finds each anchor's best rows of its own label."""

    def visit(block: Rows, table: pa.Table) -> Iterator[tuple]:
        anchors = Rows(table)
        exact = exact_in_floats(anchors, block)
        found = []
        for label in np.unique(anchors.label).tolist():
            first, last = np.searchsorted(anchors.label, (label, label + 1)).tolist()
            cols = np.arange(*np.searchsorted(block.label, (label, label + 1)))
            if not len(cols):
                continue
            low, high = anchors.intervals(slice(first, last), block, cols)
            for i in range(first, last):
                own = (block.ids[cols] == anchors.ids[i]) & ~block.missing[cols]
                own &= (block.x[cols] == anchors.x[i]).all(1) if own.any() else False
                least, most = low[i - first], high[i - first]
                least[own], most[own] = -np.inf, -np.inf
                # Rows below the ``count``-th certain score cannot be among the first.
                sure = np.partition(least, len(least) - count)[-count] if len(least) > count else -np.inf
                at = cols[(most >= sure) & ~own]
                scores = block.scores(at, anchors, i, exact)
                top = _best(scores, block, at, count)
                found.append((i, at[top], scores[top]))
        yield from _gathered(found, anchors, block, [])

    return visit


def negatives_of(count: int, least: int, most: int):
    """Visit that finds, for each positive score of an anchor, the best rows of other labels in its window."""

    def visit(block: Rows, table: pa.Table) -> Iterator[tuple]:
        anchors = Rows(table)
        exact = exact_in_floats(anchors, block)
        cols = np.arange(len(block.ids))
        low, high = anchors.intervals(slice(None), block, cols)
        found, marks = [], []
        for i, wanted in enumerate(table["wanted"].to_pylist()):
            # 100 * score between least * p and most * p; nothing for a negative p.
            windows = [(p, -(-least * p // 100), most * p // 100) for p in wanted if p >= 0]
            if not windows:
                continue
            near = (high[i] >= min(w[1] for w in windows)) & (low[i] <= max(w[2] for w in windows))
            at = cols[near & (block.label != anchors.label[i])]
            scores = block.scores(at, anchors, i, exact)
            for p, floor, roof in windows:
                inside = np.flatnonzero((scores >= floor) & (scores <= roof))
                top = inside[_best(scores[inside], block, at[inside], count)]
                found.append((i, at[top], scores[top]))
                marks.append(np.full(len(top), p))
        yield from _gathered(found, anchors, block, [np.concatenate(marks)] if marks else [])

    return visit


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(part.split()[0], pa.int64()) for part in ddl.split(", ")])


def mined(
    table: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST, scale: int = SCALE,
) -> DataFrame:
    """One row for each hard negative: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``.

    Anchors are rows whose ``vec_id`` is divisible by ``every``. Positives are the first ``positives`` other
    rows of the same label, negatives the first ``negatives`` of other labels whose score lies between
    ``least`` and ``most`` percent of the positive's; all if fewer. Higher scores come first, then smaller
    ids (null last), then a hash of the row. Rows with a null label, a null vector, or null or non-finite
    components take no part. Rows that repeat id, label and vector are one. A null id is no anchor. Vectors
    of different lengths are not compared; zero and empty ones score 0. Integers beyond 2^24 count as that.
    A positive below zero has no negatives. An empty table gives no rows. Other columns are not read.

    Anchors times rows are compared, in blocks of at most about ``BLOCK`` rows.
    """
    rows = integer_rows(table, scale)
    total, sample = rows.count(), None
    # A bounded sample: SAMPLE rows.
    sample = [r.x for r in rows.orderBy("h").limit(SAMPLE).select("x").collect()]
    refs = directions(sample)
    blocks = max(-(-total // BLOCK), min(SPLIT, -(-total // SMALL)), 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, angles = measured(batch["x"], refs)
            ends = np.arange(len(norms) + 1, dtype=np.int32) * len(refs)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), column], [*batch.schema.names, "norm", "angles"])

    stored = rows.mapInArrow(measure, "vec_id long, label long, x array<int>, h long, norm double, angles array<double>")
    stored = written_once(stored.withColumn("width", F.size("x")), "angles")
    anchors = stored.filter(F.col("vec_id") % every == 0)
    resident = stored.withColumns({"block": F.pmod("h", F.lit(blocks)).cast("int"), "kind": F.lit(0), "wanted": F.lit(None).cast("array<long>")})

    def compared(anchors: DataFrame, visit, ddl: str) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        passing = anchors.withColumns({"block": numbers, "kind": F.lit(1)}).select(resident.columns)
        dealt = resident.union(passing).repartition("block").sortWithinPartitions("block", "kind")
        return dealt.mapInArrow(streamed(visit, _schema(ddl)), ddl)

    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("h")]
    found = compared(anchors.withColumn("wanted", F.lit(None).cast("array<long>")), positives_of(positives), _FOUND)
    first = Window.partitionBy("anchor_id", "ah").orderBy(*order)
    best = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives)
    best = written_once(best.select("anchor_id", "ah", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    wanted = best.groupBy("anchor_id", "ah").agg(F.sort_array(F.collect_set("positive_score")).alias("wanted"))
    looking = anchors.join(wanted, (F.col("vec_id") == F.col("anchor_id")) & (F.col("h") == F.col("ah"))).drop("anchor_id", "ah")
    ddl = _FOUND.replace("vec_id", "wanted long, vec_id")
    near = compared(looking, negatives_of(negatives, least, most), ddl)
    window = Window.partitionBy("anchor_id", "ah", "wanted").orderBy(*order)
    near = near.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= negatives)
    near = near.select("anchor_id", "ah", F.col("wanted").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(near, ["anchor_id", "ah", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(table: DataFrame) -> DataFrame:
    """Embeddings where every seventh id has the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return table.select("vec_id", label.alias("label"), "embedding")


def mined_sql() -> str:
    """The rows of ``mined(relabelled(embeddings))`` in DuckDB, all anchors against all rows."""
    score = "list_sum(list_transform(list_zip(a.x, r.x), lambda z: z[1] * z[2]))::BIGINT"
    return f"""
WITH r AS MATERIALIZED (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda e: floor(e::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, {score} AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id AND len(a.x) = len(r.x) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.label <> p.own AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
