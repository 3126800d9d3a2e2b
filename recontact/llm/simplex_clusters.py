"""K-means over integer vectors, with centroids filtered by N-simplex projection.

A few pivots span a simplex. The distances of a vector to the pivots place it as an apex over that
base: coordinates along the base and a height above it. The distance of two apexes bounds that of
their vectors from below, and the distance with one height turned over bounds it from above. Distances
to pivots never change, so apexes are computed once and stored; each round places the centroids alike
and compares a vector exactly with those centroids only whose lower bound does not exceed the least
upper bound. Distances, sums and means are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.sources.storage import written_once

WIDTH, SCALE, CLUSTERS, ROUNDS, PIVOTS = 64, 256, 40, 5, 8
#: Integer components are held within these, so that squared distances fit 64 bits.
LIMIT = 1 << 27
#: A pivot counts only if it lies that far from the span of those before it, as a share of the furthest.
FLAT = 0.05
_CHUNK = 2048


class Base:
    """A simplex of pivots and the place of other vectors above it."""

    def __init__(self, points: np.ndarray, count: int = PIVOTS):
        """Pivots are chosen among the points, each the furthest from the span of those before."""
        self.pivots = points[:1].astype(np.int64)
        rows = np.zeros((0, 0))
        far = self.far = float(np.sqrt(squares(points, points[:1]).max())) if len(points) else 0.0
        while len(self.pivots) < min(count, len(points)):
            self._solve(rows)
            apex = self.placed(squares(points, self.pivots))
            best = int(apex[:, -1].argmax())
            if apex[best, -1] <= FLAT * far:
                break
            grown = np.zeros((len(rows) + 1, len(rows) + 1))
            grown[:-1, :-1] = rows
            grown[-1] = apex[best]
            rows, self.pivots = grown, np.concatenate((self.pivots, points[best : best + 1]))
        self._solve(rows)

    def _solve(self, rows: np.ndarray) -> None:
        self.inverse = np.linalg.inv(rows) if len(rows) else rows
        self.lengths = (rows * rows).sum(1)
        self.blur = 1e-14 * (1.0 + float(np.abs(self.inverse).sum(1).max(initial=0.0)))

    def placed(self, square: np.ndarray) -> np.ndarray:
        """Apexes for squared distances to the pivots: the last coordinate is the height."""
        own = square.astype(np.float64)
        along = ((own[:, :1] + self.lengths - own[:, 1:]) / 2) @ self.inverse.T
        height = np.sqrt(np.maximum(own[:, 0] - (along * along).sum(1), 0))
        return np.concatenate((along, height[:, None]), 1)

    def slack(self, apexes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How far rounding can shift a bound: that of the coordinates, and of a height near zero."""
        size = 1.0 + (apexes * apexes).sum(1) + (others * others).sum(1).max(initial=0.0) + self.far**2
        along = self.blur * size
        return 8 * (along + np.sqrt(along * np.sqrt(size) + 1e-14 * size))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    out = np.empty((len(a), len(b)), np.int64)
    for k in range(len(b)):
        step = a - b[k]
        out[:, k] = np.einsum("ij,ij->i", step, step)
    return out


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, base: Base) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and the squared distance; ties go to the smaller number."""
    over = base.placed(squares(centroids, base.pivots))
    best = np.zeros(len(vectors), np.int32)
    least = np.zeros(len(vectors), np.int64)
    for start in range(0, len(vectors), _CHUNK):
        own, here = vectors[start : start + _CHUNK], apexes[start : start + _CHUNK]
        step = here[:, None, :-1] - over[None, :, :-1]
        flat = np.einsum("ijk,ijk->ij", step, step)
        low = np.sqrt(flat + (here[:, None, -1] - over[None, :, -1]) ** 2)
        high = np.sqrt(flat + (here[:, None, -1] + over[None, :, -1]) ** 2)
        near = low <= (high.min(1) + base.slack(here, over))[:, None]
        square = np.full(near.shape, np.iinfo(np.int64).max)
        for k in np.flatnonzero(near.any(0)).tolist():
            rows = np.flatnonzero(near[:, k])
            gap = own[rows] - centroids[k]
            square[rows, k] = np.einsum("ij,ij->i", gap, gap)
        at = square.argmin(1)
        best[start : start + _CHUNK] = at
        least[start : start + _CHUNK] = square[np.arange(len(own)), at]
    return best, least


def integer_vectors(table: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``x``, the integers ``floor(scale * component)`` of the rows with ``width`` finite
    components."""
    sound = F.expr(
        f"embedding IS NOT NULL AND size(embedding) = {width} AND "
        "forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('Infinity'))"
    )
    scaled = F.expr(
        f"transform(embedding, e -> cast(floor(greatest({-LIMIT}D, least({LIMIT}D, cast(e AS double) * {scale}))) AS int))"
    )
    return table.filter(sound).select("vec_id", scaled.alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def clustered(
    table: DataFrame, width: int = WIDTH, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "2"
) -> DataFrame:
    """One row for each kept vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``.

    Rows whose vector is null, of another width or holds null or non-finite components are left out.
    Centroids start as the vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (a null id counts as
    empty; equal hashes fall by their components), as many as there are if those are fewer. Each row
    is a vector of its own, also one that repeats another. Empty centroids stay. Integers beyond 2^27
    count as that; sums beyond 64 bits as the largest. An empty table gives no rows. Only ``vec_id`` and
    ``embedding`` are read.

    The driver holds the pivots and centroids, ``clusters`` rows; each round sums its vectors in the tasks.
    """
    spark = table.sparkSession
    rows = integer_vectors(table, width, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # ``clusters`` rows.
    first = rows.orderBy(order, "x").limit(clusters).select("x").toArrow()["x"].combine_chunks()
    centroids = matrix(first, width).astype(np.int64)
    base = Base(centroids) if len(centroids) else None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apex = base.placed(squares(matrix(batch["x"], width).astype(np.int64), base.pivots))
            ends = np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(apex.ravel()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["x"], column], ["vec_id", "x", "apex"])

    if base is None:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    placed = written_once(rows.mapInArrow(place, "vec_id long, x array<int>, apex array<double>"), "apexes")

    def assign(batch: pa.RecordBatch, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = matrix(batch["x"], width).astype(np.int64)
        return own, *nearest(own, matrix(batch["apex"], len(base.pivots)), centroids, base)

    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray = centroids) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(now.shape, np.int64), np.zeros(len(now), np.int64)
            for batch in batches:
                own, best, _ = assign(batch, now)
                np.add.at(count, best, 1)
                np.add.at(total, best, own)
            told = np.flatnonzero(count)
            place = np.arange(width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(told, width), pa.int32()), pa.array(np.tile(place, len(told)), pa.int32()),
                 pa.array(np.repeat(count[told], width)), pa.array(total[told].ravel())],
                ["cluster", "place", "n", "s"],
            )

        parts = placed.select("x", "apex").mapInArrow(sums, "cluster int, place int, n long, s long")
        # At most ``clusters * width`` rows.
        means = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
        centroids = centroids.copy()
        centroids[means["cluster"].to_numpy(), means["place"].to_numpy()] = means["s"].to_numpy() // means["n"].to_numpy()

    def label(batches: Iterator[pa.RecordBatch], now: np.ndarray = centroids) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, least = assign(batch, now)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(best), pa.array(least)], ["vec_id", "cluster", "distance"])

    found = written_once(placed.mapInArrow(label, "vec_id long, cluster int, distance long"), "clusters")
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    # ``clusters`` rows.
    digests = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    whole = F.least(F.sum(F.col("distance").cast("decimal(38,0)")), top).cast("long")
    per = found.groupBy("cluster").agg(whole.alias("cluster_inertia")).join(digests, "cluster")
    inertia = found.agg(whole.alias("inertia"))
    out = found.join(F.broadcast(per), "cluster").withColumn("inertia", inertia.scalar())
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustered_sql(width: int = WIDTH, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "2") -> str:
    """The same rows in DuckDB, one step for each round."""
    whole = "sum(x[p])"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT row, vec_id, x, k, d FROM (SELECT row, vec_id, x, k,
    list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{r})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT k, p, ({whole} - ((({whole} % count(*)) + count(*)) % count(*))) // count(*) AS m
  FROM a{r}, range(1, {width + 1}) AS t(p) GROUP BY k, p),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(n.c, c.c) AS c FROM c{r} c
  LEFT JOIN (SELECT k, list(m::BIGINT ORDER BY p) AS c FROM m{r} GROUP BY k) n ON n.k = c.k)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda e: floor(e::DOUBLE * {scale})::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {width}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x AS c FROM (SELECT x, sha256('{seed}:' || vec_id) AS h FROM kept)
  ORDER BY h, x LIMIT {clusters}),{",".join(steps)}
SELECT vec_id, a.k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (k)"""
