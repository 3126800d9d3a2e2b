"""All pairs of embeddings above a cosine, by dual traversal of cover trees.

On unit vectors a cosine of at least ``c`` is a distance of at most ``sqrt(2 - 2c)``. Equal vectors are one
class with a count. A tree has nested centres at halving radii; each node knows how far its points
reach. Two trees are walked together: a pair of nodes is dropped if their centres are further apart
than their reaches and the distance allow, taken whole if they are near enough, and opened otherwise.
Where points lie so evenly that opening a node would leave most of them alone, its dense groups are
opened and the lone points stay together; pairs of such nodes are compared by one matrix product.

The top of the tree comes from a bounded sample. Every vector descends it; the reaches of its nodes are
measured on all vectors, and the walk over the top drops pairs of cells before any vector is copied.
Cells are cut or put together to blocks of bounded size. The rows of a block stay in a task, those of
the blocks it is still paired with pass by, and both are walked as trees of their own. Tasks return
counts and spanning links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import components, smallest_reachable
from recontact.sources.storage import release, written_once

COSINE = 0.95
#: Vectors that the top of the tree is built from, and its most cells.
SAMPLE, CELLS = 4096, 1024
#: Vectors of a block at most, and how far smaller tables are split, so that tasks share the work.
BLOCK, SPLIT, SMALL = 1 << 16, 16, 2048
#: Points that are not opened further; the share of children among points from which they count as lone;
#: and how many of the points looked at make a dense group among those.
LEAF, LONE, DENSE = 64, 0.25, 8
#: Slack of the metric bounds; links themselves are decided by the cosine in double precision.
SLACK = 1e-6
_CHUNK, _TILE = 512, 2048


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, to about 3e-8."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Tree:
    """Nested centres over unit vectors; node 0 is the root. Points of a node lie together in ``order``."""

    def __init__(self, points: np.ndarray, most_nodes: int | None = None):
        self.points = points
        self.order = np.arange(len(points))
        self.start, self.end, self.radius, self.children, self.closed = [], [], [], [], []
        self._add(0, len(points), False)
        node = 0
        while node < len(self.start) and (most_nodes is None or len(self.start) < most_nodes):
            if not self.closed[node] and self.end[node] - self.start[node] > LEAF and self.radius[node] > SLACK:
                self._open(node)
            node += 1
        self.centre = self.order[np.array(self.start)]
        self.radius = np.array(self.radius)
        self.short = points.astype(np.float32)

    def _add(self, start: int, end: int, closed: bool) -> None:
        """The first point of a node is its centre."""
        own = self.points[self.order[start:end]]
        self.start.append(start)
        self.end.append(end)
        self.radius.append(float(distances(own[:1], own).max(initial=0.0)))
        self.children.append(None)
        self.closed.append(closed)

    def _open(self, node: int) -> None:
        """Children of at most half the radius, and one of lone points; the first has the centre of its
        parent."""
        start, end = self.start[node], self.end[node]
        reach = self.radius[node] / 2
        left, lone = self.order[start:end], None
        parent = int(left[0])
        groups: list[np.ndarray] = []
        while len(left):
            trial = left[:_CHUNK]
            near = distances(self.points[trial], self.points[trial]) <= reach
            np.fill_diagonal(near, True)
            chosen: list[int] = []
            covered = np.zeros(len(trial), bool)
            for i in range(len(trial)):
                if not covered[i]:
                    chosen.append(i)
                    covered |= near[i]
            scattered = len(chosen) > LONE * len(trial)
            if scattered:
                chosen = [i for i in chosen if near[i].sum() >= DENSE]
                if not chosen:
                    lone, left = left, left[:0]
                    break
            centres = trial[chosen]
            # Rows in pieces, so the distances of many centres stay small.
            best = np.empty(len(left), np.int64)
            gap = np.empty(len(left))
            for i in range(0, len(left), _CHUNK):
                d = distances(self.points[left[i : i + _CHUNK]], self.points[centres])
                best[i : i + _CHUNK] = d.argmin(1)
                gap[i : i + _CHUNK] = d.min(1)
            best[np.array(chosen)] = np.arange(len(chosen))
            gap[np.array(chosen)] = 0
            inside = gap <= reach
            kept, of = left[inside], best[inside]
            first = np.isin(kept, centres, assume_unique=True)
            sort = np.lexsort((~first, of))
            kept, of = kept[sort], of[sort]
            groups += np.split(kept, np.flatnonzero(np.diff(of)) + 1)
            left = left[~inside]
            if scattered:
                lone, left = left, left[:0]
        if not groups:
            return
        closed = [False] * len(groups)
        if lone is not None and len(lone):
            groups.append(np.concatenate((lone[lone == parent], lone[lone != parent])))
            closed.append(True)
        # The parent's centre leads the first child.
        at = next(i for i, g in enumerate(groups) if g[0] == parent)
        groups[0], groups[at], closed[0], closed[at] = groups[at], groups[0], closed[at], closed[0]
        self.order[start:end] = np.concatenate(groups)
        self.children[node] = (len(self.start), len(self.start) + len(groups))
        for group, shut in zip(groups, closed, strict=True):
            self._add(start, start + len(group), shut)
            start += len(group)

    def below(self, node: int) -> np.ndarray:
        """Children of a node, or the node itself if it has none."""
        return np.array([node]) if self.children[node] is None else np.arange(*self.children[node])

    def members(self, node: int) -> np.ndarray:
        return self.order[self.start[node] : self.end[node]]

    def leaves(self) -> list[int]:
        return [n for n, c in enumerate(self.children) if c is None]


class Links:
    """Counts of linked vectors, and links that span the components."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.count = np.zeros(len(weights), np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links one by one; of many, those that span them are kept."""
        np.add.at(self.count, a, self.weights[b])
        np.add.at(self.count, b, self.weights[a])
        if len(a) > 4 * _TILE:
            nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
            root = smallest_reachable(at[: len(a)], at[len(a) :], len(nodes))
            a, b = nodes, nodes[root]
        self.a.append(a)
        self.b.append(b)

    def whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """All of ``a`` with all of ``b``, which are apart."""
        self.count[a] += self.weights[b].sum()
        self.count[b] += self.weights[a].sum()
        self.a += [a, b]
        self.b += [np.full(len(a), b[0]), np.full(len(b), a[0])]

    def within(self, a: np.ndarray) -> None:
        self.count[a] += self.weights[a].sum() - self.weights[a]
        self.a.append(a)
        self.b.append(np.full(len(a), a[0]))


def compare(one: Tree, two: Tree, a: np.ndarray, b: np.ndarray, shift: int, links: Links, cosine: float, mirror: bool) -> None:
    """Links of points ``a`` of one tree with ``b`` of another, by matrix products; within one set once
    each. Single precision rules pairs out, with room for its rounding; the rest is decided in double."""
    floor = np.float32(cosine - 1e-5 - 1.2e-7 * one.points.shape[1])
    for i in range(0, len(a), _TILE):
        p = a[i : i + _TILE]
        for j in range(i if mirror else 0, len(b), _TILE):
            q = b[j : j + _TILE]
            x, y = np.nonzero(one.short[p] @ two.short[q].T >= floor)
            if mirror and i == j:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), 1 << 16):
                u, v = p[x[k : k + (1 << 16)]], q[y[k : k + (1 << 16)]]
                yes = np.einsum("ij,ij->i", one.points[u], two.points[v]) >= cosine
                if yes.any():
                    links.pairs(u[yes], v[yes] + shift)


def traverse(one: Tree, two: Tree, shift: int, links: Links, cosine: float) -> None:
    """Links between two trees, or within one if both are the same. Points of the second are numbered
    from ``shift``."""
    same, most = one is two, float(np.sqrt(2 - 2 * cosine))
    todo = [(0, 0)] if len(one.points) and len(two.points) else []
    while todo:
        x, y = todo.pop()
        mirror = same and x == y
        if mirror and 2 * one.radius[x] <= most - SLACK:
            links.within(one.members(x))
            continue
        if one.children[x] is None and two.children[y] is None:
            a, b = one.members(x), two.members(y)
            if not mirror:
                # Points too far from the other centre for its reach fall out before the product.
                a = a[distances(one.points[a], two.points[two.centre[y]][None])[:, 0] <= most + two.radius[y] + SLACK]
                b = b[distances(two.points[b], one.points[one.centre[x]][None])[:, 0] <= most + one.radius[x] + SLACK]
            compare(one, two, a, b, shift, links, cosine, mirror)
            continue
        na, nb = one.below(x), two.below(y)
        for i in range(0, len(na), _CHUNK):
            part = na[i : i + _CHUNK]
            gap = distances(one.points[one.centre[part]], two.points[two.centre[nb]])
            reach = one.radius[part][:, None] + two.radius[nb][None, :]
            near = gap <= most + reach + SLACK
            if mirror:
                near &= part[:, None] < nb[None, :]
            p, q = np.nonzero(near)
            full = gap[p, q] + reach[p, q] <= most - SLACK
            for u, v, whole in zip(part[p].tolist(), nb[q].tolist(), full.tolist(), strict=True):
                if whole:
                    links.whole(one.members(u), two.members(v) + shift)
                else:
                    todo.append((u, v))
        if mirror:
            todo += [(int(n), int(n)) for n in na]


def units_of(raw: pa.Array, width: int) -> np.ndarray:
    """Unit vectors of lists of one width."""
    flat = raw.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    # Scaled by the largest component first, so squares neither overflow nor vanish.
    units = flat / np.abs(flat).max(1, keepdims=True)
    return units / np.sqrt((units * units).sum(1, keepdims=True))


class Top:
    """The top of the tree over a sample: which cell a vector belongs to, and which cells may link."""

    def __init__(self, sample: np.ndarray, cells: int = CELLS):
        tree = Tree(sample, cells)
        self.children = [None if c is None else np.arange(*c) for c in tree.children]
        # The node that opened last may have passed the number of cells; such nodes are closed again.
        for last in reversed([n for n, c in enumerate(self.children) if c is not None]):
            if len(self._paths()) <= cells:
                break
            self.children[last] = None
        self.centres = sample[tree.centre]
        self.paths = self._paths()
        self.depth = max(map(len, self.paths.values()))

    def _paths(self) -> dict[int, list[int]]:
        """The nodes from the root to each cell."""
        out, todo = {}, [[0]]
        while todo:
            path = todo.pop()
            below = self.children[path[-1]]
            if below is None:
                out[path[-1]] = path
            else:
                todo += [[*path, n] for n in below.tolist()]
        return out

    def descend(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and its distances to the centres on the way, the root's first; not a
        number beyond the cell."""
        cell = np.zeros(len(units), np.int64)
        far = np.full((len(units), self.depth), np.nan)
        groups = [(0, 0, np.arange(len(units)))] if len(units) else []
        while groups:
            node, depth, rows = groups.pop()
            far[rows, depth] = distances(units[rows], self.centres[node : node + 1])[:, 0]
            cell[rows] = node
            if self.children[node] is not None:
                near = self.children[node][distances(units[rows], self.centres[self.children[node]]).argmin(1)]
                groups += [(int(n), depth + 1, rows[near == n]) for n in np.unique(near)]
        return cell, far

    def linked_cells(self, reach: dict[int, float], cosine: float) -> set[tuple[int, int]]:
        """Pairs of cells that may hold links, both ways and with themselves, by walking the top with
        itself. ``reach`` has the measured radius of each node that has vectors."""
        most = float(np.sqrt(2 - 2 * cosine))
        out, seen, todo = set(), {(0, 0)}, [(0, 0)]
        while todo:
            x, y = todo.pop()
            if self.children[x] is None and self.children[y] is None:
                out |= {(x, y), (y, x)}
                continue
            xs, ys = (
                np.array([n for n in ([z] if self.children[z] is None else self.children[z].tolist()) if n in reach])
                for z in (x, y)
            )
            if not len(xs) or not len(ys):
                continue
            wide = np.array([reach[n] for n in xs])[:, None] + np.array([reach[n] for n in ys])[None, :]
            near = distances(self.centres[xs], self.centres[ys]) <= most + wide + SLACK
            near |= xs[:, None] == ys[None, :]
            for u, v in zip(*(z.tolist() for z in np.nonzero(near)), strict=True):
                pair = (int(min(xs[u], ys[v])), int(max(xs[u], ys[v])))
                if pair not in seen:
                    seen.add(pair)
                    todo.append(pair)
        return out


def _home(i, j):
    """Which block of a pair the rows of the other pass by: each is home to about half of its pairs."""
    return F.when((i + j) % 2 == 0, F.least(i, j)).otherwise(F.greatest(i, j))


def walked(width_of_block: int, cosine: float):
    """Function for ``mapInArrow`` over rows sorted by block and kind: links within the block, and with
    the rows that pass by in slices."""
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("root_h", pa.int64())])

    def told(links: Links, ids: pa.Array, hashes: pa.Array) -> Iterator[pa.RecordBatch]:
        a = np.concatenate([np.zeros(0, np.int64), *links.a])
        b = np.concatenate([np.zeros(0, np.int64), *links.b])
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = np.arange(len(links.count))
        if len(nodes):
            root[nodes] = nodes[smallest_reachable(at[: len(a)], at[len(a) :], len(nodes))]
        linked = np.flatnonzero(links.count)
        own, to = pa.array(linked), pa.array(root[linked])
        yield pa.RecordBatch.from_arrays(
            [ids.take(own), hashes.take(own), pa.array(links.count[linked]), ids.take(to), hashes.take(to)], schema=schema)

    class Block:
        def __init__(self, table: pa.Table, width: int):
            self.ids, self.h = table["vec_id"].combine_chunks(), table["h"].combine_chunks()
            self.n = table["n"].to_numpy()
            self.tree = Tree(units_of(table["v"].combine_chunks(), width))

        def own(self) -> Iterator[pa.RecordBatch]:
            links = Links(self.n)
            traverse(self.tree, self.tree, 0, links, cosine)
            yield from told(links, self.ids, self.h)

        def passed(self, other: Block) -> Iterator[pa.RecordBatch]:
            links = Links(np.concatenate((self.n, other.n)))
            traverse(self.tree, other.tree, len(self.n), links, cosine)
            if links.a:
                both = [pa.concat_arrays([x, y]) for x, y in ((self.ids, other.ids), (self.h, other.h))]
                yield from told(links, *both)

    def blocks(parts: list[pa.RecordBatch]) -> dict[int, Block]:
        if not parts:
            return {}
        table = pa.Table.from_batches(parts)
        widths = table["width"].to_numpy()
        return {int(w): Block(table.filter(pa.array(widths == w)), int(w)) for w in np.unique(widths)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, passing, kept = None, [], [], None

        def pass_by() -> Iterator[pa.RecordBatch]:
            for width, other in blocks(passing).items():
                if width in kept:
                    yield from kept[width].passed(other)

        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch["block"].to_numpy() * 2 + batch["kind"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                block, kind = divmod(int(code[start]), 2)
                if block != number:
                    if passing:
                        yield from pass_by()
                    elif kept is None:
                        for own in blocks(parts).values():
                            yield from own.own()
                    number, parts, passing, kept = block, [], [], None
                if kind == 0:
                    parts.append(batch.slice(start, end - start))
                    continue
                if kept is None:
                    kept, parts = blocks(parts), []
                    for own in kept.values():
                        yield from own.own()
                passing.append(batch.slice(start, end - start))
                if sum(b.num_rows for b in passing) >= width_of_block:
                    yield from pass_by()
                    passing = []
        if passing:
            yield from pass_by()
        elif kept is None:
            for own in blocks(parts).values():
                yield from own.own()

    return run


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row for each vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other vectors at a cosine of at least ``cosine``; ``component_id`` is the
    smallest id that links reach. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, as do vectors of different lengths. Rows that repeat id and vector
    are one vector. An empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.

    A vector passes by the blocks that the walk over the top leaves it, none if its cells are far from
    others. Among evenly spread vectors of many dimensions reaches exceed the distance looked for and
    nothing is dropped; then all blocks of ``BLOCK`` vectors are compared, which is quadratic.
    """
    spark = vectors.sparkSession
    rows = written_once(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).distinct(), "vectors")
    sound = F.expr(
        "v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(v, x -> x != 0)"
    )
    node = F.struct(F.col("vec_id").alias("id"), F.col("h"))
    classes = rows.filter(sound).groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"))
    classes = written_once(classes.withColumns({"h": F.xxhash64("v"), "width": F.size("v")}), "classes")
    # A bounded sample; the top is of its commonest length, and vectors of other lengths are one more cell.
    sample = classes.orderBy("h").limit(SAMPLE).select("v", "width").toArrow()
    widths, counts = np.unique(sample["width"].to_numpy(), return_counts=True)
    width = int(widths[counts.argmax()]) if len(widths) else 1
    own = sample.filter(pa.array(sample["width"].to_numpy() == width))["v"].combine_chunks()
    top = Top(units_of(own, width)) if len(own) else None
    other = -1

    def assign(batches):
        for batch in batches:
            wide = batch["width"].to_numpy()
            cell = np.full(len(wide), other, np.int64)
            far = np.full((len(wide), top.depth), np.nan)
            mine = np.flatnonzero(wide == width)
            cell[mine], far[mine] = top.descend(units_of(batch["v"].take(pa.array(mine)), width))
            steps = pa.array(np.concatenate(([0], np.cumsum((~np.isnan(far)).sum(1)))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.ListArray.from_arrays(steps, pa.array(far[~np.isnan(far)]))],
                names=[*batch.schema.names, "cell", "far"])

    columns = "v array<double>, vec_id long, h long, n long, width int"
    celled = written_once(
        classes.select("v", "vec_id", "h", "n", "width").mapInArrow(assign, f"{columns}, cell int, far array<double>"), "cells")
    # One row for each cell and step of its path: at most CELLS cells.
    sizes = {r.cell: r.n for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    depths = celled.select("cell", F.posexplode("far").alias("depth", "d")).groupBy("cell", "depth").agg(F.max("d").alias("d"))
    reach: dict[int, float] = {}
    for r in depths.collect():
        at = top.paths[r.cell][r.depth]
        reach[at] = max(reach.get(at, 0.0), r.d)
    pairs = top.linked_cells(reach, cosine) if top else set()
    plan = _dealt(sizes, pairs | {(other, other)})
    groups = spark.createDataFrame(plan[0], "cell int, team int, base int, parts int")
    facing = spark.createDataFrame(plan[1], "team int, base2 int, parts2 int")
    # At most CELLS + 1 cells and as many teams, and the pairs of teams.
    placed = celled.drop("far").join(F.broadcast(groups), "cell")
    placed = placed.withColumn("own", (F.col("base") + F.pmod("h", F.col("parts"))).cast("int"))
    placed = placed.select("v", "vec_id", "h", "n", "width", "team", "own")
    blocks = max((b + p for _, _, b, p in plan[0]), default=1)
    stay = placed.withColumns({"block": F.col("own"), "kind": F.lit(0)})
    numbers = F.explode(F.sequence(F.col("base2"), F.col("base2") + F.col("parts2") - 1))
    passing = placed.join(F.broadcast(facing), "team").withColumn("block", numbers).withColumn("kind", F.lit(1))
    passing = passing.filter((F.col("block") != F.col("own")) & (_home(F.col("own"), F.col("block")) == F.col("block")))
    dealt = stay.unionByName(passing.drop("base2", "parts2")).drop("team", "own")
    dealt = dealt.repartition(min(4 * blocks, 20_000), "block").sortWithinPartitions("block", "kind", "h")
    found = dealt.mapInArrow(walked(_CHUNK * 8, cosine), "id long, h long, links long, root long, root_h long")
    found = written_once(found.select(
        F.struct("id", "h").alias("a"), "links", F.struct(F.col("root").alias("id"), F.col("root_h").alias("h")).alias("b")), "links")
    release(celled)
    label = components(found.filter("a != b"))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    known = classes.select("v", "n", node.alias("node"))
    known = known.join(links, known.node == links.a, "left").drop("a").join(label, "node", "left")
    known = known.select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce(F.col("label.id"), F.col("node.id")).alias("component_id"),
    )
    out = rows.join(known, "v", "left")
    component = F.coalesce("component_id", "vec_id").alias("component_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component,
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def _dealt(sizes: dict[int, int], pairs: set[tuple[int, int]]) -> tuple[list[tuple], list[tuple]]:
    """Cells as teams of blocks: a large cell is a team of several blocks, small ones that follow each
    other share one. Returns (cell, team, first block, blocks), and for each team those it faces."""
    total = sum(sizes.values())
    size = min(BLOCK, max(SMALL, -(-total // SPLIT)))
    teams: list[tuple[list[int], int, int]] = []
    block, filled = 0, size
    for cell, n in sorted(sizes.items()):
        parts = -(-n // size)
        if parts == 1 and teams and filled + n <= size and cell != -1 and teams[-1][0][-1] != -1:
            teams[-1][0].append(cell)
            filled += n
            continue
        teams.append(([cell], block, parts))
        block += parts
        filled = n if parts == 1 else size
    of = {cell: t for t, (cells, _, _) in enumerate(teams) for cell in cells}
    cells = [(cell, t, base, parts) for t, (own, base, parts) in enumerate(teams) for cell in own]
    faced = sorted({(of[a], of[b]) for a, b in pairs if a in of and b in of} | {(t, t) for t in range(len(teams))})
    return cells, [(a, teams[b][1], teams[b][2]) for a, b in faced]
