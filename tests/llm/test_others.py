"""Embeddings, archives, conversations, shared parts and the pipeline."""

import gzip
import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recontact.llm import chat, common, cover_tree, fixity, queries
from tests.compare import difference, duckdb_over

BYTES, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute_links(rows, cosine):
    """Links and smallest reachable id of distinct vectors."""
    rows = list(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows))
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = [unit(v) for _, v in rows]
    near = [[b for b, y in enumerate(units) if b != a and x is not None and y is not None and len(x) == len(y) and x @ y >= cosine] for a, x in enumerate(units)]
    low = [i for i, _ in rows]
    for _ in rows:
        low = [min([low[a], *[low[b] for b in near[a]]]) if near[a] else low[a] for a in range(len(rows))]
    return Counter((i, len(near[a]), low[a], low[a] == i) for a, (i, _) in enumerate(rows))


def vectors(seed=3, n=150):
    rng = np.random.default_rng(seed)
    far = rng.normal(size=(n, 8))
    tight = far[0] + rng.normal(size=(40, 8)) * 0.05
    chain = [[np.cos(a), np.sin(a), 0, 0, 0, 0, 0, 0] for a in np.arange(0, 1.5, 0.3)]
    rows = [*far.tolist(), *tight.tolist(), *chain, *[far[1].tolist()] * 30, (far[1] * 2).tolist()]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0], [1e30] * 8, [1e-30] * 8]
    out = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in enumerate([*rows, *odd])]
    return [*out, out[0], out[3]]


def sizes(monkeypatch, **more):
    for name, value in more.items():
        monkeypatch.setattr(cover_tree, name, value)


SMALL_SIZES = dict(BLOCK=24, SMALL=8, LEAF=4, _CHUNK=16, _TILE=8, CELLS=12)


@pytest.mark.parametrize("more", [{}, SMALL_SIZES, {**SMALL_SIZES, "SAMPLE": 30, "DENSE": 2}, {"SMALL": 16, "SPLIT": 40}])
def test_links_equal_brute_force(spark, monkeypatch, more):
    sizes(monkeypatch, **more)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({n: F.lit(1) for n in ("v", "h", "n", "cell", "width", "block", "kind", "far")})
    got = Counter(tuple(r) for r in cover_tree.linked(table).collect())
    assert got == brute_links(rows, 0.95)


def near_the_threshold(width, seed, gap=1e-5):
    """Two tight groups whose cosines lie within ``gap`` of 0.95, and a few such pairs apart."""
    rng = np.random.default_rng(seed)

    def unit(v):
        return v / np.sqrt(v @ v)

    rows = []
    for _ in range(3):
        a, b = unit(rng.normal(size=width)), rng.normal(size=width)
        b = unit(b - (a @ b) * a)
        for spread in (gap, gap / 10, 0.0):
            angle = np.arccos(0.95)
            rows += [a + rng.normal(size=width) * spread / width for _ in range(6)]
            rows += [np.cos(angle) * a + np.sin(angle) * b + rng.normal(size=width) * spread for _ in range(6)]
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("width", [2, 64, 300])
def test_links_near_the_threshold(spark, monkeypatch, width):
    sizes(monkeypatch, LEAF=4, _CHUNK=16, DENSE=3, SMALL=40)
    for seed in range(2):
        rows = near_the_threshold(width, seed)
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = Counter(tuple(r) for r in cover_tree.linked(table).collect())
        units = np.array([v for _, v in rows])
        units /= np.sqrt((units * units).sum(1, keepdims=True))
        cosines = units @ units.T
        edge = np.abs(cosines - 0.95)
        # The last bits of a product depend on its order, so pairs within them may go either way.
        if edge.min() > 1e-15:
            assert got == brute_links(rows, 0.95)
        by_id = {r[0]: r[1] for r in got}
        sure, maybe = (cosines >= 0.95 + 1e-14).sum(1) - 1, (cosines >= 0.95 - 1e-14).sum(1) - 1
        assert all(sure[i] <= by_id[i] <= maybe[i] for i in by_id)


def test_tight_groups_are_linked_as_wholes(monkeypatch):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(900, 32))
    points[:300] = points[0] + rng.normal(size=(300, 32)) * 0.003
    points /= np.sqrt((points * points).sum(1, keepdims=True))
    asked = []
    plain = cover_tree.compare
    monkeypatch.setattr(cover_tree, "compare", lambda *a: (asked.append(len(a[2]) * len(a[3])), plain(*a)))
    rows = rng.permutation(900)
    tree = cover_tree.Tree(points[rows])
    links = cover_tree.Links(np.ones(900, np.int64))
    cover_tree.traverse(tree, tree, 0, links, 0.95)
    assert (np.sort(links.count) == np.sort((points @ points.T >= 0.95).sum(1) - 1)).all()
    assert sum(asked) <= 600 * 600 + 9000


def test_far_cells_are_dropped_before_vectors_are_copied():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 64))
    points = np.repeat(centres, 50, 0) + rng.normal(size=(2000, 64)) * 0.005
    points /= np.sqrt((points * points).sum(1, keepdims=True))
    top = cover_tree.Top(rng.permutation(points)[:1000])
    cell, far = top.descend(points)
    reach = {}
    for c, row in zip(cell.tolist(), far, strict=True):
        for node, d in zip(top.paths[c], row, strict=False):
            reach[node] = max(reach.get(node, 0.0), d)
    pairs = top.linked_cells(reach, 0.95)
    used = set(cell.tolist())
    assert len(used) >= 40 and len(pairs & {(a, b) for a in used for b in used}) < 3 * len(used)
    near = {(int(cell[i]), int(cell[j])) for i, j in zip(*np.nonzero(points @ points.T >= 0.95), strict=True)}
    assert near <= pairs


def test_trees_nest_and_cover():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(300, 4)), np.ones((50, 4)), 1 + rng.normal(size=(200, 4)) * 0.01])
    points /= np.sqrt((points * points).sum(1, keepdims=True))
    tree = cover_tree.Tree(points)
    assert sorted(tree.order) == list(range(len(points)))
    assert sum(c is not None for c in tree.children) > 1
    for node, children in enumerate(tree.children):
        own = tree.members(node)
        assert cover_tree.distances(points[tree.centre[node]][None], points[own]).max() <= tree.radius[node] + 1e-9
        if children:
            parts = np.concatenate([tree.members(c) for c in range(*children)])
            assert sorted(parts) == sorted(own)
            assert all(tree.radius[c] <= tree.radius[node] / 2 + 1e-6 or tree.closed[c] for c in range(*children))
            assert tree.centre[children[0]] == tree.centre[node]


def test_no_vectors(spark):
    assert cover_tree.linked(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in cover_tree.linked(bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


PAGES = [(i, f"http://h/{i}", f"<p>{'é' * (i % 7)}{i}") for i in range(700)] + [
    (800, None, None), (801, "u", ""), (None, "n", "<x"), (3, "http://h/3", "<p>again"), (802, "a\r\n\r\nWARC/1.1", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
]
PAGE_SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("volumes", [1, 5])
def test_audit_equals_sql(spark, monkeypatch, volumes):
    monkeypatch.setattr(fixity, "volume_count", lambda pages: volumes)
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA).withColumns({"volume": F.lit("x"), "digest": F.lit("y")})
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    total = sum(len((h or "").encode()) for *_, h in PAGES)
    problem, n = difference(fixity.audited_pages(pages), con, fixity.audit_sql(-(-total // volumes)))
    assert problem is None, problem
    assert n == len(PAGES)
    if volumes == 5:
        told = con.execute(f"SELECT DISTINCT status FROM ({fixity.audit_sql(-(-total // volumes))})").fetchall()
        assert {s for s, in told} == {"missing", "corrupt", "moved", "intact"}


def archived(spark, rows, path, volumes=3):
    fixity.write_archive(spark.createDataFrame(rows, PAGE_SCHEMA), path, volumes)
    return fixity.read_archive(spark, path)


def test_equal_replicas_have_equal_roots_and_extra_records_show(spark, tmp_path):
    a = archived(spark, PAGES, f"{tmp_path}/a")
    again = archived(spark, PAGES[::-1], f"{tmp_path}/b")
    more = archived(spark, [*PAGES, (9999, "zz", "<p>")], f"{tmp_path}/c")
    assert fixity.audit(a, again, 3).isEmpty()
    assert [r.status for r in fixity.audit(a, more, 3).collect()] == ["extra"]
    assert [r.status for r in fixity.audit(more, a, 3).collect()] == ["missing"]
    repeated = archived(spark, [*PAGES, *PAGES[-3:]], f"{tmp_path}/d")
    assert repeated.count() == len(PAGES) + 3
    assert fixity.audited_pages(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


def test_records_are_read_where_they_lie(spark, tmp_path):
    rows = {(r.volume, r.seq): r for r in archived(spark, PAGES[:90] + PAGES[-5:], f"{tmp_path}/a", 2).collect()}
    assert len(rows) == 95 and {r.page_id for r in rows.values()} >= {None, 802, *range(90)}
    for volume in (0, 1):
        files = list((tmp_path / "a" / f"volume={volume}").glob("part-*.gz"))
        assert len(files) == 1
        data = gzip.decompress(files[0].read_bytes())
        own = [rows[k] for k in sorted(rows) if k[0] == volume]
        assert own[0].start == 0 and own[-1].end == len(data)
        assert all(x.end == y.start for x, y in zip(own, own[1:], strict=False))
        for r in own:
            record = data[r.start : r.end]
            assert record.startswith(b"WARC/1.1\r\n") and hashlib.sha256(record).hexdigest() == r.digest


def test_bytes_that_are_no_record_are_told(spark, tmp_path):
    a = archived(spark, PAGES[:50], f"{tmp_path}/a", 1)
    clean = [tuple(r) for r in a.orderBy("seq").collect()]
    file = next((tmp_path / "a" / "volume=0").glob("part-*.gz"))
    data = gzip.decompress(file.read_bytes())
    at = clean[20][3]
    for broken, last in ((data[:at] + b"x" + data[at + 1 :], 20), (data[:-9], 49), (data + b"tail", 50), (b"", None)):
        got = list(fixity.records_of(broken))
        assert len(got) == (0 if last is None else last + 1)
        if got:
            assert got[-1][0] is None and got[-1][2] == len(broken)
            assert [g[1] for g in got[:-1]] == [c[3] for c in clean[:last]]
    (tmp_path / "b" / "volume=0").mkdir(parents=True)
    (tmp_path / "b" / "volume=0" / "part-0.gz").write_bytes(gzip.compress(data[:at] + b"x" + data[at + 1 :]))
    told = {r.seq: r.status for r in fixity.audit(a, fixity.read_archive(spark, f"{tmp_path}/b"), 1).collect()}
    assert told == {20: "corrupt", **dict.fromkeys(range(21, 50), "missing")}


TURNS = [
    (1, 1, "assistant", "b </s> \\[INST]"), (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", ""),
    (2, 0, "system", "<<SYS>> \\\\ <s>"), (2, 1, "user", None), (2, 2, "tool", "<<ROLE>>x<</ROLE>>"), (2, 3, "assistant", "é\n日 ퟿"),
    (3, 0, "assistant", "only"), (3, 1, "assistant", "two"), (4, None, None, "no role"), (None, 0, "user", "nobody"),
    (5, 0, "[INST]", "odd role"), (5, 0, "[INST]", "odd role"), (6, 0, "user", "a" * 50_000), (6, 1, "assistant", "\\" * 999),
]


def test_turns_come_back_from_the_ids(spark):
    table = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumns({"ids": F.lit(1), "turns": F.lit(2)})
    got = {r.conv_id: r for r in chat.digests(chat.with_sample(table), BYTES, PATTERN).collect()}
    own = defaultdict(list)
    for row in sorted([*TURNS, (-7, 0, "user", chat.SAMPLE), (-7, 1, "assistant", chat.SAMPLE)], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        own[row[0]].append((row[2] or "", row[3] or ""))
    assert set(got) == set(own)
    for k, turns in own.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        text = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (got[k].n_turns, got[k].turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_markup_is_never_made_from_texts(spark):
    template = chat.Template(BYTES, PATTERN)
    for _, _, role, text in TURNS:
        assert max(template.encode(text or ""), default=0) < template.first
        assert not any(c in chat.escaped(text or "") for c in chat.CONTROLS)
        assert chat.unescaped(chat.escaped(text or "")) == (text or "")
    ids, mask = template.assemble(["user", "assistant"], [template.encode("q"), template.encode("answer")])
    assert template.tokens.decode(ids[mask].tolist()) == "answer" and not mask[ids >= template.first].any()


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(none, BYTES, PATTERN).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(70)] + [(200, 200 + i) for i in range(1, 90)] + [(500, 500), (400, 401)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(71)}, **{200 + i: 200 for i in range(90)}, 400: 400, 401: 400}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packed_sets_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        values = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (common.unpack(common.pack(values)) == values).all()


def test_the_pipeline_keeps_the_columns_and_works_on_what_it_gets(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, counts = rows.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows, sf_dir).write.parquet(f"{tmp_path}/{i}")
        rows = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(rows.count())
        if i + 1 < len(corpus_pipeline.STAGES):
            assert rows.columns == names
    assert counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    assert "ids" in rows.columns


def test_the_pipeline_on_edge_rows(spark, edge, none):
    for docs in (edge, none):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, "")
        rows.collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, sf_dir, name):
    problem, n = difference(queries.QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), queries.ORACLE[name])
    assert problem is None and n > 0, problem
