"""Host reputation, clusters and hard negatives against SQL and plain versions."""

import hashlib
from collections import Counter, defaultdict
from math import floor, isfinite

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recontact.llm import angular_negatives, common, reputation, simplex_clusters
from tests.compare import difference

URLS = [
    "http://A.Example.NET/en/1", "http://a.example.net/en/1?x#y", "https://a.example.net/de/2", "http://example.com/de/3",
    "http://www.example.com/de", "ftp://x.org/fr/4", "x.org/fr/4", "", None, "://", "http://", "http://net", "http://net/",
    "http://user:pw@b.co.uk:8080/en/5", "http://b.co.uk./en/6", "http://10.0.0.1/en/7", "http://[::1]:80/en/8", "http://ÀÉ.Org/FR/9",
    "http://notnet/", "http://x.net#/en/", "http://a://b/en/1", "http://multi\nline.com/en\n/2", "http://s.com/en/123456789012345678901",
    "http://deep.er.s.com/xx/12-3", "http://s.com/en/12x", "http://s.com/en/13",
]


def pages_and_labels():
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[2]), (None, None)]
    rows += [(100 + i, f"http://www.bad.com/en/{100 + i % 60}") for i in range(400)]
    rows += [(600 + i, f"http://h{i % 9}.good.com/en/{200 + i}") for i in range(90)]
    labels = [(i, 0 if i < 160 else 1, 0) for i in range(100, 160)] + [(200 + i, 1, int(i == 3)) for i in range(90)]
    labels += [(1, 1, 0), (1, 0, None), (2, None, None), (None, 0, 1), (3, None, 1), (100, 0, 0), (5, 1, None)]
    return rows, labels


def frames(spark, pages, labels):
    return (
        spark.createDataFrame(pages, "page_id long, url string").withColumns({n: F.lit("x") for n in ("host", "path", "rule", "doc", "n_pages", "bound", "_rest", "k")}),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"bad": F.lit(7), "n": F.lit(1), "doc": F.lit(2)}),
    )


@pytest.mark.parametrize("share", [256, 1])
def test_verdicts_equal_sql(spark, monkeypatch, share):
    pages, labels = pages_and_labels()
    plain = common.looked_up
    monkeypatch.setattr(reputation, "looked_up", lambda *a, **k: plain(*a, **k, share=share))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    got = reputation.judged(*frames(spark, pages, labels))
    problem, n = difference(got, con, reputation.judged_sql())
    assert problem is None, problem
    assert n == len(pages)


def test_rules_come_first_and_bad_hosts_are_blocked(spark):
    pages, labels = pages_and_labels()
    got = {(r.page_id, r.host, r.path): r for r in reputation.judged(*frames(spark, pages, labels)).collect()}

    def said(page, host, path):
        return got[(page, host, path)].rule, got[(page, host, path)].verdict

    assert said(0, "a.example.net", "/en/1") == ("example.net/en/", "allow")
    assert said(2, "a.example.net", "/de/2") == ("net/", "block")
    assert said(3, "example.com", "/de/3") == ("example.com/de/", "block")
    assert said(4, "www.example.com", "/de")[0] is None
    assert said(5, "x.org", "/fr/4") == ("org/fr/", "allow")
    assert said(6, "", "")[0] is None and said(8, "", "")[0] is None
    assert said(11, "net", "")[0] is None and said(12, "net", "/") == ("net/", "block")
    assert said(18, "notnet", "/")[0] is None and said(19, "x.net", "")[0] is None
    assert said(17, "ÀÉ.org", "/FR/9")[0] is None
    assert said(20, "a:", "//b/en/1")[0] is None
    verdicts = defaultdict(set)
    for r in got.values():
        if r.rule is None:
            verdicts[r.host].add(r.verdict)
    assert verdicts["www.bad.com"] == {"block"}
    assert all(verdicts[f"h{i}.good.com"] == {"allow"} for i in range(9))


def test_shrinkage_goes_from_host_to_domain_to_suffix(spark):
    rows = [("a.x.com", 50, 50), ("b.x.com", 50, 50), ("c.x.com", 0, 0), ("a.y.com", 50, 0), ("b.y.com", 50, 0), ("c.y.com", 0, 0), ("z.org", 0, 0), ("w.uk", 0, 0)]
    hosts = spark.createDataFrame([(h, 1, n, b) for h, n, b in rows], "host string, n_pages long, n_labelled long, n_bad long")
    got = {r.host: r for r in reputation.reputation(hosts).collect()}
    assert got["a.x.com"].rate > 0.9 and got["c.x.com"].rate > 0.8 and got["c.y.com"].rate < 0.2
    assert abs(got["z.org"].rate - 0.5) < 0.01
    assert got["a.x.com"].bound > got["c.x.com"].bound
    assert all(r.bound <= r.rate for r in got.values())


def test_no_pages_and_no_labels(spark):
    pages, labels = pages_and_labels()
    assert reputation.judged(*frames(spark, [], labels)).count() == 0
    got = reputation.judged(*frames(spark, pages, [])).collect()
    assert len(got) == len(pages) and {r.n_labelled for r in got} == {0}


def plain_clusters(rows, width, clusters, rounds):
    kept = [(i, [floor(256 * max(-(2**27) / 256, min(2**27 / 256, x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [list(x) for _, x in first]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, x in kept:
            own[near(x)[1]].append(x)
        centroids = [[sum(c) // len(c) for c in zip(*own[k], strict=True)] if k in own else c for k, c in enumerate(centroids)]
    told = [(i, *near(x)[::-1]) for i, x in kept]
    per = Counter()
    for _, k, d in told:
        per[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, k, d, per[k], sum(per.values()), digest[k]) for i, k, d in told)


def some_vectors(n=300, width=6, seed=5):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(size=(n, width)) * 0.2, np.ones((n // 4, width)) + rng.normal(size=(n // 4, width)) * 0.01, np.round(rng.normal(size=(n // 4, width)))])
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(points)]
    rows += [(900 + i, list(rows[1][1])) for i in range(60)] + [rows[0], rows[2], (None, rows[3][1]), (None, [0.0] * width)]
    odd = [None, [], [0.5], [0.1] * (width + 1), [float("nan")] + [0.0] * (width - 1), [None] + [1.0] * (width - 1), [float("-inf")] * width, [0.0] * width]
    return rows + [(1000 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize(("rows", "clusters"), [(some_vectors(), 12), (some_vectors()[:5], 12), ([(i, [0.25] * 6) for i in range(30)], 4), ([(0, [3e38] * 6), (1, [-3e38] * 6), (2, [1.0] * 6)], 2)])
def test_clusters_equal_plain_version(spark, rows, clusters):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({n: F.lit(0) for n in ("x", "cluster", "apex", "distance", "label")})
    got = simplex_clusters.clustered(table, width=6, clusters=clusters)
    assert Counter(tuple(r) for r in got.collect()) == plain_clusters(rows, 6, clusters, 5)


def test_no_vectors_no_clusters(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert simplex_clusters.clustered(table).count() == 0
    assert simplex_clusters.clustered(spark.createDataFrame([(1, [1.0])], table.schema)).count() == 0


@pytest.mark.parametrize("scale", [1, 300, 10**7])
def test_apexes_bound_the_distances(scale):
    rng = np.random.default_rng(scale)
    points = np.concatenate([rng.integers(-scale, scale + 1, (80, 16)), np.zeros((3, 16), int)])
    points = np.concatenate([points, points[:20] + (rng.random((20, 16)) < 0.1)])
    base = simplex_clusters.Base(points[:30])
    apex = base.placed(simplex_clusters.squares(points, base.pivots))
    true = np.sqrt(simplex_clusters.squares(points, points).astype(float))
    flat = ((apex[:, None, :-1] - apex[None, :, :-1]) ** 2).sum(2)
    slack = base.slack(apex, apex)[:, None]
    assert (np.sqrt(flat + (apex[:, None, -1] - apex[None, :, -1]) ** 2) <= true + slack).all()
    assert (np.sqrt(flat + (apex[:, None, -1] + apex[None, :, -1]) ** 2) >= true - slack).all()
    assert (slack < 0.05 * (1 + true.max())).all()


def test_a_centroid_far_away_is_not_compared(monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.integers(-5000, 5000, (10, 8))
    points = np.repeat(centres, 20, 0) + rng.integers(-3, 4, (200, 8))
    base = simplex_clusters.Base(centres)
    apex = base.placed(simplex_clusters.squares(points, base.pivots))
    over = base.placed(simplex_clusters.squares(centres, base.pivots))
    low = np.sqrt(((apex[:, None] - over[None]) ** 2).sum(2))
    assert (low > low.min(1, keepdims=True) + 100).sum() > 0.7 * low.size
    best, _ = simplex_clusters.nearest(points, apex, centres, base)
    assert (best == np.repeat(np.arange(10), 20)).all()


def plain_negatives(rows, every, positives, negatives, least, most):
    kept = {(i, lab, tuple(floor(256 * max(-65536, min(65536, x))) for x in v)) for i, lab, v in rows
            if lab is not None and v is not None and all(x is not None and isfinite(x) for x in v)}
    out = Counter()
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for a in kept:
        if a[0] is None or a[0] % every:
            continue
        scored = [(sum(p * q for p, q in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in kept if b != a and len(b[2]) == len(a[2])]
        scored.sort(key=order)
        for p, pid, _ in [s for s in scored if s[2] == a[1]][:positives]:
            good = [s for s in scored if s[2] != a[1] and least * p <= 100 * s[0] <= most * p][:negatives]
            for rank, (n, nid, _) in enumerate(good, 1):
                out[(a[0], pid, rank, nid, p, n)] += 1
    return out


def labelled_vectors(seed=4, n=260, width=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, width))
    rows = []
    for i in range(n):
        v = centre[i % 4] * 0.7 + rng.normal(size=width) * (0.3 if i % 3 else 1.0)
        rows.append((i, int(rng.integers(0, 3)) if i % 2 else 0, [float(np.float32(x)) for x in v]))
    rows += [(300 + i, i % 3, rows[10][2]) for i in range(20)]
    rows += [rows[0], rows[10], (None, 0, rows[20][2]), (None, 1, rows[0][2]), (400, None, rows[0][2]), (410, 1, None), (420, 1, []), (430, 2, []), (440, 1, [])]
    rows += [(450, 1, [float("nan")] * width), (460, 1, [None] * width), (470, 2, [0.0] * width), (480, 1, [0.0] * width), (490, 0, [1.0, 2.0]), (500, 1, [1.0, 2.0]), (510, 0, [1.5, 2.0]), (520, 1, [0.9, 1.0])]
    return rows + [(530, 0, [3e38] + [0.0] * (width - 1)), (540, 1, [-3e38] * width), (550, 0, [-x for x in rows[0][2]])]


@pytest.mark.parametrize(("small", "slice_rows"), [(2048, 256), (40, 7)])
def test_negatives_equal_brute_force(spark, monkeypatch, small, slice_rows):
    monkeypatch.setattr(angular_negatives, "SMALL", small)
    monkeypatch.setattr(angular_negatives, "_ROWS", slice_rows)
    rows = labelled_vectors()
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({n: F.lit(0) for n in ("x", "h", "block", "kind", "wanted", "rank", "score")})
    got = Counter(tuple(r) for r in angular_negatives.mined(table, every=10).collect())
    assert got == plain_negatives(rows, 10, 5, 3, 50, 95)
    assert sum(got.values()) > 100


def test_no_rows_no_negatives(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert angular_negatives.mined(none).count() == 0
    lone = spark.createDataFrame([(0, 1, [1.0]), (50, 2, None)], none.schema)
    assert angular_negatives.mined(lone).count() == 0


def test_intervals_hold_the_scores_and_rule_pairs_out():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(6, 16)) * 300
    x = (centre[rng.integers(0, 6, 400)] + rng.normal(size=(400, 16)) * 8).astype(int)
    refs = angular_negatives.directions(x[:50].tolist())
    import pyarrow as pa

    lists = pa.array(x.tolist(), pa.list_(pa.int32()))
    norms, angles = angular_negatives.measured(lists, refs)
    table = pa.table({"vec_id": pa.array(range(400)), "h": pa.array(range(400)), "label": pa.array([0] * 400), "norm": norms, "x": lists, "angles": pa.array(angles.tolist())})
    rows = angular_negatives.Rows(table)
    low, high = rows.intervals(slice(None), rows, np.arange(400))
    scores = x @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (high < scores.max(1, keepdims=True) * 0.9).mean() > 0.5
