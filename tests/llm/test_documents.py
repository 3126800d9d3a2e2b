"""Operators on documents against brute force, on rows with every edge case, and on empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict
from math import log10

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recontact.llm import bpe, common, lattice, line_dedup, mixing, ngram_join, quality, queries, substring
from tests.compare import difference
from tests.llm.conftest import edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def con(edge):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", edge_rows())
    return con


def test_encoding_equals_the_library(clashing):
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in edge_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), sha(" ".join(map(str, ids))), sha(back)] += 1
    assert bag(bpe.digests(clashing, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_encoding_keeps_columns_and_skips_unknown_ids(edge, spark):
    rows = bpe.decoded(bpe.encoded(edge, PATH), PATH)
    assert rows.columns == [*edge.columns, "ids", "decoded"]
    odd = spark.createDataFrame([(1, [320, -1, 99_999_999]), (2, None), (3, [])], "k int, ids array<int>")
    told = {r.k: r.decoded for r in bpe.decoded(odd, PATH).collect()}
    assert told == {1: Tokenizer.from_file(PATH).id_to_token(320), 2: "", 3: ""}


@pytest.mark.parametrize("word", ["a" * 999, "aab" * 50, "!?" * 77, "abababab"])
def test_overlapping_pairs_merge_from_the_left(word):
    ids = Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids
    assert np.frombuffer(bpe.Encoder(PATH).encode([word])[0], np.int32).tolist() == ids


@pytest.mark.parametrize("memory", [0, 3, 200_000])
def test_ids_do_not_depend_on_what_is_remembered(monkeypatch, memory):
    monkeypatch.setattr(bpe, "MEMORY", memory)
    library, encoder = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    texts = [t or "" for _, t, *_ in edge_rows()] + ["ÀÉ, É. É, don't DON'T x'S", "ΑΣ σ ς ͰͰ", "a<|endoftext|>b <|startoftext|>", "\x1c \x1d"]
    for _ in range(3):
        for text in texts:
            ids = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == ids
    assert len(encoder.old) <= memory + 20_000


def brute_windows(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        yield w, gone


@pytest.mark.parametrize("chunk_bytes", [None, 3000])
def test_substring_dedup_equals_brute_force(clashing, monkeypatch, chunk_bytes):
    if chunk_bytes:
        monkeypatch.setattr(substring, "chunk_count", lambda docs: 23)
    rows = edge_rows()
    want = Counter()
    for (doc_id, *_), (w, gone) in zip(rows, brute_windows([r[1] for r in rows], 35), strict=True):
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[doc_id, len(w), sum(gone), sha(kept)] += 1
    assert sum(k[2] for k in want) > 0
    assert bag(substring.digests(clashing), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_line_dedup_equals_sql(clashing, edge, con):
    # SQL knows documents by their id alone, so ids must be unique and present there.
    unique = edge.filter("doc_id IS NOT NULL").filter("text IS NULL OR text != 'other text of a known id'").dropDuplicates(["doc_id"])
    con.execute("CREATE OR REPLACE VIEW all_documents AS SELECT DISTINCT * FROM documents WHERE doc_id IS NOT NULL AND (text IS NULL OR text != 'other text of a known id')")
    problem, n = difference(line_dedup.digests(unique), con, line_dedup.digests_sql().replace("FROM documents", "FROM all_documents"))
    assert problem is None, problem
    assert n == 23
    rows = line_dedup.deduped(clashing)
    assert rows.columns == [*clashing.columns, "_n_lines", "_n_deleted", "_n_gaps", "_n_words", "_n_cut", "_runs"]
    assert rows.count() == clashing.count()


def many_equal_rows(spark):
    """A third of the rows repeat one document, another third one text without id."""
    rows = edge_rows()
    copies = [(77, "w1 w2 w3 " * 20 + "end", "en", "src0", 1)] * 90 + [(None, "v1 v2 v3 " * 20, "en", None, None)] * 90
    return [*rows, *copies], spark.createDataFrame([*rows, *copies], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("sent", [200_000, 0])
def test_many_equal_rows_are_one_row_of_a_chunk(spark, monkeypatch, sent):
    monkeypatch.setattr(common, "MOST_SENT", sent)
    rows, docs = many_equal_rows(spark)
    told = common.with_times(docs, group_bytes=5000)
    assert sorted(r.times for r in told.filter("times > 1").collect()) == [90, 90]
    assert told.agg(F.sum("times")).first()[0] == len(rows)
    assert bag(common.as_often(told), "doc_id", "text") == Counter((r[0], r[1]) for r in rows)
    sizes = common.chunked(told, 4).groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("n")).select("n").toPandas()["n"]
    assert sizes.max() < 1.2 * sum(len((t or "").encode()) for _, t, *_ in edge_rows())


def test_operators_count_equal_rows_as_often(spark, monkeypatch):
    rows, docs = many_equal_rows(spark)
    plain = common.with_times
    for module in (substring, lattice):
        monkeypatch.setattr(module, "with_times", lambda *a: plain(*a, group_bytes=5000))
        monkeypatch.setattr(module, "chunk_count", lambda docs: 5)
    want = Counter()
    for (doc_id, *_), (w, gone) in zip(rows, brute_windows([r[1] for r in rows], 35), strict=True):
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[doc_id, len(w), sum(gone), sha(kept)] += 1
    assert bag(substring.digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    have = Counter((*r[:5], round(r.base_score, 6)) for r in lattice.scored(docs, PIECES).drop("score").collect())
    assert have == Counter(brute_scores(rows))


def test_cells_grow_with_the_input():
    cells = [common.bucket_count(c) * c for c in (13, 64, 3750)]
    assert cells[0] == 13 * 13 and cells[1] == 64 * 16 and cells[2] == 3750 * 938


def plain_runs(texts, min_lines, min_words):
    """Kept text and maximal deleted runs of each text, by looking up every run of every length."""
    docs = []
    for text in texts:
        lines = text.split("\n")
        docs.append((lines, [k for k, x in enumerate(lines) if x.encode().split()]))
    seen, out = set(), []
    for lines, full in docs:
        n, own, longest = len(full), [lines[k] for k in full], {}
        for p in range(n):
            for m in range(1, n - p + 1):
                run = tuple(own[p : p + m])
                words = sum(len(x.encode().split()) for x in run)
                if run in seen and (m >= min_lines or m == n or (min_words is not None and words >= min_words)):
                    longest[p] = m
            # Overlapping copies count, so a start's runs are known to the next start.
            seen.update(tuple(own[p : p + m]) for m in range(1, n - p + 1))
        gone = {k for p, m in longest.items() for k in range(p, p + m)}
        runs = []
        for p, m in sorted(longest.items()):
            if not runs or p + m > runs[-1][1]:
                runs.append((p, p + m))
        kept = "" if n and len(gone) == n else "\n".join(x for k, x in enumerate(lines) if k not in {full[g] for g in gone})
        out.append((kept, len(gone), runs))
    return out


RUNS = [
    "a\nb\nc\nd\ne\nf", "x\nb\nc\nd\ne\nf\ny", "z\nz\nz\nz\nz\nz\nz", "b\n\nc\nd\nq\ne\nf", "a\nb", "a\nb", "q\na\nb", "one", "one",
    "\n".join(f"l{i}" for i in range(40)), "k\n" + "\n".join(f"l{i}" for i in range(3, 38)) + "\nb\nc\nd", "l5\nl6\nl7\nl8\nl20\nl21\nl22",
    "", " \n\t", "w1 w2 w3 w4 w5 w6\nshort", "new\nw1 w2 w3 w4 w5 w6\nshort",
]


@pytest.mark.parametrize(("min_lines", "min_words"), [(1, None), (2, 6), (3, None), (3, 6), (5, 6)])
def test_line_dedup_equals_plain_runs(spark, min_lines, min_words):
    docs = spark.createDataFrame(list(enumerate(RUNS)), "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.deduped(docs, min_lines, min_words).collect()}
    for i, (kept, n, _) in enumerate(plain_runs(RUNS, min_lines, min_words)):
        assert (got[i].text, got[i]._n_deleted) == (kept, n)
        own = [x for x in RUNS[i].split("\n") if x.split()]
        covered = {k for a, b in got[i]._runs for k in range(a, b)}
        assert len(covered) == n
        # Each run occurs before as a whole.
        for a, b in got[i]._runs:
            run = own[a:b]
            others = [[x for x in t.split("\n") if x.split()] for t in RUNS[: i + 1]]
            assert any(o[k : k + b - a] == run for j, o in enumerate(others) for k in range(len(o) - (b - a) + 1) if (j, k) < (i, a))
    assert [tuple(r) for r in got[10]._runs] == [(1, 36)] + [(36, 39)] * (min_lines <= 3)


def test_long_passages_of_few_lines_are_cut(spark):
    long, half = " ".join(f"w{i}" for i in range(60)), " ".join(f"h{i}" for i in range(30))
    texts = [f"{long}\nx\n{half}\n{half}y", f"a\n{long}\nb", long, f"{half}\n\n{half}y\nc", f"{half}\nd", "x\nd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r._n_deleted) for r in line_dedup.deduped(docs, min_words=50).collect()}
    want = [(texts[0], 0), ("a\nb", 1), ("", 1), ("\nc", 2), (texts[4], 0), (texts[5], 0)]
    assert got == dict(enumerate(want))


@pytest.mark.parametrize("min_words", [line_dedup.MIN_WORDS, line_dedup.PASSAGE_WORDS])
def test_line_dedup_of_the_documents_equals_sql(spark, sf_dir, min_words):
    path = f"{sf_dir}/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    docs = spark.read.parquet(path)
    problem, _ = difference(line_dedup.digests(docs, min_words), con, line_dedup.digests_sql(min_words))
    assert problem is None, problem


def test_no_line_of_ten_words_stays_twice(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = Counter(
        line for r in line_dedup.deduped(docs).select("text").collect() for line in (r.text or "").split("\n") if len(line.encode().split()) >= 10
    )
    assert max(lines.values()) == 1


def test_passage_form_on_odd_rows(clashing, none):
    rows = line_dedup.deduped(clashing, min_words=line_dedup.PASSAGE_WORDS)
    assert rows.columns[: len(clashing.columns)] == clashing.columns
    assert rows.count() == clashing.count()
    assert line_dedup.digests(none, line_dedup.PASSAGE_WORDS).count() == 0


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def test_ngram_join_equals_brute_force(clashing):
    got = ngram_join.joined(clashing).collect()
    ids = {}  # row key of each document: its id, or the hash the operator gives a text without id
    for r in got:
        ids.setdefault(r.row_key, r)
    rows = edge_rows()
    assert len(got) == len(rows)
    hashed = {r.row_key for r in got if r.doc_id is None}
    assert len(hashed) == 2
    key_of_base = next(r.row_key for r in got if r.doc_id is None and r.copy_id == 0)
    classes = defaultdict(set)
    for doc_id, text, *_ in rows:
        if doc_id is not None or text is not None:
            classes[shingles(text)].add(key_of_base if doc_id is None else doc_id)
    full = [s for s in classes if s]
    links = Counter()
    group = {s: s for s in full}
    for i, a in enumerate(full):
        for b in full[:i]:
            if 5 * len(a & b) >= 4 * len(a | b):
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = {s: new if g == old else g for s, g in group.items()}
    assert sum(links.values()) >= 4
    want = Counter()
    for doc_id, text, *_ in rows:
        s = shingles(text)
        if doc_id is None and text is None:
            continue
        own = key_of_base if doc_id is None else doc_id
        near = min(min(classes[x]) for x in full if group[x] == group[s]) if s else own
        want[doc_id, min(classes[s]) if s else own, links[s], near, near == own] += 1
    have = Counter((r.doc_id, r.copy_id, r.n_links, r.class_id, r.kept) for r in got if r.row_key in {*want_keys(rows), key_of_base})
    assert have == want


def want_keys(rows):
    return {doc_id for doc_id, *_ in rows if doc_id is not None}


def test_ngram_join_splits_large_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:i], f"v{i}", *words[i + 1 :]])) for i in range(60)]
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [shingles(t) for _, t in rows]
    for i, a in enumerate(sets):
        assert got[i] == (sum(5 * len(a & b) >= 4 * len(a | b) for b in sets) - 1, 0)


def test_one_document_of_each_group_stays(clashing):
    rows = ngram_join.one_of_each(clashing)
    assert rows.columns == clashing.columns
    texts = Counter(shingles(r.text) for r in rows.collect() if shingles(r.text))
    assert max(texts.values()) == 1


def test_unlike_texts_of_one_id_stay(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:30], "changed", *words[31:]])
    other, third = (" ".join(f"{c}{i}" for i in range(20)) for c in "xy")
    rows = [(0, " ".join(words)), (3, near), (3, other), (3, other), (3, third), (3, third + " end"), (4, None), (4, ""), (4, "word"), (None, other)]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r.text)
    assert by_id[0] == [" ".join(words)]
    # The hash that stands for a missing id decides whether that row or the one of id 3 stays.
    assert len(by_id[None]) + by_id[3].count(other) == 1
    assert sorted(set(by_id[3]) - {other}) == [third]
    assert len(by_id[4]) == 2 and "word" in by_id[4]


def test_posterior_bounds_are_tight():
    least = ngram_join.least_matches()
    assert least == sorted(least) and all(m <= (i + 1) * ngram_join.LOOK for i, m in enumerate(least))
    assert least[-1] >= ngram_join.HASHES // 2


def test_rules_count_words_symbols_lines_and_repeats(clashing):
    want = Counter()
    for doc_id, text, *_ in edge_rows():
        text = text or ""
        w = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
        chars = sum(len(x.decode()) for x in w)
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        want[doc_id, len(w), chars, sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed] += 1
    got = quality.judged(clashing)
    assert bag(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert got.filter("base_failed AND kept").isEmpty()
    assert quality.keep_good(clashing).columns == clashing.columns


def test_em_finds_the_junk_of_the_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    told = quality.judged(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in told.collect()}
    assert share[1] > 0.95 and share[0] < 0.1


def em(counts):
    """The rounds of the model in plain Python."""
    rules = len(quality.RULES)
    prior, caught, spared = quality.PRIOR, [quality.CAUGHT] * rules, [quality.SPARED] * rules
    inside = lambda name, x: min(quality.BOUNDS[name][1], max(quality.BOUNDS[name][0], x))
    for _ in range(quality.ROUNDS):
        told = []
        for v, n in counts.items():
            odds = np.log(prior / (1 - prior))
            for j, x in enumerate(v):
                odds += np.log(spared[j] / (1 - caught[j])) if x == 1 else np.log((1 - spared[j]) / caught[j]) if x == -1 else 0
            told.append((v, n, 1 / (1 + np.exp(-odds))))
        prior = inside("prior", sum(n * q for _, n, q in told) / sum(n for _, n, _ in told))
        rate = lambda j, vote, start, w: (quality.SMOOTH * start + sum(w(n, q) for v, n, q in told if v[j] == vote)) / (quality.SMOOTH + sum(w(n, q) for v, n, q in told if v[j]))
        caught = [inside("caught", rate(j, -1, quality.CAUGHT, lambda n, q: n * (1 - q))) for j in range(rules)]
        spared = [inside("spared", rate(j, 1, quality.SPARED, lambda n, q: n * q)) for j in range(rules)]
    return prior, caught, spared


def test_em_equals_plain_rounds(spark, sf_dir):
    stats = quality.text_stats(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("v", quality.votes())
    counts = {tuple(r.v): r["count"] for r in stats.groupBy("v").count().collect()}
    got = quality.fitted(stats).first().m
    prior, caught, spared = em(counts)
    assert np.allclose([got.prior, *got.caught, *got.spared], [prior, *caught, *spared], atol=1e-9)


def test_mixing_equals_sql(clashing, con):
    weights = {"src0": 0.7, "src1": 0.1, "src2": 0.0, "*": 3.0}
    rows = mixing.mixed_sources(clashing, weights).select(
        "doc_id", "source", F.col("_copy").alias("copy"), F.col("_at").alias("at"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_text"),
    )
    assert set(clashing.columns) < set(mixing.replicated(clashing, weights).columns)
    # SQL counts repeated rows once for each distinct row, so they are compared without them.
    want = Counter(con.execute(mixing.mixing_sql(weights).replace("GROUP BY ALL", "GROUP BY ALL")).fetchall())
    have = Counter(tuple(r) for r in rows.select("doc_id", "source", "copy", "at", "n_text").collect())
    once = {k for k, n in Counter((r[0], r[3]) for r in edge_rows()).items() if n == 1}
    pick = lambda c: {k: n for k, n in c.items() if (k[0], k[1]) in once}
    assert pick(have) == pick(want) and pick(have)


def test_large_rates_meet_their_targets(spark):
    rows = [(i, "x" * 10, "rare") for i in range(50)] + [(100 + i, "x" * 10, "common") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    told = {r.source: r["count"] for r in mixing.replicated(docs, {"rare": 0.5, "common": 0.5, "*": 0}).groupBy("source").count().collect()}
    assert abs(told["rare"] - 2525) < 250 and abs(told["common"] - 2525) < 250


def brute_scores(rows):
    texts = [(i, (t or "").encode().lower().split()) for i, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = Counter(w for (_, ws), out in zip(texts, held, strict=True) if not out for w in ws)
    ends = held.count(False)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for (i, ws), out in zip(texts, held, strict=True):
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in ws) + log10((ends + 1) / (n + v + 1))
        yield i, out, len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n, round(base, 6)


def test_word_scores_equal_brute_force(clashing):
    got = lattice.scored(clashing, PIECES)
    have = Counter((*r[:5], round(r.base_score, 6)) for r in got.drop("score").collect())
    assert have == Counter(brute_scores(edge_rows()))
    assert got.filter("score IS NULL OR isnan(score) OR score > 0 OR score = -double('Infinity')").isEmpty()


def brute_lattice(pieces, word):
    text = "▁" + word
    logs = {}
    for length, (keys, values) in pieces.tables.items():
        for i in range(len(text) - length + 1):
            codes = np.frombuffer(text[i : i + length].encode("utf-32-le"), np.uint32)
            key = lattice._hashes(codes)[1][-1]
            at = np.searchsorted(keys, key)
            if at < len(keys) and keys[at] == key:
                logs[i, i + length] = values[at]
    total = np.full(len(text) + 1, -np.inf)
    total[0] = 0
    for end in range(1, len(text) + 1):
        for start in range(end):
            if (start, end) in logs:
                total[end] = np.logaddexp(total[end], total[start] + logs[start, end])
        if end > 1:
            spelled = pieces.bytes[np.frombuffer(text[end - 1].encode(), np.uint8)].sum()
            total[end] = np.logaddexp(total[end], total[end - 1] + spelled)
    return total[-1]


def test_lattice_sums_all_cuts():
    pieces = lattice.Pieces(PIECES, {i: i % 97 for i in range(3, 32000)}, 10)
    words = ["the", "thethe", "日本語", "x" * 70, "ﬁ▁▁", "é", "internationalization", "a"]
    got = pieces.score([w.encode() for w in words])
    assert np.allclose(got, [brute_lattice(pieces, w) for w in words])


def test_lattice_predicts_held_out_words_better_untrained(spark, sf_dir):
    """Trained on the corpus, the lattice beats one with equal weights on held-out documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    own = lattice.scored(docs, PIECES).filter("held_out").agg(F.sum("score")).first()[0]
    flat = lattice.Pieces(PIECES, {}, 0)
    words = [w for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for w in r.text.encode().lower().split()]
    assert own > flat.score(words).sum() / np.log(10) * 0.95


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op5", "op7", "op9", "op10"])
def test_empty_tables_give_no_rows(none, tmp_path, spark, name):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    run = next(f for n, f in queries.QUERIES.items() if n.startswith(f"{name}_"))
    assert run(spark, str(tmp_path)).count() == 0
