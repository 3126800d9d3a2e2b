"""The whole pipeline against a plain version of each stage, on the given documents."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from recontact.llm import mixing, quality
from tests.llm.test_documents import em, shingles

STATS = "n_words word_chars n_symbols n_upper n_lines n_dup_lines n_repeat_words".split()


def stats(text):
    w = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    upper = sum("A" <= c <= "Z" for c in text)
    return (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), upper, len(lines), len(lines) - len(set(lines)), len(hit))


def good(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE s (k BIGINT, " + ", ".join(f"{c} BIGINT" for c in STATS) + ")")
    con.executemany("INSERT INTO s VALUES (?, ?, ?, ?, ?, ?, ?, ?)", [(k, *stats(t)) for k, (_, t, _) in enumerate(docs)])
    vote = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {fine} THEN 1 ELSE 0 END" for _, bad, fine in quality.RULES)
    rows = con.execute(f"SELECT n_words, n_repeat_words, {vote} FROM s ORDER BY k").fetchall()
    prior, caught, spared = em(Counter(r[2:] for r in rows))
    for doc, (n, repeats, *v) in zip(docs, rows, strict=True):
        odds = np.log(prior / (1 - prior))
        for j, x in enumerate(v):
            odds += np.log(spared[j] / (1 - caught[j])) if x == 1 else np.log((1 - spared[j]) / caught[j]) if x == -1 else 0
        if n >= 10 and 100 * repeats <= 20 * n and odds >= 0:
            yield doc


def without_runs(docs):
    """Without lines of runs that came before: of three lines, of fifty words, or whole documents."""
    seen = set()
    for doc_id, text, source in sorted(docs):
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for p in range(len(full)):
            for n in (1, 2, 3):
                if p + n > len(full):
                    break
                key = tuple(lines[k] for k in full[p : p + n])
                enough = n == 3 or n == len(full) or sum(len(x.encode().split()) for x in key) >= 50
                gone |= set(full[p : p + n]) if enough and key in seen else set()
                seen.add(key)
        words = {k: len(lines[k].encode().split()) for k in full}
        # A document that loses four fifths of its words goes.
        if not gone or 5 * sum(words[k] for k in gone) < 4 * sum(words.values()):
            yield doc_id, "\n".join(x for k, x in enumerate(lines) if k not in gone), source


def first_of_groups(docs):
    sets = [shingles(t) for _, t, _ in docs]
    low = [d[0] for d in docs]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                old, new = max(low[i], low[j]), min(low[i], low[j])
                low = [new if x == old else x for x in low]
    return [d for d, x in zip(docs, low, strict=True) if d[0] == x]


def mixed(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    texts = {d: t for d, t, _ in docs}
    return [(r[0], texts[r[0]], r[1]) for r in con.execute(mixing.mixing_sql()).fetchall()]


def test_pipeline_equals_its_plain_version(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = mixed(first_of_groups(list(without_runs(list(good(docs))))))
    assert 0 < len(rows) < len(docs) * 2
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text, source in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        want[doc_id, source, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    got = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.source, tuple(r.ids), r.decoded) for r in got) == want
    # The places tell copies apart and give back the order of the mix.
    assert len({(r.part, r.row) for r in got}) == len(got)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", first_of_groups(list(without_runs(list(good(docs))))))
    order = con.execute(f"SELECT doc_id FROM ({mixing.mixing_sql()}) ORDER BY \"at\", doc_id, copy").fetchall()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.part, r.row))] == [r[0] for r in order]
