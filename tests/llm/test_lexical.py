import math
import random
import re
from collections import Counter

import numpy as np

from gridloom.llm import lexical
from gridloom.llm.lexical import Block, terms, top_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k):
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, query in asked.items():
        found = []
        for i, c in counts:
            m = 50 + (50 * c.total() * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in query if c[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i, score))
        out += [(item, rank, f[3], f[4]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_terms():
    for t in ("", "a", "A-b_c", "Éa É x y 1.2", "\x00z\x7f~Z`[", "x" * 100_000 + " Q", "日本 語"):
        assert [x.decode() for x in terms(t.encode())] == words(t)


def test_whole_table(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in items.collect()], [(r.doc_id, r.text) for r in documents.collect()], 50)
    assert got(top_documents(items, documents)) == want


def _random(seed, n):
    rnd = random.Random(seed)
    return [(i, " ".join(f"w{min(int(rnd.paretovariate(0.7)), 400)}" for _ in range(rnd.randint(0, 60)))) for i in range(n)]


def test_blocks_ties_and_passes(spark, docs_of, monkeypatch):
    """Small blocks, several passes over the items, copies that tie beyond the k-th place."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 50)
    monkeypatch.setattr(lexical, "PASS_PAIRS", 40)
    docs = _random(1, 600) + [(1000 + i, "w1 w7 w9 w30") for i in range(80)]
    items = _random(2, 12) + [(3, "w9 w30"), (77, None), (78, "none of these"), (None, "w7 w9"), (79, "W1!w2")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert got(top_documents(frame, docs_of(docs).repartition(3), k=7)) == brute(items, docs, 7)


def test_odd_rows(spark, docs_of):
    docs = [(1, None), (2, ""), (3, "..."), (None, "a b"), (None, "a b"), (4, "a " * 300_000 + "b"), (5, "b" * 200_000), (6, "a b c"), (6, "a b c"), (7, "C c")]
    items = [(1, "a"), (2, "c b"), (2, "c b"), (3, ""), (4, "b" * 200_000)]
    frame = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, rank int, score string")
    assert got(top_documents(frame, docs_of(docs), k=3)) == brute(items, docs, 3)
    assert top_documents(frame, docs_of([])).collect() == []
    assert top_documents(frame.limit(0), docs_of(docs)).collect() == []


def test_accumulators_are_limited():
    """A common term opens none once rare ones have filled the first places; scores stay exact."""
    n = 10_000
    doc = np.r_[np.arange(n), np.arange(20)]
    block = Block(np.full(n, 10), doc, np.r_[np.zeros(n, int), np.ones(20, int)], np.ones(n + 20, np.int64), n, 10 * n)
    at, score, opened = block.search([(1, 5000), (0, 10)], 5)
    assert opened == 20 and sorted(at) == list(range(20))
    every, full, opened = block.search([(1, 5000), (0, 10)], 100)
    assert opened == n and set(full[:20]) == set(score)
