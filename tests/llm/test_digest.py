import math
import random

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import digest
from gridloom.llm.digest import census, digests, entropy_classes, filters, likeness, rank_table, to_chain, to_text, with_next


def brute_class(window):
    n = len(window)
    total = sum(round(c * math.log2(c) * (1 << 20)) for c in (window.count(b) for b in set(window)))
    whole = 6 * n << 20
    return (whole - total) * 1000 // whole


def test_entropy_classes():
    rng = random.Random(1)
    for data in (b"", b"a" * 63, b"a" * 200, bytes(range(64)) * 3, bytes(rng.choices(b"abc de", k=500)), rng.randbytes(300)):
        got = entropy_classes(np.frombuffer(data, np.uint8)).tolist()
        assert got == [brute_class(data[i:i + 64]) for i in range(len(data) - 63)]


def brute_features(text, rank):
    """Windows that win often enough among their 64 neighbours, by plain loops."""
    n = len(text) - 63
    value = [int(rank[brute_class(text[i:i + 64])]) for i in range(n)]
    wins = [0] * max(n, 0)
    for s in range(n):
        v, i = min((value[i], i) for i in range(s, min(s + 64, n)))
        if v <= 1000:
            wins[i] += 1
    return [i for i in range(n) if wins[i] >= 16]


def test_features_do_not_depend_on_neighbours():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abcdefgh iklmnoprst", k=rng.randint(0, 700))) for _ in range(30)] + [b"", b"x", b"y" * 500]
    rank = rank_table(np.arange(1001)[::-1])
    alone = [filters([t], rank)[0] for t in texts]
    for a, b in zip(alone, filters(texts, rank)):
        assert (a == b).all() and a.shape == b.shape
    joined = digest.Joined(texts)
    owner, _ = digest.features(joined, rank)
    for i, t in enumerate(texts):
        want = len(brute_features(t, rank)) or int(len(t) > 0)
        assert (owner == i).sum() == want
        assert (to_chain(to_text(alone[i])) == alone[i]).all()


def test_census(documents, docs_of):
    counts = census(documents)
    texts = [r.text.encode() for r in documents.limit(20).collect()]
    few = np.zeros(1001, int)
    for t in texts:
        few += np.bincount(entropy_classes(np.frombuffer(t, np.uint8)), minlength=1001)
    assert (census(documents.limit(20)) == few).all() and (counts >= few).all()
    assert census(docs_of([(1, None), (2, "short")])).sum() == 0


def pairs_of(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    return sorted(((i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)), key=repr)


def test_next(docs_of):
    rng = random.Random(3)
    for n in (1, 2, 5, 300):
        rows = [(rng.randint(0, 2 * n), f"text {k}" * rng.randint(0, 5)) for k in range(n)]
        if n > 2:
            rows += [(None, "last"), (None, None), (0, "é"), (0, "é")]
        got = with_next(docs_of(rows).repartition(3))
        assert sorted(((r.doc_id, r.text, r.next_text) for r in got.collect()), key=repr) == pairs_of(rows)
    assert with_next(docs_of([])).collect() == []


def test_likeness_tells_edits_from_others(documents):
    rank = rank_table(census(documents))
    pairs = with_next(documents).withColumn("half", F.expr("concat(substring(text, 1, cast(length(text) * 3 / 4 as int)), substring(next_text, 1, cast(length(text) / 4 as int)))"))
    names = {"text": "a", "half": "b", "next_text": "c"}
    rows = digests(pairs, names, rank, {"near_half": ("a", "b"), "near_next": ("a", "c")}).collect()
    long = [r for r in pairs.collect() if len(r.text) > 500]
    ids = {r.doc_id for r in long if r.text != r.next_text}
    near = [r.near_half for r in rows if r.doc_id in ids]
    far = [r.near_next for r in rows if r.doc_id in ids]
    assert all(0 <= x <= 1 for x in near + far)
    assert np.median(near) > 0.5 and np.quantile(near, 0.05) > np.quantile(far, 0.9)
    for r in rows[:50]:
        assert likeness(to_chain(r.a), to_chain(r.a)) == 1.0


def test_odd_rows(docs_of):
    rank = rank_table(np.ones(1001, int))
    rows = docs_of([(1, None), (1, None), (2, ""), (None, "x"), (4, "word " * 40_000)])
    out = digests(rows.select("doc_id", "text", "kept"), {"text": "fingerprint"}, rank).collect()
    assert [r.fingerprint for r in sorted(out, key=repr) if r.doc_id in (1, 2)] == ["", "", ""] and len(out) == 5
    assert likeness(to_chain(""), to_chain("")) == 1.0 and likeness(to_chain(""), filters([b"x"], rank)[0]) == 0.0
    assert digests(docs_of([]).select("doc_id", "text"), {"text": "fingerprint"}, rank).collect() == []
