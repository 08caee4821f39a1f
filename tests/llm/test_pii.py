import itertools
import random
import re

import numpy as np
import pytest

from gridloom.llm import pii
from gridloom.llm.pii import KINDS, OVERLAP, TRAIN, WINDOW, Tagger, base_spans, find, learn, luhn, read_windows, reconcile, spellings, windows_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


@pytest.fixture(scope="module")
def trained(spark):
    """A model learned from part of the documents, and the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return learn(docs.filter("doc_id % 4 <> 0")), docs.filter("doc_id % 4 = 0")


def test_patterns():
    rnd = random.Random(1)
    texts = ["", "a@b.c", "x@@y.z@q.r-.s..t", "@a.b", "a@b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3", "1.2.3.256.7.8.9", "00001.2.3.4", "+1 2", "+1  +12 (345) 678-9012)",
             "4111 1111-1111 1111", "4111-1111--1111", "é@ü.de é a.b@c.d", "a@b.c" * 50, "+" * 50 + "1.2.3.4@5.6"]
    texts += ["".join(rnd.choices("ab1234567890.@+- ()%é", k=rnd.randint(1, 120))) for _ in range(3000)]
    texts += ["".join(rnd.choices("41.+ 0", k=60)) for _ in range(1000)]
    for t in texts:
        raw = t.encode()
        found = [(k, len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b in base_spans(raw)]
        assert found == brute(t), t
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_long_runs():
    """Patterns stay linear on long runs of what they are made of."""
    for c in ("1", "a", "@", "+", ".", "1.", "a@", "+1 ", "a.", " -", "1-", "a@b."):
        base_spans((c * 400_000).encode())


def test_gradients():
    rnd = np.random.default_rng(0)
    tagger, codes = Tagger(3), rnd.integers(0, pii.CLASSES, (7, 4))
    tags = np.array([[0, 0, 1, 0], [1, 0, 1, 2], [1, 0, 0, 2], [0, 3, 0, 2], [0, 3, 0, 0], [0, 0, 4, 0], [0, 0, 4, 0]])
    for p, g in zip(tagger.params(), tagger.learn(codes, tags)[1]):
        for _ in range(8):
            at = tuple(rnd.integers(0, d) for d in p.shape)
            if p is tagger.embed:
                at = at[0], codes[rnd.integers(0, 7), rnd.integers(0, 4)]
            value, losses = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = value + step
                losses.append(tagger.learn(codes, tags)[0])
            p[at] = value
            assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-5


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(1)
    move = np.where(Tagger().barred, pii.NEVER, rnd.normal(0, 1, (5, 5))).astype(np.float32)
    lengths = np.array([5, 5, 3, 1])
    emit = rnd.normal(0, 2, (5, 5, 4)).astype(np.float32)
    got = pii._viterbi(move, emit.copy(), np.array([4, 3, 3, 2, 2]), lengths)
    for w, n in enumerate(lengths):
        best = max(itertools.product(range(5), repeat=int(n)), key=lambda p: sum(emit[t, x, w] for t, x in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
        assert tuple(got[:n, w]) == best


def test_windows_are_joined():
    n = 5 * WINDOW
    line = np.zeros(n, np.uint8)
    edge = WINDOW - OVERLAP
    want = [(1, 5, 30), (2, edge + 2, edge + 25), (3, edge + 40, edge + 60), (4, WINDOW - 5, WINDOW + 20), (1, 3 * edge - 40, 3 * edge + OVERLAP + 40), (2, n - 9, n)]
    for tag, lo, hi in want:
        line[lo:hi] = tag
    tags = {w: line[s:s + size].copy() for w, (s, size) in enumerate(windows_of(n)) if line[s:s + size].any()}
    assert reconcile(n, tags) == want
    # A neighbour that does not see a span at its rim has no say there.
    tags[0][edge:] = 0
    assert [s for s in reconcile(n, tags) if s[1] >= edge + OVERLAP // 2] == [s for s in want if s[1] >= edge + OVERLAP // 2]
    for size in (0, 1, WINDOW, WINDOW + 1, 2 * WINDOW - OVERLAP, 2 * WINDOW - OVERLAP + 1, 10_000):
        covered = sorted({c for s, k in windows_of(size) for c in (s, s + k)})
        assert not size or covered[0] == 0 and covered[-1] == size


def test_result_of_a_window_does_not_hang_on_its_neighbours(trained):
    model = trained[0]
    texts = ["call 4111 or a@b.c now", "é" * 40 + " x [at] y [dot] org", "1.2.3.4 " * 30]
    codes = [pii._encode(t) for t in texts]
    starts = np.cumsum([0, *map(len, codes)])
    both = dict(read_windows(model, np.concatenate(codes), starts[:-1], np.array([len(c) for c in codes])))
    for i, c in enumerate(codes):
        alone = dict(read_windows(model, c, np.array([0]), np.array([len(c)])))
        assert (i in both) == (0 in alone) and (i not in both or (both[i] == alone[0]).all())


def test_held_out_spellings(spark, trained):
    """Values of held-out documents, spelled as no pattern knows them, are found; documents as they are gain nothing."""
    model, docs = trained
    rnd, rows, want = random.Random(4), [], {}
    for r in docs.collect():
        spans = brute(r.text)
        for kind, a, b in spans:
            if len(rows) < 400 and not any(x < b + 60 and y > a - 60 for _, x, y in spans if (x, y) != (a, b)):
                form = spellings(kind, r.text[a:b], rnd)
                want[len(rows)] = (kind, a, a + len(form))
                rows.append((len(rows), r.text[:a] + form + r.text[b:]))
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in find(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    hits = {k: [want[i] in found[i] for i in want if want[i][0] == k] for k in KINDS}
    assert all(len(h) > 20 for h in hits.values())
    assert all(sum(h) >= 0.75 * len(h) for h in hits.values()) and sum(map(sum, hits.values())) >= 0.85 * len(want), {k: sum(h) / len(h) for k, h in hits.items()}
    added = [s for r in find(docs, model).collect() for s in r.spans if not s.base]
    assert len(added) <= 2, added


def test_whole_table(documents, trained):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in find(documents, trained[0]).collect()}
    assert got == {r.doc_id: brute(r.text) for r in documents.collect()}


def test_query(spark, documents):
    import hashlib

    from gridloom.llm.queries import op11

    text = {r.doc_id: r.text for r in documents.collect()}
    rows = op11(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(text)
    for r in rows:
        spans = brute(text[r.doc_id])
        joined = [":".join(map(str, s)) for s in spans]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest() and set(joined) <= set(r.spans.split(",")) | {""}
    assert any(r.n_card for r in rows) or any(r.n_email for r in rows)


def test_odd_rows(docs_of, trained):
    model = trained[0]
    pairs = [(1, None), (2, ""), (None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c"), (4, "é " * 100_000 + "+1 (988) 555-2485"), (5, "7" * 5_000), (6, "x" * 2000 + " bob [at] mail [dot] org " + "y" * 2000)]
    for m in (model, None):
        got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.base]) for r in find(docs_of(pairs), m).collect()), key=repr)
        assert got == sorted(((i, brute(t)) for i, t in pairs), key=repr)
    # The plain patterns above take the square of such a run; it has no value.
    assert [r.spans for r in find(docs_of([(1, "7" * 300_000)]), model).collect()] == [[]]
    assert find(docs_of([]), model).collect() == []
    assert learn(docs_of([])) is None and learn(docs_of([(1, "no such thing"), (2, None)])) is None


def test_training_windows_hold_their_spans():
    rows = [("x" * 96 + "a@b.cd" + " y" * 48, 96, 102, "email"), ("plain", 0, 0, None), ("1.2.3.4", 0, 7, "ip")]
    for codes, tags in pii.training_windows(rows):
        assert len(codes) == len(tags) == TRAIN
    assert {int(t.max()) for _, t in pii.training_windows(rows)} == {0, 1, 2}
