import random

from gridloom.llm import suffix_dedup
from gridloom.llm.suffix_dedup import remove_repeats


def brute(pairs, t=50):
    first = {}
    data = [(i, (x or "").encode()) for i, x in pairs]
    low = lambda i: (i is None, i or 0)
    for i, b in data:
        for p in range(len(b) - t + 1):
            w = b[p:p + t]
            first[w] = min(first.get(w, low(i)), low(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - t + 1):
            if first[b[p:p + t]] < low(i):
                gone[p:p + t] = b"\1" * t
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, kept))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def test_random_texts(docs_of, monkeypatch):
    rng = random.Random(3)
    passages = ["".join(rng.choices("abé ", k=rng.randint(40, 140))) for _ in range(12)]
    pairs = []
    for i in range(160):
        parts = [rng.choice(passages)[rng.randint(0, 20):] if rng.random() < 0.6 else "".join(rng.choices("abcdefgh ", k=30)) for _ in range(rng.randint(0, 5))]
        pairs.append((rng.randint(0, 150), "".join(parts)))
    pairs += [(7, None), (None, passages[0] * 2), (None, passages[0] * 2), (900, ""), (901, "a" * 49), (902, "a" * 50), (903, "a" * 5000), (904, "a" * 51)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    want = brute(pairs)
    assert sum(r[2] > 0 for r in want) > 40
    assert got(remove_repeats(docs_of(pairs).repartition(4))) == want


def test_whole_table(documents):
    pairs = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(remove_repeats(documents)) == brute(pairs)


def test_empty_table_and_columns(docs_of):
    out = remove_repeats(docs_of([]))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "n_bytes", "n_removed", "n_spans"] and not out.collect()


def test_other_thresholds(docs_of):
    rng = random.Random(5)
    pairs = [(i, "".join(rng.choices("ab", k=rng.randint(0, 60)))) for i in range(60)]
    for t in (1, 2, 9, 16):
        assert got(remove_repeats(docs_of(pairs), threshold=t)) == brute(pairs, t)
