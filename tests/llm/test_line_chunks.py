import random

from gridloom.llm import line_chunks
from gridloom.llm.line_chunks import chunks, remove_repeated


def brute(pairs):
    first, cut = {}, []
    for i, t in pairs:
        parts = []
        if t is not None:
            lines = t.split("\n")
            for k, (lo, hi) in enumerate(chunks(t.encode())):
                text = "\n".join(lines[lo:hi])
                several = sum(bool(x.encode().strip()) for x in lines[lo:hi]) > 1
                at = (i is None, i or 0, k)
                if several:
                    first[text] = min(first.get(text, at), at)
                parts.append((text, several, at, hi - lo))
        cut.append((i, t, parts))
    out = []
    for i, t, parts in cut:
        kept = [p for p in parts if not (p[1] and p[2] > first[p[0]])]
        text = None if t is None else "\n".join(p[0] for p in kept)
        out.append((i, text, sum(p[3] for p in parts), sum(p[3] for p in parts) - sum(p[3] for p in kept), len(parts) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_lines_removed, r.n_chunks_removed) for r in remove_repeated(df).collect()), key=repr)


def passage_table():
    rng = random.Random(8)
    shared = ["\n".join(f"shared line {p} {k}" for k in range(rng.randint(4, 30))) for p in range(5)]
    pairs = []
    for i in range(80):
        own = [f"own {i} {k} {rng.random()}" for k in range(rng.randint(0, 6))]
        pairs.append((rng.randint(0, 70), "\n".join(own + [rng.choice(shared)] * rng.randint(0, 2) + own[:2])))
    return pairs + [(3, None), (None, shared[0]), (None, shared[0]), (500, ""), (501, "\n" * 50), (502, "same\n" * 3000), (503, "same\n" * 3000), (504, "x" * 100_000)]


def test_against_plain_loops(docs_of):
    pairs = passage_table()
    want = brute(pairs)
    assert sum(r[4] for r in want) > 20
    df = docs_of(pairs)
    assert got(df) == want
    assert remove_repeated(df).columns == [*df.columns, "n_lines", "n_lines_removed", "n_chunks_removed"]


def test_equal_digests_of_different_passages(docs_of, monkeypatch):
    """With a poor digest, bytes still decide."""
    pairs = passage_table()
    want = brute(pairs)
    real = line_chunks.hash48
    monkeypatch.setattr(line_chunks, "_passage_digest", lambda p: b"one" if p.startswith(b"shared") else real(p).to_bytes(6, "big"))
    assert got(docs_of(pairs)) == want


def test_shift(docs_of):
    text = "\n".join(f"line {k} of a longer passage" for k in range(60))
    assert len(set(chunks(text.encode()))) > 8
    out = {r.doc_id: r for r in remove_repeated(docs_of([(1, text), (2, "one more\n" + text)])).collect()}
    assert out[1].n_lines_removed == 0 and out[2].n_lines_removed > 45


def test_empty_table(docs_of):
    assert remove_repeated(docs_of([])).collect() == []
