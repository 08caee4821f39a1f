import random

import corpus_pipeline

from gridloom.llm.line_chunks import chunks, remove_repeated


def brute(pairs):
    """Text without the lines of any pair of neighbouring lines that an earlier place has."""
    first, out = {}, {}
    for last in (False, True):
        for i, t in sorted(pairs):
            lines = t.split("\n")
            full = [n for n, x in enumerate(lines) if x.strip()]
            drop = set()
            for a, b in zip(full, full[1:]):
                passage = "\n".join(lines[a:b + 1])
                if last and first[passage] != (i, a):
                    drop |= set(range(a, b + 1))
                first[passage] = min(first.get(passage, (i, a)), (i, a))
            out[i] = "\n".join(x for n, x in enumerate(lines) if n not in drop)
    return out


def test_short_passages_between_other_lines(spark, docs_of):
    rng = random.Random(2)
    pairs, shared = [], {}
    for k in range(60):
        shared[k] = [f"passage {k} line {n} {rng.random()}" for n in range(rng.randint(2, 10))]
        for copy in range(3):
            own = [f"own {k} {copy} {n} {rng.random()}" for n in range(rng.randint(2, 8))]
            at = rng.randint(1, len(own) - 1)
            pairs.append((100 * k + copy, "\n".join(own[:at] + shared[k] + own[at:])))
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs_of(pairs), "").collect()}
    before = dict(pairs)
    for i, t in before.items():
        if i % 100 == 0:
            assert out[i] == t
        else:
            assert out[i] == "\n".join(x for x in t.split("\n") if x not in shared[i // 100])


def test_pairs_against_plain_loops(docs_of):
    rng = random.Random(5)
    lines = ["", " ", "é", *(f"line {k}" for k in range(30))]
    pairs = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(150)] + [(500, "same\n" * 300), (501, "\n\n"), (502, "one")]
    got = {r.doc_id: r for r in remove_repeated(docs_of(pairs), pairs=True).collect()}
    want = brute(pairs)
    assert {i: r.text for i, r in got.items()} == want
    assert sum(r.n_lines_removed for r in got.values()) > 100
    assert all(r.n_lines == dict(pairs)[i].count("\n") + 1 for i, r in got.items())
    odd = {r.doc_id: r.text for r in remove_repeated(docs_of([(1, None), (None, "a\nb"), (2, "a\nb")]), pairs=True).collect()}
    assert odd == {1: None, 2: "a\nb", None: ""}


def test_stage_takes_chunks_beside_pairs(spark, docs_of):
    """The lines of a repeated chunk go with the blank ones at its ends, which no pair of lines has."""
    rng = random.Random(9)
    shared = ["\n".join([*(f"shared {p} line {k}" for k in range(20)), "", " ", ""]) for p in range(10)]
    pairs = [(i, f"own {i} {rng.random()}\n{shared[i % 10]}\nend {i} {rng.random()}") for i in range(30)]
    twos, first, want = brute(pairs), {}, {}
    for i, t in pairs:
        lines, drop = t.split("\n"), set()
        full = [n for n, x in enumerate(lines) if x.strip()]
        for a, b in zip(full, full[1:]):
            if first.setdefault("\n".join(lines[a:b + 1]), (i, a)) != (i, a):
                drop |= set(range(a, b + 1))
        for k, (lo, hi) in enumerate(chunks(t.encode())):
            if sum(bool(x.strip()) for x in lines[lo:hi]) > 1 and first.setdefault(("chunk", "\n".join(lines[lo:hi])), (i, k)) != (i, k):
                drop |= set(range(lo, hi))
        want[i] = "\n".join(x for n, x in enumerate(lines) if n not in drop)
    assert want != twos
    odd = [(100, None), (101, "\n\n"), (102, "one")]
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs_of(pairs + odd), "").collect()}
    assert out == want | dict(odd)
