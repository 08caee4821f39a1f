import random

import xxhash

from gridloom.llm import simhash as module
from gridloom.llm.simhash import drop_near_duplicates, near_duplicates, near_links, simhash


def brute_print(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Fingerprint -> the set it reaches, by plain search."""
    prints, left, out = list(prints), set(prints), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 2}
            left -= near
            group |= near
            todo += near
        for x in group:
            out[x] = group
    return out


def check(df, pairs):
    prints = [(i, brute_print(t)) for i, t in pairs]
    groups = brute_groups({p for _, p in prints})
    least = {}
    for i, p in prints:
        key = min(groups[p])
        if i is not None:
            least[key] = min(least.get(key, i), i)
    want = sorted(((i, p, least.get(min(groups[p]))) for i, p in prints), key=repr)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=repr) == want


def test_fingerprint():
    for t in ("", "One", "a b", "A b\tC", "x y \x1c z É é \n d", "la " * 700, "w" * 100_000):
        assert simhash(t.encode()) == brute_print(t)


def test_whole_table(documents):
    check(near_duplicates(documents), [(r.doc_id, r.text) for r in documents.collect()])


def test_odd_rows(docs_of):
    words = [f"w{i}" for i in range(300)]
    pairs = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (8, "a b c"), (8, "a b c"), (9, "A  B c"), (None, None), (None, "q r s t"), (4, " ".join(words)), (5, " ".join(words[1:]))]
    check(near_duplicates(docs_of(pairs)), pairs)
    assert near_duplicates(docs_of([])).collect() == []


def test_crowded_cells(spark, monkeypatch):
    """Dense groups go through the finest grid; the components are the same."""
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(5)]
    prints = set(seeds) | {0, 2**64 - 1, 2**63}
    for s in seeds:
        for _ in range(60):
            x = s
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(10)
            prints.add(x)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    want = {frozenset(g) for g in brute_groups(prints).values()}
    for crowd in (3, 128):
        monkeypatch.setattr(module, "CROWD", crowd)
        links = [(r.a % 2**64, r.b % 2**64) for r in near_links(spark.createDataFrame(signed, "fp long")).collect()]
        assert all((a ^ b).bit_count() <= 64 for a, b in links)
        reach = {p: {p} for p in prints}
        for a, b in links:
            if reach[a] is not reach[b]:
                reach[a] |= reach[b]
                for x in reach[b]:
                    reach[x] = reach[a]
        assert {frozenset(g) for g in reach.values()} == want


def test_drop(docs_of):
    text = " ".join(f"word{i}" for i in range(400))
    pairs = [(5, text), (3, text), (9, text + " end"), (1, "quite another text with some words of its own"), (2, None), (4, "")]
    assert sorted(r.doc_id for r in drop_near_duplicates(docs_of(pairs)).collect()) == [1, 2, 3, 4]


def test_drop_follows_fingerprints_and_shares_together(docs_of):
    """Fingerprints that agree link texts whose distinct shingles differ; a text that shares most shingles with one of them goes with both."""
    phrase = [f"p{i}" for i in range(11)]
    tails = [[f"t{k}w{i}" for i in range(24)] for k in range(2)]
    a, b = (" ".join(phrase * 60 + tail) for tail in tails)
    c = " ".join(phrase * 60 + tails[1] + ["more"])
    other = " ".join(f"o{i}" for i in range(300))
    assert (simhash(a.encode(), 5) ^ simhash(b.encode(), 5)).bit_count() <= 2
    pairs = [(1, a), (2, b), (3, c), (4, other), (5, None), (6, " "), (7, "")]
    assert sorted(r.doc_id for r in drop_near_duplicates(docs_of(pairs)).collect()) == [1, 4, 5, 6, 7]
