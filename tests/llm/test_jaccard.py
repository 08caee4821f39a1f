import random

from gridloom.llm.jaccard import keys, near_copies, shingles
from gridloom.llm.simhash import drop_near_duplicates


def words_of(text, n=5):
    w = text.lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_groups(texts):
    sets = {t: words_of(t) for t in texts if words_of(t)}
    left, out = set(sets), set()
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if alike(sets[x], sets[y])}
            left -= near
            group |= near
            todo += near
        out.add(frozenset(group))
    return out


def groups_of(df):
    import hashlib

    texts = {hashlib.md5(r.text.encode()).digest(): r.text for r in df.select("text").collect() if r.text}
    out = {}
    for r in near_copies(df).collect():
        out.setdefault(r.root, set()).add(texts[bytes(r.digest)])
    return {frozenset(g) for g in out.values()}


def edited(rng, words, share):
    """One stretch of the words is replaced."""
    n = round(len(words) * share)
    at = rng.randrange(len(words) - n)
    return words[:at] + [f"new{rng.random()}" for _ in range(n)] + words[at + n:]


def test_edited_copies_go(docs_of):
    rng = random.Random(3)
    pairs = []
    for k in range(60):
        words = [f"t{k}w{i}" for i in range(rng.randint(150, 900))]
        pairs += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(edited(rng, words, rng.uniform(0.05, 0.08)))), (3 * k + 2, " ".join(edited(rng, words, 0.2)))]
    kept = {r.doc_id for r in drop_near_duplicates(docs_of(pairs)).collect()}
    assert kept == {i for i, _ in pairs if i % 3 != 1}


def test_against_all_pairs(docs_of):
    """Chains of edits, a crowded group and unrelated texts that share a passage."""
    rng = random.Random(4)
    pairs = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (5, "A  b C"), (None, "a b c d e f"), (6, "A  b c d e f")]
    common = [f"c{i}" for i in range(150)]
    for k in range(12):
        words = [f"t{k}w{i}" for i in range(200)] + common
        for _ in range(15):
            pairs.append((100 + len(pairs), " ".join(words)))
            words = edited(rng, words, rng.choice([0.03, 0.06, 0.09, 0.11, 0.15]))
    base = [f"b{i}" for i in range(300)]
    pairs += [(1000 + k, " ".join(edited(rng, base, rng.choice([0.01, 0.05, 0.12, 0.3])))) for k in range(150)]
    df = docs_of(pairs)
    want = brute_groups({t for _, t in pairs if t})
    assert len(want) > 40 and max(map(len, want)) > 70
    assert groups_of(df) == want
    assert near_copies(docs_of([])).collect() == [] and drop_near_duplicates(docs_of([])).collect() == []


def test_keys_depend_on_the_set_only():
    a, b = shingles(b"a b c d e f g a b c d e f g a b"), shingles(b"A B c d e f g a b c d e f g a b c")
    assert a.tolist() == b.tolist() and keys(a).tolist() == keys(b).tolist()


def _counted(monkeypatch):
    """Rows of all candidate tables, added up."""
    from gridloom.llm import jaccard

    seen, plain = [], jaccard._pairs

    def counted(*args):
        out = plain(*args)
        seen.append(jaccard.row_count(out))
        return out

    monkeypatch.setattr(jaccard, "_pairs", counted)
    return seen


def _found(want, got):
    """Share of the texts that go because a group keeps one, over those that should."""
    name = {t: k for k, g in enumerate(got) for t in g}
    return sum(len(g) - len({name[t] for t in g}) for g in want) / sum(len(g) - 1 for g in want)


def test_large_groups_are_linear_and_found(docs_of, monkeypatch):
    """Edits of 2 to 15 % of one base, and texts that share 70 % of their words: twice the texts, about twice the pairs."""
    seen = _counted(monkeypatch)
    pairs_of, recall = {}, {}
    for n in (150, 300):
        rng = random.Random(7)
        base, common = [f"b{i}" for i in range(400)], [f"c{i}" for i in range(280)]
        texts = [" ".join(edited(rng, base, rng.uniform(0.02, 0.15))) for _ in range(n)]
        texts += [" ".join(common + [f"t{k}w{i}" for i in range(120)]) for k in range(n)]
        seen.clear()
        got = groups_of(docs_of(list(enumerate(texts))))
        pairs_of[n], recall[n] = sum(seen), _found(brute_groups(texts), got)
    print("pairs", pairs_of, "recall", recall)
    assert pairs_of[300] < 2.6 * pairs_of[150] and min(recall.values()) >= 0.97
