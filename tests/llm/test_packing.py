import itertools
import random
from binascii import crc32
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCUMENT = open(PATH, encoding="utf-8").read()


def optimum(sizes, capacity):
    """Fewest sequences, by trying all sets for the largest piece."""
    seen = {}

    def solve(left):
        if not left:
            return 0
        if left not in seen:
            j, rest, best = left[-1], left[:-1], len(left)
            options = {s for k in range(len(rest) + 1) for s in itertools.combinations(rest, k) if sum(s) + j <= capacity}
            for s in options:
                c = Counter(rest)
                c.subtract(s)
                best = min(best, 1 + solve(tuple(sorted(c.elements()))))
            seen[left] = best
        return seen[left]

    return solve(tuple(sorted(sizes)))


def test_plan_is_whole_and_reduction_keeps_the_optimum():
    rng = random.Random(4)
    for _ in range(250):
        capacity = rng.randint(5, 25)
        sizes = [rng.randint(1 if rng.random() < 0.3 else 1 + capacity // 4, capacity) for _ in range(rng.randint(0, 8))]
        fixed, rest = packing.reduce_instance(Counter(sizes), capacity)
        best = optimum(sizes, capacity)
        assert sum(t for _, t in fixed) + optimum(list(Counter(rest).elements()), capacity) == best
        used = Counter()
        for content, times in packing.plan(Counter(sizes), capacity):
            assert sum(content) <= capacity and times > 0
            for s in content:
                used[s] += times
        assert used == Counter(sizes)


def test_plan_of_a_large_instance_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    sizes = Counter(np.minimum(2048, rng.lognormal(6, 1, 1_000_000)).astype(int).clip(1).tolist())
    patterns = packing.plan(sizes, 2048)
    bound = -(-sum(s * n for s, n in sizes.items()) // 2048)
    assert sum(t for _, t in patterns) <= bound * 1.001 and len(packing.slots(patterns)) < 40_000


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(df, pairs, library, capacity):
    got = packing.pack(df, DOCUMENT, capacity=capacity, with_ids=True).collect()
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        cut = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (lo, hi) in enumerate(zip(cut, cut[1:])):
            data = np.array(ids[lo:hi], "<u4").tobytes()
            want.append((i, k, lo, hi - lo, crc32(data), data))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in got)


def test_whole_table(documents, library):
    n, tokens = check(documents, [(r.doc_id, r.text) for r in documents.collect()], library, 2048)
    assert n <= -(-tokens // 2048) * 1.02


def test_odd_rows(docs_of, library):
    pairs = [(1, None), (1, None), (None, "x"), (2, ""), (3, "a<|endoftext|>b é \U0001f600  \n\n"), (4, "word " * 5000), (5, "x" * 30_000), (6, "one two three four five six")]
    check(docs_of(pairs), pairs, library, 7)
    assert packing.pack(docs_of([]), DOCUMENT).collect() == []


def test_long_runs(library):
    """Runs of blanks of any length, before, between and after words and special tokens, and of letters and signs."""
    bpe = packing.ByteBpe(DOCUMENT)
    n = 2_000_000
    odd = "\t\n \u3000\xa0" * 40_000
    texts = [" " * n, " " * n + "a b", "a b" + " " * n, "a" + " " * n + "b" + "\n" * n + ".", " " * n + "<|endoftext|>" + " " * n + "<|endoftext|>x", odd + "x" + odd,
             " " * 65_535 + "x", " " * 65_536 + "x", " " * 65_536 + "\x1c", "\x1f" * 70_000, "a" * 70_000 + " " + "." * 70_000]
    for t in texts:
        assert bpe.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
