"""Groups of near copies: texts whose sets of word shingles have a Jaccard similarity of `SHARE` or more, found by banded minima, decided exactly.

The segment-popcount grid of `simhash` cannot carry this similarity: at 0.8 fingerprints differ in about 10 of 64 bits, and at that radius the
bit counts of unrelated fingerprints are close as well.  Here each distinct shingle set gets `BANDS` keys of `ROWS` minima; sets that share
a key are candidates, which a pair of similarity 0.8 misses with a probability of 3e-6.  Candidates are compared by their whole sets.

The work grows with the rows of the buckets, never with their pairs: the members of a bucket are compared with two of them, the centres.
Where that leaves groups apart in one bucket, its members are dealt again, by pairs of keys (`ROUNDS`), which part texts that share a passage from
near copies, and each finer bucket has centres of its own.  Two groups stay apart by mistake only if no two centres of the finer buckets that
they share are near copies of members of both; README has figures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, mix, slices
from gridloom.operators.regions import components
from gridloom.session import BROADCAST_ROWS, discard, lookup, materialise, row_count

#: Least similarity of near copies, as a fraction.
SHARE = (4, 5)
#: Keys of a text, and minima in each.
BANDS, ROWS = 24, 4
#: Keys that a pair must share to be compared by its whole sets: a pair of similarity 0.8 shares ten and fails with a probability of 5e-4.
COMMON = 3
#: Keys that are dealt first: what they join is not compared again under the others.
FIRST = 3
#: Later deals of the members of mixed buckets: each pairs the keys with those so many places further on.
ROUNDS = ((1, 2, 3), (4, 5, 7))
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FLIP, _FACTOR = _SEEDS[::2, None], _SEEDS[1::2, None] | np.uint64(1)


def shingles(text: bytes, words: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles of a text, read as in `simhash`; empty without words."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        parts = [b" ".join(tokens)]
    else:
        parts = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, seed) for s in parts), np.uint64))


def keys(marks: np.ndarray) -> np.ndarray:
    """The `BANDS` keys of a set of shingles that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(marks), 512):
        x = (marks[None, start:start + 512] ^ _FLIP) * _FACTOR
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=1))
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def _texts(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.select(F.col(text).cast("binary").alias("text"))
    return rows.filter("text IS NOT NULL").select(F.unhex(F.md5("text")).alias("digest"), "text")


def _measure(texts: DataFrame, words: int, whole: bool) -> DataFrame:
    """``(digest, node, size, marks)`` per text with a word: `node` names its set; `marks` are the keys, or with `whole` the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at, node, size, marks = [], [], [], []
            for i, t in enumerate(batch.column(1)):
                found = shingles(t.as_py(), words)
                if len(found):
                    at.append(i), size.append(len(found)), node.append(xxhash.xxh64_intdigest(found.tobytes()))
                    marks.append((found if whole else keys(found)).view(np.int64))
            cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int32())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(marks, pa.list_(pa.int64()))], ["digest", "node", "size", "marks"])

    return for_python(texts).mapInArrow(run, "digest binary, node long, size int, marks array<long>")


def _with_both(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """`pairs` ``(a, b)``, a table at hand, with the marks of both nodes; every node has a row in `marks`."""
    out = pairs
    for side in ("a", "b"):
        # Marks are long rows: never broadcast, and joined once, since the pairs alone tell how often a node occurs.
        named = marks.select(F.col("node").alias(side), F.col("marks").alias(f"_{side}"))
        out = lookup(out, named, [side], at_most=BROADCAST_ROWS + 1, counted=pairs)
    return out


def _close(texts: DataFrame, names: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Those of `pairs` ``(a, b)`` whose sets are near copies; `names` has digest and keys of each node."""
    common = F.size(F.filter(F.zip_with("_a", "_b", lambda x, y: x == y), lambda same: same))
    pairs = materialise(_with_both(pairs, names).filter(common >= COMMON).select("a", "b"))
    if not row_count(pairs):
        return pairs
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialise(names.join(used, "node", "left_semi").select("digest", F.lit(True).alias("_wanted")))
    sets = _measure(lookup(texts, wanted, ["digest"]).select("digest", "text"), words, True)
    sets = materialise(sets.groupBy("node").agg(F.first("marks").alias("marks")))
    both = F.size(F.array_intersect("_a", "_b"))
    near = materialise(_with_both(pairs, sets).filter(SHARE[1] * both >= SHARE[0] * (F.size("_a") + F.size("_b") - both)).select("a", "b"))
    discard(pairs, wanted, sets)
    return near


def _candidates(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of ``(key, node, size, root)`` rows with the two centres of their bucket, if these are in another group."""
    place = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "size", "root")
    buckets = rows.groupBy("key").agg(F.min(place).alias("_a"), F.max(place).alias("_b"), F.min("root").alias("_low"), F.max("root").alias("_high"))
    mixed = materialise(buckets.filter("_low <> _high").select("key", F.array("_a", "_b").alias("_ends")))
    star = lookup(rows, mixed, ["key"]).select("node", "size", "root", F.explode("_ends").alias("c")).filter(F.col("root") != F.col("c.root"))
    found = _pairs(star, F.col("c.node"), F.col("c.size"))
    discard(mixed)
    return found


def _apart(rows: DataFrame) -> DataFrame:
    """The nodes in buckets that hold more than one group."""
    mixed = materialise(rows.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low <> _high").select("key", F.lit(True).alias("_mixed")))
    return materialise(lookup(rows, mixed, ["key"]).select("node").distinct())


def _finer(names: DataFrame, steps: tuple[int, ...]) -> DataFrame:
    """``(key, node, size)``: a key for each key and the one `step` further on, around."""
    both = [F.expr(f"transform(marks, (x, i) -> xxhash64(x, element_at(marks, (i + {s}) % {BANDS} + 1), i, {s}))") for s in steps]
    return names.select(F.explode(F.concat(*both)).alias("key"), "node", "size")


def near_copies(docs: DataFrame, text: str = "text", words: int = 5) -> DataFrame:
    """``(digest, root)`` per distinct text with a word: the MD5 of its bytes and the name of its group.

    Texts are linked at a Jaccard similarity of `SHARE` or more of their sets of shingles; links are transitive.  An empty table gives an
    empty result.
    """
    texts = _texts(docs, text)
    seen = materialise(_measure(texts, words, False).groupBy("digest").agg(*(F.first(c).alias(c) for c in ("node", "size", "marks"))))
    names = materialise(seen.groupBy("node").agg(F.min("digest").alias("digest"), F.first("size").alias("size"), F.first("marks").alias("marks")))
    spread = names.select(F.explode("marks").alias("key"), "node", "size")
    links, groups = None, None
    for turn, steps in enumerate((FIRST, None, *ROUNDS)):
        if steps == FIRST:
            rows = names.select(F.explode(F.slice("marks", 1, FIRST)).alias("key"), "node", "size", F.col("node").alias("root"))
        elif steps is None and links is None:
            rows = spread.withColumn("root", F.col("node"))
        elif links is None:
            break
        else:
            rooted = materialise(lookup(names, groups, ["node"], "left").withColumn("root", F.coalesce("root", "node")))
            members = lookup(spread, rooted.select("node", "root"), ["node"])
            if steps is None:
                rows = members
            else:
                part = materialise(rooted.join(_apart(members), "node", "left_semi"))
                if not row_count(part):
                    break
                rows = lookup(_finer(part, steps), part.select("node", "root"), ["node"])
        pairs = _candidates(rows, turn)
        if row_count(pairs):
            near = _close(texts, names, pairs, words)
            links = near if links is None else materialise(links.unionByName(near))
            groups = materialise(components(_ends(links), links))
        discard(pairs)
    if links is None:
        return seen.select("digest", F.col("node").alias("root"))
    found = seen.select("digest", "node").join(groups, "node", "left")
    return found.select("digest", F.coalesce("root", "node").alias("root"))


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node")).union(links.select("b")).distinct()


def _alike(a, b):
    """Sizes that allow the similarity."""
    return F.least(a, b) * SHARE[1] >= F.greatest(a, b) * SHARE[0]


def _pairs(rows: DataFrame, other, size) -> DataFrame:
    """Distinct pairs of `node` and `other` in order, of sizes that allow the similarity."""
    return materialise(rows.filter(_alike(F.col("size"), size)).select(F.least("node", other).alias("a"), F.greatest("node", other).alias("b")).distinct())
