"""SimHash near-duplicates: a segment-popcount embedding and a grid range-join find candidates, exact Hamming distance decides.

A 64-bit fingerprint is cut into `SEGMENTS` segments; the vector of their bit counts moves by at most one step (Manhattan) per differing
bit, so fingerprints that differ in two bits have vectors at distance two or less, and some grid cell is within one step of both.  Every
distinct fingerprint goes to its own cell and to the cells one step away; fingerprints that meet are compared exactly.  A cell that holds
more than `CROWD` fingerprints is cut down to the finest grid (one bit per segment), whose cells cannot hold more than 65.

Copies share a fingerprint and are one row here, whatever their number.  Links are returned as links to the smallest fingerprint of the
connected ones in a cell, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, scale, slices, smallest_labels
from gridloom.llm.jaccard import near_copies
from gridloom.operators.regions import components
from gridloom.session import lookup, materialise

#: Segments of the embedding, and bits in each.
SEGMENTS, WIDTH = 16, 4
#: Fingerprints in one cell that are compared pair by pair inside a task.
CROWD = 128


def simhash(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a text: a bit is set if it is set in over half of the XXH64 of its shingles; 0 without words.

    Words are ASCII-lower-cased runs of other than ASCII white space; a text with fewer than `words` words is one shingle.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), "<u8", n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 255):
        ones += np.add.reduce(bits[start:start + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)`` per row of `docs`; `fp` is the fingerprint as a signed long.  A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            got = [simhash(t.as_py() or b"", words, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(got, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    return for_python(rows).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _cells() -> Column:
    """The cell of `fp` and the cells one step away, as an array; a cell packs the segments' bit counts, three bits each."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))).cast("long") for i in range(SEGMENTS)]
    own = F.lit(0).cast("long")
    for i, c in enumerate(counts):
        own = own + F.shiftleft(c, 3 * i)
    near = [own]
    for i, c in enumerate(counts):
        step = F.lit(1 << (3 * i)).cast("long")
        near += [F.when(c < WIDTH, own + step), F.when(c > 0, own - step)]
    return F.array_compact(F.array(*near))


def _meet(max_bits: int):
    """Rows sorted by cell -> links (0, fp, smallest fp connected to it in the cell), and (1, finest cell, fp) for crowded cells."""
    steps = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

    def links(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        left, right, lag = [], [], 1
        while lag < len(cell):
            same = np.flatnonzero(cell[lag:] == cell[:-lag])
            if not same.size:
                break
            same = same[_popcount(fp[same] ^ fp[same + lag]) <= max_bits]
            left.append(same)
            right.append(same + lag)
            lag += 1
        if not left:
            return out(0, fp[:0], fp[:0])
        label = smallest_labels(len(cell), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(cell)))
        return out(0, fp[moved], fp[label[moved]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        crowded = None
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            for i, part in _ready(cell, fp, crowded, last=False):
                yield (out(1, *part) if i else links(*part)) if len(part[0]) else links(cell[:0], fp[:0])
            cell, fp, crowded = _rest(cell, fp, crowded)
        for i, part in _ready(cell, fp, crowded, last=True):
            yield out(1, *part) if i else links(*part)

    def _split(cell: np.ndarray, crowded, last: bool):
        """Which rows are in crowded cells, and how many rows at the front are complete."""
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, int)
        sizes = np.diff(np.append(starts, len(cell)))
        many = sizes > CROWD
        if len(starts) and cell[0] == crowded:
            many[0] = True
        done = len(cell) if last or not len(starts) or many[-1] else starts[-1]
        return np.repeat(many, sizes), done

    def _ready(cell: np.ndarray, fp: np.ndarray, crowded, last: bool):
        many, done = _split(cell, crowded, last)
        plain = np.flatnonzero(~many[:done])
        yield 0, (cell[plain], fp[plain])
        held = fp[:done][many[:done]]
        for lo in range(0, len(held), 10_000):
            x = held[lo:lo + 10_000]
            yield 1, ((x[:, None] ^ steps[None, :]).ravel(), np.repeat(x, 65))

    def _rest(cell: np.ndarray, fp: np.ndarray, crowded):
        many, done = _split(cell, crowded, False)
        if len(cell) and done == len(cell):
            crowded = cell[-1]
        elif done:
            crowded = None
        return cell[done:], fp[done:], crowded

    return run


def near_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all that are linked by `max_bits` (two at most) differing bits.

    `fps` has a column `fp` of distinct longs.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the grid's cells meet within one step of each side, which finds up to two differing bits")
    # A table of fingerprints has few files, and each row becomes a cell per segment and side.
    spread = fps.repartition(scale(fps), "fp").select(F.explode(_cells()).alias("cell"), "fp")
    dealt = spread.repartition(scale(fps), "cell").sortWithinPartitions("cell")
    met = materialise(dealt.mapInArrow(_meet(max_bits), "kind int, a long, b long"))
    fine = met.filter("kind = 1").select(F.col("a").alias("cell"), F.col("b").alias("fp")).distinct()
    # A cell of the finest grid holds fingerprints within one bit of it.
    first = fine.groupBy("cell").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("cell", "a")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    if max_bits == 2:
        more = fine.withColumnRenamed("fp", "b").join(first, "cell").select("a", "b")
    else:
        more = fine.withColumnRenamed("fp", "b").join(fine.withColumnRenamed("fp", "a"), "cell").filter("a < b").select("a", "b")
    return met.filter("kind = 0").select("a", "b").unionByName(more.filter((F.col("a") != F.col("b")) & close)).distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2, seed: int = 42,
) -> DataFrame:
    """``(id, fp, component_id)``: per row its fingerprint and the smallest id among all documents reachable by links.

    Fingerprints link at `max_bits` or fewer differing bits; links are transitive.  Null and empty texts have fingerprint zero and link
    like any other.  Repeated rows stay; null ids take part and never are the smallest while another is there.  An empty table gives an
    empty result.  Other columns of `docs` are not read.
    """
    marks = materialise(fingerprints(docs, id, text, words, seed))
    distinct = materialise(marks.groupBy("fp").agg(F.min(id).alias("_first")))
    links = near_links(distinct.select("fp"), max_bits)
    ends = materialise(links)
    nodes = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct()
    root = components(nodes, ends).select(F.col("node").alias("fp"), "root")
    rooted = materialise(distinct.join(root, "fp").select("fp", "root", "_first"))
    least = rooted.groupBy("root").agg(F.min("_first").alias("_least"))
    linked = rooted.join(least, "root").select("fp", "_least")
    ids = distinct.join(linked, "fp", "left").select("fp", F.coalesce("_least", "_first").alias("component_id"))
    return marks.join(ids, "fp").select(id, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, max_bits: int = 2) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their group of near-duplicates; of rows that repeat an id, one stays.

    Near-duplicates have fingerprints that differ in `max_bits` or fewer bits.  Texts that share four fifths or more of their distinct
    shingles but lie further apart than that are linked as well (`jaccard.near_copies`), and links of both kinds are followed together.
    Documents without a word are no copies of each other in this form and all stay.
    """
    digest = F.unhex(F.md5(F.col(text).cast("binary")))
    groups = materialise(near_copies(docs, text, words))
    texts = docs.filter(F.col(text).isNotNull()).select(digest.alias("digest"), F.col(text).alias("text"))
    prints = materialise(fingerprints(texts, "digest", "text", words).groupBy("digest").agg(F.min("fp").alias("fp")))
    # Only texts with a word have a group, so the fingerprint of texts without one links nothing.
    named = materialise(lookup(groups, prints, ["digest"]))
    first = materialise(named.groupBy("fp").agg(F.min("root").alias("_first")))
    links = lookup(named, first, ["fp"]).select(F.col("root").alias("a"), F.col("_first").alias("b"))
    far = materialise(near_links(first.select("fp"), max_bits))
    for side in ("a", "b"):
        far = lookup(far, first.select(F.col("fp").alias(side), F.col("_first").alias(f"_{side}")), [side])
    ends = materialise(links.unionByName(far.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).filter("a <> b").distinct())
    joined = materialise(components(ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct(), ends))
    merged = lookup(groups, joined.select(F.col("node").alias("root"), F.col("root").alias("_root")), ["root"], "left")
    groups = materialise(merged.select("digest", F.coalesce("_root", "root").alias("root")))
    marks = materialise(lookup(docs.select(id, digest.alias("digest")), groups, ["digest"]))
    least = marks.groupBy("root").agg(F.min(id).alias("_least"))
    gone = lookup(marks, least, ["root"]).filter(F.col(id) != F.col("_least")).select(id).distinct()
    return docs.join(gone, id, "left_anti")
