"""Improbable-feature digests: similar documents share rare byte windows, kept in a chain of Bloom filters.

Every 64-byte window has an entropy class; classes that are rare in the corpus rank first.  Among 64 neighbouring windows the one of the
lowest rank is the most improbable, and a window that wins often enough is a feature.  Features go into Bloom filters of 2,048 bits, five
bits each, and a new filter begins after 160.  Two digests are compared filter by filter by the bits they share beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, mix, scale, slices

#: Bytes in a window, entropy classes, windows that compete, wins that make a feature, and the entropy class from which windows count.
WINDOW, CLASSES, RIVALS, WINS, LEAST_CLASS = 64, 1000, 64, 16, 100
#: Bits of a filter, features in it, bits per feature (11 bits of the hash each).
BITS, FEATURES, HASHES = 2048, 160, 5
#: Share of the way from chance to full overlap below which two filters count as unrelated.
CUT = 0.3
#: Bytes of text that are worked on together.
BLOCK_BYTES = 1 << 20
LAST = np.iinfo(np.int64).max
_C = np.arange(WINDOW + 1)
_TERM = np.rint(_C * np.log2(np.maximum(_C, 1)) * (1 << 20)).astype(np.int64)
_STEP = np.diff(_TERM)
_WHOLE = int(np.log2(WINDOW) * WINDOW) << 20


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Entropy class (0 to 1000) of the window that begins at each byte; integers throughout, so the same bytes have the same class anywhere."""
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = data[lag:] == data[:-lag]
        before[lag:] += same
        after[:-lag] += same
    # Sum of c log c over the byte counts c of a window that moves on: the byte that comes in and the one that goes out change one term each.
    total = _STEP[before]
    total[WINDOW:] -= _STEP[after[:-WINDOW]]
    total = np.cumsum(total)[WINDOW - 1:]
    return (_WHOLE - total) * CLASSES // _WHOLE


class Joined:
    """Texts one after another, and which windows lie inside one text."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.classes = entropy_classes(self.data)
        start = np.searchsorted(self.ends, np.arange(len(self.classes)), side="right")
        self.inside = np.arange(WINDOW, WINDOW + len(self.classes)) <= self.ends[start] if len(self.classes) else np.empty(0, bool)


def census(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of all documents are in each entropy class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for batch in slices(batches, "text", BLOCK_BYTES):
            joined = Joined([t or b"" for t in batch.column(0).to_pylist()])
            total += np.bincount(joined.classes[joined.inside], minlength=CLASSES + 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["class", "n"])

    counted = for_python(docs).select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    out = np.zeros(CLASSES + 1, np.int64)
    for r in counted.collect():
        out[r["class"]] = r["n"]
    return out


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the rarest first; classes of too little entropy have none (a rank beyond all)."""
    order = np.lexsort((np.arange(len(counts)), counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    rank[:LEAST_CLASS] = CLASSES + 1
    return rank


def features(joined: Joined, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every feature, in order; a text that has none is one feature itself, an empty one has none."""
    n = len(joined.classes)
    owner, hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
    if n:
        value = np.where(joined.inside, rank[joined.classes], CLASSES + 2)
        key = np.concatenate([value << 40 | np.arange(n), np.full(RIVALS, LAST)])
        # After a text's last window come 63 that leave it, so the windows that compete are of one text.
        step = 1
        while step < RIVALS:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        key = key[:n][joined.inside]
        wins = np.bincount(key[key >> 40 <= CLASSES] & ((1 << 40) - 1), minlength=n)
        at = np.flatnonzero(wins >= WINS)
        owner = np.searchsorted(joined.ends, at, side="right")
        weight = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
        hashes = np.zeros(len(at), np.uint64)
        for k in range(WINDOW):
            hashes += mix(joined.data[at + k].astype(np.uint64) + np.uint64(1)) * weight[k]
        hashes = mix(hashes)
    bare = np.setdiff1d(np.flatnonzero([len(t) > 0 for t in joined.texts]), owner)
    if len(bare):
        whole = np.array([_whole(joined.texts[i]) for i in bare], np.uint64)
        owner, hashes = np.concatenate([owner, bare]), np.concatenate([hashes, whole])
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    return owner, hashes


def _whole(text: bytes) -> int:
    return int.from_bytes(hashlib.sha1(text).digest()[:8], "big")


def filters(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text: rows of 32 64-bit numbers."""
    owner, hashes = features(Joined(texts), rank)
    size = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(size) - size
    chain = (size + FEATURES - 1) // FEATURES
    base = np.cumsum(chain) - chain
    row = base[owner] + (np.arange(len(owner)) - begin[owner]) // FEATURES
    bits = np.zeros((int(chain.sum()), BITS), bool)
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return [packed[b:b + c] for b, c in zip(base, chain)]


def to_text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def to_chain(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").reshape(-1, BITS // 64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the shorter chain's filters each take their best match in the other, weighted by their bits.

    A match is the overlap beyond what chance gives, as a share of what the smaller filter allows beyond that, from `CUT` on.  Two digests
    without features are alike, one without is unlike any other; chains of one length are compared both ways and averaged.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    na, nb = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    best, back = np.zeros(len(a)), np.zeros(len(b))
    for i, one in enumerate(a):
        shared = np.bitwise_count(one & b).sum(axis=1, dtype=np.int64)
        most, chance = np.minimum(na[i], nb), na[i] * nb / BITS
        floor = chance + CUT * (most - chance)
        got = np.clip((shared - floor) / np.maximum(most - floor, 1e-9), 0, 1)
        best[i] = got.max()
        back = np.maximum(back, got)
    score = float((best * na).sum() / na.sum())
    if len(a) == len(b):
        score = (score + float((back * nb).sum() / nb.sum())) / 2
    return min(1.0, score)


def digests(rows: DataFrame, texts: dict[str, str], rank: np.ndarray, pairs: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """`rows` with the text columns (keys of `texts`) replaced by their digests (values), and for each of `pairs` the likeness of two digests.

    A null text counts as empty; equal texts have equal digests.  Columns with the names of new ones are replaced.
    """
    pairs = pairs or {}
    new = [*texts.values(), *pairs]
    others = [c for c in rows.columns if c not in texts and c not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = sum(np.array([v or 0 for v in pc.binary_length(whole.column(k)).to_pylist()], np.int64) for k in range(len(texts)))
            part = np.cumsum(sizes) // BLOCK_BYTES
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                batch = whole.slice(lo, hi - lo)
                n = batch.num_rows
                flat = [t or b"" for k in range(len(texts)) for t in batch.column(k).to_pylist()]
                chains = filters(flat, rank)
                by = {name: chains[k * n:(k + 1) * n] for k, name in enumerate(texts.values())}
                cols = [batch.column(len(texts) + k) for k in range(len(others))]
                cols += [pa.array([to_text(c) for c in by[name]], pa.string()) for name in texts.values()]
                cols += [pa.array([likeness(x, y) for x, y in zip(by[a], by[b])], pa.float64()) for a, b in pairs.values()]
                yield pa.RecordBatch.from_arrays(cols, [*others, *new])

    schema = rows.select(*others).schema
    for c in texts.values():
        schema = schema.add(c, "string")
    for c in pairs:
        schema = schema.add(c, "double")
    return for_python(rows).select(*(F.col(c).cast("binary").alias(c) for c in texts), *others).mapInArrow(run, schema)


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text, next_text)``: the text of the next row in order of id, after the last one that of the first; null texts are empty.

    Rows are dealt out by ranges of the id, whose limits are ids of the table; the rows at a limit also go to the range before, as its end.
    Rows with equal ids follow each other in order of their text, and null ids come last.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    parts = scale(docs)
    # Ranges are dealt to tasks by hash; several to a task make tasks more even.
    ranges = 4 * parts
    share = [k / ranges for k in range(1, ranges)]
    facts = rows.agg(F.percentile_approx(F.coalesce("id", F.lit(LAST)), share or [0.5], max(10_000, 4 * ranges)).alias("cut"), F.min(F.coalesce("id", F.lit(LAST))).alias("first")).first()
    limits = np.array(sorted(set(facts["cut"] or ()) - {facts["first"]}), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).fill_null(int(LAST)).to_numpy(zero_copy_only=False)
            part = np.searchsorted(limits, key, side="right")
            at = [np.arange(len(key)), np.flatnonzero(np.isin(key, limits)), np.flatnonzero(key == facts["first"])]
            to = [part, part[at[1]] - 1, np.full(len(at[2]), len(limits))]
            end = np.repeat([False, True, True], [len(x) for x in at])
            batch = batch.take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to).astype(np.int32)), pa.array(end), *batch.columns], ["part", "end", "id", "text"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            ids, texts, after, size = [], [], [], 0
            for part, end, key, value in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and held[0] == part:
                    ids.append(held[1]), texts.append(held[2]), after.append(value)
                    size += len(held[2]) + len(value)
                held = None if end else (part, key, value)
                if size > 4 * BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(after, pa.string())], ["id", "text", "next_text"])
                    ids, texts, after, size = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(after, pa.string())], ["id", "text", "next_text"])

    order: list[Column] = [F.col("part"), F.col("end"), F.col("id").asc_nulls_last(), F.col("text")]
    dealt = for_python(rows).mapInArrow(deal, "part int, end boolean, id long, text binary").repartition(parts, "part").sortWithinPartitions(*order)
    out = dealt.mapInArrow(follow, "id long, text string, next_text string")
    return out.select(F.col("id").cast(docs.schema[id].dataType).alias(id), F.col("text").alias(text), "next_text")
