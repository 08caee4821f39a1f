"""Exact substring dedup by distributed prefix doubling over the suffixes of all texts.

A position's rank names the prefix of a given length that starts there: equal prefixes, equal ranks.  Ranks of length 2L follow from the
pair (rank of length L here, rank of length L at L further on).  Every round deals (rank, position) pairs out to tasks by ranges of the
rank, each task sorts its range, and a position whose rank is unique, or that is past the threshold, leaves.  Rounds:

1. prefixes of half the threshold, at sampled positions only: of the half-length prefixes inside each threshold-long window the one with
   the smallest rank is sampled, which depends on the window's bytes alone, so equal windows sample the same place.  A window whose sample
   is unique is unique.
2. at samples that are left, the prefix grown to both sides over all windows that sample it (equal in the middle of a repeated passage);
   all but the first document of an equal group are settled, and so is the first one if its sample never occurs with other surroundings.
3. for what is left (the ends of repeated passages) the doubled prefix itself: the rank pair of every window, at half and full offset.

Ranks are 64-bit names (pairs: 96 to 128 bits) computed from the bytes, so no round has to send ranks back to neighbours; only one bit per
pair goes back.  Texts are packed once into blocks of whole documents, written as a bucketed table in the warehouse, and every round reads
them in place: the texts themselves are never shuffled.  A task holds one block and one range of ranks; a range grows with the number of
blocks divided by the number of ranges, and a block names a rank once, however often it occurs there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, mix, scale
from gridloom.session import materialise

#: Bytes of text in a block; a longer document has a block of its own.
BLOCK_BYTES = 2 << 20
#: Fixed odd factor of the prefix names and its inverse modulo 2^64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
#: What a block asks in a round, and what it sends per entry: a rank seen elsewhere, other surroundings, the same with a smaller id.
SEEN, VARIED, EARLIER = 0, 1, 2
LAST_ID = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x)


def _bytes_of(x: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bytes of each 64-bit number, one row each."""
    return np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _number(x: np.ndarray) -> np.ndarray:
    full = np.zeros((len(x), 8), np.uint8)
    full[:, :x.shape[1]] = x
    return full.view("<u8").ravel()


class Block:
    """Whole documents in one task: their text as bytes, and what is known about their windows after each round."""

    def __init__(self, payload: bytes, threshold: int):
        self.rows = pa.ipc.open_stream(payload).read_next_batch()
        self.t, self.half = threshold, (threshold + 1) // 2
        self.ids = self.rows.column(0).fill_null(LAST_ID).to_numpy(zero_copy_only=False)
        texts = self.rows.column(1).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
        self.edges = offsets - offsets[0]

    def prefixes(self) -> np.ndarray:
        """Round 1: the distinct ranks of the sampled positions."""
        n, t, half = len(self.data), self.t, self.half
        starts, ends = self.edges[:-1], self.edges[1:] - t + 1
        inside = ends > starts
        step = np.zeros(n + 1, np.int8)
        step[starts[inside]] = 1
        np.add.at(step, ends[inside], -1)
        windows = np.flatnonzero(np.cumsum(step[:n], dtype=np.int8))
        if not windows.size:
            self.known = self.rank = np.empty(0, np.uint64)
            self.at = self.lo = self.hi = self.owner = self.which = np.empty(0, np.int64)
            self.total, self.power = np.zeros(1, np.uint64), np.ones(1, np.uint64)
            return self.known
        names = mix(np.arange(1, 257, dtype=np.uint64))
        self.power = _powers(FACTOR, n + 1)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names[self.data] * _powers(INVERSE, n))])
        at = np.arange(n - half + 1)
        rank = self.name(at, at + half)
        # The smallest rank of each window; equal ones go to the leftmost.  Rank and place share a number, 32 bits each.
        low = (rank & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        count, have = t - half + 1, 1
        while 2 * have <= count:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < count:
            low = np.minimum(low[:-(count - have)], low[count - have:])
        sample = (low[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], sample[1:] != sample[:-1]]))
        self.at, self.lo, self.hi = sample[first], windows[first], windows[np.append(first[1:], len(windows)) - 1]
        self.owner = self.ids[np.searchsorted(self.edges, self.at, side="right") - 1]
        self.rank = rank[self.at]
        self.known, self.which = np.unique(self.rank, return_inverse=True)
        return self.known

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.power[start])

    def surroundings(self, seen: np.ndarray) -> tuple[tuple, tuple]:
        """Round 2, for samples seen in other blocks (or in several documents here): what to ask about their surroundings."""
        most = np.full(len(self.known), -1, np.int64)
        least = np.full(len(self.known), LAST_ID)
        np.maximum.at(most, self.which, self.owner)
        np.minimum.at(least, self.which, self.owner)
        keep = np.flatnonzero((seen | (least < most))[self.which])
        self.at, self.lo, self.hi, self.owner, self.rank = (v[keep] for v in (self.at, self.lo, self.hi, self.owner, self.rank))
        left, right = (self.at - self.lo).astype(np.uint64), (self.hi - self.at + self.t).astype(np.uint64)
        wide = mix(self.name(self.lo, self.hi + self.t) ^ mix((left << np.uint64(32)) | right))
        # One entry per rank with its smallest and largest surroundings: two differ if any do.
        order = np.lexsort((wide, self.rank))
        rank, around = self.rank[order], wide[order]
        head = np.concatenate([[True], rank[1:] != rank[:-1]]) if len(rank) else np.empty(0, bool)
        tail = np.append(head[1:], True) if len(rank) else head
        ranks, low, high = rank[head], around[head], around[tail]
        self.family = np.empty(len(order), np.int64)
        self.family[order] = np.cumsum(head) - 1
        twice = np.concatenate([np.arange(len(ranks)), np.flatnonzero(low != high)])
        twice = twice[np.argsort(ranks[twice], kind="stable")]
        second = np.concatenate([[False], twice[1:] == twice[:-1]]) if len(twice) else np.empty(0, bool)
        self.asked = twice
        varied = (ranks[twice], np.where(second, high[twice], low[twice]), None)
        key = mix(self.rank ^ np.bitwise_not(mix(wide)))
        self.same, entries = _first_ids(key, wide, self.owner)
        self.first = entries[2]
        return varied, entries

    def windows(self, varied: np.ndarray, earlier: np.ndarray) -> tuple:
        """Round 3: rank pairs of the windows whose samples are in doubt."""
        differs = np.zeros(int(self.family.max(initial=-1)) + 1, bool)
        differs[self.asked[varied]] = True
        gone = earlier[self.same] | (self.owner > self.first[self.same])
        self.gone = gone
        doubt = np.flatnonzero(~gone & differs[self.family])
        length = self.hi[doubt] - self.lo[doubt] + 1
        ends = np.cumsum(length)
        self.start = np.repeat(self.lo[doubt] - (ends - length), length) + np.arange(length.sum())
        owner = np.repeat(self.owner[doubt], length)
        here = self.name(self.start, self.start + self.half)
        further = self.name(self.start + self.t - self.half, self.start + self.t)
        self.window_owner = owner
        self.pair, entries = _first_ids(mix(here ^ np.bitwise_not(mix(further))), further, owner)
        self.window_first = entries[2]
        return entries

    def covered(self, earlier: np.ndarray) -> np.ndarray:
        """Which bytes lie in a window that also starts in a document with a smaller id."""
        step = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(step, self.lo[self.gone], 1)
        np.add.at(step, self.hi[self.gone] + self.t, -1)
        late = self.start[earlier[self.pair] | (self.window_owner > self.window_first[self.pair])]
        np.add.at(step, late, 1)
        np.add.at(step, late + self.t, -1)
        return np.cumsum(step[:-1]) > 0


def _first_ids(key: np.ndarray, more: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Distinct (key, more) in order of key with their smallest owner, and the place of each input among them."""
    order = np.lexsort((owner, more, key))
    k, m = key[order], more[order]
    head = np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1])]) if len(k) else np.empty(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(head) - 1
    return place, (k[head], m[head], owner[order][head])


def _range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


class Questions:
    """One block's rounds so far: what it asks next, given the bits that came back."""

    def __init__(self, payload: bytes, threshold: int, ranges: int, replies: dict):
        self.block, self.ranges, self.replies = Block(payload, threshold), ranges, replies

    def bits(self, kind: int, key: np.ndarray, round: int) -> np.ndarray:
        edges = np.searchsorted(_range_of(key, self.ranges), np.arange(self.ranges + 1))
        got = np.zeros(len(key), bool)
        for (r, k, part), bits in self.replies.items():
            if (r, k) == (round, kind):
                lo, hi = edges[part], edges[part + 1]
                got[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
        return got

    def ask(self, round: int) -> list[tuple]:
        """``(kind, keys in order, further number, id)`` for the round."""
        b = self.block
        known = b.prefixes()
        if round == 1:
            return [(SEEN, known, None, None)]
        varied, entries = b.surroundings(self.bits(SEEN, known, 1))
        if round == 2:
            return [(VARIED, *varied), (EARLIER, *entries)]
        pairs = b.windows(self.bits(VARIED, varied[0], 2), self.bits(EARLIER, entries[0], 2))
        if round == 3:
            return [(EARLIER, *pairs)]
        self.removed = b.covered(self.bits(EARLIER, pairs[0], 3))
        return []


def _send(kind: int, key: np.ndarray, more: np.ndarray | None, owner: np.ndarray | None) -> np.ndarray:
    """Entries as rows of bytes; keys are cut to the 48 bits below which a false meeting only costs a later check, others stay whole."""
    if kind == SEEN:
        return _bytes_of(key >> np.uint64(16), 6)
    if kind == VARIED:
        return np.hstack([_bytes_of(key >> np.uint64(16), 6), _bytes_of(more, 8)])
    return np.hstack([_bytes_of(key, 8), _bytes_of(more, 4), owner.astype("<i8").view(np.uint8).reshape(-1, 8)])


WIDTHS = {SEEN: 6, VARIED: 14, EARLIER: 20}


def _answer(kind: int, entries: np.ndarray) -> np.ndarray:
    """A bit per entry of one range of ranks: sorted, then compared with the neighbours."""
    if kind == SEEN:
        key = _number(entries)
        order = np.argsort(key)
        k = key[order]
        equal = np.concatenate([[False], k[1:] == k[:-1]])
        hit = equal | np.append(equal[1:], False)
    elif kind == VARIED:
        key, around = _number(entries[:, :6]), _number(entries[:, 6:])
        order = np.lexsort((around, key))
        k, a = key[order], around[order]
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        tail = np.append(head[1:], len(k)) - 1
        hit = np.repeat(a[head] != a[tail], tail - head + 1)
    else:
        key, more, owner = _number(entries[:, :8]), _number(entries[:, 8:12]), _number(entries[:, 12:]).view(np.int64)
        order = np.lexsort((owner, more, key))
        k, m, o = key[order], more[order], owner[order]
        head = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1])]))
        hit = o > np.repeat(o[head], np.diff(np.append(head, len(k))))
    bits = np.empty(len(hit), bool)
    bits[order] = hit
    return bits


def pack_blocks(docs: DataFrame, id: str, text: str, others: list[str]) -> DataFrame:
    """``(block_id, payload)``: consecutive documents of a partition in Arrow's stream format, compressed; id first, text (bytes) second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def full() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block_id", "payload"])

        for batch in batches:
            batch = batch.set_column(1, "text", batch.column(1).cast(pa.large_binary()))
            sizes = np.asarray(pc.binary_length(batch.column(1)).fill_null(0))
            lo = 0
            for i, n in enumerate(sizes.tolist()):
                size += n + 64
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(lo, i + 1 - lo))
                    yield full()
                    number, held, size, lo = number + 1, [], 0, i + 1
            if lo < batch.num_rows:
                held.append(batch.slice(lo))
        if held:
            yield full()

    rows = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("binary").alias("_text"), *(F.col(c) for c in others))
    return for_python(rows).mapInArrow(run, "block_id long, payload binary")


def _rounds(blocks: DataFrame, replies: DataFrame | None, run, schema: str) -> DataFrame:
    """`run` over the blocks, each with the replies it got so far."""
    if replies is None:
        rows = blocks.withColumn("replies", F.lit(None).cast("array<struct<round:int,kind:int,part:int,bits:binary>>"))
    else:
        got = replies.groupBy("block_id").agg(F.collect_list(F.struct("round", "kind", "part", "bits")).alias("replies"))
        rows = blocks.join(got, "block_id", "left")
    return rows.select("block_id", "payload", "replies").mapInArrow(run, schema)


def _replies(value) -> dict:
    return {(r["round"], r["kind"], r["part"]): r["bits"] for r in value or ()}


def _exchange(blocks: DataFrame, replies: DataFrame | None, round: int, threshold: int, ranges: int) -> DataFrame:
    """One round: blocks ask, ranges of ranks are sorted, a bit per entry comes back as ``(round, kind, part, block_id, bits)``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q = Questions(batch.column(1)[i].as_py(), threshold, ranges, _replies(batch.column(2)[i].as_py()))
                for kind, key, more, owner in q.ask(round):
                    entries, edges = _send(kind, key, more, owner), np.searchsorted(_range_of(key, ranges), np.arange(ranges + 1))
                    parts = np.flatnonzero(np.diff(edges))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(parts), kind, np.int32)), pa.array(parts.astype(np.int32)),
                        pa.array([batch.column(0)[i].as_py()] * len(parts), pa.int64()),
                        pa.array([entries[edges[p]:edges[p + 1]].tobytes() for p in parts], pa.binary()),
                    ], ["kind", "part", "block_id", "entries"])

    def group(key: tuple, held: list) -> pa.RecordBatch:
        kind, part = key
        entries = [np.frombuffer(e, np.uint8).reshape(-1, WIDTHS[kind]) for _, e in held]
        sizes = np.array([len(e) for e in entries])
        ends = np.cumsum(sizes)
        hit = _answer(kind, np.concatenate(entries))
        bits = [np.packbits(hit[e - n:e]).tobytes() for n, e in zip(sizes, ends)]
        some = [i for i, x in enumerate(bits) if any(x)]
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(some), round, np.int32)), pa.array(np.full(len(some), kind, np.int32)), pa.array(np.full(len(some), part, np.int32)),
            pa.array([held[i][0] for i in some], pa.int64()), pa.array([bits[i] for i in some], pa.binary()),
        ], ["round", "kind", "part", "block_id", "bits"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for kind, part, block, entries in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (kind, part) != key:
                    if held:
                        yield group(key, held)
                    key, held = (kind, part), []
                held.append((block, entries))
        if held:
            yield group(key, held)

    asked = _rounds(blocks, replies, ask, "kind int, part int, block_id long, entries binary")
    dealt = asked.repartition(ranges, "part", "kind").sortWithinPartitions("kind", "part")
    return materialise(dealt.mapInArrow(answer, "round int, kind int, part int, block_id long, bits binary"))


def _blocks_table(spark: SparkSession, blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks as a bucketed table of the warehouse: a join on the block number leaves them where they are."""
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    blocks.write.bucketBy(buckets, "block_id").option("compression", "uncompressed").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: int = 50, as_text: bool = False) -> DataFrame:
    """All columns of `docs` with ``kept``, ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte covered by a `threshold`-byte string that also starts in a document with a smaller id is removed; overlaps count, strings are
    judged on the input, and none crosses documents.  `kept` (binary) is what is left, `n_spans` the number of maximal removed runs.  With
    `as_text`, `kept` is a string, without the characters of which only a part is left.

    A null text counts as empty, a null id as larger than all others; rows that repeat an id never remove from each other.  Texts shorter
    than the threshold stay whole; a text of any length is handled whole.  An empty table gives an empty result.  Columns of `docs` that
    have the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    new = ["kept", "n_bytes", "n_removed", "n_spans"]
    others = [c for c in docs.columns if c not in (id, text, *new)]
    ranges = scale(docs)
    blocks = _blocks_table(spark, pack_blocks(docs, id, text, others), ranges)
    replies = _exchange(blocks, None, 1, threshold, ranges)
    replies = replies.unionByName(_exchange(blocks, replies, 2, threshold, ranges))
    replies = replies.unionByName(_exchange(blocks, replies, 3, threshold, ranges))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q = Questions(batch.column(1)[i].as_py(), threshold, ranges, _replies(batch.column(2)[i].as_py()))
                q.ask(4)
                b, gone = q.block, q.removed
                edges = b.edges
                rise = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]])) if len(gone) else np.empty(0, np.int64)
                # A run that goes on into the next document counts there as well.
                runs = np.searchsorted(rise, edges)
                spans = np.diff(runs) + [bool(lo < hi and lo and gone[lo] and gone[lo - 1]) for lo, hi in zip(edges[:-1], edges[1:])]
                kept = [b.data[lo:hi][~gone[lo:hi]].tobytes() for lo, hi in zip(edges[:-1], edges[1:])]
                size = np.diff(edges)
                left = [len(k) for k in kept]
                if as_text:
                    kept = [k.decode("utf-8", "ignore").encode() for k in kept]
                cols = [
                    b.rows.column(0), b.rows.column(1).cast(pa.binary()), *(b.rows.column(2 + k) for k in range(len(others))), pa.array(kept, pa.binary()).cast(pa.string() if as_text else pa.binary()), pa.array(size),
                    pa.array(size - left, pa.int64()), pa.array(np.asarray(spans, np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(cols, [id, text, *others, *new])

    schema = docs.select(F.col(id).cast("long").alias(id), F.col(text).cast("binary").alias(text), *others).schema
    for c, kind in zip(new, ["string" if as_text else "binary", "long", "long", "long"]):
        schema = schema.add(c, kind)
    out = _rounds(blocks, replies, finish, schema)
    return out.select(F.col(id).cast(docs.schema[id].dataType).alias(id), F.col(text).cast("string").alias(text), *others, *new)
