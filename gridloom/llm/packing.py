"""Best-fit packing of token pieces into fixed-length sequences, after a Martello-Toth dominance reduction.

Only lengths matter, so the instance is a histogram: at most `capacity` numbers, whatever the number of documents.  The reduction walks
from the largest length down and fixes a sequence whenever one set of pieces provably dominates all others that could go with the current
largest piece (it goes alone, with the largest piece that fits, or with the best two); fixing does not cost optimality.  What no rule
settles is packed by best fit, largest first.  Both work on counts: a step that recurs is taken for all its repetitions at once, so the plan
is a short list of patterns with multiplicities.  Pieces then find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import binascii
import bisect
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridloom.llm.bpe import byte_symbols
from gridloom.llm.common import for_python, slices
from gridloom.session import materialise

#: Blanks in a row from which a run is cut out before the splitter sees it.
LONG_RUN = 1 << 16
#: The characters that the splitter takes as blank; fixed values.
_BLANKS = re.compile(f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}")

# -- the plan ---------------------------------------------------------------------------------------------------------------------


class Lengths:
    """How many pieces of each length are left, with the lengths that have any in order."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {s: n for s, n in histogram.items() if n}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))

    def give(self, size: int) -> None:
        if size not in self.count:
            bisect.insort(self.sizes, size)
        self.count[size] = self.count.get(size, 0) + 1

    def largest(self, room: int) -> int:
        """The largest length that fits, 0 if none does."""
        i = bisect.bisect_right(self.sizes, room)
        return self.sizes[i - 1] if i else 0

    def fit(self, room: int) -> int:
        """How many pieces fit at most, counted up to three: the smallest ones."""
        n = 0
        for s in self.sizes[:3]:
            for _ in range(min(3 - n, self.count[s])):
                room -= s
                if room < 0:
                    return n
                n += 1
            if n == 3:
                break
        return n

    def below(self, size: int, room: int) -> int:
        """The largest piece of at most `room` that can go beside one of `size`, which is in use."""
        c = self.largest(room)
        if c == size and self.count[c] < 2:
            c = self.largest(c - 1)
        return c

    def pair(self, room: int) -> tuple[int, int]:
        """Two pieces with the largest sum that fits, the larger one first and as large as it can be; zeros without one."""
        best = (0, 0, 0)
        for a in reversed(self.sizes[:bisect.bisect_right(self.sizes, room)]):
            if 2 * a < best[0]:
                break
            b = self.below(a, min(a, room - a))
            if b:
                best = max(best, (a + b, a, b))
        return best[1:]

    def smallest_pair_above(self, size: int) -> int:
        """Sum of the two smallest pieces that are larger than `size`; 0 if there are no two."""
        i, got = bisect.bisect_right(self.sizes, size), []
        for s in self.sizes[i:i + 2]:
            got += [s] * min(2, self.count[s])
        return sum(got[:2]) if len(got) > 1 else 0


def reduce_instance(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed patterns ``(lengths, times)`` and the histogram that is left.

    A set of pieces beside j dominates another if the other's pieces can be grouped so that each group is no longer than one of the set's;
    exchanging them then never costs a sequence.  From the largest j down, with room r beside it and all pieces that are left:

    * nothing fits: {j} is fixed;
    * a piece of exactly r, or at most one more piece fits: {j, a} with a the largest that fits;
    * at most two more fit, (b, c) being the fitting pair of largest sum: {j, a} if a >= b + c; {j, b, c} if b = a and no two pieces that are
      both larger than c fit together, so that of any other pair one goes for a and the other for c;
    * otherwise j stays, and may still be a partner of smaller ones.

    A rule that holds once holds as long as its pieces last, because taking pieces away only shrinks the alternatives.
    """
    left, fixed = Lengths(histogram), []
    for j in reversed(list(left.sizes)):
        while left.count.get(j):
            left.take(j, 1)
            room = capacity - j
            a, most = left.largest(room), left.fit(room)
            chosen: tuple[int, ...] | None = None
            if most == 0:
                chosen = ()
            elif most == 1 or a == room:
                chosen = (a,)
            elif most == 2:
                b, c = left.pair(room)
                if a >= b + c:
                    chosen = (a,)
                elif b == a:
                    above = left.smallest_pair_above(c)
                    if not above or above > room:
                        chosen = (b, c)
            left.give(j)
            if chosen is None:
                break
            whole = (j, *chosen)
            times = min(left.count[s] // whole.count(s) for s in whole)
            for s in set(whole):
                left.take(s, times * whole.count(s))
            fixed.append((whole, times))
    return fixed, dict(left.count)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, largest first, on counts: open sequences with the same room and content are one group."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, content: tuple[int, ...], n: int) -> None:
        if not groups[room]:
            bisect.insort(rooms, room)
        groups[room].append((content, n))

    for size in sorted(histogram, reverse=True):
        n = histogram[size]
        while n:
            i = bisect.bisect_left(rooms, size)
            if i == len(rooms):
                # New sequences take as many of this length as go in; best fit fills each before it opens the next.
                each = capacity // size
                whole, rest = divmod(n, each)
                if whole:
                    put(capacity - each * size, (size,) * each, whole)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[i]
            content, have = groups[room].pop()
            if not groups[room]:
                rooms.pop(i)
            each = room // size
            whole = min(have, n // each)
            if whole:
                put(room - each * size, content + (size,) * each, whole)
                n -= whole * each
                have -= whole
            if have and n < each and n:
                put(room - n * size, content + (size,) * n, 1)
                have -= 1
                n = 0
            if have:
                put(room, content, have)
    return [(content, n) for room in rooms for content, n in groups[room]]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, times)`` that use up the histogram."""
    fixed, rest = reduce_instance(histogram, capacity)
    return fixed + best_fit(rest, capacity)


# -- pieces -----------------------------------------------------------------------------------------------------------------------


class ByteBpe:
    """Ids as the tokenizer file gives them, by the same merges held as ranks; special tokens written out in a text are those tokens."""

    def __init__(self, document: str):
        spec = json.loads(document)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ids = [vocab[a + b] for a, b in merged]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or any(x >= y for x, y in zip(ids, ids[1:])):
            raise ValueError("not a byte-level BPE file whose ids follow its merges")
        byte = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(byte[c] for c in s): i for s, i in vocab.items() if s not in special}
        # The pattern that the byte-level splitter is defined by; a fixed value.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.special = list(special)
        self.encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        """Long runs of blanks, which the splitter's look-ahead cannot carry, are cut out as the one piece that it makes of them.

        That is the whole run at the end of a text or before a special token, else all but its last character.
        """
        if len(text) < LONG_RUN:
            return self._plain(text)
        parts, at = [], 0
        for run in _BLANKS.finditer(text):
            last = run.end() == len(text) or text.startswith(tuple(self.special), run.end())
            end = run.end() if last else run.end() - 1
            parts += [self._plain(text[at:run.start()]), np.array(self.encoding._encode_single_piece(text[run.start():end]), np.uint32)]
            at = end
        return np.concatenate([*parts, self._plain(text[at:])])

    def _plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def pieces(docs: DataFrame, document: str, id: str = "doc_id", text: str = "text", capacity: int = 2048, close: int = 0, with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: documents as token pieces of at most `capacity`.

    A document is its ids and `close`.  Only longer ones are cut, from the end, into pieces of `capacity`: the first may be shorter.  A null
    or empty text is the single id `close`.  `_task` and `_nth` number the pieces of a length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, seen = ByteBpe(document), TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches, "text"):
            origin, piece, start, length, crc, nth, content = [], [], [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = np.append(bpe.encode(t or "").astype("<u4"), np.uint32(close)).astype("<u4")
                head = len(ids) % capacity or capacity
                at = [0, *range(head, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(at, at[1:])):
                    part = ids[lo:hi].tobytes()
                    origin.append(i), piece.append(k), start.append(lo), length.append(hi - lo), crc.append(binascii.crc32(part)), nth.append(seen[hi - lo])
                    seen[hi - lo] += 1
                    if with_ids:
                        content.append(part)
            cols = [batch.column(0).take(pa.array(origin, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            cols += [pa.array([task] * len(nth), pa.int32()), pa.array(nth, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32", "_task", "_nth"]
            if with_ids:
                cols, names = [*cols, pa.array(content, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, _task int, _nth long" + ", ids binary" * with_ids
    return for_python(docs.select(F.col(id).alias("id"), F.col(text).alias("text"))).mapInArrow(run, schema).withColumnRenamed("id", id)


# -- placement --------------------------------------------------------------------------------------------------------------------


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first, each, sequence, offset`` in order: pieces of a length with rank `first` and on go to sequence `sequence` and on.

    `each` of them share a sequence.  There are a few rows per pattern, so their number follows the capacity, not the documents.
    """
    rows, used, sequence = [], defaultdict(int), 0
    for content, times in patterns:
        offset, i = 0, 0
        while i < len(content):
            size, each = content[i], 1
            while i + each < len(content) and content[i + each] == size:
                each += 1
            rows.append((size, used[size], each, sequence, offset))
            used[size] += times * each
            offset += each * size
            i += each
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(table: np.ndarray):
    ends = {int(s): (int(lo), int(hi)) for s, lo, hi in _stretches(table[:, 0])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for size, lo, hi in _stretches(length[order]):
                at = order[lo:hi]
                mine = table[slice(*ends[int(size)])]
                slot = mine[np.searchsorted(mine[:, 1], rank[at], side="right") - 1]
                step = rank[at] - slot[:, 1]
                sequence[at] = slot[:, 3] + step // slot[:, 2]
                offset[at] = slot[:, 4] + step % slot[:, 2] * size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    return run


def _stretches(values: np.ndarray) -> list[tuple]:
    """``(value, from, to)`` of each run of equal values."""
    if not len(values):
        return []
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return list(zip(values[at], at, np.append(at[1:], len(values))))


def pack(docs: DataFrame, document: str, id: str = "doc_id", text: str = "text", capacity: int = 2048, close: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of `pieces` with ``sequence_id`` and ``offset``: each piece lies in one sequence of at most `capacity`, gapless from 0.

    Repeated rows and null ids are documents of their own; an empty table gives an empty result; other columns are not read.
    """
    cut = materialise(pieces(docs, document, id, text, capacity, close, with_ids))
    # Pieces of one length are alike, so any numbering will do: by the task that cut them, then inside the task.  No length is a hot key.
    tally = materialise(cut.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = tally.select("length", "_task", (F.sum("_n").over(Window.partitionBy("length").orderBy("_task")) - F.col("_n")).alias("_before"))
    ranked = cut.join(before, ["_task", "length"]).withColumn("_rank", F.col("_before") + F.col("_nth")).select(*cut.columns, "_rank")
    schema = StructType([*ranked.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(_place(slots(plan(histogram, capacity))), schema).drop("_task", "_nth", "_rank")
