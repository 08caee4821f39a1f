"""Ranked lexical search, exact: term at a time over blocks of documents, with as many accumulators as the bounds call for.

Documents are cut down once to the terms that some item has.  A task inverts its documents block by block and takes an item's terms rarest
first.  Terms open accumulators until the bounds of the terms left cannot lift a new document to the k-th best partial score; from then on
only accumulators that can still get there are updated, exactly.  The k-th best score of earlier blocks of the task holds for later ones.  Each
task hands on its k best documents an item; the best of all are among them, since every score is that of the whole corpus.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices
from gridloom.session import discard, global_rank, materialise, row_count

#: Pairs of item and term that are searched in one pass; an item is never parted.  The terms of a pass are sent to all tasks.
PASS_PAIRS = 200_000
#: A block is inverted when it has this many documents or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 21
#: Tasks whose best documents are compared with each other before all are.
NEAR_TASKS = 256
#: Bytes of terms: ASCII digits and letters, in lower case, and whatever is not ASCII; every other byte parts terms.
_TERMS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _texts(rows: DataFrame, id: str, text: str) -> DataFrame:
    return for_python(rows.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text")))


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``(id, term)``: the distinct terms of each item; rows that share an id are one item, and so are those without an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sorted(set(terms(t.as_py() or b""))) for t in batch.column(1)]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([t for f in found for t in f], pa.binary())], ["id", "term"])

    kind = items.schema[id].dataType.simpleString()
    return _texts(items, id, text).mapInArrow(run, f"id {kind}, term binary").distinct()


def vectors(docs: DataFrame, number: dict[bytes, int], id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n, term, tf)`` per row of `docs`: all its terms counted, and those in `number` with their occurrences."""
    known = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in slices(batches, "text"):
            n, ends, term, tf = [], [0], [], []
            for t in batch.column(1):
                words = terms(t.as_py() or b"")
                n.append(len(words))
                found, times = np.unique(np.array([x for x in map(get, words) if x is not None], np.int32), return_counts=True)
                term.append(found)
                tf.append(times)
                ends.append(ends[-1] + len(found))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(kind))) for x, kind in ((term, np.int32), (tf, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["id", "n", "term", "tf"])

    kind = docs.schema[id].dataType.simpleString()
    return _texts(docs, id, text).mapInArrow(run, f"id {kind}, n long, term array<int>, tf array<long>")


def _holders(index: DataFrame, size: int) -> DataFrame:
    """``(term, df)``: documents that hold a term, counted in each task before they are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held])], ["term", "df"])

    return index.select("term").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Block:
    """Postings of a block of documents by term."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.size, self.doc, term, tf = len(n), doc[order], term[order], tf[order]
        m = 50 + (50 * n * n_docs) // n_terms
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc])
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(term))
        most = np.maximum.reduceat(self.impact, starts) if len(starts) else starts
        self.lists = {int(t): (int(a), int(b), int(x)) for t, a, b, x in zip(term[starts], starts, ends, most)}

    def search(self, query: list[tuple[int, int]], k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that may be among the `k` best with a score of `least` or more: places, exact scores, and accumulators opened.

        `query` has terms and weights, rarest first.  All documents that tie with the k-th best are returned.
        """
        lists = [(*self.lists[t], w) for t, w in query if w > 0 and t in self.lists]
        left = np.cumsum([0, *(w * most for _, _, most, w in lists[::-1])])[::-1]
        score, live = np.zeros(self.size, np.int64), None
        for (a, b, _, w), bound in zip(lists, left):
            doc, part = self.doc[a:b], w * self.impact[a:b]
            if live is None:
                open_ = np.flatnonzero(score)
                if len(open_) >= k:
                    least = max(least, int(np.partition(score[open_], len(open_) - k)[len(open_) - k]))
                if bound < least:
                    # A document without an accumulator gets less than `least`, which k documents have.
                    live = np.zeros(self.size, bool)
            if live is not None:
                live = score + bound >= least if not live.any() else live & (score + bound >= least)
                live &= score > 0
                if not live.any():
                    break
                keep = live[doc]
                doc, part = doc[keep], part[keep]
            score[doc] += part
        opened = np.flatnonzero(score)
        if len(opened) >= k:
            least = max(least, int(np.partition(score[opened], len(opened) - k)[len(opened) - k]))
        best = opened[score[opened] >= least]
        if live is not None:
            best = best[live[best]]
        return best, score[best], len(opened)


def _best(table: pa.Table, k: int) -> pa.Table:
    order = pc.sort_indices(table, [("score", "descending"), ("id", "ascending")], null_placement="at_start")
    return table.take(order[:k])


def search(index: DataFrame, queries: list[list[tuple[int, int]]], k: int, n_docs: int, n_terms: int) -> DataFrame:
    """``(q, id, score)``: of each task the `k` best documents of each query, equal scores by ascending id (null first)."""
    asked = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        held: list[pa.RecordBatch] = []
        docs = postings = 0

        def settle() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            n, tf = rows["n"].to_numpy(), rows["tf"].combine_chunks()
            doc = np.repeat(np.arange(len(n)), np.asarray(pc.list_value_length(tf).to_numpy(zero_copy_only=False), np.int64))
            term = rows["term"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            block = Block(n, doc, term, tf.flatten().to_numpy(zero_copy_only=False), n_docs, n_terms)
            for q, query in enumerate(asked.value):
                before = best.get(q)
                least = before["score"][-1].as_py() if before is not None and before.num_rows >= k else 1
                at, score, _ = block.search(query, k, least)
                if len(at):
                    found = pa.table({"id": rows["id"].take(pa.array(at)), "score": pa.array(score)})
                    best[q] = _best(found if before is None else pa.concat_tables([before, found]), k)

        for batch in batches:
            lengths = np.cumsum(np.asarray(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False), np.int64))
            at = 0
            while at < batch.num_rows:
                room = np.searchsorted(lengths, (lengths[at - 1] if at else 0) + BLOCK_POSTINGS - postings, "right")
                end = min(max(int(room), at + 1), at + BLOCK_DOCS - docs, batch.num_rows)
                held.append(batch.slice(at, end - at))
                docs, postings = docs + end - at, postings + int(lengths[end - 1] - (lengths[at - 1] if at else 0))
                at = end
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS or at < batch.num_rows:
                    settle()
                    held.clear()
                    docs = postings = 0
        if held:
            settle()
        for q, table in best.items():
            rows = table.combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, q, np.int32)), rows.column(0), rows.column(1)], ["q", "id", "score"])

    kind = index.schema["id"].dataType.simpleString()
    return index.mapInArrow(run, f"q int, id {kind}, score long")


def _passes(pairs: DataFrame) -> Iterator[DataFrame]:
    """`pairs` in parts of about `PASS_PAIRS` rows with whole items."""
    if row_count(pairs) <= PASS_PAIRS:
        yield pairs
        return
    placed = materialise(global_rank(pairs, [F.asc("id"), F.asc("term")], "_at"))
    firsts = materialise(placed.groupBy("id").agg(F.expr(f"(min(_at) - 1) DIV {PASS_PAIRS}").alias("_pass")))
    for number in range(-(-row_count(pairs) // PASS_PAIRS)):
        part = firsts.filter(F.col("_pass") == number).withColumnRenamed("id", "_item")
        yield materialise(placed.join(F.broadcast(part), F.col("id").eqNullSafe(F.col("_item"))).select("id", "term"))


def top_documents(
    items: DataFrame, docs: DataFrame, k: int = 50, item_id: str = "item_id", doc_id: str = "doc_id", item_text: str = "text", text: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the `k` documents with the highest score above 0 for each item, equal scores by ascending id.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z.  Scores are integers, from the
    document frequency of a term (`weight`), its occurrences and the document's length against the mean of documents with a term.  Null texts
    have no terms.  Rows of `docs` are documents of their own, repeated ones too; null ids come first among equal scores.  Rows of `items`
    that share an id are one item; items without a match have no row.  Empty tables give an empty result; other columns are not read.
    """
    spark, kind = docs.sparkSession, items.schema[item_id].dataType.simpleString()
    pairs = materialise(item_terms(items, item_id, item_text))
    out = None
    for part in _passes(pairs):
        by_item: dict = defaultdict(list)
        for r in part.toLocalIterator():
            by_item[r["id"]].append(bytes(r["term"]))
        names = list(by_item)
        number = {t: i for i, t in enumerate(sorted({t for found in by_item.values() for t in found}))}
        index = materialise(vectors(docs, number, doc_id, text))
        n_docs, n_terms = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r["term"]: r["df"] for r in _holders(index, len(number)).collect()} if n_terms else {}
        queries = [[(t, weight(n_docs, df[t])) for t in sorted((number[x] for x in by_item[i] if number[x] in df), key=lambda t: (df[t], t))] for i in names]
        best = search(index, queries, k, n_docs, max(n_terms, 1))
        order = [F.desc("score"), F.asc("id")]
        near = Window.partitionBy("q", F.floor(F.spark_partition_id() / NEAR_TASKS)).orderBy(*order)
        best = best.withColumn("_near", F.row_number().over(near)).filter(F.col("_near") <= k)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(names)), f"q int, item {kind}")
        found = materialise(best.join(F.broadcast(named), "q").select(F.col("item").alias("_item"), "rank", F.col("id").alias("_doc"), "score"))
        discard(index)
        out = found if out is None else out.unionByName(found)
    return out.withColumnsRenamed({"_item": item_id, "_doc": doc_id})
