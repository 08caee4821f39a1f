"""Line dedup by content-defined chunks: repeated passages of several lines go, wherever they stand in a document.

A rolling hash over the hashes of the last `SPAN` lines decides where a chunk ends, so the same lines are cut in the same places after any
shift.  Chunks of several lines whose digest occurs more than once are compared byte by byte (grouped by their text), and of equal ones
all but the first, by id and place, are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices
from gridloom.llm.quality_lines import hash48
from gridloom.session import lookup, materialise, row_count

#: Lines under the rolling hash, factor of the hash, and lines in a chunk on average and at most.
SPAN, FACTOR, AVERAGE, MOST = 3, 31, 4, 64


def chunks(text: bytes) -> list[tuple[int, int]]:
    """``(from, to)`` line numbers of the chunks, all lines covered.

    A line ends a chunk if h(i) + 31 h(i-1) + 961 h(i-2) of its and the two lines before it is divisible by `AVERAGE` (lines before the text
    count 0), or if the chunk has `MOST` lines.
    """
    out, start, window = [], 0, [0] * SPAN
    lines = text.split(b"\n")
    for i, line in enumerate(lines):
        window = [hash48(line), *window[:-1]]
        if sum(h * FACTOR**k for k, h in enumerate(window)) % AVERAGE == 0 or i + 1 - start == MOST or i + 1 == len(lines):
            out.append((start, i + 1))
            start = i + 1
    return out


def _passages(text: bytes) -> list[tuple[int, bytes]]:
    """Number and text of the chunks that have two or more lines with something in them."""
    lines = text.split(b"\n")
    out = []
    for k, (lo, hi) in enumerate(chunks(text)):
        if sum(1 for x in lines[lo:hi] if x.strip()) > 1:
            out.append((k, b"\n".join(lines[lo:hi])))
    return out


def _pairs(text: bytes) -> list[tuple[int, bytes]]:
    """Every line with something in it up to the next one: number of the first of the two, and their text with what is between."""
    lines = text.split(b"\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    return [(i, b"\n".join(lines[i:j + 1])) for i, j in zip(full, full[1:])]


def _lines_of_pairs(text: bytes, pairs: set[int]) -> set[int]:
    """The lines of the pairs of these numbers."""
    full = [i for i, x in enumerate(text.split(b"\n")) if x.strip()]
    return {n for i, j in zip(full, full[1:]) if i in pairs for n in range(i, j + 1)}


def _passage_digest(passage: bytes) -> bytes:
    return hashlib.md5(passage).digest()


def passages(docs: DataFrame, id: str, text: str, with_text: bool, pairs: bool = False) -> DataFrame:
    """``(id, doc, chunk, digest[, passage])`` per chunk of several lines, or per pair of lines; `doc` is the MD5 of the document's text."""
    parts = _pairs if pairs else _passages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at, doc, chunk, digest, passage = [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                whole = hashlib.md5(t).digest()
                for k, p in parts(t):
                    at.append(i), doc.append(whole), chunk.append(k), digest.append(_passage_digest(p))
                    if with_text:
                        passage.append(p)
            cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(doc, pa.binary()), pa.array(chunk, pa.int32()), pa.array(digest, pa.binary())]
            if with_text:
                cols.append(pa.array(passage, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names)

    names = ["id", "doc", "chunk", "digest", *["passage"] * with_text]
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, doc binary, chunk int, digest binary" + ", passage binary" * with_text
    return for_python(docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))).mapInArrow(run, schema)


def _repeats(docs: DataFrame, id: str, text: str, pairs: bool) -> DataFrame:
    """``(id, doc, chunk)`` of the passages that an earlier place has."""
    seen = materialise(passages(docs, id, text, False, pairs))
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("chunk").alias("chunk"))
    again = materialise(seen.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    # The bytes decide: equal passages meet under their text, combined inside each task first.
    full = lookup(passages(docs, id, text, True, pairs), again.withColumn("_again", F.lit(True)), ["digest"], at_most=row_count(again))
    equal = materialise(full.groupBy("digest", "passage").agg(F.min(place).alias("first")))
    texts = equal.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"))
    plain = materialise(texts.filter("texts = 1").select("digest", "first"))
    gone = lookup(seen, plain, ["digest"], at_most=row_count(plain)).filter(place != F.col("first")).select("id", "doc", "chunk")
    odd = materialise(texts.filter("texts > 1").select("digest"))
    if row_count(odd):
        # Different passages with one digest: told apart by their text.
        both = passages(docs, id, text, True, pairs).join(odd, "digest", "left_semi").join(equal, ["digest", "passage"])
        gone = gone.unionByName(both.filter(place != F.col("first")).select("id", "doc", "chunk"))
    return gone


def remove_repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", pairs: bool = False, chunked: bool | None = None) -> DataFrame:
    """All columns of `docs`, the text without repeated passages, and ``n_lines``, ``n_lines_removed``, ``n_chunks_removed``.

    A passage is a chunk with at least two lines that are not blank.  Of equal passages the one with the smallest (id, chunk number) stays,
    null ids last; rows that repeat an id with the same text stay or lose passages alike.  A null text stays null and has no lines.  An
    empty table gives an empty result.  Columns of `docs` with the names of the new ones are replaced.

    With `pairs` the passages are all pairs of neighbouring lines with something in them, and what is between, so that a run of two or more
    lines goes whatever surrounds it and no boundary can miss it; ``n_chunks_removed`` counts pairs, and a line of any such pair goes.
    Every line that goes stands, with its neighbour, at an earlier place, but not all of that place need have stayed.  With `chunked` as well
    (by default either chunks or pairs) both kinds of passages are judged on the text as given; what either takes goes, and both count.
    """
    chunked = not pairs if chunked is None else chunked
    kinds = [k for k, wanted in ((False, chunked), (True, pairs)) if wanted]
    gone = None
    for k in kinds:
        some = _repeats(docs, id, text, k).withColumn("pairs", F.lit(k))
        gone = some if gone is None else gone.unionByName(some)
    lists = gone.groupBy(F.col("id").alias("_id"), F.col("doc").alias("_doc")).agg(
        F.sort_array(F.collect_set(F.when(~F.col("pairs"), F.col("chunk")))).alias("_gone"), F.sort_array(F.collect_set(F.when(F.col("pairs"), F.col("chunk")))).alias("_pairs")
    )
    new = ["n_lines", "n_lines_removed", "n_chunks_removed"]
    columns = [c for c in docs.columns if c not in new]
    doc = F.unhex(F.md5(F.col(text).cast("binary")))
    rows = docs.select(*columns).join(lists, F.col(id).eqNullSafe(F.col("_id")) & (doc == F.col("_doc")), "left").select(*columns, "_gone", "_pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text)
        for batch in slices(batches, text):
            left, n_lines, n_removed, n_chunks = [], [], [], []
            for t, gone, twos in zip(*(batch.column(k).to_pylist() for k in (at, len(columns), len(columns) + 1))):
                lines, drop = [] if t is None else t.split("\n"), set()
                if gone:
                    cut = chunks(t.encode())
                    drop |= {n for k in gone for n in range(*cut[k])}
                if twos:
                    drop |= _lines_of_pairs(t.encode(), set(twos))
                if drop:
                    t = "\n".join(x for n, x in enumerate(lines) if n not in drop)
                left.append(t), n_lines.append(len(lines)), n_removed.append(len(drop)), n_chunks.append(len(gone or ()) + len(twos or ()))
            kept = [pa.array(left, pa.string()) if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, pa.int64()) for v in (n_lines, n_removed, n_chunks))], [*columns, *new])

    schema = docs.select(*columns).schema
    for c in new:
        schema = schema.add(c, "long")
    return for_python(rows).mapInArrow(run, schema)
