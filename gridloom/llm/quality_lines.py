"""Quality rules with cross-document line frequency: boilerplate lines of a host go, and documents that consist of them are rejected.

Lines are normalised and hashed.  Per host, the distinct documents that hold a line are counted; equal texts are one document here, so that
a much copied text does not turn its own lines into boilerplate.  A line above the limits is removed from the host's documents, and a document that loses most of its words
is depleted.  Base rules on length and repetition come first.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices
from gridloom.session import lookup, materialise

_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\v\f\r"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
#: Words of a line and columns that `measure` gives besides the document's own.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def hash48(data: bytes) -> int:
    """The first twelve hexadecimal digits of the MD5 as a number."""
    return int.from_bytes(hashlib.md5(data).digest()[:6], "big")


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines with a word, words in repeated three-word windows."""
    blank = len(text) - len(text.translate(None, _BLANKS))
    chars = len(text.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        count, last = Counter(windows), 0
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeated += i + 3 - max(i, last)
                last = i + 3
    return len(words), chars - blank, symbols, len(lines) - len(set(lines)), repeated


def normal_line(line: bytes) -> bytes:
    """Lower case (ASCII), one blank between words, every digit a zero."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def measure(docs: DataFrame, id: str, text: str, host: str) -> DataFrame:
    """Per row its id, host, text digest, counts, identity and the hashes of its lines that have a word, in order with their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for t in batch.column(2).to_pylist():
                t = t or b""
                lines = []
                for n, x in enumerate(t.split(b"\n")):
                    plain = normal_line(x)
                    if plain:
                        lines.append({"n": n, "line": hash48(plain), "words": plain.count(b" ") + 1})
                rows.append((hashlib.md5(t).digest(), *base_counts(t, t.split()), lines))
            cols = list(zip(*rows))
            kinds = [pa.binary(), *[pa.int64()] * len(COUNTS), pa.list_(pa.struct([("n", pa.int32()), ("line", pa.int64()), ("words", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    names = ["id", "host", "digest", *COUNTS, "lines"]
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, host string, digest binary, " + ", ".join(f"{c} long" for c in COUNTS) + ", lines array<struct<n:int,line:bigint,words:int>>"
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).cast("binary").alias("text"))
    return for_python(rows).mapInArrow(run, schema)


def judge(
    docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 50, max_repeat: int = 50,
    min_docs: int = 25, max_share: float = 0.01, least_left: float = 0.3,
) -> DataFrame:
    """Per row: id, digest of the text, the five counts, ``base_failed``, ``kept``, ``words_removed`` and ``lines_removed`` (line numbers).

    Base rules: fewer than `min_words` words, or more than `max_repeat` percent of the words in repeated three-word windows.  A line is
    boilerplate of a host if more than `min_docs` distinct documents and more than `max_share` of the host's distinct documents have it.
    A document is depleted if less than `least_left` of its words are in other lines.  Documents that fail the base rules count for the
    frequencies like all others.  Distinct documents are distinct texts.

    A null or empty text has no words and fails; a null host is a host of its own, the empty string too; repeated rows are one document
    for the frequencies and each get their row; an empty table gives an empty result; other columns are not read.
    """
    seen = materialise(measure(docs, id, text, host))
    lines = seen.select("host", "digest", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    # Two steps of partial aggregation: a line or host that is in a third of all rows is combined before it moves.
    holders = lines.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("_docs")).filter(F.col("_docs") > min_docs)
    hosts = seen.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_all"))
    common = holders.join(hosts, "host").filter(F.col("_docs") > max_share * F.col("_all")).select("host", "line", F.lit(True).alias("_common"))
    common = materialise(common)
    rows = materialise(seen.select("id", "host", "digest", F.explode("lines").alias("x")).select("id", "digest", "host", "x.*"))
    found = lookup(rows, common, ["host", "line"]).groupBy("id", "host", "digest").agg(
        F.sort_array(F.collect_set("n")).alias("lines_removed"), F.sum("words").alias("_words"), F.count(F.lit(1)).alias("_n"))
    # Rows that repeat id, host and text were counted together.
    found = found.withColumn("words_removed", F.expr("_words * size(lines_removed) div _n")).select(
        F.col("id").alias("_id"), F.col("host").alias("_host"), F.col("digest").alias("_digest"), "lines_removed", "words_removed")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("host") == F.col("_host")) & (F.col("digest") == F.col("_digest"))
    out = seen.drop("lines").join(found, same, "left").drop("_id", "_host", "_digest")
    removed = F.coalesce("words_removed", F.lit(0)).cast("long")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    depleted = (F.col("n_words") - removed) < least_left * F.col("n_words")
    return out.select(
        F.col("id").alias(id), "host", "digest", *COUNTS, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        removed.alias("words_removed"), F.coalesce("lines_removed", F.array().cast("array<int>")).alias("lines_removed"),
    )


def clean(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The kept rows of `docs`, all columns, with boilerplate lines taken out of the text.

    Rows are told by id, host and text as in `judge`: repeated rows stay repeated, a null id or host is a value of its own, null and empty texts
    fail the base rules and go, an empty table stays empty.  Other columns are handed on, whatever their names.
    """
    marks = judge(docs, id, text, host, **limits)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    touched = marks.filter(~F.col("kept") | (F.size("lines_removed") > 0)).select(
        F.col(id).alias("id"), F.col("host"), F.col("digest"), "kept", "lines_removed").distinct().alias("m")
    plain = docs.select(row).alias("d")
    own_text, own_host = F.col("d.row")[text], F.col("d.row")[host].cast("string")
    digest = F.unhex(F.md5(F.coalesce(own_text, F.lit("")).cast("binary")))
    same = F.col("d.row")[id].eqNullSafe(F.col("m.id")) & (F.coalesce(own_host, F.lit("")) == F.col("m.host")) & (digest == F.col("m.digest"))
    out = plain.join(touched, same, "left").filter("m.kept IS NULL OR m.kept")
    left = F.array_join(F.filter(F.split(own_text, "\n", -1), lambda x, n: ~F.array_contains("m.lines_removed", n)), "\n")
    cleaned = F.when(F.size("m.lines_removed") > 0, left).otherwise(own_text)
    return out.select(*[(cleaned if c == text else F.col("d.row")[c]).alias(c) for c in docs.columns])
