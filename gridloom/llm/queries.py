"""One query per operator: it reads the whole table, applies the operator with production parameters and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, digest, html_text, language, lexical, line_chunks, merkle, packing, pii, quality_lines, simhash, sql, suffix_dedup, warc
from gridloom.session import materialise

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable) -> Callable:
        QUERIES[name] = (fn, sql)
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def tokenizer(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def pieces_model(name: str = "piece_bpe_32k.model") -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@query("op1_quality_lines", sql.QUALITY)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return quality_lines.judge(docs).select("doc_id", *quality_lines.COUNTS, "base_failed", "kept", "words_removed")


@query("op2_warc", sql.WARC)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written to the shared folder and read back from it."""
    archives = materialise(warc.write_archives(read(spark, sf_dir, "pages", "page_id", "url", "html")))
    records = warc.read_archives(archives, with_payload=False)
    fault = F.raise_error(F.concat(F.lit("bad record: "), "error")).cast("long")
    return records.select(
        F.when(F.col("error").isNotNull(), fault).otherwise(warc.page_of("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.page_of("refers_to").alias("refers_to"),
    )


@query("op3_suffix_dedup", sql.SUFFIX)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("byte_bpe_50k.json"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    vocabulary = language.Vocabulary.of_model(pieces_model())
    model = language.learn(docs, vocabulary, where=~F.col("held_out"))
    return language.predict(docs, vocabulary, model, keep=["held_out"])


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "html"))


@query("op7_line_dedup", sql.LINE_DEDUP)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_chunks.remove_repeated(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_lines_removed", "n_chunks_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op8_digest")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    rank = digest.rank_table(digest.census(docs))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    pairs = digest.with_next(docs).withColumn("n_chars", n.cast("long"))
    pairs = pairs.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars as int) - cast(floor(n_chars / 4) as int))"), F.substring("next_text", F.lit(1), cut)))
    pairs = pairs.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    names = {"text": "fingerprint", "edited": "edited_fingerprint", "next_text": "next_fingerprint"}
    likes = {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "next_fingerprint")}
    out = digest.digests(pairs, names, rank, likes)
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = tokenizer("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), document), document)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op11_pii")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find(docs, pii.learn(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"cast(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


@query("op12_lexical_search", sql.LEXICAL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(read(spark, sf_dir, "benchmark", "item_id", "text"), read(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_merkle", sql.MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *merkle.FIELDS)
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = merkle.manifest(docs, tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, when=even)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
