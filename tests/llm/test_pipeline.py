import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridloom.llm import packing


def test_entry_registers_every_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 11)) and len(names) == 10
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "substring_dedup", "pack"]


@pytest.fixture(scope="module")
def raw(spark):
    def body(k, n=120):
        return " ".join(f"w{k}y{i}" for i in range(n))

    passage = "\n".join(" ".join(f"passage{i}z{j}" for j in range(8)) for i in range(40))
    rows = [(k, body(k), "en", f"s{k % 3}", 1) for k in range(10)]
    rows += [(20, body(3), "en", "s0", 1), (21, body(4) + " more", "en", "s1", 1), (22, "too short", "en", "s1", 1), (23, None, None, None, None)]
    rows += [(30, body(30) + "\n" + passage, "en", "s0", 1), (31, body(31) + "\n" + passage, "en", "s0", 1), (None, body(40), "en", "s0", 1)]
    rows += [(50, body(50) + " é " + " ".join(body(60).split()[:30]), "en", "s1", 1), (51, body(51) + " é " + " ".join(body(60).split()[:30]), "en", "s1", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, raw, tmp_path):
    docs, seen = raw, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        if name != "pack":
            assert docs.columns == raw.columns and [f.dataType for f in docs.schema] == [f.dataType for f in raw.schema]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert {22, 23}.isdisjoint(ids["quality"]) and set(range(10)) <= ids["quality"]
    assert ids["line_dedup"] == ids["quality"]
    assert 20 not in ids["near_dedup"] and set(range(10)) | {30, 31, 50, 51, None} <= ids["near_dedup"]
    assert set(range(10)) | {30, 31, 50, 51, None} <= ids["substring_dedup"]
    assert "passage3z" in seen["line_dedup"].filter("doc_id = 30").first().text
    short = seen["substring_dedup"].filter("doc_id = 51").first().text
    assert "w60y5" not in short and "w51y100" in short
    places = seen["pack"].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("top")).collect()
    assert places and all(r.n == r.top <= 2048 for r in places)
    assert ids["pack"] == ids["substring_dedup"]


def test_whole_table(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.filter(F.crc32("ids") != F.col("ids_crc32")).count() == 0
    full = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), open(__import__("public_tokenizers").path("byte_bpe_50k.json")).read())
    assert 0 < out.agg(F.sum("length")).first()[0] < full.agg(F.sum("length")).first()[0]


def test_empty_table(spark, raw, tmp_path):
    docs = raw.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / f"none-{name}")
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0
