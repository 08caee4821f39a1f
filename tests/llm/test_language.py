import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import language
from gridloom.llm.language import Model, Vocabulary, expected_counts, learn, log_probability, predict
from gridloom.llm.queries import pieces_model


def segmentations(data, pieces):
    """All ways to cut bytes into pieces and single bytes, as lists of numbers; a byte may be a piece as well."""
    if not data:
        yield []
    for k in range(1, len(data) + 1):
        options = ([data[0]] if k == 1 else []) + ([pieces[data[:k]]] if data[:k] in pieces else [])
        for p in options:
            for rest in segmentations(data[k:], pieces):
                yield [p, *rest]


@pytest.fixture(scope="module")
def small():
    vocabulary = Vocabulary(["▁a".encode(), b"a", b"ab", b"b", "é".encode(), "bé".encode(), "▁".encode()])
    rng = np.random.default_rng(0)
    p = rng.random((vocabulary.size, 2))
    return vocabulary, Model(["x", "y"], np.log(p / p.sum(axis=0)))


def test_forward_sums_all_segmentations(small):
    vocabulary, model = small
    words = ["a", "ab", "aab", "bé", "éa", "q"]
    got = log_probability(vocabulary, words, model)
    for w, row in zip(words, got):
        for lang in range(2):
            want = sum(math.exp(sum(model.log_p[p, lang] for p in s)) for s in segmentations(("▁" + w).encode(), vocabulary.number))
            assert row[lang] == pytest.approx(math.log(want), rel=1e-9)


def test_long_words_agree(small, monkeypatch):
    vocabulary, model = small
    words = ["ab" * 9, "aé" * 7, "b" * 30]
    short = log_probability(vocabulary, words, model)
    monkeypatch.setattr(language, "SHORT", 3)
    assert log_probability(vocabulary, words, model) == pytest.approx(short, rel=1e-9)


def test_expected_counts(small):
    vocabulary, model = small
    p = np.exp(model.log_p[:, 0])
    words, weight = ["ab", "aab"], np.array([2.0, 3.0])
    want = np.zeros(vocabulary.size)
    for w, n in zip(words, weight):
        ways = [(s, math.prod(p[k] for k in s)) for s in segmentations(("▁" + w).encode(), vocabulary.number)]
        total = sum(x for _, x in ways)
        for s, x in ways:
            for k in s:
                want[k] += n * x / total
    assert expected_counts(vocabulary, vocabulary.edges(words), weight, p) == pytest.approx(want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    vocabulary = Vocabulary.of_model(pieces_model())
    model = learn(docs, vocabulary, where=~held, sample=60)
    rows = predict(docs.filter(held), vocabulary, model, keep=["lang"]).collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, docs_of, small):
    vocabulary, model = small
    rows = [(1, None), (2, ""), (3, "12 # \n ²"), (4, "ab"), (4, "ab"), (None, "é" * 5000), (6, "中文")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs_of(rows), vocabulary, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in "xy" and got[None][0] in "xy" and got[6][0] in "xy"
    none = learn(docs_of([(1, None)]), vocabulary)
    assert none.languages == [] and predict(docs_of(rows), vocabulary, none).select("lang_pred").distinct().collect()[0][0] == "und"
    assert predict(docs_of([]), vocabulary, model).collect() == []
    assert learn(docs_of([]), vocabulary).languages == []
