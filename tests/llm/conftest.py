import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{BASE}/documents.parquet")


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with extra columns that have operators' names."""

    def make(pairs):
        rows = [(i, t, "en", "a", None, "x") for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")

    return make
