import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCUMENT = open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(df, pairs, library):
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.decode(bpe.encode(df, DOCUMENT), DOCUMENT).collect()), key=repr)
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)


def test_whole_table(documents, library):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()], library)


def test_odd_texts(docs_of, library):
    rng = random.Random(2)
    odd = [
        None, "", " ", "\n\t", "aaaaaaa aaa a", "ababab abababab", "It's we'll THEY'RE 'S", "x<|endoftext|>y<|startoftext|> <|endoftext|><|endof",
        "été İstanbul ΣΑΣ ß ſ Å", "12 3² ٤٥ Ⅻ", "a b c　d\x1ce\x85f​g", "\U0001f600\U0001f600 中文 ไทย",
        "z" * 100_000, "()[]{}...!!!??", "﻿bom ́ start", "\x00 null \x7f",
    ]
    pairs = list(enumerate(odd)) + [(3, "again"), (3, "again"), (None, "no id")]
    alphabet = "abcdeinrst'. \né̈A1<|>-"
    pairs += [(100 + i, "".join(rng.choices(alphabet, k=rng.randint(0, 80)))) for i in range(300)]
    check(docs_of(pairs), pairs, library)


def test_small_stretches(docs_of, library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH_BYTES", 20)
    monkeypatch.setattr(bpe, "REMEMBER", 3)
    pairs = [(i, f"some words {i % 5} and others {i}") for i in range(40)]
    check(docs_of(pairs).coalesce(1), pairs, library)


def test_empty_table(docs_of):
    assert bpe.decode(bpe.encode(docs_of([]), DOCUMENT), DOCUMENT).collect() == []
