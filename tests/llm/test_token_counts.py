from __future__ import annotations

import random

import edge
import public_tokenizers
import pytest
from conftest import SF
from tokenizers import Tokenizer

from wardlens.llm import pretokens, token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def setup():
    with open(FILE, encoding="utf-8") as file:
        return token_counts.counting(file.read())


def test_every_whole_token_is_one_token_of_the_library(library, setup):
    texts = sorted(setup.whole)
    assert len(texts) > 20_000
    assert set(expected(library, texts)) == {1}


def test_odd_characters_count_as_in_the_library(library, setup):
    rng = random.Random(3)
    odd = "aB zé Ñ'sĐΣσςİıǅﬁ①Ⅷ²½一二ぁ한글́̈\t\n\r\x0b\x0c\x1c\x85\xa0 　﻿!?—’“€𝐀😀\x00\x7f-_12३"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choice(pretokens.CANDIDATES) for _ in range(60)) for _ in range(1500)]
    texts += ["<|endoftext|>" * 3, "<|ENDOFTEXT|> WE'RE x's's <|startoftext|>y", "ΌΣΟΣ"]
    assert token_counts.Counter(setup).count(texts) == expected(library, texts)


def test_long_texts_are_split_where_tokens_end(library, setup, monkeypatch):
    monkeypatch.setattr(pretokens, "PART", 50)
    texts = ["It's a long text, isn't it? " * 40, "no-breaks-" * 100, "tab\tand  two  spaces " * 30]
    assert token_counts.Counter(setup).count(texts) == expected(library, texts)


def test_memory_of_merged_pretokens_is_bounded(library, setup, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 3)
    texts = ["zqxj qqzx wxyzzy plughh xyzzq", "qqzx plughh zzzqqq"]
    counter = token_counts.Counter(setup)
    assert counter.count(texts) == expected(library, texts)
    assert len(counter.known) <= 3


def test_whole_tables(spark, library):
    plain = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = edge.documents(spark, repeat=True, null_id=True)
    for docs in (plain, odd):
        rows = docs.select("doc_id", "text").collect()
        want = sorted(
            (str(r.doc_id), len((r.text or "").encode()), n, n > 2048)
            for r, n in zip(rows, expected(library, [r.text for r in rows]))
        )
        got = token_counts.token_counts(docs, FILE)
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert token_counts.token_counts(edge.empty(spark), FILE).count() == 0
