from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import documents, empty

from wardlens.llm import queries, spelling_variants

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def near(u, v):
    """Whether the Levenshtein distance is one, by the table."""
    row = list(range(len(v) + 1))
    for i, a in enumerate(u, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(v, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1] == 1


def expected(rows, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    by_letters = {}
    for w in words:  # words one edit apart share a string that lacks one letter of either or of one
        for s in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by_letters.setdefault(s, set()).add(w)
    links = {w: set() for w in words}
    for some in by_letters.values():
        for u in some:
            links[u] |= {v for v in some if u != v and v not in links[u] and near(u, v)}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(links[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_query_equals_brute_force(spark):
    got = queries.op11_spelling_variants(spark, SF)
    assert got.columns == COLUMNS
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = expected(pairs_of(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows_of(got) == want
    assert any(f is not None for _, _, _, f, _, _ in want)


@pytest.mark.parametrize("unit", [3, 4096])
def test_edges_and_large_blocks(spark, unit):
    docs = documents(spark, repeat=True, null_id=True)
    got = spelling_variants.spelling_variants(docs, min_length=3, min_count=1, ratio=2, unit=unit)
    assert rows_of(got) == expected(pairs_of(docs), 3, 1, 2)
    assert spelling_variants.spelling_variants(empty(spark)).count() == 0


def test_chains_ties_and_long_words(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefé") for _ in range(5000))
    words = ["abcdefgh"] * 3 + ["abcdefghi"] * 40 + ["abcdefghij"] * 500 + ["xbcdefgh"] * 40 + [long, long + "x", long[1:]] * 2
    docs = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "doc_id long, text string")
    got = rows_of(spelling_variants.spelling_variants(docs))
    assert got == expected(list(enumerate(words)))
    by_word = {r[0]: r for r in got}
    assert by_word["abcdefgh"][3] == "abcdefghi" and by_word["abcdefgh"][5] == "abcdefghij"


def test_text_longer_than_a_part(spark):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcÉéÿ×") for _ in range(rng.randint(5, 9))) for _ in range(400_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    counted = {r["word"]: r["n"] for r in spelling_variants.word_counts(docs, 7, 1).collect()}
    want = {}
    for run, n in Counter(map(lowered, re.findall("[A-Za-zÀ-ÿ]+", text))).items():
        word = spelling_variants.slipped(run, zlib.crc32(b"1:"))
        if len(word) >= 7:
            want[word] = want.get(word, 0) + n
    assert counted == want


def test_letter_counts_give_distances():
    words = ["abcdefg", "abcdefh", "abcdefgé", "gfedcba"]
    counts = spelling_variants.letter_counts(words)
    squared = ((counts[:, None] - counts[None]) ** 2).sum(axis=2)
    assert squared.tolist() == [[0, 2, 1, 0], [2, 0, 3, 2], [1, 3, 0, 1], [0, 2, 1, 0]]
    found = list(spelling_variants.near_pairs(words, np.zeros(4, int)))
    assert found == [(0, 1), (0, 2), (0, 3), (1, 3), (2, 3)]
