from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge import documents, empty
from tokenizers import Tokenizer

from wardlens.llm import queries, token_alignment
from wardlens.llm.token_counts import _byte_letters

SF = "/root/testdata/sf0.001"
FILES = tuple(public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def encoded(texts):
    """Per text: tokens of both sides as (id, bytes), by the libraries on the whole text."""
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters, names = _byte_letters(), {i: t for t, i in first.get_vocab().items()}
    for text in texts:
        if not text:
            yield [], []
            continue
        a = [(i, bytes(letters[c] for c in names[i])) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            b.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        good = all(b"".join(t for _, t in side) == whole for side in (a, b))
        yield (a, b) if good else ([], [])


def grouped(a, b):
    def ends(side):
        at, out = 0, []
        for _, t in side:
            at += len(t)
            out.append(at)
        return out

    a_ends, b_ends = ends(a), ends(b)
    out, i, j = [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        out.append(([t for t, _ in a[i:k]], [t for t, _ in b[j:m]]))
        i, j = k, m
    return out


def expected(rows):
    docs = []
    for (doc, _), (a, b) in zip(rows, encoded([t for _, t in rows])):
        groups = grouped(a, b)
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    held = Counter(pair for d in docs for pair in d[4])
    highest = Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    return sorted(
        (
            (
                doc, n_a, n_b, n_groups, sum(links.values()), sum(n for p, n in links.items() if held[p] == highest[p[0]]),
                sum(held[p] * n for p, n in links.items()), digest,
            )
            for doc, n_a, n_b, n_groups, links, digest in docs
        ),
        key=str,
    ), held


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_query_equals_brute_force(spark):
    got = queries.op12_token_alignment(spark, SF)
    assert all(t == "bigint" for c, t in got.dtypes if c != "groups_sha256")
    assert rows_of(got) == expected(texts_of(spark.read.parquet(f"{SF}/documents.parquet")))[0]


def test_edges_with_many_units(spark):
    docs = documents(spark, repeat=True, null_id=True)
    want, held = expected(texts_of(docs))
    assert rows_of(token_alignment.token_alignment(docs, *FILES)) == want
    small = token_alignment.Alignment(docs, *FILES, groups=True, radix=4, unit=200)
    assert small.salts.where("salts > 1").count() > 0
    rows = small.documents().collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str) == want
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in rows if r["groups"])
    pairs = {(r["a_id"], r["b_id"]): r["n"] for r in token_alignment.aligned_pairs(docs, *FILES).collect()}
    assert pairs == held


def test_empty(spark):
    assert token_alignment.token_alignment(empty(spark), *FILES).count() == 0


ODD = [
    "a  b", " a", "a ", "a\n b", "a \n\n  b c", "x́ y ́z", "  a  b c", "▁x y", "<s> a </s> <|endoftext|> b", "<0x41> a",
    "日本 語 a 日", "\x00 a \x1c b", "it's 's a 'll b", "😀 a😀b 😀", "  a", "ﬁ ﬀ a", "ﬁ ﻿a b", "a\tb c", "1 2 34 5,6 .7",
]


def test_units_equal_the_libraries(monkeypatch):
    rng = random.Random(6)
    pieces = ["a", " ", "  ", "\n", "é", "word", "Word,", ".", "'s", "日", "́", "<s>", "123", " ", "-", "\t", "▁", "x" * 70]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    aligner = token_alignment.Aligner(token_alignment.read_setup(*FILES))
    want = [grouped(a, b) for a, b in encoded(texts)]
    for memo in (token_alignment.MEMO, 3):
        monkeypatch.setattr(token_alignment, "MEMO", memo)
        for at in range(0, len(texts), 50):
            batch = aligner.align(texts[at : at + 50])
            strings = [";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in w) for w in want[at : at + 50]]
            assert batch.groups == strings
            assert batch.numbers["n_groups"].tolist() == [len(w) for w in want[at : at + 50]]


@pytest.mark.parametrize("few", [0, 64])
def test_groups_of_many_links(monkeypatch, few):
    monkeypatch.setattr(token_alignment, "FEW", few)
    s = token_alignment.SECOND

    def align(a, b, a_sizes, b_sizes, ends):
        ids = np.array(a), np.array(b)
        return token_alignment.align(*ids, np.cumsum(a_sizes), np.cumsum(b_sizes), np.array(ends))

    found = align([5, 5, 7, 5, 6], [1, 2, 4, 1, 3], [1] * 5, [1] * 5, [4, 5])
    assert found.groups == ["5|1;5|2;7|4;5|1", "6|3"] and found.n_links.tolist() == [4, 1]
    assert found.pairs.tolist() == [5 * s + 1, 5 * s + 2, 7 * s + 4, 6 * s + 3] and found.links.tolist() == [2, 1, 1, 1]
    wide = align([5, 5, 7], [1, 2], [1, 1, 2], [3, 1], [4])
    assert wide.groups == ["5,5,7|1,2"] and wide.n_links.tolist() == [6]
    assert dict(zip(wide.pairs.tolist(), wide.links.tolist())) == {5 * s + 1: 2, 5 * s + 2: 2, 7 * s + 1: 1, 7 * s + 2: 1}
    assert align([5, 7], [1, 2], [1, 3], [2, 2], [2, 4]) is None
