from __future__ import annotations

import hashlib
import random

import edge
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from wardlens.llm import prefix_doubling, suffix_dedup

FINDS = [suffix_dedup.anchored_matches, prefix_doubling.matches]


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, sha256) of each (id, bytes), comparing every window."""
    first: dict[bytes, int] = {}
    for i, b in rows:
        if i is not None:
            for p in range(len(b) - length + 1):
                w = b[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1 if i is not None else 0):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(docs, length, find=suffix_dedup.anchored_matches):
    rows = suffix_dedup.suffix_dedup(docs, length, find).collect()
    for r in rows:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def pairs(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("find", FINDS)
def test_fixture(spark, find):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs, 50, find) == brute(pairs(docs), 50)


@pytest.mark.parametrize("find", FINDS)
@pytest.mark.parametrize("repeat", [False, True])
def test_edges(spark, repeat, find):
    docs = edge.documents(spark, repeat, null_id=repeat)
    assert result(docs, 50, find) == brute(pairs(docs), 50)


@pytest.mark.parametrize("find", FINDS)
@pytest.mark.parametrize("length", [2, 7, 20])
def test_random_strings_with_many_overlaps(spark, length, find):
    rng = random.Random(length)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i * 3 % 61, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert result(docs, length, find) == brute(pairs(docs), length)


def test_blocks_of_a_long_text_give_the_same_windows():
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(700)), np.uint8)
    covered = [
        sorted(p for _, _, first, count in suffix_dedup.stretches(data, 50, block) for f, c in zip(first, count) for p in range(f, f + c))
        for block in (100, 1 << 20)
    ]
    assert covered[0] == covered[1] == list(range(651))


def test_documents_keep_their_columns(spark):
    docs = edge.documents(spark)
    out = suffix_dedup.deduplicated_documents(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    want = {i: (n, removed) for i, n, removed, _, _ in brute(pairs(docs), 50)}
    got = {str(r.doc_id): r for r in out.collect()}
    assert set(got) == {i for i, (n, removed) in want.items() if not removed or removed < n}
    before = {str(r.doc_id): r.text for r in docs.collect()}
    assert all(got[i].text == before[i] for i in got if not want[i][1])
    assert all(len(got[i].text.encode()) == want[i][0] - want[i][1] for i in got if want[i][1])
    assert suffix_dedup.deduplicated_documents(edge.empty(spark)).count() == 0


def test_cut_characters_go(spark):
    shared = "x" * 49 + "é"
    docs = spark.createDataFrame(
        [(1, shared.encode()[:50].decode("utf-8", "ignore") + "è", 50), (2, "x" * 49 + "éa", 51)],
        "doc_id long, text string, n_chars long",
    )
    assert {r.doc_id: r.text for r in suffix_dedup.deduplicated_documents(docs).collect()}[2] == "a"


def test_plain_form_with_blocks_and_without_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_doubling, "PAIR_ROWS", 64)
    parts = list(prefix_doubling._first_pairs(8, 8)([pa.RecordBatch.from_pydict({"_id": [3], "_key": [0], "_text": [b"abc" * 99]})]))
    rows = [r for part in parts for r in part.to_pylist()]
    text = b"abc" * 99
    assert [r["at"] for r in rows] == list(range(len(text) - 15)) and len(parts) > 2
    assert all(r["r1"].to_bytes(8, "big") + r["r2"].to_bytes(8, "big") == text[r["at"] : r["at"] + 16] for r in rows)
    assert result(edge.empty(spark), 50, prefix_doubling.matches) == []
    assert prefix_doubling.offsets(50) == (8, [8, 16, 18])
