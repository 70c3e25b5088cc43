from __future__ import annotations

import hashlib
import random
import re

import pytest
from edge import documents, empty

from wardlens.llm import decontamination, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, window=10):
    """doc_id, n_words, n_hit, n_items, digest, by a table of all windows."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(len(words), window)
        for k in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = words_of(text)
        hit, owners = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                found = windows.get(tuple(words[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    owners |= found
        ids = sorted(str(i) for i in owners if i is not None)
        out.append((doc, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def longest(words, items):
    best = 0
    for item in items:
        row = [0] * (len(item) + 1)
        for w in words:
            row = [0, *(row[k] + 1 if w == v else 0 for k, v in enumerate(item))]
            best = max(best, *row)
    return best


def digest_rows(found):
    out = []
    for r in found.collect():
        ids = ",".join(r["items"])
        out.append((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(ids.encode()).hexdigest(), r["n_hit"] > 0))
    return sorted(out, key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def test_query_equals_brute_force(spark):
    got = queries.op13_decontamination(spark, SF)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = expected(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    assert dict(got.dtypes)["n_items"] == "bigint"


ITEMS = [
    (3, "one two"), (4, "!!!"), (5, None), (6, ""), (7, "a b c"), (None, "other text under the same id"), (8, "b c d e a b c d e a b c d e f"),
    (8, "One TWO"), (10, "long " * 40), (11, "日本語"), (9, "x"),
]


@pytest.mark.parametrize(("shard", "piece"), [(400_000, 50_000), (7, 4)])
def test_edges_and_several_shards(spark, shard, piece):
    docs = documents(spark, repeat=True, null_id=True)
    texts = [t for _, t in pairs(docs, "doc_id") if t]
    rng = random.Random(3)
    cut = [(100 + k, " ".join(rng.choice(texts).split()[:60][rng.randrange(3) :])) for k in range(12)]
    items = spark.createDataFrame([*ITEMS, *cut], "item_id long, text string").repartition(3)
    found = decontamination.decontaminate(docs, items, window=5, shard=shard, piece=piece)
    assert digest_rows(found) == expected(pairs(docs, "doc_id"), pairs(items, "item_id"), 5)
    assert found.where("doc_id IS NULL").count() == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.decontaminate(documents(spark), none).collect()
    assert found and all(not r["spans"] and not r["items"] and r["longest"] == 0 for r in found)
    assert decontamination.decontaminate(empty(spark), none).count() == 0


def test_longest_match(spark):
    rng = random.Random(8)
    sequences = [[rng.choice("abcd") for _ in range(rng.randint(1, 60))] for _ in range(30)]
    built = decontamination.build([(str(k), s) for k, s in enumerate(sequences)], 4)
    for _ in range(40):
        text = [rng.choice("abcde") for _ in range(80)]
        assert decontamination.stream(built, [text[:30], text[30:]])[1] == longest(text, sequences)


def test_cleaned_removes_spans_beyond_the_limits(spark):
    passage = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12"
    texts = [f"Before,  it. {passage.upper()}! After; it", f"w {passage}", "nothing here", None, ""]
    docs = spark.createDataFrame([(k, t, "kept") for k, t in enumerate(texts)], "doc_id long, text string, _spans string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")

    def clean(**limits):
        return [r["text"] for r in decontamination.cleaned(docs, items, **limits).orderBy("doc_id").collect()]

    assert decontamination.cleaned(docs, items).columns == docs.columns
    assert clean() == ["Before,  it. ! After; it", "w ", "nothing here", None, ""]
    assert clean(span_limit=12, coverage_limit=0.8) == [texts[0], "w ", "nothing here", None, ""]
    assert clean(span_limit=12, coverage_limit=1.0) == texts


def test_text_longer_than_a_part(spark):
    rng = random.Random(1)
    words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(500_000)]
    item = "zero one two three four five six seven eight nine"
    words[210_000:210_000] = item.split()
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = decontamination.decontaminate(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (500_010, 10, ["5"])
    assert (row["spans"][0]["start"], row["spans"][0]["stop"]) == (210_000, 210_010)
