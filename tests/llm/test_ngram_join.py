from __future__ import annotations

import random
import re
from itertools import combinations

import edge
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from wardlens.llm import components, exchange, ngram_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent=80):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted((str(i), len(s), str(least.get(root(n)))) for n, ((i, _), s) in enumerate(zip(rows, sets)))


def result(docs):
    return sorted((str(r[0]), r[1], str(r[2])) for r in ngram_join.ngram_join(docs).collect())


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def family(size, rng):
    """Near copies whose mutual similarities lie on both sides of the threshold."""
    base = edge.sentence(rng, 80, "abcdefgh").split()
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = edge.sentence(rng, 1, "qrstuv")
        out.append(" ".join(words))
    return out


def test_fixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs) == brute(pairs(docs))


@pytest.mark.parametrize("unit_rows", [1024, 4])
def test_families_in_one_unit_or_in_pairs_of_blocks(spark, monkeypatch, unit_rows):
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", unit_rows)
    rng = random.Random(4)
    texts = family(40, rng) + family(12, rng)
    docs = spark.createDataFrame([(i * 7 % 53, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = brute(pairs(docs))
    assert 2 < len({c for _, _, c in want}) < 52
    assert result(docs) == want


def test_edges(spark):
    docs = edge.documents(spark, repeat=True, null_id=True)
    want = brute(pairs(docs))
    got = result(docs)
    assert got == want
    assert result(edge.empty(spark)) == []


def test_links_of_copies_whose_files_are_not_read_in_row_order(spark):
    """Later partitions make larger files, which Spark reads first when it packs several into one partition."""
    rng, parts = random.Random(11), 64
    rows = [[] for _ in range(parts)]
    for at in range(parts - 8):
        one = family(1, rng)[0]
        other = one.replace(one.split()[40], "changed", 1)
        for text in (one, other):
            for part in range(at, at + 8):
                rows[part].append(text)
    for at, texts in enumerate(rows):
        texts += [""] * (16 - len(texts)) + [edge.sentence(rng, 30 * at + 1, "mnopq")]
    data = [(n * 37 % 1088, t) for n, t in enumerate(t for texts in rows for t in texts)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(data, parts), "doc_id long, text string")
    assert docs.rdd.getNumPartitions() == parts > spark.sparkContext.defaultParallelism
    got = result(docs)
    classes = {}
    for i, t in data:
        classes.setdefault(t, []).append(i)
    links = brute([(min(ids), t) for t, ids in classes.items()])
    least = {i: c for i, _, c in links}
    want = sorted((str(i), len(shingles(t)), least[str(min(classes[t]))] if t else str(i)) for i, t in data)
    assert got == want


def test_routing_keeps_the_smallest_row_of_equal_sets():
    batch = pa.RecordBatch.from_pydict({
        "row": [1 << 33, 5, 7], "s1": [1, 1, 2], "s2": [3, 3, 3], "route": [np.array([9], "u8").tobytes()] * 3,
    })
    blobs = [b for out in ngram_join._route(1)([batch]) for b in out.column("data").to_pylist()]
    assert exchange.unpacked(blobs, ("u8", "i8"))[1].tolist() == [5, 7]


def test_one_document_of_each_component_stays(spark):
    docs = edge.documents(spark)
    out = ngram_join.one_per_component(docs)
    assert out.columns == docs.columns
    want = [i for i, n, c in brute(pairs(docs)) if not n or i == c]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(want)


def test_repeated_ids_and_texts_leave_one_row_and_wordless_rows_stay(spark):
    words = "seven words that make a whole text"
    data = [(1, words, "a"), (1, words, "b"), (1, words, "b"), (2, words, "c"), (3, "other words of a single row", "a")]
    data += [(4, "", "a"), (4, "", "a"), (5, None, "a"), (5, None, "a"), (None, " ", "a"), (None, " ", "a")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    out = ngram_join.one_per_component(docs)
    assert out.columns == docs.columns
    want = [data[0], *data[4:]]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    clashing = edge.documents(spark, repeat=True, null_id=True)
    assert ngram_join.one_per_component(clashing.where("doc_id is null")).count() == 3


def test_tree_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 300).astype("u8")
    sets = []
    for _ in range(120):
        kept = base[rng.random(300) < rng.uniform(0.7, 1)]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 40)).astype("u8")])))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    vectors = np.stack([ngram_join.count_vector(s).astype(np.int64) for s in sets])
    tree = ngram_join.CountTree(sizes, vectors, 80)
    for i, s in enumerate(sets):
        linked = [j for j, t in enumerate(sets) if 180 * ngram_join.overlap(s, t) >= 80 * (len(s) + len(t))]
        assert set(linked) <= set(tree.partners(len(s), vectors[i]).tolist())


def test_routing_keeps_every_link():
    rng = np.random.default_rng(3)
    totals = rng.integers(0, 50, ngram_join.GROUPS)
    for _ in range(300):
        common = rng.integers(0, 2**64, rng.integers(1, 60), dtype="u8")
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**64, rng.integers(0, 8), dtype="u8")])) for _ in "ab")
        both = ngram_join.overlap(a, b)
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert ngram_join.overlap(*(np.sort(ngram_join.routing_shingles(s, totals, 80)) for s in (a, b)))


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    roots = components.component_roots(spark.createDataFrame(edges, "u long, v long"))
    want = {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, 201: 200}
    assert {r.u: r.v for r in roots.collect()} == want
