from __future__ import annotations

import re
from collections import defaultdict

import edge
from conftest import SF
from test_ngram_join import brute as joined
from test_packing import check_layout
from test_suffix_dedup import brute as cut

import __spark_entry__ as entry
import corpus_pipeline
from wardlens.functions.scale import materialize


def stages(spark, docs):
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF), f"test-{name}"))
    return frames


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def check(spark, docs):
    given, told, single, unique, mixed, packed = stages(spark, docs)
    for df in (told, single, unique, mixed):
        assert df.columns == given.columns and [f.dataType for f in df.schema] == [f.dataType for f in given.schema]
    letters = {str(r.doc_id) for r in given.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert set(ids(told)) == letters
    rows = [(r.doc_id, r.text) for r in told.collect()]
    assert ids(single) == sorted(i for i, n, c in joined(rows) if not n or i == c)
    rows = [(r.doc_id, (r.text or "").encode()) for r in single.collect()]
    left = {i: n - removed for i, n, removed, *_ in cut(rows, 50) if not removed or removed < n}
    assert ids(unique) == sorted(left)
    assert {str(r.doc_id): len(r.text.encode()) for r in unique.collect()} == left
    texts = {r.doc_id: r.text for r in unique.collect()}
    assert all(texts[r.doc_id] == r.text for r in mixed.collect())
    out = packed.collect()
    copies, pieces = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        copies[r.doc_id] += 1
    for r in out:
        pieces[r.doc_id] += r.piece == 0
    assert copies == pieces
    bound = -(-sum(r.length for r in out) // 2048)
    assert bound <= check_layout(out) <= bound + 1


def test_fixture(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_edges(spark):
    check(spark, edge.documents(spark))


def test_empty(spark):
    assert all(df.count() == 0 for df in stages(spark, edge.empty(spark)))


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert {"op7_exact_topk", "op8_source_mix"} <= set(entry.oracle_sql())
