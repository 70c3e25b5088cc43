from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlens.llm import exchange, hashing, task_cache

TYPES = ("u8", "i8", "i8", "u4", "u2")
ROWS = st.lists(
    st.tuples(
        st.integers(0, 2**64 - 1), st.integers(-(2**63), 2**63 - 1), st.integers(-5, 5), st.integers(0, 2**32 - 1),
        st.integers(0, 2**16 - 1),
    ),
    max_size=30,
)


def columns(rows):
    return [np.array([r[i] for r in rows], t) for i, t in enumerate(TYPES)]


@settings(max_examples=200, deadline=None)
@given(ROWS, ROWS)
def test_packed_columns_come_back(a, b):
    for rows in (a, sorted(a, key=lambda r: r[1])):
        back = exchange.unpacked([exchange.packed(columns(rows)), exchange.packed(columns(b))], TYPES)
        for got, want in zip(back, columns(rows + b)):
            assert got.dtype == want.dtype and got.tolist() == want.tolist()


def test_ascending_extremes():
    a = np.array([-(2**63), -1, 0, 2**63 - 1], "i8")
    assert exchange.unpacked([exchange.packed([a])], ("i8",))[0].tolist() == a.tolist()


def test_buckets_hold_their_entries():
    target = np.array([3, 1, 3, 0])
    rows = {b: exchange.unpacked([d], ("i8",))[0].tolist() for _, b, d in exchange.by_bucket(0, target, [np.arange(4)])}
    assert rows == {0: [3], 1: [1], 3: [0, 2]}


def test_tables_travel_whole():
    batch = pa.RecordBatch.from_pydict({"t": ["a", None, "c"], "bucket": pa.array([1, 0, 1], pa.int32())})
    (out,) = exchange.packed_tables(7)([batch])
    found = {b: next(exchange.tables_of([d])).column("t").to_pylist() for k, b, d in zip(*out.to_pydict().values()) if k == 7}
    assert found == {0: [None], 1: ["a", "c"]}


def test_id_buckets_agree_with_spark(spark):
    from pyspark.sql import functions as F

    ids = [0, 1, -1, 99, 2**62, -(2**62), 2147483647, -2147483648]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = [r[0] for r in df.select(exchange.id_bucket_column(F.col("i"), 13)).collect()]
    assert got == exchange.id_bucket(np.array(ids), 13).tolist()


def test_long_batches_are_cut():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 1000] * 50})
    parts = list(exchange.text_batches([batch], 5000))
    assert len(parts) > 5 and sum(p.num_rows for p in parts) == 50


@pytest.mark.parametrize("size", [1, 2, 5])
def test_equal_sequences_have_equal_hashes(size):
    words = hashing.word_hashes(b"a b a b a b c".split())
    hashes = hashing.sequence_hashes(words, size)
    plain = ["a b a b a b c".split()[i : i + size] for i in range(8 - size)]
    assert [[x == y for y in hashes] for x in hashes] == [[x == y for y in plain] for x in plain]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.integers(1, 8))
def test_window_hashes_name_their_bytes(data, length):
    names = hashing.Windows(np.frombuffer(data, np.uint8)).all_of(length)
    spans = [data[i : i + length] for i in range(len(data) - length + 1)]
    assert len(names) == len(spans) and len(set(names.tolist())) == len(set(spans))


def test_one_object_at_a_time():
    first = task_cache.held("a", list)
    assert task_cache.held("a", list) is first
    task_cache.held("b", list)
    assert task_cache.held("a", list) is not first


def test_tasks_that_hold_much_forget_earlier_objects(spark):
    """A model of an earlier stage must not stay in the workers while texts are packed or their stretches named."""
    from wardlens.llm import language_id, ngram_join, suffix_dedup

    texts = pa.RecordBatch.from_pydict({"_id": [1], "_key": [0], "_text": [b"x" * 60], "bucket": pa.array([0], pa.int32())})
    labelled = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["some words"]})
    totals = np.zeros(ngram_join.GROUPS, np.int64)
    for run, batches in (
        (exchange.packed_tables(0), [texts]), (suffix_dedup._rank_anchors(50, 4), [texts]), (language_id._count, [labelled]),
        (ngram_join._describe(5, 80, totals), []),
    ):
        first = task_cache.held("model", list)
        list(run(iter(batches)))
        assert task_cache.held("model", list) is not first
    task_cache.release()


def test_written_frames_restore_the_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    assert exchange.written(spark.range(5).repartition(2), "t").count() == 5
    assert spark.conf.get(key) == before


def test_totals_of_many_task_groups_are_added_up(spark, monkeypatch):
    """Rows of several groups of tasks, as many tasks would send, give the same sums as one group."""
    import numpy as np

    from wardlens.llm import exchange, ngram_join

    rng = np.random.default_rng(2)
    arrays = [(int(kind), int(bucket), rng.integers(0, 9, 4)) for kind in range(5) for bucket in (0, 1, 7) for _ in range(3)]
    rows = spark.createDataFrame([(k, b, a.astype("i8").tobytes()) for k, b, a in arrays], exchange.PACKED_DDL).repartition(6)
    found = {r["bucket"]: np.frombuffer(r["data"], "i8").tolist() for r in exchange.added_up(rows, ngram_join._add_slices).collect()}
    assert found == {b: sum(a for _, c, a in arrays if c == b).tolist() for b in (0, 1, 7)}


def test_batches_are_bounded_by_bytes(spark):
    """Packed rows are large: neither a batch nor a group's batch may hold tens of megabytes."""
    from pyspark.sql import functions as F

    from wardlens.llm.shipping import ship_package

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    def pieces(group):
        return pa.table({"pieces": [group.column("data").num_chunks], "rows": [group.num_rows]})

    ship_package(spark)
    packed = spark.range(0, 400, 1, 1).select(F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.expr("cast(repeat('ab', 50000) as binary)").alias("data"))
    found = packed.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r.rows for r in found) == 400 and max(r.bytes for r in found) < 10 << 20
    (group,) = packed.groupBy("bucket").applyInArrow(pieces, "pieces long, rows long").collect()
    assert group.rows == 400 and group.pieces > 3
