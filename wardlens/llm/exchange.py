"""Moving numpy columns between tasks: one row per (batch, target bucket) instead of one row per entry.

A map task packs the entries of a batch that belong to one bucket into a single binary value; Spark shuffles
and groups these rows by bucket. Buckets are hash ranges, so their size follows the data divided by their
number (a multiple of ``spark.sql.shuffle.partitions``). Before packing, each batch keeps one entry per key
where the operator allows it, so a key shared by a third of all rows costs its bucket one entry per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize
from wardlens.llm.task_cache import release

BUCKETS_PER_PARTITION = 1
_PRIME, _FACTOR = 2147483647, 48271
PACKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])
PACKED_DDL = "kind int, bucket int, data binary"


def bucket_total(spark: SparkSession) -> int:
    return BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(ids: np.ndarray, total: int) -> np.ndarray:
    """Bucket of integer ids; ``id_bucket_column`` gives the same number in Spark."""
    return (ids % _PRIME) * _FACTOR % _PRIME % total


def id_bucket_column(column: Column, total: int) -> Column:
    return (F.pmod(column.cast("long"), F.lit(_PRIME)) * _FACTOR % _PRIME % total).cast("int")


def packed(arrays: Sequence[np.ndarray]) -> bytes:
    """The columns of some entries, each in the narrowest width that holds its values.

    Layout: number of entries (8 bytes), width of each column (1 byte each), the columns. An ascending column
    is stored as its first value (8 bytes) and differences, marked by a width of 16 or more.
    """
    rows = len(arrays[0])
    widths, parts = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        ascending = a.dtype.itemsize == 8 and a.dtype.kind == "i" and bool((a[1:] >= a[:-1]).all())
        if ascending:
            parts.append(a[:1].astype("i8").tobytes())
            a = np.diff(a, prepend=a[:1]).view("u8")
        if a.dtype.kind == "u" or (len(a) and a.min() >= 0):
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        widths.append(a.dtype.itemsize + 16 * ascending)
        parts.append(a.tobytes())
    return b"".join([rows.to_bytes(8, "little"), bytes(widths), *parts])


def unpacked(blobs: Iterable[bytes], dtypes: Sequence[str]) -> list[np.ndarray]:
    """The columns of all blobs, one after the other, in the given types."""
    parts: list[list[np.ndarray]] = [[] for _ in dtypes]
    for blob in blobs:
        rows, at = int.from_bytes(blob[:8], "little"), 8 + len(dtypes)
        for part, t, width in zip(parts, dtypes, blob[8:at]):
            if width >= 16 and rows:
                first = np.frombuffer(blob, "i8", 1, at)
                at += 8
            narrow = np.dtype(f"u{width % 16}") if width % 16 < 8 else np.dtype(t)
            values = np.frombuffer(blob, "u8" if width >= 16 and width % 16 == 8 else narrow, rows, at)
            at += rows * (width % 16)
            if width >= 16 and rows:
                values = np.cumsum(values.astype("i8")) + first
            part.append(values.astype(t, copy=False))
    return [np.concatenate(p) if p else np.empty(0, t) for p, t in zip(parts, dtypes)]


def by_bucket(kind: int, target: np.ndarray, arrays: Sequence[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """Rows (kind, bucket, data) with the entries of each target bucket."""
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    target = target[order]
    cuts = np.flatnonzero(np.diff(target)) + 1
    starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(target)]])
    arrays = [a[order] for a in arrays]
    for a, b in zip(starts.tolist(), stops.tolist()):
        yield kind, int(target[a]), packed([x[a:b] for x in arrays])


def packed_rows(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.Table.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, PACKED)], schema=PACKED
    )


TASKS_PER_SUM = 1024


def task_group() -> int:
    """Number of the group of tasks whose packed totals are added up first."""
    return TaskContext.get().partitionId() // TASKS_PER_SUM


def added_up(totals: DataFrame, add: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """One packed row per bucket from every task's rows, whose kind is their ``task_group``.

    Added in two levels, so no group holds more rows than ``TASKS_PER_SUM`` or the number of task groups.
    """
    first = totals.groupBy("kind", "bucket").applyInArrow(add, PACKED_DDL)
    return first.groupBy("bucket").applyInArrow(add, PACKED_DDL)


def first_of_runs(sorted_keys: np.ndarray) -> np.ndarray:
    """True where a new key starts."""
    out = np.ones(len(sorted_keys), bool)
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=out[1:])
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, after which Spark deletes the shuffle files of the write at once instead of some time later."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(key, before)


def text_batches(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``max_bytes``, or a single longer row."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        per = max(1, int(rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, rows, per):
            yield batch.slice(at, per)


def packed_tables(kind: int, bucket_name: str = "bucket"):
    """Rows of a table as compressed Arrow streams, one per (batch, bucket); ``tables_of`` reads them back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in text_batches(batches):
            target = batch.column(bucket_name).to_numpy()
            order = np.argsort(target, kind="stable")
            ordered = batch.drop_columns([bucket_name]).take(pa.array(order))
            starts = np.flatnonzero(first_of_runs(target[order])).tolist()
            rows = []
            for a, b in zip(starts, [*starts[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, ordered.schema, options=options) as writer:
                    writer.write_batch(ordered.slice(a, b - a))
                rows.append((kind, int(target[order[a]]), sink.getvalue().to_pybytes()))
            yield from packed_rows(rows).to_batches()

    return run


def tables_of(blobs: Iterable[bytes]) -> Iterator[pa.Table]:
    for blob in blobs:
        yield pa.ipc.open_stream(blob).read_all()


def blobs_of(table: pa.Table, kind: int) -> list[bytes]:
    """The data of the rows of one kind."""
    return [d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()) if k == kind]
