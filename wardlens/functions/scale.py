"""Exact order-dependent building blocks that stay distributed.

Global ranks, running totals and quantiles are usually written as an unpartitioned window, which puts
every row into one task. Here the rows are range-partitioned once, frozen as a table with their chunk
number, and only one row per chunk (bounded by the shuffle partition count) is ever gathered.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

# Above this many distinct values a single aggregation buffer no longer holds the histogram of a column. Both ways
# are exact (tests compare them); the limit only decides where the counting happens.
HISTOGRAM_LIMIT = 100_000
ROWS_PER_BUCKET = 400_000
# Most bytes of files or compressed shuffle data that a task reads, unless the session sets them. Spark's own 128 and 64 MB
# unpack to more wide rows than a core's share of the memory can sort.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

_local_dirs: dict[str, str] = {}
_bucketed_tables: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="wardlens-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/wardlens/{app}/{name}-{uuid.uuid4().hex[:8]}"


def remove_intermediates(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application; every frame read from them becomes unusable."""
    for table in _bucketed_tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/wardlens/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_tasks(spark: SparkSession) -> None:
    """Let tasks grow in number instead of size, so that the sorts of a stage do not spill. What the session sets stays."""
    for name, size in TASK_BYTES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, size)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives executor loss, gives Catalyst its size.

    A small result read back this way is broadcast by Catalyst only if its real size is under
    ``spark.sql.autoBroadcastJoinThreshold``; a large one is shuffled, so no join needs a hint.
    """
    bound_tasks(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_small(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for aggregated results: a handful of files instead of one per shuffle partition.

    The adaptive coalescing of the final shuffle picks the file count, so a large result stays split.
    """
    return materialize(df.hint("rebalance"), name)


def bucket_count(spark: SparkSession, rows: int) -> int:
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_BUCKET))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))  # Spark's own limit, to be raised there
    return max(1, min(wanted, most))


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int, partitioned: bool = False) -> DataFrame:
    """Write ``df`` hash-bucketed and sorted by ``key`` so later joins and groupings on it do not shuffle.

    ``partitioned`` says that the rows already sit in ``buckets`` hash partitions of ``key``; each task then
    writes exactly one bucket without another shuffle.
    """
    spark = df.sparkSession
    bound_tasks(spark)
    path = new_path(spark, name)
    table = f"wardlens_{name}_{uuid.uuid4().hex[:12]}"
    placed = df if partitioned else df.repartition(buckets, key)
    placed.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    _bucketed_tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)


def with_order_chunks(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Range-partition by ``order`` (a total order) and freeze each row's partition number as ``chunk``."""
    chunked = df.repartitionByRange(*[F.col(c) for c in order]).withColumn("chunk", F.spark_partition_id())
    return materialize(chunked, name)


def chunk_offsets(chunked: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Totals of all earlier chunks, one row per chunk."""
    per_chunk = chunked.groupBy("chunk").agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        "chunk", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums]
    )


def running_totals(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column], name: str) -> DataFrame:
    """Add inclusive running totals over the whole frame in ``order``."""
    chunked = with_order_chunks(df, order, name)
    local = Window.partitionBy("chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    offsets = F.broadcast(chunk_offsets(chunked, sums))
    out = chunked
    for total, expr in sums.items():
        out = out.withColumn(f"_local_{total}", F.sum(expr).over(local))
    out = out.join(offsets, "chunk")
    for total in sums:
        out = out.withColumn(total, F.col(f"_local_{total}") + F.col(f"_before_{total}"))
    return out.drop("chunk", *[f"_local_{t}" for t in sums], *[f"_before_{t}" for t in sums])


def with_row_index(df: DataFrame, order: Sequence[str], name: str, column: str = "row_index") -> DataFrame:
    """Add a dense 0-based position in ``order``."""
    indexed = running_totals(df, order, {column: F.lit(1).cast("bigint")}, name)
    return indexed.withColumn(column, F.col(column) - 1)


def order_statistics(df: DataFrame, order: Sequence[str], ranks: Sequence[int], name: str) -> dict[int, Row]:
    """Rows at the given 0-based positions of the sorted frame; only those rows reach the driver.

    ``order`` must be unique per row, so that equal leading values can still be split over chunks.
    """
    chunked = with_order_chunks(df.select(*order), order, name)
    sizes = {r["chunk"]: r["count"] for r in chunked.groupBy("chunk").count().collect()}
    wanted: dict[tuple[int, int], int] = {}
    start = 0
    for chunk in sorted(sizes):
        for rank in ranks:
            if start <= rank < start + sizes[chunk]:
                wanted[(chunk, rank - start + 1)] = rank
        start += sizes[chunk]
    if not wanted:
        return {}
    position = F.row_number().over(Window.partitionBy("chunk").orderBy(*order))
    hit = F.lit(False)
    for chunk, local_rank in wanted:
        hit = hit | ((F.col("chunk") == chunk) & (F.col("_position") == local_rank))
    found = (
        chunked.where(F.col("chunk").isin(sorted({c for c, _ in wanted})))
        .withColumn("_position", position)
        .where(hit)
        .collect()
    )
    return {wanted[(r["chunk"], r["_position"])]: r for r in found}


def _interpolation(count: int, p: float) -> tuple[int, int, float]:
    position = (count - 1) * p
    low = math.floor(position)
    return low, min(low + 1, count - 1), position - low


def _values_at(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """Values at 0-based positions of a sorted column, counted per value first so a hot value is one row."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("copies"))
    sweep = running_totals(counted, [column], {"up_to": F.col("copies")}, "quantiles")
    covers = [(F.col("up_to") > r) & (F.col("up_to") - F.col("copies") <= r) for r in ranks]
    hit = F.lit(False)
    for cover in covers:
        hit = hit | cover
    found = sweep.where(hit).select(column, "up_to", "copies").collect()
    return {
        r: float(row[column]) for r in ranks for row in found if row["up_to"] - row["copies"] <= r < row["up_to"]
    }


@dataclass(frozen=True)
class ColumnCounts:
    """Rows, values and roughly how many distinct values a column has."""

    values: int
    nulls: int
    distinct: int


def count_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnCounts]:
    """One pass over the given columns."""
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: ColumnCounts(row[f"n_{i}"], row["rows"] - row[f"n_{i}"], row[f"d_{i}"]) for i, c in enumerate(columns)
    }


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], counts: Mapping[str, ColumnCounts] | None = None
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of numeric columns, nulls skipped.

    Columns whose distinct values fit one aggregation buffer share one ``percentile`` pass; the others
    go through a range partitioning and read only the rows at the requested ranks.
    """
    counts = counts or count_columns(df, list(wanted))
    result: dict[str, list[float | None]] = {}
    narrow = []
    for c, probabilities in wanted.items():
        if counts[c].values == 0:
            result[c] = [None] * len(probabilities)
        elif counts[c].distinct <= HISTOGRAM_LIMIT:
            narrow.append(c)
        else:
            spans = [_interpolation(counts[c].values, p) for p in probabilities]
            at = _values_at(df, c, sorted({r for low, high, _ in spans for r in (low, high)}))
            result[c] = [at[low] + (at[high] - at[low]) * share for low, high, share in spans]
    if narrow:
        row = df.agg(
            *[
                F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in wanted[c]])).alias(c)
                for c in narrow
            ]
        ).first()
        for c in narrow:
            result[c] = list(row[c])
    return result


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Columns of one-row aggregates next to each other. Each frame must have a single row."""
    out = first
    for other in others:
        out = out.crossJoin(other)
    return out


HOT_ROWS = 500_000  # joined rows of one key that a task should hold at most


def left_join_salted(
    one: DataFrame, many: DataFrame, key: str, sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``one LEFT JOIN many`` in one pass over either side, with the rows of a frequent key spread over tasks.

    ``sizes`` gives the rows of ``many`` per key as ``n``, if known; else they are counted. A key with more than ``hot_rows`` gets
    several salts: its rows of ``many`` are dealt over them by a hash of the whole row, and its row of ``one`` joins
    each. A copy that meets nothing is dropped: such a key has rows elsewhere. All other rows of ``one`` come once, as in
    any left join. At most rows / ``hot_rows`` keys are frequent; their table is written, so Catalyst knows its size.
    """
    counts = sizes if sizes is not None else many.groupBy(key).agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / hot_rows).cast("int").alias("_salts")
    hot = materialize_small(counts.where((F.col("n") > hot_rows) & F.col(key).isNotNull()).select(key, salts), "hot_keys")
    last = F.coalesce("_salts", F.lit(1)) - 1
    left = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in many.columns])
    right = many.join(hot, key, "left").withColumn("_salt", F.pmod(row, last + 1).cast("int")).drop("_salts")
    joined = left.join(right.withColumn("_met", F.lit(True)), [key, "_salt"], "left")
    return joined.where(F.col("_salts").isNull() | F.col("_met")).drop("_salts", "_salt", "_met")


def join_many_to_one_keep_all(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one LEFT JOIN many`` with the fan-out side streamed.

    A hot key sits in ``many``. An outer join that preserves the other side cannot be split by adaptive
    skew handling; an inner join can, so the unmatched rows are added separately from the distinct keys.
    """
    matched = many.join(one, key)
    unmatched = one.join(many.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
