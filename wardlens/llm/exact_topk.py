"""Exact top-k inner products by distributed histogram selection.

Vectors are cut into blocks inside the tasks; the stated queries meet all candidates block by block (an
equi-join on block numbers, dealt over salts). Every round scores everything and counts, per query, how many scores fall into
each of ``BINS`` equal parts of the bracket that holds its k-th score. A task adds up the blocks it sees and sends only
the parts that hold a score; Spark sums them, and the bracket shrinks to one part, until it is one integer wide. Then one pass keeps the scores above the k-th value and, of those equal
to it, the smallest ids that are still needed, of each block first, so ties cost a block k rows per query at most.

Cases: vectors that are null, empty or hold null, NaN or infinite components, and rows without an id, take no part; vectors meet
only vectors of the same length; a candidate with the query's id is its own row; rows that repeat an id with the same vector
are one query but as many candidates; fewer than k candidates are all returned; ties go to the smaller id; other
columns are ignored; an empty table gives an empty result. Components of any size are exact; only a score of 2^62 or more
between two different ids raises an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize
from wardlens.llm.shipping import ship_package

K = 10
SCALE = 1024
BINS = 256
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
SALTS = 16
HELD_BLOCKS = 32  # query blocks whose histograms a task holds before it passes them on
LIMIT = 2**62  # scores stay below it
_BLOCK_DDL = "dim int, block long, ids binary, ints binary, largest double, norm double"


def _blocks(size: int):
    """Rows of up to ``size`` vectors of one length: ids and integer components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, tuple[list, list]] = {}

        def row(dim: int, ids: list, vectors: list) -> pa.RecordBatch:
            nonlocal number
            ints = np.floor(np.array(vectors, np.float64) * SCALE)  # whole numbers, exact as doubles
            number += 1
            values = [
                [dim], [number], [np.array(ids, "i8").tobytes()], [ints.tobytes()], [float(np.abs(ints).max())],
                [float(np.sqrt((ints * ints).sum(axis=1)).max())],
            ]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds)], names=["dim", "block", "ids", "ints", "largest", "norm"]
            )

        for batch in batches:
            for i, vector in zip(batch.column("_id").to_pylist(), batch.column("_vector").to_pylist()):
                ids, vectors = waiting.setdefault(len(vector), ([], []))
                ids.append(i)
                vectors.append(vector)
                if len(ids) == size:
                    yield row(len(vector), *waiting.pop(len(vector)))
        for dim, (ids, vectors) in waiting.items():
            yield row(dim, ids, vectors)

    return run


def _matrix(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, "f8").reshape(-1, dim)


def _scores(queries: np.ndarray, candidates: np.ndarray, largest: float, counts: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs that count.

    Through doubles where every partial sum is exact, else through 64-bit integers; pairs whose terms might not fit
    those, and only these, through Python's integers.
    """
    dim = queries.shape[1]
    if largest * dim < 2**53:
        return (queries @ candidates.T).astype("i8")
    q_most, c_most = np.abs(queries).max(axis=1), np.abs(candidates).max(axis=1)
    wide = q_most[:, None] * c_most[None, :] * dim >= float(LIMIT)
    fit_q, fit_c = (np.where((most < 2.0**62)[:, None], rows, 0).astype("i8") for most, rows in ((q_most, queries), (c_most, candidates)))
    with np.errstate(over="ignore"):
        scores = fit_q @ fit_c.T
    for q, c in zip(*np.nonzero(wide & counts)):
        score = sum(int(a) * int(b) for a, b in zip(queries[q].tolist(), candidates[c].tolist()))
        if abs(score) >= LIMIT:
            raise OverflowError("inner products of these vectors exceed 64-bit integers")
        scores[q, c] = score
    return scores


def _block_scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, scores, mask of pairs that count) of a pair of blocks."""
    dim = row["dim"]
    query_ids, ids = np.frombuffer(row["query_ids"], "i8"), np.frombuffer(row["ids"], "i8")
    counts = query_ids[:, None] != ids[None, :]
    queries, candidates = _matrix(row["query_ints"], dim), _matrix(row["ints"], dim)
    return query_ids, ids, _scores(queries, candidates, row["largest"] * row["query_largest"], counts), counts


def _state(row: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower end of the bracket and needed rank of every query of a block; those that met nothing so far need nothing."""
    low, need = np.full(size, LIMIT, "i8"), np.zeros(size, "i8")
    for entry in row["state"]:
        low[entry["place"]], need[entry["place"]] = entry["low"], entry["need"]
    return low, need


def _histograms(step: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            parts = [(block, *np.divmod(np.flatnonzero(c), BINS), c[c > 0]) for block, c in held.items()]
            held.clear()
            columns = [np.concatenate([np.full(len(p[1]), p[0]) for p in parts]), *(np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))]
            return pa.RecordBatch.from_arrays([pa.array(c.astype("i8")) for c in columns], names=["query_block", "place", "bin", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                query_ids, _, scores, counts = _block_scores(row)
                low, need = _state(row, len(query_ids))
                below = scores < low[:, None]
                part = np.where(below, -1, scores - np.where(below, scores, low[:, None])) // step
                inside = counts & ~below & (part < BINS) & (need > 0)[:, None]
                flat = (np.arange(len(query_ids))[:, None] * BINS + part)[inside]
                counted = np.bincount(flat, minlength=len(query_ids) * BINS)
                if row["query_block"] in held:
                    held[row["query_block"]] += counted
                else:
                    if len(held) >= HELD_BLOCKS:
                        yield flush()
                    held[row["query_block"]] = counted
        if held:
            yield flush()

    return run


def _narrowed(counted: DataFrame, state: DataFrame, step: int) -> DataFrame:
    """(query_block, place, low, need) with each bracket cut to the part that holds the needed rank.

    A query has at most ``BINS`` parts. One with fewer scores than needed goes on with the lowest part.
    """
    summed = counted.groupBy("query_block", "place", "bin").agg(F.sum("n").alias("n"))
    from_top = Window.partitionBy("query_block", "place").orderBy(F.desc("bin"))
    parts = summed.join(state, ["query_block", "place"]).withColumn("above", F.sum("n").over(from_top) - F.col("n"))
    reached = parts.where(F.col("above") < F.col("need"))
    last = reached.groupBy("query_block", "place").agg(
        F.min(F.struct("bin", "low", (F.col("need") - F.col("above")).alias("need"))).alias("hit")
    )
    return last.select(
        "query_block", "place", (F.col("hit.low") + F.col("hit.bin") * step).alias("low"), F.col("hit.need").alias("need")
    )


def _winners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores above the k-th value and, of those equal to it, the smallest ids that are needed."""
    for batch in batches:
        for row in batch.to_pylist():
            query_ids, ids, scores, counts = _block_scores(row)
            value, need = _state(row, len(query_ids))
            q, c = np.nonzero(counts & (scores > value[:, None]))
            parts = [(q, c)]
            tied_q, tied_c = np.nonzero(counts & (scores == value[:, None]))
            order = np.lexsort((ids[tied_c], tied_q))
            tied_q, tied_c = tied_q[order], tied_c[order]
            place = np.arange(len(tied_q)) - np.searchsorted(tied_q, tied_q)
            kept = place < need[tied_q]
            parts.append((tied_q[kept], tied_c[kept]))
            q, c = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(q), row["query_block"])), pa.array(q.astype("i8")), pa.array(query_ids[q]),
                    pa.array(ids[c]), pa.array(scores[q, c]),
                ],
                names=["query_block", "place", "query_id", "vec_id", "score"],
            )


def usable(vector: Column) -> Column:
    """Not null nor empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def exact_topk(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """Per query the ``k`` highest scores among all other rows: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id that states the query set.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col("`vec_id`").cast("long").alias("_id"), F.col("`embedding`").cast("array<double>").alias("_vector"),
        is_query.alias("_query"),
    ).where(F.col("_id").isNotNull() & usable(F.col("_vector")))
    candidates = materialize(rows.mapInArrow(_blocks(CANDIDATE_BLOCK), _BLOCK_DDL), "candidates")
    stated = rows.where("_query").dropDuplicates(["_id", "_vector"])
    queries = materialize(
        stated.mapInArrow(_blocks(QUERY_BLOCK), _BLOCK_DDL).select(
            "dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"),
            F.col("ints").alias("query_ints"), F.col("largest").alias("query_largest"), F.col("norm").alias("query_norm"),
        ),
        "queries",
    )
    lanes = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    meetings = (
        candidates.select("dim", "block", lanes.alias("salt"))
        .join(queries.select("dim", "query_block", salt("query_block").alias("salt")), ["dim", "salt"])
        .select("block", "query_block", salt("block").alias("lane"))
    )
    # No score is larger than the product of the largest norms, nor than the limit that scores are held to.
    norms = candidates.agg(F.max("norm")).first()[0] or 0.0, queries.agg(F.max("query_norm")).first()[0] or 0.0
    bound = LIMIT - 1 if norms[0] * norms[1] >= LIMIT / 2 else int(norms[0] * norms[1] * (1 + 1e-9)) + 1
    step = 1
    while BINS * step < 2 * bound + 1:
        step *= BINS
    places = F.sequence(F.lit(0), (F.length("query_ids") / 8).cast("int") - 1)
    state = queries.select("query_block", F.explode(places.cast("array<long>")).alias("place")).select(
        "query_block", "place", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need")
    )

    def meeting() -> DataFrame:
        """Pairs of blocks with the query block's state; its copies are dealt over lanes, as it meets all candidates."""
        packed = state.groupBy("query_block").agg(F.collect_list(F.struct("place", "low", "need")).alias("state"))
        asked = queries.drop("dim").join(packed, "query_block").withColumn("lane", lanes)
        return meetings.join(candidates, "block").join(asked, ["query_block", "lane"])

    while True:
        counted = meeting().mapInArrow(_histograms(step), "query_block long, place long, bin long, n long")
        state = materialize(_narrowed(counted, state, step), "state")
        if step == 1:
            break
        step //= BINS
    winners = meeting().mapInArrow(_winners, "query_block long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_block", "place").orderBy(F.desc("score"), "vec_id")
    return winners.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def statement(k: int = K) -> str:
    """DuckDB statement of ``exact_topk`` over ``embeddings`` with the ids divisible by 100 as queries."""
    return f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.ints, c.ints) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.ints) = len(c.ints) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
         vec_id, score
  FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= {k}
"""
