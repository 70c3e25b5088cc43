"""Matched windows by plain prefix doubling: Spark sorts the (position, rank) pairs of every byte position.

The first ranks are the bytes themselves (up to eight in an integer). A round pairs the rank at ``p`` with the rank at
``p + offset``, Spark sorts the pairs by range partitions, and the place of the first row of equal pairs is the new
rank. The offset doubles until the ranks cover ``length`` bytes; the last round overlaps. A position whose rank no
other document shares leaves after each round: whatever holds it cannot repeat either. Ranks are exact, not hashes.

This is the named method of ``suffix_dedup`` without its thinning, and takes the place of its matching by
``suffix_dedup(docs, find=prefix_doubling.matches)``. Every byte becomes a row of five numbers in the first round, so its
shuffle is a large multiple of the text (README.md has the figures); all rows of one rank meet in one task.

Cases are those of ``suffix_dedup``: null texts are empty, short ones have no window, rows without an id take no
part, rows that repeat an id do not match each other, and an empty table has no matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.exchange import PACKED_DDL, by_bucket, id_bucket, packed_rows, text_batches, written
from wardlens.llm.suffix_dedup import MATCH, texts_of

PAIRS_DDL = "doc long, key long, at int, r1 long, r2 long"
PAIR_ROWS = 1 << 18  # rows per Arrow batch; bounds the memory that a very long text takes


def offsets(length: int) -> tuple[int, list[int]]:
    """Bytes in the first ranks, and the offset of each round until ``length`` bytes are covered."""
    if length < 2:
        raise ValueError("prefix doubling needs a length of at least 2")
    start = have = min(8, length // 2)
    steps = []
    while have < length:
        steps.append(min(have, length - have))
        have += steps[-1]
    return start, steps


def _integers(data: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each position on as one integer."""
    out = np.zeros(len(data) - width + 1, np.uint64)
    for n in range(width):
        out = out << np.uint64(8) | data[n : n + len(out)]
    return out.view(np.int64)


def _first_pairs(start: int, offset: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in text_batches(batches):
            for doc, key, text in texts_of(batch):
                data = np.frombuffer(text, np.uint8)
                for a in range(0, len(data) - start - offset + 1, PAIR_ROWS):
                    ranks = _integers(data[a : a + PAIR_ROWS + start + offset - 1], start)
                    n = len(ranks) - offset
                    waiting.append((np.full(n, doc), np.full(n, key), np.arange(a, a + n), ranks[:n], ranks[offset:]))
                    rows += n
                    if rows >= PAIR_ROWS:
                        yield _pairs(waiting)
                        waiting, rows = [], 0
        if waiting:
            yield _pairs(waiting)

    return run


def _pairs(parts) -> pa.RecordBatch:
    types = (np.int64, np.int64, np.int32, np.int64, np.int64)
    columns = [pa.array(np.concatenate(c).astype(t)) for c, t in zip(zip(*parts), types)]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "key", "at", "r1", "r2"])


def reranked(pairs: DataFrame) -> DataFrame:
    """doc, key, at, rank, and the least id with this rank, of the positions whose pair another document has too."""
    placed = pairs.repartitionByRange("r1", "r2").sortWithinPartitions("r1", "r2")
    placed = placed.withColumn("place", F.monotonically_increasing_id())
    equal = Window.partitionBy("r1", "r2")
    least, most = F.min("doc").over(equal), F.max("doc").over(equal)
    ranks = placed.select("doc", "key", "at", F.min("place").over(equal).alias("rank"), least.alias("least"), most.alias("most"))
    return ranks.where("least < most").drop("most")


def doubled(ranks: DataFrame, offset: int) -> DataFrame:
    """Each position's rank beside the one ``offset`` further on; positions whose partner has left go."""
    further = Window.partitionBy("doc", "key").orderBy("at").rangeBetween(offset, offset)
    pairs = ranks.select("doc", "key", "at", F.col("rank").alias("r1"), F.max("rank").over(further).alias("r2"))
    return pairs.where("r2 is not null")


def _packed_matches(total: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key, at = (batch.column(c).to_numpy() for c in ("doc", "key", "at"))
            columns = [doc, key, at.astype("u4"), np.ones(len(doc), "u4")]
            yield from packed_rows(by_bucket(MATCH, id_bucket(doc, total), columns)).to_batches()

    return run


def matches(rows: DataFrame, length: int, total: int) -> DataFrame:
    """Packed matched windows of ``rows`` (_id, _key, _text), as ``suffix_dedup`` takes them."""
    start, steps = offsets(length)
    pairs = rows.select("_id", "_key", "_text").mapInArrow(_first_pairs(start, steps[0]), PAIRS_DDL)
    ranks = written(reranked(pairs), "ranks")
    for offset in steps[1:]:
        ranks = written(reranked(doubled(ranks, offset)), "ranks")
    found = ranks.where("doc > least").select("doc", "key", "at")
    return found.mapInArrow(_packed_matches(total), PACKED_DDL)
