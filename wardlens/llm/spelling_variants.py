"""Spelling variant grouping: words one edit apart, found by blocked Gram matrices of letter counts.

1. Tasks count the words of whole texts per document and flush bounded dictionaries; Spark adds the counts up.
2. Blocks. Two words one edit apart have lengths L, or L and L + 1, and the edit lies in one half only: cut the shorter word at
   h = L // 2, then either the first h letters of both agree or the letters behind the cut do. So a word meets the
   words of its own and the two adjacent lengths only inside blocks that share a half, which loses no pair.
3. Inside a block, words are rows of letter counts. One NumPy product of a tile of rows with the rows behind it gives all squared
   distances: a replaced letter makes 2 (0 never, as the letters differ), an inserted or deleted one makes 1. Pairs of at
   most 2 are verified letter by letter. A pair is taken from the block of first halves if these agree, else from
   the other one, so each pair comes once.
4. A word's form is the near word with most occurrences if it has at least ``ratio`` times as many; roots follow the
   forms by pointer doubling (a chain has at most log_ratio(occurrences) links).

A block of more than ``UNIT`` words is cut by hash and its parts meet pair by pair, each pair a unit of its own, so no task holds a
large block. Products use single precision while all sums are below 2^24, else double precision: both are exact.

Cases: null and empty texts have no words; a null id counts as an empty string before the colon; rows that repeat an id or a text are
counted each; ties in occurrences go to the smallest word in code-point order; very long texts are read part by part and very long
words are ordinary words; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize, materialize_small
from wardlens.llm.exchange import bucket_total, text_batches
from wardlens.llm.shipping import ship_package
from wardlens.llm.words import Words, ascii_lower

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SLIP = 31  # of so many (document, word) hashes, one deletes a letter
UNIT = 4096
TILE = 512
HELD = 300_000  # words counted in a task before they are passed on
LETTERS = 26 + 64
EXACT_SINGLE = 2048  # longest word whose squared counts stay below 2^24
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_LINKS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def slipped(word: str, prefix: int) -> str:
    """The word, less one letter where its hash says so. ``prefix`` is the CRC-32 of the text before the word."""
    h = zlib.crc32(word.encode(), prefix)
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(min_length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words("a-zÀ-ÿ")
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_COUNTS)
            held.clear()
            return out

        for batch in text_batches(batches):
            for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                prefix = zlib.crc32(f"{doc}:".encode())
                found: Counter[str] = Counter()
                for part in words.lists(ascii_lower(text.as_py() or "")):
                    found.update(part)
                for word, n in found.items():
                    if len(word) >= min_length:
                        result = slipped(word, prefix)
                        if len(result) >= min_length:
                            held[result] += n
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    return run


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points with their occurrences, at least ``min_count``."""
    ship_package(docs.sparkSession)
    read = docs.select(F.coalesce(F.col("`doc_id`").cast("string"), F.lit("")).alias("_id"), F.col("`text`").alias("_text"))
    counted = read.mapInArrow(_count(min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _routes(min_length: int) -> Column:
    """The blocks of a word: both halves among words of its length (as the shorter), and among those one shorter (as the longer)."""
    word, size = F.col("word"), F.col("size")

    def route(shorter: Column, kind: int, half: Column) -> Column:
        return F.struct(
            shorter.cast("int").alias("shorter"), F.lit(kind).alias("kind"), F.xxhash64(half).alias("half")
        )

    own, less = F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")
    as_shorter = [route(size, 0, F.substring(word, F.lit(1), own)), route(size, 1, F.substring(word, own + 1, size))]
    as_longer = [route(size - 1, 0, F.substring(word, F.lit(1), less)), route(size - 1, 1, F.substring(word, less + 2, size))]
    return F.when(size > min_length, F.array(*as_shorter, *as_longer)).otherwise(F.array(*as_shorter))


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts per word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    letters = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26)
    return np.bincount(rows * LETTERS + letters, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)


def one_edit(shorter: str, longer: str) -> bool:
    """Whether two different words of the same or adjacent lengths differ by one code point."""
    at = next((k for k, (a, b) in enumerate(zip(shorter, longer)) if a != b), len(shorter))
    return shorter[at + (len(shorter) == len(longer)) :] == longer[at + 1 :]


def near_pairs(words: list[str], group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Index pairs of one group whose squared distance of letter counts is at most two. ``group`` is ascending."""
    counts, sizes = letter_counts(words), np.fromiter(map(len, words), np.int64, len(words))
    kind = np.float32 if sizes.max(initial=0) <= EXACT_SINGLE else np.float64
    norms = (counts * counts).sum(axis=1)
    ones = np.ones(len(words))
    left = np.column_stack([-2 * counts, norms, ones]).astype(kind)
    right = np.column_stack([counts, ones, norms]).astype(kind).T.copy()
    ends = np.searchsorted(group, group, side="right")
    for a in range(0, len(words), TILE):
        b = min(a + TILE, len(words))
        end = int(ends[b - 1])
        i, j = np.nonzero(left[a:b] @ right[:, a:end] <= 2)
        i, j = i + a, j + a
        good = (j > i) & (group[i] == group[j]) & (np.abs(sizes[i] - sizes[j]) <= 1)
        yield from zip(i[good].tolist(), j[good].tolist())


def _links(rows: pa.Table) -> pa.RecordBatch:
    """Verified pairs of whole units, in both directions."""
    words, n = rows.column("word").to_pylist(), rows.column("n").to_pylist()
    unit = np.column_stack([rows.column(c).to_numpy() for c in ("shorter", "kind", "half", "first", "second")])
    group = np.cumsum(np.concatenate([[False], (unit[1:] != unit[:-1]).any(axis=1)]))
    part, shorter, kind = rows.column("part").to_numpy(), unit[:, 0].tolist(), unit[:, 1].tolist()
    first, second = unit[:, 3], unit[:, 4]
    across = (first != second).tolist()
    out: tuple[list, list, list] = ([], [], [])
    for i, j in near_pairs(words, group):
        u, v = sorted((words[i], words[j]), key=len)
        size = shorter[i]
        if len(u) != size or across[i] and part[i] == part[j] or not one_edit(u, v):
            continue
        if (u[: size // 2] == v[: size // 2]) == (kind[i] == 0):
            for x, y in ((i, j), (j, i)):
                for column, value in zip(out, (words[x], words[y], n[y])):
                    column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _LINKS)], schema=_LINKS)


def _match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; the last unit of a batch waits for its remaining rows."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.column_stack([batch.column(c).to_numpy() for c in ("shorter", "kind", "half", "first", "second")])
        starts = np.flatnonzero(np.concatenate([[False], (unit[1:] != unit[:-1]).any(axis=1)]))
        if not len(starts):
            if waiting and any(waiting[-1].column(c)[-1] != batch.column(c)[0] for c in ("shorter", "kind", "half", "first", "second")):
                yield _links(pa.Table.from_batches(waiting))
                waiting = []
            waiting.append(batch)
            continue
        cut = int(starts[-1])
        yield _links(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
        waiting = [batch.slice(cut)]
    if waiting:
        yield _links(pa.Table.from_batches(waiting))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, unit: int = UNIT) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, in both directions, once each."""
    ship_package(words.sparkSession)
    sized = words.withColumn("size", F.char_length("word"))
    routed = sized.select("word", "n", F.inline(_routes(min_length)))
    block = ["shorter", "kind", "half"]
    large = routed.groupBy(*block).agg(F.ceil(F.count("*") / unit).cast("int").alias("parts")).where("parts > 1")
    dealt = routed.join(large, block, "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit(unit), "word"), F.col("parts"))).cast("int")
    )
    others = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    paired = dealt.withColumn("other", F.explode(others)).select(
        *block, F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "word", "n"
    )
    unit_key = [*block, "first", "second"]
    placed = paired.repartition(bucket_total(words.sparkSession), *unit_key).sortWithinPartitions(*unit_key)
    return placed.mapInArrow(_match, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms that starts at every word with a form."""
    current = materialize_small(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize_small(current.join(step, "root", "left").select("word", "root", "next"), "roots")
        current = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next IS NOT NULL").isEmpty():
            return current


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, unit: int = UNIT
) -> DataFrame:
    """Per word: n, n_near, form, form_n and root."""
    words = materialize_small(word_counts(docs, min_length, min_count), "words")
    nearest = near_words(words, min_length, unit).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    dominated = -F.col("best.less") >= ratio * F.col("n")
    judged = materialize(
        words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(dominated, F.col("best.near")).alias("form"), F.when(dominated, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
