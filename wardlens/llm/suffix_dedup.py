"""Removal of byte strings that also start in an earlier document, by minimizer anchors with hashed windows.

A substitute for prefix doubling, which sorts the (position, rank) pairs of all bytes at growing offsets. That form is
in ``prefix_doubling`` and gives the same rows through ``find=prefix_doubling.matches``; it moves tens of bytes per text
byte and round (figures in README.md). From it stays that a position leaves once its name is unique:

* Ranks are 64-bit names of the strings themselves (prefix sums of a polynomial), so the rank at ``p + h``
  needs no join; equal strings get equal names in every task.
* Round 1 ranks only anchors: in each window of ``length`` bytes the leftmost smallest name of its
  ``h``-byte substrings (h about half of ``length``). Equal windows have equal anchors, so a window whose
  anchor name is unique is unique, and its position is dropped.
* Round 2 ranks the whole stretch covered by the windows of one anchor. If an equal stretch starts in a
  document with a smaller id, all its windows do, without ranking them one by one.
* Round 3 ranks the remaining windows at the full ``length``: those of stretches that share an anchor name
  with a different stretch. Here the threshold is passed and a rank shared with a smaller id is a match.

Names are compared inside hash buckets; a batch sends one entry per stretch name (that of its smallest id),
because the other documents of the batch are known to be matched already. Hence a stretch that a third of
all documents share costs its bucket one entry per batch.

Cases: a null text counts as empty; texts shorter than ``length`` bytes lose nothing; rows with a null id lose nothing and
are no source; rows that repeat an id do not match each other, for no id is smaller; an empty table gives an
empty result. Other columns never clash, as only id and text are read (or carried through untouched).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.exchange import (
    PACKED,
    PACKED_DDL,
    blobs_of,
    bucket_total,
    by_bucket,
    first_of_runs,
    id_bucket,
    id_bucket_column,
    packed_rows,
    packed_tables,
    tables_of,
    text_batches,
    unpacked,
    written,
)
from wardlens.llm.hashing import U64, Windows
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import release

MIN_LENGTH = 50
BLOCK = 1 << 20  # windows hashed at once; bounds the memory that a very long text takes
MATCH, PROBE, DOCS = 0, 1, 2
NAME_BITS = 48  # of anchor and stretch names on the way; compared together, so 96 bits name a stretch
ENTRY = ("u8", "u8", "i8", "i8", "u4", "u4")  # anchor name, stretch name, id, text key, first window, windows
RANGE = ENTRY[2:]
WINDOW = ("u8", "i8", "i8", "u4")


def anchor_length(length: int) -> int:
    return max(1, length // 2 - 1)


def leftmost_smallest(names: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest name in every run of ``width`` names."""
    value, index, span = names, np.arange(len(names), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left = value[:-step] <= value[step:]
        value = np.where(left, value[:-step], value[step:])
        index = np.where(left, index[:-step], index[step:])
        span += step
    return index


def stretches(data: np.ndarray, length: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor names, stretch names, first windows, window counts) of a text, block by block."""
    short = anchor_length(length)
    for start in range(0, len(data) - length + 1, block):
        windows = Windows(data[start : start + block + length - 1])
        names = windows.all_of(short)
        at = leftmost_smallest(names, length - short + 1)
        first = np.flatnonzero(first_of_runs(at))
        last = np.concatenate([first[1:], [len(at)]]) - 1
        yield names[at[first]], windows.spans(first, last + length), first + start, last - first + 1


def texts_of(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, int, bytes]]:
    """(id, text key, bytes) of the rows with an id, each (id, key) once, in id order."""
    ids, keys = batch.column("_id").to_pylist(), batch.column("_key").to_pylist()
    texts = batch.column("_text")
    seen = sorted({(i, k): n for n, (i, k) in enumerate(zip(ids, keys)) if i is not None}.items())
    for (i, k), n in seen:
        yield i, k, texts[n].as_py() or b""


def _split_off_known(names, docs, columns):
    """Entries whose name has a smaller id in the same batch are matched; the others go to the name's bucket.

    ``docs`` is ascending, so the first entry of a run in a stable order has the smallest id.
    """
    order = np.argsort(names, kind="stable")
    first = first_of_runs(names[order])
    smallest = docs[order][first][np.cumsum(first) - 1]
    known = np.zeros(len(names), bool)
    known[order] = docs[order] > smallest
    return [c[known] for c in columns], [c[~known] for c in columns]


def _rank_anchors(length: int, total: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in text_batches(batches):
            yield from packed_rows(_anchor_rows(batch, length, total)).to_batches()

    return run


def _anchor_rows(batch: pa.RecordBatch, length: int, total: int) -> list[tuple[int, int, bytes]]:
    """The packed stretches of one batch; the columns they are made of go with the call."""
    parts: list[list[np.ndarray]] = [[] for _ in ENTRY]
    for i, key, text in texts_of(batch):
        for anchor, name, first, count in stretches(np.frombuffer(text, np.uint8), length):
            n = len(first)
            for part, a, kind in zip(parts, (anchor, name, np.full(n, i), np.full(n, key), first, count), ENTRY):
                part.append(a.astype(kind, copy=False))
    if not parts[0]:
        return []
    columns = [np.concatenate(p) for p in parts]
    parts.clear()
    known, home = _split_off_known(columns[1], columns[2], columns)
    columns.clear()
    target = (home[0] % U64(total)).astype(np.int64)
    entries = [*_short(home[0]), *_short(home[1]), *home[2:]]
    home.clear()
    rows = list(by_bucket(0, id_bucket(known[2], total), known[2:]))
    known.clear()
    return list(by_bucket(1, target, entries)) + rows


def _short(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper ``NAME_BITS`` bits of names, as two narrow columns."""
    return (names >> U64(32)).astype("u4"), (names >> U64(16) & U64(0xFFFF)).astype("u2")


def _judge_stretches(total: int):
    """Of one bucket: stretches with a smaller id are matched; first holders of one name among several are probed."""

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("kind")[0].as_py() == 0:
            return _relabel(table, MATCH)
        columns = unpacked(table.column("data").to_pylist(), ("u4", "u2", "u4", "u2", *RANGE))
        anchor, name = (high.astype("u8") << U64(16) | low for high, low in (columns[:2], columns[2:4]))
        doc, key, first, count = columns[4:]
        order = np.lexsort((doc, name, anchor))
        anchor, name, doc, key, first, count = (a[order] for a in (anchor, name, doc, key, first, count))
        new_anchor = first_of_runs(anchor)
        new_name = new_anchor | first_of_runs(name)
        smallest = doc[new_name][np.cumsum(new_name) - 1]
        several = np.add.reduceat(new_name.astype(np.int64), np.flatnonzero(new_anchor)) > 1
        several = several[np.cumsum(new_anchor) - 1]
        matched = doc > smallest
        probed = ~matched & several
        rows = []
        for kind, hit in ((MATCH, matched), (PROBE, probed)):
            rows += by_bucket(kind, id_bucket(doc[hit], total), [a[hit] for a in (doc, key, first, count)])
        return packed_rows(rows)

    return run


def _relabel(table: pa.Table, kind: int) -> pa.Table:
    return table.select(PACKED.names).set_column(0, "kind", pa.array([kind] * table.num_rows, pa.int32()))


def _rank_windows(length: int, total: int):
    """Round 3, one bucket of documents with its probed stretches: names of the single windows."""

    def run(table: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[] for _ in WINDOW]
        wanted = _ranges_by_row(*unpacked(blobs_of(table, PROBE), RANGE))
        for i, k, text in (row for docs in tables_of(blobs_of(table, DOCS)) for row in texts_of(docs)):
            if (i, k) not in wanted:
                continue
            at = _covered(*wanted.pop((i, k)))
            data = np.frombuffer(text, np.uint8)
            for start in range(0, len(data), BLOCK):
                here = at[(at >= start) & (at < start + BLOCK)]
                if len(here):
                    windows = Windows(data[start : start + BLOCK + length - 1])
                    names = windows.spans(here - start, here - start + length)
                    for part, a in zip(parts, (names, np.full(len(here), i), np.full(len(here), k), here)):
                        part.append(a)
        if not parts[0]:
            return packed_rows([])
        columns = [np.concatenate(p).astype(t) for p, t in zip(parts, WINDOW)]
        order = np.argsort(columns[1], kind="stable")
        columns = [c[order] for c in columns]
        known, home = _split_off_known(columns[0], columns[1], columns)
        rows = list(by_bucket(1, (home[0] % U64(total)).astype(np.int64), home))
        rows += by_bucket(0, id_bucket(known[1], total), [*known[1:], np.ones(len(known[0]), "u4")])
        return packed_rows(rows)

    return run


def _judge_windows(total: int):
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("kind")[0].as_py() == 0:
            return _relabel(table, MATCH)
        name, doc, key, at = unpacked(table.column("data").to_pylist(), WINDOW)
        order = np.lexsort((doc, name))
        name, doc, key, at = (a[order] for a in (name, doc, key, at))
        new = first_of_runs(name)
        hit = doc > doc[new][np.cumsum(new) - 1]
        columns = [doc[hit], key[hit], at[hit], np.ones(int(hit.sum()), "u4")]
        return packed_rows(by_bucket(MATCH, id_bucket(doc[hit], total), columns))

    return run


def _ranges_by_row(doc, key, first, count) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    if not len(doc):
        return {}
    order = np.lexsort((first, key, doc))
    doc, key, first, count = (a[order] for a in (doc, key, first, count))
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(key) != 0)) + 1
    starts, stops = [0, *cuts.tolist()], [*cuts.tolist(), len(doc)]
    return {
        (int(doc[a]), int(key[a])): (first[a:b].astype(np.int64), count[a:b].astype(np.int64))
        for a, b in zip(starts, stops)
    }


def _covered(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sorted distinct positions of the ranges [first, first + count)."""
    ends = np.cumsum(count)
    return np.unique(np.arange(ends[-1]) - np.repeat(ends - count, count) + np.repeat(first, count))


def removed_spans(first: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, stop) of bytes covered by the matched windows; ranges sorted by ``first``."""
    stop = np.maximum.accumulate(first + count - 1 + length)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > stop[:-1]
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])
    return first[new], stop[last]


def _cut(length: int, carried: Sequence[str], as_text: bool):
    """The documents of one bucket without their removed bytes."""

    def cut(docs: pa.Table, found) -> pa.Table:
        texts, out = docs.column("_text"), []
        for n, row in enumerate(zip(docs.column("_id").to_pylist(), docs.column("_key").to_pylist())):
            given = texts[n].as_py()
            text = kept = given or b""
            spans = ()
            if row in found:
                starts, stops = removed_spans(*found[row], length)
                spans = list(zip(starts.tolist(), stops.tolist()))
                edges = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            facts = (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
            out.append((None if given is None else kept.decode("utf-8", "ignore") if as_text else kept, *facts))
        kinds = (pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out)) if out else [()] * 5
        return pa.Table.from_arrays(
            [*[docs.column(c) for c in carried], *[pa.array(c, type=t) for c, t in zip(columns, kinds)]],
            names=[*carried, *OUTPUT],
        )

    def run(table: pa.Table) -> pa.Table:
        found = _ranges_by_row(*unpacked(blobs_of(table, MATCH), RANGE))
        return pa.concat_tables([cut(docs, found) for docs in tables_of(blobs_of(table, DOCS))])

    return run


OUTPUT = ("_kept", "_bytes", "_removed", "_spans", "_sha256")


def anchored_matches(rows: DataFrame, length: int, total: int) -> DataFrame:
    """Packed matched windows of ``rows`` (_id, _key, _text, bucket), in ranges."""
    ranked = rows.drop("bucket").mapInArrow(_rank_anchors(length, total), PACKED_DDL)
    judged = written(
        ranked.groupBy("kind", "bucket").applyInArrow(_judge_stretches(total), PACKED_DDL), "stretches"
    )
    texts = rows.mapInArrow(packed_tables(DOCS), PACKED_DDL)
    windows = texts.unionByName(judged.where(F.col("kind") == PROBE)).groupBy("bucket").applyInArrow(
        _rank_windows(length, total), PACKED_DDL
    )
    singles = written(
        windows.groupBy("kind", "bucket").applyInArrow(_judge_windows(total), PACKED_DDL), "windows"
    )
    return judged.where(F.col("kind") == MATCH).unionByName(singles)


def cut_repeats(
    docs: DataFrame,
    carry: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = MIN_LENGTH,
    as_text: bool = False,
    find: Callable[[DataFrame, int, int], DataFrame] = anchored_matches,
) -> DataFrame:
    """Columns ``carry`` of ``docs`` and, per row, _kept (remaining bytes), _bytes, _removed, _spans and _sha256.

    With ``as_text`` the remaining bytes are text; a character of which only some bytes remain goes. ``find`` finds the
    matched windows.
    """
    spark, total = docs.sparkSession, bucket_total(docs.sparkSession)
    ship_package(spark)
    ids, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    repeated = not docs.select(ids.alias("_id")).where("_id is not null").groupBy("_id").count().where("count > 1").isEmpty()
    key = F.xxhash64(text) if repeated else F.lit(0).cast("long")
    home = F.coalesce(id_bucket_column(ids, total), F.pmod(F.xxhash64(text), F.lit(total)).cast("int"))
    read = docs.select(
        ids.alias("_id"), key.alias("_key"), text.cast("binary").alias("_text"), home.alias("bucket"),
        *[F.col(f"`{c}`").alias(f"_c{n}") for n, c in enumerate(carry)],
    )
    rows = read.select("_id", "_key", "_text", "bucket")

    matches = find(rows, length, total)
    carried = [f"_c{n}" for n in range(len(carry))]
    kinds = (T.StringType() if as_text else T.BinaryType(), T.LongType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType(
        [T.StructField(n, docs.schema[c].dataType) for n, c in zip(carried, carry)]
        + [T.StructField(n, t) for n, t in zip(OUTPUT, kinds)]
    )
    whole = read.mapInArrow(packed_tables(DOCS), PACKED_DDL).unionByName(matches)
    cut = whole.groupBy("bucket").applyInArrow(_cut(length, carried, as_text), schema)
    return cut.select(*[F.col(f"_c{n}").alias(c) for n, c in enumerate(carry)], *OUTPUT)


def suffix_dedup(docs: DataFrame, length: int = MIN_LENGTH, find=anchored_matches) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    out = cut_repeats(docs, ["doc_id"], length=length, find=find)
    return out.select(
        "doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"),
        F.col("_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"),
        F.coalesce("_kept", F.lit(b"")).alias("kept"),
    )


def deduplicated_documents(docs: DataFrame, length: int = MIN_LENGTH) -> DataFrame:
    """The documents without repeated bytes, in their own columns; those that lose every byte go.

    ``n_chars`` becomes the new length. A text that loses nothing stays as it was, null included.
    """
    out = cut_repeats(docs, [c for c in docs.columns if c != "text"], length=length, as_text=True)
    changed = F.col("_removed") > 0
    size = F.length("_kept").cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("_kept"), "n_chars": F.when(changed, size).otherwise(F.col("n_chars"))}
    columns = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return out.where(~changed | (F.col("_removed") < F.col("_bytes"))).select(*columns)
