"""Cross-tokenizer alignment with external spill counting of token pairs.

1. Tasks encode whole texts with both tokenizers and cut both token sequences where tokens of both end. A text is first cut before single
   spaces between regular characters, where either tokenizer provably ends a token, so each such unit is
   aligned once and remembered (bounded); what cannot be cut is encoded in one piece.
2. Spill. Per batch of documents, the linked pairs become records (pair, document, links), radix-partitioned by the first
   tokenizer's id, sorted side-major (first id, then second id, then document) and written as one zstd run per
   partition to the shared folder: keys and documents apart, so that counting does not read the latter.
3. Count. A partition's runs are dealt to units of about ``UNIT`` records by hash. Each unit merges its runs through a heap of run blocks
   and adds up, pair by pair, how many documents hold it; Spark adds the units up. A pair that a third of all
   documents hold is one key per run, never one group of documents.
4. Stream back. The same merge runs again with the totals as one more sorted run: as keys come side-major, each first id's totals are
   consecutive and give its maximum, and the runs' documents receive their counts. One packed row per run goes
   back to the batch that wrote it.

Cases: null and empty texts and texts that a tokenizer does not reproduce byte by byte have no tokens: zeros and an empty string; the strings
of special tokens inside texts are plain text; rows that repeat an id or a text are documents of their own; ties for an id's highest
count all count; very long texts and units that are too long to remember are encoded whole; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import itertools
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scale import materialize_small
from wardlens.llm.exchange import first_of_runs, packed, text_batches, unpacked, written
from wardlens.llm.pretokens import Tokenizer
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import held
from wardlens.llm.token_counts import _byte_letters

RADIX = 64  # partitions by the lowest bits of the first tokenizer's id
BLOCK_IDS = 4096  # first ids of a block, the part of a run that the heap merges at once
UNIT = 8_000_000  # records of a unit
MEMO = 300_000  # units of text remembered
JOINED = 256  # units encoded at once
MEMO_LENGTH = 64  # characters of a remembered unit
SECOND = 1 << 20  # a pair is first id * SECOND + second id
DOC_BITS = 20  # of a document's number in its batch
STATS, RUN = -1, 0
REGULAR = "!-~À-ɏ"  # characters of no white space, in both tokenizers' eyes
SPILLED = pa.schema(
    [("radix", pa.int32()), ("origin", pa.int64()), ("records", pa.int64()), ("keys", pa.binary()), ("postings", pa.binary())]
)
SPILLED_DDL = "radix int, origin long, records long, keys binary, postings binary"
COUNTED_DDL = "radix int, pair long, n long"


@dataclass(frozen=True)
class Setup:
    first: str  # the tokenizers' file of the first one
    second: bytes  # the sentencepiece model of the second one
    cut_inside: bool  # whether the second one may be cut before a space


def read_setup(first_file: str, second_file: str) -> Setup:
    """Both files, and the proof that no piece has a space behind another character."""
    with open(first_file, encoding="utf-8") as file:
        first = file.read()
    with open(second_file, "rb") as file:
        second = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=second)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return Setup(first, second, not any("▁" in p.lstrip("▁") for p in pieces))


def _summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs)
    pairs = pairs[order]
    starts = np.flatnonzero(first_of_runs(pairs)) if len(pairs) else np.empty(0, np.int64)
    return pairs[starts], np.add.reduceat(n[order], starts) if len(starts) else n


@dataclass
class Aligned:
    """Some pieces of text in both tokenizers: per piece its tokens, groups and links, and how often each pair is linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    stops: np.ndarray  # of each piece's pairs
    pairs: np.ndarray
    links: np.ndarray


FEW = 64  # links of a group that are listed one by one


def align(a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, ends: np.ndarray) -> Aligned | None:
    """Groups and links of pieces one after the other. All ``ends`` are in bytes; none if a piece ends inside a token."""
    a_stops, b_stops = np.searchsorted(a_ends, ends, side="right"), np.searchsorted(b_ends, ends, side="right")
    if not ((a_ends[a_stops - 1] == ends).all() and (b_ends[b_stops - 1] == ends).all()):
        return None
    n_a, n_b = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    per_a, per_b = (np.bincount(np.searchsorted(cuts, ends), minlength=len(cuts)) for ends in (a_ends, b_ends))
    first_a, first_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
    piece = np.repeat(np.arange(len(ends)), n_a)[first_a]  # of each group
    starts = np.searchsorted(piece, np.arange(len(ends)))
    total = per_a * per_b

    few = np.flatnonzero(total <= FEW)
    group = np.repeat(few, total[few])
    at = np.arange(len(group)) - np.repeat(np.cumsum(total[few]) - total[few], total[few])
    pair = a_ids[first_a[group] + at // per_b[group]] * SECOND + b_ids[first_b[group] + at % per_b[group]]
    owners, pairs, links = [piece[group]], [pair], [np.ones(len(pair), np.int64)]
    for g in np.flatnonzero(total > FEW).tolist():
        (x, n), (y, o) = (
            np.unique(ids[first[g] : first[g] + per[g]], return_counts=True)
            for ids, first, per in ((a_ids, first_a, per_a), (b_ids, first_b, per_b))
        )
        owners.append(np.full(len(x) * len(y), piece[g]))
        pairs.append((x[:, None] * SECOND + y).ravel())
        links.append((n[:, None] * o).ravel())
    owner, pair, n = np.concatenate(owners), np.concatenate(pairs), np.concatenate(links)
    order = np.lexsort((pair, owner))
    owner, pair, n = owner[order], pair[order], n[order]
    new = np.flatnonzero(first_of_runs(owner) | first_of_runs(pair)) if len(pair) else np.empty(0, np.int64)
    a_names, b_names = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
    strings = [
        f"{a_names[i]}|{b_names[j]}" if x == y == 1 else f"{','.join(a_names[i : i + x])}|{','.join(b_names[j : j + y])}"
        for i, j, x, y in zip(first_a.tolist(), first_b.tolist(), per_a.tolist(), per_b.tolist())
    ]
    stops = np.append(starts[1:], len(piece))
    return Aligned(
        n_a, n_b, stops - starts, np.add.reduceat(total, starts) if len(starts) else total,
        [";".join(strings[i:j]) for i, j in zip(starts.tolist(), stops.tolist())],
        np.searchsorted(owner[new], np.arange(len(ends)), side="right"), pair[new], np.add.reduceat(n, new) if len(new) else n,
    )


class Units:
    """A growing table of aligned units; the last ones can be taken off again."""

    COLUMNS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self) -> None:
        self.columns = {c: array("q") for c in self.COLUMNS}
        self.stops = array("q", [0])  # of each unit's pairs
        self.pairs, self.links = array("q"), array("q")
        self.groups: list[str] = []

    def add(self, found: Aligned) -> int:
        """Append units; the number of the first one."""
        first = len(self.groups)
        for name, column in self.columns.items():
            column.frombytes(getattr(found, name).astype(np.int64).tobytes())
        self.stops.frombytes((found.stops + len(self.pairs)).astype(np.int64).tobytes())
        self.pairs.frombytes(found.pairs.tobytes())
        self.links.frombytes(found.links.tobytes())
        self.groups += found.groups
        return first

    def keep(self, size: int) -> None:
        for column in self.columns.values():
            del column[size:]
        del self.stops[size + 1 :]
        del self.pairs[self.stops[-1] :]
        del self.links[self.stops[-1] :]
        del self.groups[size:]


@dataclass
class Batch:
    """The alignment of some texts: one number per text, and the records (pair, document, links), sorted by pair and document."""

    numbers: dict[str, np.ndarray]
    groups: list[str]
    pair: np.ndarray
    doc: np.ndarray
    links: np.ndarray


class Aligner:
    """Both tokenizers and the units that were aligned before."""

    def __init__(self, setup: Setup):
        self.first = Tokenizer.from_str(setup.first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=setup.second)
        letters = _byte_letters()
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes: list[bytes] = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.second.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        self.cut_inside = setup.cut_inside
        self.regular = re.compile(f"[{REGULAR}](?:.*[{REGULAR}])?", re.DOTALL).fullmatch
        self.known: dict[str, int] = {}  # between batches, only units without a space between two regular characters
        self.units = Units()

    def add(self, pieces: list[str], joined: int = 1) -> list[int]:
        """Pieces aligned with a space before each; -1 where a tokenizer does not reproduce the bytes.

        Pieces between which the text may be cut can be encoded ``joined``, so many at a time; where that does not work
        out, they are encoded one by one.
        """
        chunks = [pieces[k : k + joined] for k in range(0, len(pieces), joined)]
        if not chunks:
            return []
        texts = [" ".join(c) for c in chunks]
        firsts = self.first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        seconds = self.second.encode(texts, num_threads=1)
        good: list[list[str]] = []
        a: list[int] = []
        b: list[int] = []
        out: dict[int, list[int]] = {}
        for k, (chunk, text, first, y) in enumerate(zip(chunks, texts, firsts, seconds)):
            x, data = first.ids, (" " + text).encode()
            if data == b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y)):
                good.append(chunk)
                a += x
                b += y
            else:
                out[k] = self.add(chunk) if len(chunk) > 1 else [-1]
        if good:
            a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
            sizes = np.fromiter((len(p.encode()) + 1 for c in good for p in c), np.int64, sum(map(len, good)))
            found = align(a_ids, b_ids, np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids]), np.cumsum(sizes))
            if found is None:
                return self.add(pieces)
            first_number = self.units.add(found)
            if not out:
                return list(range(first_number, len(self.units.groups)))
            numbers = iter(range(first_number, len(self.units.groups)))
        return [n for k, c in enumerate(chunks) for n in (out[k] if k in out else itertools.islice(numbers, len(c)))]

    def cut(self, text: str) -> list[str]:
        """The text cut at single spaces between two regular characters."""
        if not self.cut_inside:
            return [text]
        regular = self.regular
        out, open_end = [], False
        for n, part in enumerate(text.split(" ")):
            if not n or open_end and part and regular(part[0]):
                out.append(part)
            else:
                out[-1] = f"{out[-1]} {part}"
            open_end = bool(part and regular(part[-1]))
        return out

    def _units(self, texts: list[str]) -> tuple[list[list[str]], list[str], list[str]]:
        """Every text's units, and the unknown ones: those without a space between two regular characters, and others."""
        if not self.cut_inside:
            return [[t] if t else [] for t in texts], [], list(dict.fromkeys(t for t in texts if t))
        split = [t.split(" ") if t else [] for t in texts]
        new = set(itertools.chain.from_iterable(split)) - self.known.keys()
        odd = {p for p in new if not self.regular(p)}
        others: dict[str, None] = {}
        if odd:
            for k, parts in enumerate(split):
                if not odd.isdisjoint(parts):
                    split[k] = self.cut(texts[k])
                    new.update(u for u in split[k] if " " not in u and u not in odd and u not in self.known)
                    others.update((u, None) for u in split[k] if " " in u or u in odd)
        return split, list(new - odd), list(others)

    def align(self, texts: list[str]) -> Batch:
        known = self.known
        split, brief, others = self._units(texts)
        brief.sort(key=len)  # short ones come back more often
        room = max(0, min(MEMO - len(self.units.groups), bisect.bisect_right(brief, MEMO_LENGTH, key=len)))
        known.update(zip(brief[:room], self.add(brief[:room], JOINED)))
        size = len(self.units.groups)
        passing = [*brief[room:], *others]
        known.update(zip(passing, [*self.add(brief[room:], JOINED), *self.add(others)]))
        ids: list[list[int]] = []
        for text, names in zip(texts, split):
            found = list(map(known.__getitem__, names))
            if -1 in found:  # the units' differences might cancel out, so the whole text decides
                found = [n for n in self.add([text]) if n >= 0]
            ids.append(found)
        try:
            return self._batch(ids)
        finally:
            self.units.keep(size)
            for u in passing:
                del known[u]

    def _batch(self, ids: list[list[int]]) -> Batch:
        units, sizes = self.units, np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(ids)), sizes)
        numbers = {}
        for name, column in units.columns.items():
            totals = np.zeros(len(ids), np.int64)
            np.add.at(totals, doc, np.array(column, np.int64)[flat])
            numbers[name] = totals
        groups = [";".join([units.groups[u] for u in found]) for found in ids]
        used, n = np.unique(doc << 40 | flat, return_counts=True)
        doc, unit = used >> 40, used & (1 << 40) - 1
        stops = np.array(units.stops, np.int64)
        start, count = stops[unit], stops[unit + 1] - stops[unit]
        at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else start, count) + np.arange(int(count.sum()))
        code = np.array(units.pairs, np.int64)[at] << DOC_BITS | np.repeat(doc, count)
        links = np.array(units.links, np.int64)[at] * np.repeat(n, count)
        code, links = _summed(code, links)
        return Batch(numbers, groups, code >> DOC_BITS, code & (1 << DOC_BITS) - 1, links)


def _spilled_runs(origin: int, batch: Batch, radix: int) -> Iterator[tuple]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    part = batch.pair // SECOND % radix
    order = np.argsort(part.astype(np.int16), kind="stable")
    pair, doc, links = batch.pair[order], batch.doc[order], batch.links[order]
    cuts = np.searchsorted(part[order], np.arange(radix + 1))
    for r in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[r], cuts[r + 1]
        starts = np.flatnonzero(first_of_runs(pair[a:b]))
        holders = np.diff(np.append(starts, b - a))
        keys = squeeze(packed([pair[a:b][starts], holders]))
        yield r, origin, int(b - a), keys, squeeze(packed([doc[a:b], links[a:b]]))


def _spill(shared, radix: int, groups: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(shared.value, Aligner)
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(text_batches(batches, 4 << 20)):
            origin = task << 32 | n
            found = aligner.align([t or "" for t in batch.column("_text").to_pylist()])
            columns = {"doc_id": batch.column("_id"), **{c: pa.array(v) for c, v in found.numbers.items()}}
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.groups]
            columns["groups_sha256"] = pa.array(digests, pa.string())
            if groups:
                columns["groups"] = pa.array(found.groups, pa.string())
            table = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(table)
            rows = [(STATS, origin, batch.num_rows, sink.getvalue().to_pybytes(), b""), *_spilled_runs(origin, found, radix)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SPILLED)], schema=SPILLED)

    return run


def _blocks(run: int, pairs: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(block, run, start, stop) of a sorted run. Blocks are ranges of the first id."""
    block = pairs // (SECOND * BLOCK_IDS)
    starts = np.flatnonzero(first_of_runs(block)).tolist() if len(block) else []
    for a, b in zip(starts, [*starts[1:], len(block)]):
        yield int(block[a]), run, a, b


def merged_blocks(runs: Sequence[np.ndarray]) -> Iterator[list[tuple[int, int, int]]]:
    """The blocks of all sorted runs in order, through a heap: per block, its (run, start, stop)."""
    heads = heapq.merge(*(_blocks(n, pairs) for n, pairs in enumerate(runs)))
    for _, block in itertools.groupby(heads, key=lambda b: b[0]):
        yield [b[1:] for b in block]


def _keys(blob: bytes) -> list[np.ndarray]:
    return unpacked([zstandard.ZstdDecompressor().decompress(blob)], ("i8", "i8"))


def _count(rows: pa.Table) -> pa.Table:
    """Documents per pair of one unit's runs."""
    runs = [_keys(blob) for blob in rows.column("keys").to_pylist()]
    parts = []
    for block in merged_blocks([pairs for pairs, _ in runs]):
        parts.append(_summed(*(np.concatenate([runs[r][c][a:b] for r, a, b in block]) for c in (0, 1))))
    pair, n = (np.concatenate([p[c] for p in parts]) for c in (0, 1))
    radix = np.full(len(pair), rows.column("radix")[0].as_py(), np.int32)
    return pa.table({"radix": radix, "pair": pair, "n": n})


def _return(rows: pa.Table, totals: pa.Table) -> pa.Table:
    """Counts streamed back: per run, its documents' links at their first id's highest count, and the sum of counts."""
    pair, n = (totals.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    total, n = pair[order], n[order]
    origins = rows.column("origin").to_pylist()
    runs = [_keys(blob) for blob in rows.column("keys").to_pylist()]
    posted = [zstandard.ZstdDecompressor().decompress(b) for b in rows.column("postings").to_pylist()]
    ends = [np.concatenate([[0], np.cumsum(holders)]) for _, holders in runs]
    gained: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    count_of = [np.empty(len(pairs), np.int64) for pairs, _ in runs]
    best_of = [np.empty(len(pairs), bool) for pairs, _ in runs]
    for block in merged_blocks([total, *(pairs for pairs, _ in runs)]):
        (_, a, b), *held_by = block  # every pair of a run is in the totals, which are run 0
        ids, counts = total[a:b] // SECOND, n[a:b]
        starts = np.flatnonzero(first_of_runs(ids))
        highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, b - a)))
        for r, c, d in held_by:
            at = np.searchsorted(total[a:b], runs[r - 1][0][c:d])
            count_of[r - 1][c:d], best_of[r - 1][c:d] = counts[at], counts[at] == highest[at]
    out = []
    for r, (origin, blob) in enumerate(zip(origins, posted)):
        doc, links = unpacked([blob], ("i8", "i8"))
        holders = np.diff(ends[r])
        size = int(doc.max()) + 1
        sums, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(sums, doc, np.repeat(count_of[r], holders) * links)
        np.add.at(best, doc, np.repeat(best_of[r], holders) * links)
        out.append((origin, packed([best, sums])))
    return pa.table({"origin": pa.array([o for o, _ in out], pa.int64()), "gained": pa.array([g for _, g in out], pa.binary())})


def _finish(stats: pa.Table, gained: pa.Table) -> pa.Table:
    """The documents of one batch with what their runs brought back."""
    table = pa.ipc.open_stream(stats.column("keys")[0].as_py()).read_all()
    best, sums = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
    for blob in gained.column("gained").to_pylist():
        found = unpacked([blob], ("i8", "i8"))
        for total, part in zip((best, sums), found):
            total[: len(part)] += part
    return table.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(sums))


class Alignment:
    """The spilled runs of one table and what is counted from them."""

    def __init__(
        self, docs: DataFrame, first_file: str, second_file: str, groups: bool = False, radix: int = RADIX, unit: int = UNIT
    ):
        spark = docs.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast(read_setup(first_file, second_file))
        read = docs.select(F.col("`doc_id`").alias("_id"), F.col("`text`").alias("_text"))
        self.schema = T.StructType([T.StructField("doc_id", read.schema["_id"].dataType)])
        for name in ("n_a", "n_b", "n_groups", "n_links"):
            self.schema.add(name, "long")
        self.schema.add("groups_sha256", "string")
        if groups:
            self.schema.add("groups", "string")
        self.schema.add("n_best", "long").add("count_sum", "long")
        self.spilled = written(read.mapInArrow(_spill(shared, radix, groups), SPILLED_DDL), "token_pairs")
        runs = self.spilled.where(F.col("radix") >= RUN)
        salts = runs.groupBy("radix").agg(F.ceil(F.sum("records") / unit).cast("int").alias("salts"))
        self.salts = materialize_small(salts, "salts")  # one row per radix partition
        self.runs = runs.join(F.broadcast(self.salts), "radix").withColumn(
            "salt", F.pmod(F.xxhash64("origin"), F.col("salts")).cast("int")
        )

    def pair_counts(self) -> DataFrame:
        """(radix, pair, n): how many documents hold each linked pair."""
        parts = self.runs.select("radix", "salt", "keys").groupBy("radix", "salt").applyInArrow(_count, COUNTED_DDL)
        return parts.groupBy("radix", "pair").agg(F.sum("n").alias("n"))

    def documents(self) -> DataFrame:
        """Per document: tokens, groups, links, best links, the sum of counts and the digest of the groups."""
        totals = written(self.pair_counts(), "pair_counts").join(F.broadcast(self.salts), "radix")
        dealt = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("radix", "salt", "pair", "n")
        units = self.runs.select("radix", "salt", "origin", "keys", "postings").groupBy("radix", "salt")
        gained = units.cogroup(dealt.groupBy("radix", "salt")).applyInArrow(_return, "origin long, gained binary")
        stats = self.spilled.where(F.col("radix") == STATS).select("origin", "keys")
        return stats.groupBy("origin").cogroup(written(gained, "gained").groupBy("origin")).applyInArrow(_finish, self.schema)


def aligned_pairs(docs: DataFrame, first_file: str, second_file: str) -> DataFrame:
    """(a_id, b_id, n, best): every linked pair, its documents, and whether that is the first id's highest count."""
    counts = written(Alignment(docs, first_file, second_file).pair_counts(), "pair_counts")
    ids = counts.select(
        F.floor(F.col("pair") / SECOND).cast("int").alias("a_id"), F.pmod("pair", F.lit(SECOND)).cast("int").alias("b_id"), "n"
    )
    highest = ids.groupBy("a_id").agg(F.max("n").alias("highest"))
    return ids.join(highest, "a_id").select("a_id", "b_id", "n", (F.col("n") == F.col("highest")).alias("best"))


def token_alignment(docs: DataFrame, first_file: str, second_file: str, groups: bool = False) -> DataFrame:
    """The alignment of every document; ``groups`` adds the groups themselves as a string."""
    return Alignment(docs, first_file, second_file, groups).documents()
