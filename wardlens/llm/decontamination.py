"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

1. Items become words (A-Z lowered; runs of digits, a-z and everything above ASCII). Items longer than ``PIECE`` words are cut into pieces that
   overlap by all but one word of a window, so each window lies in a piece. Pieces are dealt to shards of about
   ``SHARD`` words; one task per shard builds its automaton over words, whose states say which items own the window
   they stand for. Shards are written to the shared folder.
2. Documents stream through a shard: following transitions and suffix links gives, at every word, the length of the
   longest run that ends there and occurs in an item. A length of at least ``window`` words, or a whole shorter item, is a hit; hit
   words merge into spans. One shard at a time is broadcast: its size is bounded by ``SHARD`` words, and a benchmark of several shards takes
   as many passes, the spans found so far travelling with the rows. Nothing is shuffled.
3. ``cleaned`` removes spans longer than a limit, and all spans of a document that they cover beyond a limit.

Cases: null texts and texts without a word have no words and hit nothing; an item without a word is no window; items without an id make
hits but are not listed; repeated items are listed once per id; documents that repeat an id are judged row by row; very long
texts are read part by part; an empty benchmark leaves all documents clean; an empty table gives an empty result; other columns are
carried by ``cleaned`` untouched and ignored otherwise.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize_small
from wardlens.llm.exchange import text_batches, written
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import held
from wardlens.llm.words import Words, ascii_lower

WINDOW = 10
SHARD = 400_000
PIECE = 50_000
SPAN_LIMIT = 0  # words; longer spans are removed
COVERAGE_LIMIT = 0.5  # share of a document's words in spans; above it all its spans are removed
WORD = "0-9a-z\u0080-\U0010ffff"
SPAN = "struct<start: long, stop: long, first: long, last: long>"
_SPAN = pa.struct([(c, pa.int64()) for c in ("start", "stop", "first", "last")])
FOUND = pa.schema(
    [("_words", pa.int64()), ("_longest", pa.int64()), ("_spans", pa.list_(_SPAN)), ("_items", pa.list_(pa.string()))]
)
FOUND_DDL = f"_words long, _longest long, _spans array<{SPAN}>, _items array<string>"


class Builder:
    """A suffix automaton of several word sequences, grown word by word."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def _state(self, size: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]

    def _target(self, state: int, word: int) -> int:
        """The state of the sequence of ``state`` followed by ``word``, split off if its state also stands for longer ones."""
        reached = self.next[state][word]
        if self.size[reached] == self.size[state] + 1:
            return reached
        split = self._state(self.size[state] + 1, dict(self.next[reached]), self.link[reached])
        self.link[reached] = split
        self._redirect(state, word, reached, split)
        return split

    def add(self, words: Sequence[str]) -> None:
        last = 0
        for text in words:
            word = self.words.setdefault(text, len(self.words))
            if word in self.next[last]:
                last = self._target(last, word)
                continue
            new = self._state(self.size[last] + 1, {}, 0)
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._target(state, word)
            last = new


@dataclass
class Automaton:
    """What a document is streamed through. ``whole`` lists, per state, items shorter than a window that it stands for."""

    window: int
    words: dict[str, int]
    step: dict[int, int]  # state * number of words + word -> state
    link: list[int]
    size: list[int]
    windows: list[int]  # per state, the state of its last ``window`` words, or -1
    owners: dict[int, list[str]]
    whole: dict[int, list[tuple[int, list[str]]]]
    nearest: list[int] | None  # per state, the next one up the suffix links with a whole item


def build(items: Sequence[tuple[str | None, Sequence[str]]], window: int = WINDOW) -> Automaton:
    grown = Builder()
    for _, words in items:
        grown.add(words)
    link, size, base = grown.link, grown.size, max(1, len(grown.words))
    order = sorted(range(len(size)), key=size.__getitem__)
    windows = [-1] * len(size)
    for s in order:
        if size[s] >= window:
            windows[s] = s if size[link[s]] < window else windows[link[s]]
    owners: dict[int, set[str]] = {}
    whole: dict[int, dict[int, set[str]]] = {}
    for item, words in items:
        if not words:
            continue
        state = 0
        for n, text in enumerate(words, 1):
            state = grown.next[state][grown.words[text]]
            if n >= window:
                owners.setdefault(windows[state], set()).update([item] * (item is not None))
        if len(words) < window:
            whole.setdefault(state, {}).setdefault(len(words), set()).update([item] * (item is not None))
    nearest = None
    if whole:
        nearest = [-1] * len(size)
        for s in order:
            nearest[s] = s if s in whole else nearest[link[s]] if link[s] >= 0 else -1
    step = {s * base + w: t for s, following in enumerate(grown.next) for w, t in following.items()}
    return Automaton(
        window, grown.words, step, link, size, windows, {s: sorted(o) for s, o in owners.items()},
        {s: [(m, sorted(o)) for m, o in sorted(found.items())] for s, found in whole.items()}, nearest,
    )


def _add_span(spans: list[list[int]], start: int, stop: int) -> None:
    while spans and spans[-1][0] >= start:
        spans.pop()
    if spans and spans[-1][1] >= start:
        spans[-1][1] = stop
    else:
        spans.append([start, stop])


def stream(automaton: Automaton, parts: Iterable[list[str]]) -> tuple[int, int, list[list[int]], set[str]]:
    """(words, longest match, spans of hit words, items) of one text."""
    step, link, size, nearest = automaton.step, automaton.link, automaton.size, automaton.nearest
    window, base, known = automaton.window, max(1, len(automaton.words)), automaton.words
    state = length = longest = at = 0
    spans: list[list[int]] = []
    owners: set[int] = set()
    items: set[str] = set()
    for part in parts:
        for at, word in enumerate(map(known.get, part), at + 1):  # noqa: B020
            if word is None:
                state = length = 0
                continue
            reached = step.get(state * base + word)
            while reached is None:
                state = link[state]
                length = size[state]
                reached = step.get(state * base + word)
            state = reached
            length += 1
            if length > longest:
                longest = length
            if length >= window:
                owners.add(automaton.windows[state])
                _add_span(spans, at - window, at)
            if nearest is not None:
                holder = nearest[state]
                while holder >= 0:
                    for m, owned in automaton.whole[holder]:
                        if m <= length:
                            _add_span(spans, at - m, at)
                            items.update(owned)
                    holder = nearest[link[holder]] if link[holder] >= 0 else -1
    for s in owners:
        items.update(automaton.owners[s])
    return at, longest, spans, items


def _merged(spans: list[list[int]], offsets: list[tuple[int, int]] | None, earlier: list[dict]) -> list[dict]:
    """Spans of this pass with their characters, united with those of earlier passes."""
    own = [dict(start=a, stop=b, first=offsets[a][0], last=offsets[b - 1][1]) for a, b in spans]
    out: list[dict] = []
    for s in sorted([*earlier, *own], key=lambda s: (s["start"], s["stop"])):
        if out and s["start"] <= out[-1]["stop"]:
            if s["stop"] > out[-1]["stop"]:
                out[-1] = {**out[-1], "stop": s["stop"], "last": s["last"]}
        else:
            out.append(s)
    return out


def _pass(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held(shared.value, pickle.loads)
        words = Words(WORD)
        for batch in text_batches(batches):
            columns: tuple[list, ...] = ([], [], [], [])
            earlier = zip(batch.column("_longest").to_pylist(), batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())
            for text, (longest, spans, items) in zip(batch.column("_text"), earlier):
                lowered = ascii_lower(text.as_py() or "")
                count, length, hits, owners = stream(automaton, words.lists(lowered))
                if hits:
                    spans = _merged(hits, list(words.spans(lowered)), spans)
                    items = sorted({*items, *owners})
                for column, value in zip(columns, (count, max(longest, length), spans, items)):
                    column.append(value)
            rest = batch.drop_columns(FOUND.names)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, *(pa.array(c, f.type) for c, f in zip(columns, FOUND))], names=[*rest.schema.names, *FOUND.names]
            )

    return run


def _pieces(piece: int, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(WORD)
        for batch in text_batches(batches):
            out: tuple[list, list, list] = ([], [], [])
            for item, text in zip(batch.column("_item").to_pylist(), batch.column("_text")):
                found = [w for part in words.lists(ascii_lower(text.as_py() or "")) for w in part]
                for at in range(0, max(1, len(found) - window + 1), piece):
                    cut = found[at : at + piece + window - 1]
                    for column, value in zip(out, (item, " ".join(cut), len(cut))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                names=["item", "words", "size"],
            )

    return run


def _build(window: int):
    def run(rows: pa.Table) -> pa.Table:
        items = [(i, w.split(" ")) for i, w in sorted(zip(rows.column("item").to_pylist(), rows.column("words").to_pylist()), key=str)]
        blob = pickle.dumps(build(items, window), protocol=5)
        return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "automaton": pa.array([blob], pa.binary())})

    return run


def automata(benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """(shard, automaton): the written automata of the benchmark's shards; none if no item has a word."""
    ship_package(benchmark.sparkSession)
    read = benchmark.select(F.col("`item_id`").cast("string").alias("_item"), F.col("`text`").alias("_text"))
    cut = read.mapInArrow(_pieces(piece, window), "item string, words string, size long").where("size > 0")
    pieces = materialize_small(cut, "benchmark_pieces")
    total = pieces.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int"))
    return materialize_small(dealt.groupBy("shard").applyInArrow(_build(window), "shard int, automaton binary"), "automata")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """The rows of ``docs`` with ``_words``, ``_longest``, ``_spans`` (words start to stop, characters first to last) and ``_items``.

    Besides the columns of ``docs``, renamed to ``_0``, ``_1``, ..., there is the text as ``_text``.
    """
    spark = docs.sparkSession
    built = automata(benchmark, window, shard, piece)
    shards = sorted(r["shard"] for r in built.select("shard").collect())
    empty = [
        F.lit(0).cast("long").alias("_words"), F.lit(0).cast("long").alias("_longest"),
        F.array().cast(f"array<{SPAN}>").alias("_spans"), F.array().cast("array<string>").alias("_items"),
    ]
    frame = docs.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(docs.columns)], F.col("`text`").alias("_text"), *empty)
    blank = pickle.dumps(build([], window), protocol=5)
    for n, number in enumerate(shards or [None]):
        blob = blank if number is None else bytes(built.where(F.col("shard") == number).first()["automaton"])
        shared = spark.sparkContext.broadcast(blob)  # of at most about ``shard`` words
        frame = frame.mapInArrow(_pass(shared), frame.schema)
        if n + 1 < len(shards):
            frame = written(frame, "decontamination")
    return frame


def _hit_words() -> Column:
    return F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, longest match in words, spans and items (ids as sorted strings)."""
    found = matches(docs.select("`doc_id`", "`text`"), benchmark, window, shard, piece)
    return found.select(
        F.col("_0").alias("doc_id"), F.col("_words").alias("n_words"), _hit_words().alias("n_hit"),
        F.col("_longest").alias("longest"), F.col("_spans").alias("spans"), F.col("_items").alias("items"),
    )


def cleaned(
    docs: DataFrame, benchmark: DataFrame, span_limit: int = SPAN_LIMIT, coverage_limit: float = COVERAGE_LIMIT,
    window: int = WINDOW, shard: int = SHARD, piece: int = PIECE,
) -> DataFrame:
    """``docs`` with the spans taken out of ``text`` that are longer than ``span_limit`` words, or all of them where
    they cover more than ``coverage_limit`` of the words. A null text stays null."""
    found = matches(docs, benchmark, window, shard, piece)
    covered = _hit_words() > coverage_limit * F.col("_words")
    gone = F.filter("_spans", lambda s: covered | (s["stop"] - s["start"] > span_limit))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_gone", lambda s: s["last"]))
    starts = F.concat(F.transform("_gone", lambda s: s["first"]), F.array(F.char_length("_text").cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(F.col("_text"), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.size("_gone") == 0, F.col("_text")).otherwise(F.array_join(kept, ""))
    names = [text.alias(c) if c == "text" else F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)]
    return found.withColumn("_gone", gone).select(*names)


def statement(window: int = WINDOW) -> str:
    """DuckDB statement of the digest columns over ``documents`` and ``benchmark``, by a join of all windows."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lowered}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents
), items AS (
  SELECT item_id, w, least(len(w), {window}) AS size FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM items)
), places AS (
  SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS s
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT r, k, size, item_id FROM places JOIN windows USING (size, s)
), hits AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT r, k, size FROM found))
  GROUP BY r
), owners AS (
  SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found WHERE item_id IS NOT NULL GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN owners USING (r)
"""
