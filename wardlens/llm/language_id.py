"""Word-first language identification with back-off to character n-grams.

Learning: corpus counts per language of whole words and of the character n-grams (orders 1 to 4, over words with
boundary marks, which are no 1-grams) of a bounded, hash-drawn sample of labelled documents (``SAMPLE_ROWS`` per language). The
``WORDS`` most frequent words and ``GRAMS`` most frequent n-grams of each order of any language are kept, each with its
counts in all languages, so the model's size follows the number of languages (at most ``MOST_LANGUAGES``), not the corpus. Prediction: a known word adds its log frequency in each language. An
unseen word adds the mean log frequency of its 4-grams known in any language, else of its 3-, 2- or 1-grams, else
nothing. The mean over all words decides; the score is the softmax of that mean.

Cases: null texts and texts without a letter are ``und`` with score 0; so is every text when nothing could be learned.
A text with letters but without any known n-gram gets the most frequent language with score 1 / languages.
Equal scores go to the first language in order. Rows without a language are predicted, not learned from.
Repeated rows count as often as they occur. Only the text is used for a prediction; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scale import materialize_small
from wardlens.llm.exchange import text_batches
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import held, release

FOLDS = 5
SAMPLE_ROWS = 4000
WORDS = 20_000
GRAMS = 5_000
ORDERS = (4, 3, 2, 1)
SMOOTHING = 0.5
MEMO_WORDS = 200_000
MOST_LANGUAGES = 64  # beyond it training is refused: the model holds a number per kept string and language
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []


def grams_of(word: str, order: int) -> list[str]:
    marked = f"<{word}>" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, order, gram, n) of each batch; order 0 holds whole words."""
    release()
    for batch in text_batches(batches):
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text))
        out: Counter = Counter()
        for lang, words in found.items():
            for word, n in words.items():
                out[lang, 0, word] += n
                for order in ORDERS:
                    for gram in grams_of(word, order):
                        out[lang, order, gram] += n
        if out:
            langs, orders, grams = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs), pa.array(orders, pa.int32()), pa.array(grams), pa.array(out.values(), pa.int64())],
                names=["lang", "order", "gram", "n"],
            )


@dataclass(frozen=True)
class Model:
    """Languages in order, and per order (0: words) the log frequency vectors of the kept strings."""

    languages: tuple[str, ...]
    default: int
    tables: tuple[tuple[tuple[str, ...], bytes], ...]


def _log_frequencies(rows: list, languages: tuple[str, ...], totals: dict[str, int]) -> tuple[tuple[str, ...], bytes]:
    grams = sorted({r["gram"] for r in rows})
    at = {g: i for i, g in enumerate(grams)}
    counts = np.zeros((len(grams), len(languages)))
    for r in rows:
        counts[at[r["gram"]], languages.index(r["lang"])] = r["n"]
    total = np.array([totals.get(lang, 0) for lang in languages])
    return tuple(grams), np.log((counts + SMOOTHING) / (total + SMOOTHING * (len(grams) + 1))).tobytes()


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, most_languages: int = MOST_LANGUAGES) -> Model | None:
    """Learn from the rows of ``docs`` (text, lang, doc_id) that are not held out and have a language."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"), F.col("`lang`").cast("string").alias("lang")
    ).where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = tuple(sorted(sizes))
    if len(languages) > most_languages:
        raise ValueError(f"{len(languages)} languages are labelled, more than most_languages={most_languages}")
    parts = 1 << 20
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(math.ceil(parts * sample_rows / n)))])
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(parts)) < share[F.col("lang")]
    counts = materialize_small(
        rows.where(drawn).select("lang", "text")
        .mapInArrow(_count, "lang string, order int, gram string, n long")
        .groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")),
        "language_counts",
    )
    best = Window.partitionBy("lang", "order").orderBy(F.desc("n"), "gram")
    kept = F.when(F.col("order") == 0, WORDS).otherwise(GRAMS)
    frequent = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= kept).select("order", "gram").distinct()
    model_rows = counts.join(frequent, ["order", "gram"], "left_semi").collect()
    totals = counts.groupBy("lang", "order").agg(F.sum("n").alias("total")).collect()
    tables = []
    for order in (0, *ORDERS):
        own = [r for r in model_rows if r["order"] == order]
        tables.append(_log_frequencies(own, languages, {r["lang"]: r["total"] for r in totals if r["order"] == order}))
    default = languages.index(min(sizes, key=lambda lang: (-sizes[lang], lang)))
    return Model(languages, default, tuple(tables))


class Scorer:
    """Log frequency vectors of words; unseen words are backed off once and remembered, within a bound."""

    def __init__(self, model: Model):
        self.model = model
        width = len(model.languages)
        (words, values), *grams = model.tables
        self.known = {w: i + 1 for i, w in enumerate(words)}
        self.grams = [
            dict(zip(names, np.frombuffer(v).reshape(-1, width))) for names, v in grams
        ]
        table = np.frombuffer(values).reshape(-1, width)
        self.vectors = np.zeros((len(words) + 1 + MEMO_WORDS, width))  # row 0: nothing known
        self.vectors[1 : len(words) + 1] = table
        self.informs = np.zeros(len(self.vectors), bool)
        self.informs[1 : len(words) + 1] = True
        self._forget()

    def _forget(self) -> None:
        self.at, self.free = dict(self.known), len(self.known) + 1

    def _back_off(self, word: str) -> np.ndarray | None:
        for order, table in zip(ORDERS, self.grams):
            found = [table[g] for g in grams_of(word, order) if g in table]
            if found:
                return np.mean(found, axis=0)
        return None

    def _add(self, words: Iterable[str]) -> None:
        for word in words:
            vector = self._back_off(word)
            if vector is None:
                self.at[word] = 0
                continue
            self.vectors[self.free], self.informs[self.free] = vector, True
            self.at[word] = self.free
            self.free += 1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words:
            return UNDETERMINED, 0.0
        total, used = np.zeros(len(self.model.languages)), 0
        for start in range(0, len(words), MEMO_WORDS):
            part = words[start : start + MEMO_WORDS]
            unseen = dict.fromkeys(w for w in part if w not in self.at)
            if self.free + len(unseen) > len(self.vectors):
                self._forget()
                unseen = dict.fromkeys(w for w in part if w not in self.at)
            self._add(unseen)
            rows = np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))
            total += self.vectors[rows].sum(axis=0)
            used += int(self.informs[rows].sum())
        if not used:
            return self.model.languages[self.model.default], 1 / len(total)
        odds = np.exp(total / used - (total / used).max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _predict(shared, text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(shared.value, Scorer)
        for batch in text_batches(batches):
            found = [scorer.predict(t.as_py()) for t in batch.column(text)]
            langs, scores = zip(*found)
            rest = batch.drop_columns(["_text"]) if text == "_text" else batch
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*rest.schema.names, "_lang", "_score"],
            )

    return run


def predictions(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """Columns ``carry`` of ``docs`` with _lang and _score."""
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in carry], F.lit(UNDETERMINED).alias("_lang"), F.lit(0.0).alias("_score"))
    ship_package(docs.sparkSession)
    carried = [f"_c{n}" for n in range(len(carry))]
    read = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(carried, carry)])
    ddl = T.StructType(read.schema.fields[:]).add("_lang", "string").add("_score", "double")
    text = dict(zip(carry, carried)).get("text", "_text")
    if text == "_text":
        read = docs.select(
            *[F.col(f"`{c}`").alias(n) for n, c in zip(carried, carry)], F.col("`text`").alias("_text")
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = read.mapInArrow(_predict(shared, text), ddl)
    return out.select(*[F.col(n).alias(c) for n, c in zip(carried, carry)], "_lang", "_score")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, learned from the labelled rows of ``docs``."""
    out = predictions(docs, train(docs), ["doc_id"])
    return out.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
    )


def with_known_language(docs: DataFrame) -> DataFrame:
    """The documents with a letter, in their own columns; a null ``lang`` is filled with the predicted language.

    Every text with a letter has a best language and stays, also one in a script that no label teaches. Without a labelled row to learn from no verdict is possible: a table with letters then raises an error.
    """
    model = train(docs)
    if model is None and not docs.where(F.col("`text`").rlike(r"\p{L}")).isEmpty():
        raise ValueError("no labelled document to learn languages from")
    out = predictions(docs, model, docs.columns)
    told = F.coalesce(F.col("`lang`"), F.col("_lang").cast(docs.schema["lang"].dataType)).alias("lang")
    return out.where(F.col("_lang") != UNDETERMINED).select(*[told if c == "lang" else F.col(f"`{c}`") for c in docs.columns])
