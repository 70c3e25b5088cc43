"""Token counts by a whole-token shortcut.

Proven once on the driver: the vocabulary strings that, taken as a pre-token alone, the library's merges turn into one token.
Tasks split each whole text into pre-tokens, count those in the proven set directly and merge only the rest,
remembering a bounded number of merged pre-tokens. Counting is a narrow transformation: nothing is shuffled.

Cases: null and empty texts have no token and 0 bytes; strings of special tokens inside a text count as one token each, as the
library does by default; repeated rows are counted each; very long texts are split part by part, at spaces
where every pre-token ends; other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.exchange import text_batches
from wardlens.llm.pretokens import PreTokens, Rules, Splitter, merged, prove_rules
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import held

TOKEN_LIMIT = 2048
MEMO = 400_000


@dataclass(frozen=True)
class Counting:
    rules: Rules
    whole: frozenset[str]


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable bytes for themselves, others moved up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)})
    return out


def prove_whole_tokens(config: str, word_end: str = "</w>") -> frozenset[str]:
    """Vocabulary strings that encode alone as exactly their one token, as a text and as a pre-token."""
    splitter, letters = Splitter(config), _byte_letters()
    candidates = {}
    for name, token in splitter.piece.get_vocab(with_added_tokens=False).items():
        if name.endswith(word_end) and len(name) > len(word_end):
            try:
                candidates[bytes(letters[c] for c in name[: -len(word_end)]).decode()] = token
            except (KeyError, UnicodeDecodeError):
                continue
    alone, inside = merged(splitter.whole, candidates), merged(splitter.piece, candidates)
    return frozenset(
        s for (s, token), ids, piece in zip(candidates.items(), alone, inside) if ids == piece == [token]
    )


def counting(config: str) -> Counting:
    return Counting(prove_rules(config), prove_whole_tokens(config))


class Counter:
    def __init__(self, setup: Counting):
        self.split, self.whole = PreTokens(setup.rules), setup.whole
        self.known: dict[str, int] = {}

    def _merged(self, pieces: Iterable[str]) -> dict[str, int]:
        pieces = list(pieces)
        return dict(zip(pieces, map(len, merged(self.split.piece, pieces))))

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; pre-tokens that are no whole token are merged once per batch at most."""
        totals, extra = [], {}
        for text in texts:
            total = 0
            for run in self.split.of(text or ""):
                if isinstance(run, int):
                    total += 1
                    continue
                rest = [p for p in run if p not in self.whole]
                total += len(run) - len(rest)
                new = {p for p in rest if p not in self.known and p not in extra}
                if new:
                    counts = self._merged(new)
                    if len(self.known) + len(counts) <= MEMO:
                        self.known.update(counts)
                    else:
                        extra.update(counts)
                known = self.known
                total += sum(known[p] if p in known else extra[p] for p in rest)
                if len(extra) > MEMO:
                    extra = {}
            totals.append(total)
        return totals


def _count(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held(shared.value, Counter)
        for batch in text_batches(batches):
            texts = batch.column("_text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("n_bytes"), pa.array(counter.count(texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and whether that is more than ``limit``."""
    ship_package(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        setup = counting(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(setup)
    read = docs.select(
        F.col("`doc_id`").alias("_id"), F.coalesce(F.octet_length("`text`"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("`text`").alias("_text"),
    )
    schema = docs.select("`doc_id`").schema.add("n_bytes", "long").add("n_tokens", "long")
    return read.mapInArrow(_count(shared), schema).withColumn("over_limit", F.col("n_tokens") > limit)
