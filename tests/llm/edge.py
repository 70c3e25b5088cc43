"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, bucket int, _id string, node long, "
    "n_bytes string, kept string, copy int, rate double, data binary, _text string"
)


def sentence(rng: random.Random, words: int, vocabulary: str = "ab") -> str:
    return " ".join("".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 7))) for _ in range(words))


def texts() -> list[str | None]:
    rng = random.Random(5)
    base = [sentence(rng, n, "abcdefghij") for n in (3, 5, 30, 60, 120, 400)]
    near = []
    for text in base:
        words = text.split()
        for _ in range(3):
            at = rng.randrange(len(words))
            near.append(" ".join(words[:at] + ["changed"] + words[at + 1 :]))
    passage = sentence(rng, 20, "klmnop")
    shared = [f"{sentence(rng, 40, 'qrstu')} {passage} {sentence(rng, 30, 'vwxyz')}" for _ in range(4)]
    odd = [
        None, "", " ", "\n\t\r\x0b\x0c", "one", "One two three four", "a b c d e", "A B c D e", "!!! ??? 123", "ééé ßß Straße",
        "<|endoftext|> it's <|startoftext|>I'll", "x́  wide space", "日本語 テキスト", "same line\nsame line\nother",
        "long " * 30_000, "-" * 3000,
    ]
    return [*odd, *base, *near, *shared, *base[2:4]]


def documents(spark, repeat: bool = False, null_id: bool = False):
    """One row per text; optionally repeated rows and ids, and rows without an id."""
    rows = [
        (7 * i + 1, t, ("en", "de", None)[i % 3], ("big", "big", "small", None)[i % 4], len(t or ""), i, "x", -i, "y", None, 1, 0.5, b"z", "w")
        for i, t in enumerate(texts())
    ]
    if repeat:
        rows += rows[:8] + rows[20:23]
        rows += [(rows[17][0], "another text under the same id " * 6, *rows[17][2:])]
    if null_id:
        rows += [(None, t, *rows[0][2:]) for t in (None, "text without an id " * 9, texts()[20])]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
