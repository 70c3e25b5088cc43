"""Words of long texts, part by part, so that a very long text never becomes one list of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

PART = 1 << 20  # characters of a text that are split into words at once


def ascii_lower(text: str) -> str:
    """The text with A-Z lowered and nothing else changed; no character changes its place."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


class Words:
    """Maximal runs of the characters of a class, written as the inside of a regular expression's brackets."""

    def __init__(self, inside: str):
        self.run = re.compile(f"[{inside}]+")
        self.other = re.compile(f"[^{inside}]")

    def parts(self, text: str) -> Iterator[tuple[int, str]]:
        """(start, part): parts of about ``PART`` characters, cut where no word is."""
        at = 0
        while len(text) - at > PART:
            cut = self.other.search(text, at + PART)
            if cut is None:
                break
            yield at, text[at : cut.start()]
            at = cut.start()
        yield at, text[at:]

    def lists(self, text: str) -> Iterator[list[str]]:
        for _, part in self.parts(text):
            yield self.run.findall(part)

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in self.run.finditer(text))
