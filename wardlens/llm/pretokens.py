"""Splitting texts into a tokenizer's pre-tokens, quickly where that is proven to equal the library's own split.

The library's normaliser and splitter are asked, once on the driver, how they treat every character of a small
alphabet. Texts over the characters that behave regularly are split by a pattern built from the answers; all other
texts go through the library. Either way the pre-tokens are the library's, and merging one is context-free.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already uses every core

from tokenizers import Regex, Tokenizer, pre_tokenizers  # noqa: E402

#: Characters put to the test: Latin with its supplements, and general punctuation.
CANDIDATES = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC)]
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
CONTRACTED = "'(?:s|t|re|ve|m|ll|d)"  # the same strings, tried once per apostrophe
PART = 1 << 20  # characters of a text that are split at once


@dataclass(frozen=True)
class Rules:
    """A tokenizer file and the proven classes of its regular characters."""

    config: str
    lower: bool
    letters: str
    digits: str
    spaces: str
    others: str


def _classes(split, normalised, lower: bool) -> dict[str, str]:
    """Regular characters by class: the library must treat the character alike at the start, middle and end."""
    found: dict[str, list[str]] = {"letters": [], "digits": [], "spaces": [], "others": []}
    for c in CANDIDATES:
        if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c or c == "'":
            continue
        plain = c.lower() if lower else c
        if len(plain) != 1 or plain not in CANDIDATES:
            continue
        space = normalised(f"x{c}x") == "x x" if lower else c.isspace() and split(f"x{c}x") != [f"x{c}x"]
        if not space and lower and (normalised(f"x{c}x") != f"x{plain}x" or normalised(c) != plain):
            continue
        kept = [p.strip(" ") if not lower else p for p in split(normalised(f"x{c}x 1{c}1 !{c}!"))]
        if space:
            if lower and split(normalised(f"x{c}x")) == ["x", "x"] or not lower and c in " \t\n\r\x0b\x0c":
                found["spaces"].append(c)
        elif kept[0] == f"x{plain}x":
            found["letters"].append(c)
        elif f"!{plain}!" in kept:
            found["others"].append(c)
        elif f"1{plain}1" in kept or lower and kept[:3] == ["x", plain, "x"]:
            found["digits"].append(c)
    return {k: "".join(v) for k, v in found.items()}


class Splitter:
    """Pre-tokens of whole texts, with the strings of special tokens set apart as the library does."""

    def __init__(self, config: str):
        parsed = json.loads(config)
        self.whole = Tokenizer.from_str(config)
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        for t in parsed["added_tokens"]:
            if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("only plain special tokens are supported")
        self.lower = parsed["normalizer"] is not None
        steps = parsed["pre_tokenizer"]
        if steps["type"] == "Sequence":
            pattern = steps["pretokenizers"][0]["pattern"]["Regex"]
            self.outer = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        else:
            self.outer = pre_tokenizers.Split(
                Regex(CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"), "removed", invert=True
            )
        # The model on one pre-token: no normaliser, no splitting, no special tokens.
        parsed["normalizer"] = None
        parsed["added_tokens"] = []
        parsed["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.piece = Tokenizer.from_str(json.dumps(parsed))

    def normalised(self, text: str) -> str:
        return self.whole.normalizer.normalize_str(text) if self.lower else text

    def library_split(self, text: str) -> list[str]:
        return [p for p, _ in self.outer.pre_tokenize_str(text)]


def prove_rules(config: str) -> Rules:
    """Ask the library about every candidate character; only done on the driver."""
    s = Splitter(config)
    return Rules(config, s.lower, **_classes(s.library_split, s.normalised, s.lower))


class PreTokens(Splitter):
    """``of(text)`` gives runs of pre-tokens; an int between them is the id of a special token."""

    def __init__(self, rules: Rules):
        super().__init__(rules.config)
        regular = re.escape(rules.letters + rules.digits + rules.spaces + rules.others)
        self.irregular = re.compile(f"[^'{regular}]")
        self.find = re.compile(self._pattern(rules, 0x110000)).findall
        self.find_ascii = re.compile(self._pattern(rules, 128)).findall  # smaller classes are matched faster
        names = "|".join(re.escape(x) for x in self.specials)
        self.special = re.compile(f"({names})") if names else None

    @staticmethod
    def _pattern(rules: Rules, limit: int) -> str:
        def chars(found: str) -> str:
            plain = found.lower() if rules.lower else found
            return re.escape("".join(dict.fromkeys(c for c in plain if ord(c) < limit)))

        letters, digits, spaces, others = (
            chars(x) for x in (rules.letters, rules.digits, rules.spaces, rules.others)
        )
        if rules.lower:
            return f"{CONTRACTED}|[{letters}]+|[{digits}]|['{others}]+"
        return (
            f"{CONTRACTED}| ?[{letters}]+| ?[{digits}]+| ?['{others}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
        )

    def _run(self, text: str) -> list[str]:
        ascii_only = text.isascii() and self.ascii_regular
        if ascii_only or not self.irregular.search(text):
            return (self.find_ascii if ascii_only else self.find)(text.lower() if self.lower else text)
        return self.library_split(self.normalised(text))

    @property
    def ascii_regular(self) -> bool:
        known = self.__dict__.get("_ascii")
        if known is None:
            known = self.__dict__["_ascii"] = not self.irregular.search("".join(map(chr, range(128))))
        return known

    def of(self, text: str) -> Iterator[list[str] | int]:
        parts = self.special.split(text) if self.special else [text]
        for n, part in enumerate(parts):
            if n % 2:
                yield self.specials[part]
            else:
                for run in _shorter(part):
                    if run:
                        yield self._run(run)


_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _shorter(text: str) -> Iterator[str]:
    """Parts of a long text, cut before a space between two ASCII letters, where every pre-token ends."""
    at = 0
    while len(text) - at > PART:
        cut = _BETWEEN_WORDS.search(text, at + PART)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def merged(piece: Tokenizer, pieces: Iterable[str]) -> list[list[int]]:
    """Ids of pre-tokens, by the library's merges."""
    return [e.ids for e in piece.encode_batch_fast(list(pieces), add_special_tokens=False)]
