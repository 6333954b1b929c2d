"""Words of byte-pair tokenizers, and a bounded memo from words to ids in front of the library.

Byte-pair merges never cross a word of the tokenizer's own pattern, so a text's ids are its words' ids in a row.
Texts are cut into words here when all their characters are ones whose Unicode class has never changed; any other
text goes to the library whole. The memo only saves time: a word that is not in it is resolved anew.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
from tokenizers import Tokenizer

LATIN = [chr(i) for i in range(0x250)]
LETTER = "".join(re.escape(c) for c in LATIN if unicodedata.category(c)[0] == "L")
NUMBER = "".join(re.escape(c) for c in LATIN if unicodedata.category(c)[0] == "N")
SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
#: Anything but Latin and general punctuation, and the controls that Python alone takes for white space.
UNUSUAL = re.compile(r"[^\x00-\x1b\x20-ɏ‐-‧‰-⁒]")
# The word patterns of the two public tokenizers, with the classes above.
SPACED_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
                         f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
BARE_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
JOINED_SPACE = re.compile(f" (?:[{SPACE}]|\\Z)")
#: Marks a stretch that no blank precedes; UNUSUAL keeps this control from standing in such a text.
HEAD = "\x1c"
BOUNDARY = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")

#: Byte-level tokenizers write the bytes that do not print as the characters from 256 on, in order.
PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in PRINTS} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(PRINTS))}

MEMO_WORDS = 400_000
LONG = 1 << 18


def split_long(text: str, size: int = LONG) -> Iterator[str]:
    """Cut a long text before single blanks between ASCII letters, where no word of either tokenizer spans.

    A stretch without such a place stays whole.
    """
    start = 0
    while len(text) - start > size and (cut := BOUNDARY.search(text, start + size)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Subwords:
    """Ids of whole texts as little-endian unsigned 32-bit integers, equal to the library's."""

    def __init__(self, path: str, resolve: Callable[[list[str]], list[bytes]] | None = None,
                 memo_words: int = MEMO_WORDS):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.lowers = spec["normalizer"] is not None
        self.find = (BARE_WORD if self.lowers else SPACED_WORD).findall
        self.specials = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.resolve = resolve or self.by_library
        self.memo_words = memo_words
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def by_library(self, words: list[str]) -> list[bytes]:
        tokenize, pack = self.library.model.tokenize, struct.pack
        found = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(BYTE_CHARS))] for w in words]
        return [pack(f"<{len(ids)}I", *ids) for ids in found]

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; of null as of an empty one."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each; words that are new to the memo are resolved for all texts together."""
        plans = [[step for piece in split_long(text or "") for part in self.special.split(piece) if part
                  for step in self._plan(part)] for text in texts]
        self._learn([s for plan in plans for s in plan if not isinstance(s, bytes)])
        return [b"".join(s if isinstance(s, bytes) else b"".join(map(self.chunks.__getitem__, s)) for s in plan)
                for plan in plans]

    def _plan(self, text: str) -> list[bytes | list[str]]:
        """Ids, where they are known at once, or stretches of text to be looked up."""
        if text in self.specials:
            return [self.specials[text]]
        if UNUSUAL.search(text):
            return [np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        if self.lowers:
            return [text.lower().split()]
        if JOINED_SPACE.search(text):
            return [[w[1:] if w[0] == " " else HEAD + w for w in self.find(text)]]
        first, *rest = text.split(" ")
        return [[HEAD + first] if first else [], rest]

    def _learn(self, lists: list[list[str]]) -> None:
        missing = list(set().union(*lists).difference(self.chunks))
        if len(self.chunks) + len(missing) > 2 * self.memo_words:
            self.chunks.clear()
            missing = list(set().union(*lists))
        cut = [self.find(c if self.lowers else c[1:] if c[:1] == HEAD else " " + c) for c in missing]
        words = list(set().union(*cut).difference(self.words))
        if len(self.words) + len(words) > self.memo_words:
            self.words.clear()
            words = list(set().union(*cut))
        self.words.update(zip(words, self.resolve(words)))
        self.chunks.update((c, b"".join(map(self.words.__getitem__, w))) for c, w in zip(missing, cut))
