"""Counts of byte-pair tokens as a deterministic finite-state transducer.

The tokenizer reads a text through two machines:

1. A splitter over characters cuts words. It reads one character (or, inside a
   possible contraction, a few) ahead, so it is a finite transducer with delay.
2. Inside a word, merging byte pairs is a regular relation. For every prefix of a
   word, the last token of its encoding is fixed: it is the token t ending there that
   re-encodes to itself after the last token before it. A state is what
   future bytes can depend on: the longest suffix that begins a token, with the last token and
   the relative count at each place inside it. States are made when first reached. Each transition is
   annotated with the number of tokens by which the count of the prefix grows (which
   may be negative, when a longer token replaces several), so a word's count is the sum
   along its path.

A run of text is a map from the state before it to (state after it, tokens). Maps of
chunks compose associatively. White space resets the machine, so a chunk's map is
constant behind its first white space: `Chunk` keeps the part before it (the head), the count
between, and the part after its last white space (the tail).
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass

import regex

#: The pattern that cuts words, as the vocabulary file states it, and Unicode white space.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
NOT_WHITE_HERE = re.compile("[\x1c-\x1f]")  # white space for str.split, but not for the tokenizer
#: Letters lowered one by one (no rule for a final sigma), and pairs newer than Python's tables.
LOWER = {"\u03a3": "\u03c3", "\ua7cb": "\u0264", "\ua7dc": "\u019b"}
END = "</w>"


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordMachine:
    """Transducer over the bytes of one word; symbols 256 + b are bytes that end it."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], limit: int = 160_000):
        letters = byte_letters()

        def symbols(token: str) -> tuple[int, ...]:
            ends = token.endswith(END)
            out = [letters[c] for c in (token[: -len(END)] if ends else token)]
            if ends:
                out[-1] += 256
            return tuple(out)

        self.rank = {(symbols(a), symbols(b)): i for i, (a, b) in enumerate(merges)}
        tokens = {symbols(t) for t in vocab if all(c in letters for c in t.removesuffix(END)) and t != END}
        # token -> the same token, so that all states share one object
        self.tokens = {t: t for t in tokens if len(t) == 1 or self._merged(t) == [t]}
        self.starts = {t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.pairs: dict[tuple, bool] = {}
        # state: (suffix, lasts, counts): for the word's prefix ending j symbols into the suffix, lasts[j] is its
        # last token and counts[j] its number of tokens less that of the whole prefix
        self.states: list[tuple] = [((), (None,), (0,))]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def _merged(self, word: tuple[int, ...]) -> list[tuple[int, ...]]:
        """Encoding by merging the pair of least rank first."""
        parts = [(s,) for s in word]
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[at], parts[at + 1]) not in self.rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, left: tuple | None, right: tuple) -> bool:
        """Does `right` stay a token of its own after `left`?"""
        if left is None:
            return True
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.pairs[key] = self._merged(left + right) == [left, right]
        return known

    def _compile(self, key: int) -> tuple[int, int]:
        """Transition of state key >> 9 under symbol key & 511: (state, tokens added)."""
        suffix, lasts, counts = self.states[key >> 9]
        grown = (*suffix, key & 511)
        for start in range(len(grown)):  # the longest token that may follow what is before it
            token = self.tokens.get(grown[start:])
            if token is not None and self._follows(lasts[start], token):
                break
        else:
            raise ValueError(f"symbol {key & 511} is no token")
        added = counts[start] + 1
        cut = next((n for n in range(len(grown)) if grown[n:] in self.starts), len(grown))
        after = (grown[cut:], (*lasts, token)[cut:], tuple(c - added for c in counts[cut:]) + (0,))
        if after not in self.number:
            self.number[after] = len(self.states)
            self.states.append(after)
        step = self.steps[key] = (self.number[after], added)
        return step

    def count(self, word: bytes) -> int:
        """Tokens of a word."""
        if len(self.states) > self.limit:  # compiled anew from here on: bounds memory, not results
            self._clear()
        state, total, steps = 0, 0, self.steps
        last = len(word) - 1
        for i, b in enumerate(word):
            key = state << 9 | (b if i < last else b + 256)
            state, added = steps.get(key) or self._compile(key)
            total += added
        return total


class Fragments(dict):
    """Tokens of a stretch without white space, each counted once; emptied when `limit` is reached."""

    def __init__(self, machine: WordMachine, limit: int = 250_000):
        super().__init__()
        self.machine, self.limit = machine, limit

    def __missing__(self, text: str) -> int:
        n = sum(self.machine.count(w.encode("utf-8", "replace")) for w in WORDS.findall(text))
        if len(text) < 64:
            if len(self) >= self.limit:
                self.clear()
            self[text] = n
        return n


@dataclass(frozen=True)
class Chunk:
    """State map of a stretch of text. Not `closed`: no white space, all of it is the head."""

    head: str
    closed: bool
    count: int = 0
    tail: str = ""

    @staticmethod
    def of(text: str, fragments: Fragments) -> Chunk:
        parts = WHITE.split(text) if NOT_WHITE_HERE.search(text) else None
        if parts is None:
            parts = text.split()
            if text[:1].isspace():
                parts.insert(0, "")
            if text[-1:].isspace():
                parts.append("")
            if not text:
                parts = [""]
            elif not any(parts):
                parts = ["", ""]
        if len(parts) < 2:
            return Chunk(parts[0], False)
        return Chunk(parts[0], True, sum(map(fragments.__getitem__, parts[1:-1])), parts[-1])

    def then(self, other: Chunk, fragments: Fragments) -> Chunk:
        """The map of this stretch followed by another."""
        if not self.closed:
            return Chunk(self.head + other.head, other.closed, other.count, other.tail)
        if not other.closed:
            return Chunk(self.head, True, self.count, self.tail + other.head)
        met = self.count + fragments[self.tail + other.head] + other.count
        return Chunk(self.head, True, met, other.tail)

    def total(self, fragments: Fragments) -> int:
        """Tokens when the text begins before this chunk and ends behind it."""
        return fragments[self.head] + (self.count + fragments[self.tail] if self.closed else 0)


def composed(maps: list[Chunk], fragments: Fragments) -> Chunk:
    """All maps in order, composed in rounds of neighbours as a parallel scan does."""
    while len(maps) > 1:
        odd = maps[-1:] if len(maps) % 2 else []
        maps = [a.then(b, fragments) for a, b in zip(maps[::2], maps[1::2])] + odd
    return maps[0]


class TokenCounter:
    """Counts of whole texts for a vocabulary file of lower-case, byte-level word merges."""

    def __init__(self, path: str, chunk: int = 1 << 16):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in file["model"]["merges"]]
        special = sorted((t["content"] for t in file["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words = {k: v for k, v in file["model"]["vocab"].items() if k not in special}
        self.fragments = Fragments(WordMachine(self.words, merges))
        self.chunk = chunk

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.special.split(text) if self.special else [text]
        return len(pieces) - 1 + sum(self._plain(p) for p in pieces)

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        if not text.isascii():
            for upper, lower in LOWER.items():
                text = text.replace(upper, lower)
        text = text.lower()
        cuts = range(0, len(text), self.chunk)
        maps = [Chunk.of(text[at:at + self.chunk], self.fragments) for at in cuts]
        return composed(maps, self.fragments).total(self.fragments) if maps else 0
