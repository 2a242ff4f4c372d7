"""Noisy-channel reading of disguised words: lattices, a character language model, Viterbi.

A disguised token is a lattice: each character stands for itself, for letters it may replace
(leetspeak), for nothing (separators between letters), and a run of equal characters for one or two of them
(repetition). A path costs what the channel charges for its arcs plus what a trigram model over
characters charges for the letters read. The cheapest paths are found by dynamic programming over (place, last two
letters), keeping the `readings` cheapest per cell. Letters of any script count as letters; those that look like
Latin ones may also stand for them.
"""

from __future__ import annotations

import itertools
import re
import unicodedata

import numpy as np

#: Letters that digits and signs stand in for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
}
SEPARATORS = " .-_*~,'`​­/\t\n\r"
#: Cyrillic and Greek letters, and the Latin ones they look like.
ALIKE = dict(zip("авгеікмнорстухѕјԁһӏαβεηικνορτυχωγ", "abreikmhopctyxsjdhlabenikvoptuxwy"))
#: Costs of the channel, in natural logarithms.
SWAP, DROP, SQUEEZE, KEEP_SIGN = 1.5, 0.7, 0.5, 6.0

# Alphabet of the model: 0 is all that is no letter, 1-26 a-z, then the letters from sharp s to y with diaeresis; the letters
# of other scripts share what is left.
FIRST_LATIN, SIZE = 0xDF, 64
OTHERS = 27 + 0x100 - FIRST_LATIN
POINTS = np.arange(1 << 16)
CLASS = np.where([chr(c).isalpha() for c in POINTS], OTHERS + POINTS % (SIZE - OTHERS), 0)
CLASS[:FIRST_LATIN] = 0
CLASS[97:123] = np.arange(1, 27)
CLASS[FIRST_LATIN:0x100] = np.arange(27, OTHERS)
CLASS[0xF7] = 0

LETTER, LATIN = r"[^\W\d_]", "a-zß-öø-ÿ"
SIGN = "[0-9@$!|+(€£¡*#]"
BETWEEN = f"[{re.escape(SEPARATORS)}]"
#: A token is read as a lattice if a letter and a sign touch, separators stand between letters, or a letter is repeated.
SUSPECT = re.compile(rf"{LETTER}{SIGN}|{SIGN}{LETTER}|{LETTER}{BETWEEN}+{LETTER}|({LETTER})\1|[\u200b\u00ad]")
#: Look-alikes beside Latin letters, or nothing but look-alikes.
MIXED = re.compile(rf"[{LATIN}].*[{''.join(ALIKE)}]|[{''.join(ALIKE)}].*[{LATIN}]|^[{''.join(ALIKE)}]+$", re.S)
#: Single characters with white space or marks between them.
SPACED = re.compile(rf"(?<!\S)(?:{LETTER}|{SIGN})(?:[\s.\-_*~]{{1,3}}(?:{LETTER}|{SIGN}){{1,2}}){{2,}}(?!\S)")
DOUBLED = re.compile(r"(.)\1")
RUNS = re.compile(r"(.)\1+")


def lowered(text: str) -> str:
    """Compatibility forms (full-width letters and such) as plain ones, in lower case."""
    return (text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)).lower()


def classes(text: str) -> np.ndarray:
    """Alphabet numbers of a lowered text; characters beyond the base plane count as no letter."""
    return CLASS[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")]


def trigram_counts(text: str) -> np.ndarray:
    """Counts of all trigrams, the text set in non-letters."""
    c = np.concatenate([[0, 0], classes(text), [0]])
    return np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)


class CharModel:
    """-log probability of a letter after two others, interpolated over orders."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        two, one = three.sum(0), three.sum((0, 1))
        unigram = (one + 0.5) / (one + 0.5).sum()
        bigram = (two + 2 * unigram) / (two.sum(1, keepdims=True) + 2)
        trigram = (three + 4 * bigram[None]) / (three.sum(2, keepdims=True) + 4)
        self.cost = (-np.log(trigram)).tolist()


def arcs(token: str) -> list[list[tuple[str, int, float]]]:
    """Per place: (letters read, next place, channel cost)."""
    out, n = [], len(token)
    for i, c in enumerate(token):
        end = i + 1
        while end < n and token[end] == c:
            end += 1
        letters = c if CLASS[min(ord(c), 0xFFFF)] else ""
        here: list[tuple[str, int, float]] = []
        if letters:
            here.append((c, i + 1, 0.0))
            if c in ALIKE:
                here.append((ALIKE[c], i + 1, SWAP))
            if end - i >= 2 and (i == 0 or token[i - 1] != c):  # a run, read once or twice
                here.append((c, end, SQUEEZE))
                if end - i > 2:
                    here.append((c + c, end, SQUEEZE))
        else:
            for x in LEET.get(c, ""):
                here.append((x, i + 1, SWAP))
                if end - i >= 2 and (i == 0 or token[i - 1] != c):
                    here.append((x, end, SWAP + SQUEEZE))
            if c in SEPARATORS or c in "!|+(*#":
                here.append(("", i + 1, DROP))
            here.append((" ", i + 1, KEEP_SIGN))
        out.append(here)
    return out


def squeezed(token: str, most: int) -> list[str] | None:
    """All readings of a token of letters without look-alikes, if they are no more than `most`: no model is needed to choose then."""
    runs, n = list(RUNS.finditer(token)), 1
    for m in runs:
        n *= 2 if m.end() - m.start() == 2 else 3
        if n > most:
            return None
    parts, at = [], 0
    for m in runs:
        c = m[1]
        parts += [(token[at:m.start()],), tuple(dict.fromkeys((m[0], c + c, c)))]
        at = m.end()
    return ["".join(p) for p in itertools.product(*parts, (token[at:],))]


def decode(token: str, model: CharModel, readings: int = 4) -> list[str]:
    """The cheapest different readings of a token, best first; signs that stay signs split it."""
    cost, n = model.cost, len(token)
    cells: list[dict[tuple[int, int], list[tuple[float, str]]]] = [{} for _ in range(n + 1)]
    cells[0][(0, 0)] = [(0.0, "")]
    for i, here in enumerate(arcs(token)):
        for (a, b), paths in cells[i].items():
            for letters, to, charge in here:
                x, y, more = a, b, charge
                for c in letters:
                    z = int(CLASS[ord(c)])
                    more += cost[x][y][z]
                    x, y = y, z
                cell = cells[to].setdefault((x, y), [])
                cell += [(p + more, said + letters) for p, said in paths]
        for cell in cells[i + 1].values():
            if len(cell) > readings:
                cell.sort()
                del cell[readings:]
    ends = [(p + cost[a][b][0], said) for (a, b), paths in cells[n].items() for p, said in paths]
    out: list[str] = []
    for _, said in sorted(ends):
        if said not in out:
            out.append(said)
        if len(out) == readings:
            break
    return out
