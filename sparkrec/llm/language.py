"""Language ID by a small convolutional network over bytes, trained and applied in numpy.

A text is read as UTF-8 bytes (A-Z lowered) in windows of fixed length that together cover
all of it. A window's bytes are embedded, filters of several widths slide over it,
each filter keeps its largest response, and a softmax layer over these gives language
probabilities. Since an embedded byte times a filter column is one of 256 values, filters are
applied as sums of table rows. A document's probabilities are the mean over its windows, weighted by
their bytes.

Training (Adam on cross-entropy, gradients only through the winning places of the pooling) runs on
the driver, on at most `per_language` documents of each language and `windows` windows of each: a
documented bound that does not depend on the size of the corpus. Everything else covers
all rows and whole texts.

Defined results: `und` with score 0 for texts that are NULL or have no letter; without any labelled row
every text is `und`; repeated rows give repeated results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import drawn, id_remainder, text_of

WINDOW, WIDTHS, FILTERS, EMBED = 128, (2, 3, 4), 16, 8
PER_LANGUAGE, WINDOWS, EPOCHS, BATCH, RATE = 1500, 4, 6, 128, 0.01
UNKNOWN, MOST_LANGUAGES = "und", 200
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = 64  # windows whose responses are computed at once: they stay in the cache


def windows_of(text: str, length: int = WINDOW) -> np.ndarray:
    """The whole text as rows of `length` bytes, the last one padded with zeros."""
    raw = text.encode("utf-8", "replace").translate(_LOWER)
    rows = max(1, -(-len(raw) // length))
    return np.frombuffer(raw.ljust(rows * length, b"\0"), np.uint8).reshape(rows, length)


@dataclass
class ByteNet:
    languages: list[str]
    embed: np.ndarray  # bytes x EMBED
    filters: list[np.ndarray]  # per offset: EMBED x all filters, zero for filters that are shorter
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str], seed: int = 0) -> ByteNet:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        width = np.repeat(WIDTHS, FILTERS)
        filters = [
            (rng.normal(0, 1, (EMBED, n)) / np.sqrt(EMBED * width) * (width > j)).astype(np.float32)
            for j in range(max(WIDTHS))
        ]
        return ByteNet(languages, rng.normal(0, 1, (256, EMBED)).astype(np.float32), filters, np.zeros(n, np.float32),
                       (rng.normal(0, 1, (n, len(languages))) / np.sqrt(n)).astype(np.float32), np.zeros(len(languages), np.float32))

    def responses(self, x: np.ndarray, places: bool = False):
        """Largest response of every filter in each window (and where it is)."""
        tables = [self.embed @ f for f in self.filters]
        pooled = np.empty((len(x), len(self.bias)), np.float32)
        at = np.empty(pooled.shape, np.int64) if places else None
        last = x.shape[1] - len(tables) + 1
        for k in range(0, len(x), BLOCK):
            part = x[k:k + BLOCK]
            total = tables[0][part[:, :last]]
            for j in range(1, len(tables)):
                used = FILTERS * sum(w <= j for w in WIDTHS)  # shorter filters have ended
                total[:, :, used:] += tables[j][:, used:][part[:, j:last + j]]
            if places:
                at[k:k + BLOCK] = total.argmax(1)
            pooled[k:k + BLOCK] = total.max(1)
        return (pooled + self.bias, at) if places else pooled + self.bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(self.responses(x), 0) @ self.out + self.out_bias)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> ByteNet:
        rng = np.random.default_rng(seed)
        weights = [self.embed, *self.filters, self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        width = np.repeat(WIDTHS, FILTERS)
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), BATCH):
                some = order[k:k + BATCH]
                grads = self._gradients(x[some], y[some], width)
                step += 1
                rate = RATE * 0.5 ** max(0, epoch - epochs // 2)
                for w, g, m, v in zip(weights, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, width: np.ndarray) -> list[np.ndarray]:
        pooled, at = self.responses(x, places=True)
        hidden = np.maximum(pooled, 0)
        error = _softmax(hidden @ self.out + self.out_bias)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        back = (error @ self.out.T) * (pooled > 0)
        embed, filters = np.zeros_like(self.embed), []
        for j, f in enumerate(self.filters):
            seen = np.take_along_axis(x, at + j, 1)  # the byte under this offset of each winning place
            flow = back * (width > j)
            filters.append(np.einsum("bfe,bf->ef", self.embed[seen], flow).astype(np.float32))
            np.add.at(embed, seen.ravel(), (flow[:, :, None] * f.T[None]).reshape(-1, EMBED))
        return [embed, *filters, back.sum(0), hidden.T @ error, error.sum(0)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def training_windows(docs: DataFrame, learned: Column, per_language: int, windows: int) -> pd.DataFrame:
    """(lang, bytes): windows of a bounded sample of labelled documents, in a fixed order."""
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    lang = F.col("lang").cast("string")
    labelled = docs.filter(learned & lang.isNotNull())
    # texts leave their partition only with about three times the chance that the sample needs
    counts = labelled.groupBy(lang.alias("lang")).count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chance = F.lit(0.0)
    for r in counts:
        chance = F.when(lang == r["lang"], min(1.0, 3 * per_language / r["count"])).otherwise(chance)
    known = labelled.filter(F.pmod(draw, F.lit(1_000_003)) < chance * 1_000_003).filter(F.col("text").rlike(r"\p{L}")).select(
        lang.alias("lang"), "text", draw.alias("draw"))
    some = drawn(known, "lang", per_language, "text")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for lang, text, draw in zip(b["lang"], b["text"], b["draw"]):
                rows = windows_of(text)
                some = np.random.default_rng(int(draw) & 0xFFFFFFFF).permutation(len(rows))[:windows]
                out += [(lang, int(draw), k, rows[i].tobytes()) for k, i in enumerate(some)]
            yield pd.DataFrame(out, columns=["lang", "draw", "k", "bytes"])

    picked = some.select("lang", "text", "draw").mapInPandas(pick, "lang string, draw long, k int, bytes binary").toPandas()
    return picked.sort_values(["lang", "draw", "k", "bytes"], ignore_index=True)


def train(docs: DataFrame, learned: Column, per_language: int = PER_LANGUAGE, windows: int = WINDOWS) -> ByteNet | None:
    """A network for the languages of the learned rows, or None if there are none."""
    seen = training_windows(docs, learned, per_language, windows)
    if not len(seen):
        return None
    languages = sorted(seen["lang"].unique())
    x = np.stack([np.frombuffer(b, np.uint8) for b in seen["bytes"]])
    return ByteNet.fresh(languages).fit(x, np.searchsorted(languages, seen["lang"]))


def classify(net: ByteNet, texts: list[str], block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(language number, probability) of each text; windows of many texts share a pass."""
    total = np.zeros((len(texts), len(net.languages)))
    held, owners, n = [], [], 0

    def flush() -> None:
        if held:
            x, owner = np.concatenate(held), np.concatenate(owners)
            weight = np.maximum((x != 0).sum(1), 1)
            np.add.at(total, owner, net.probabilities(x) * weight[:, None])

    for i, text in enumerate(texts):
        rows = windows_of(text)
        for k in range(0, len(rows), block):
            part = rows[k:k + block]
            held.append(part)
            owners.append(np.full(len(part), i))
            n += len(part)
            if n >= block:
                flush()
                held, owners, n = [], [], 0
    flush()
    mean = total / total.sum(1, keepdims=True)
    return mean.argmax(1), mean.max(1)


def predicted(net: ByteNet | None, text: str = "text") -> Column:
    """struct<lang_pred, score> of a text column."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return unknown
    languages = np.array(net.languages, object)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            which, score = classify(net, texts.fillna("").tolist())
            yield pd.DataFrame({"lang_pred": languages[which], "score": score.clip(0, 1)})

    return F.when(letters, run(F.col(text))).otherwise(unknown)


def accepted(net: ByteNet | None, least: float, text: str = "text") -> Column:
    """Does a text have a letter, and a language with at least this probability?"""
    found = predicted(net, text)
    return (found["lang_pred"] != UNKNOWN) & (found["score"] >= (0.0 if net is None else least))


def label(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; a quarter of the ids is never learned from."""
    held_out = id_remainder(4) == 2
    net = train(docs, ~held_out)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), predicted(net).alias("found"),
    ).select("doc_id", "held_out", "found.*")
