"""Quality scores from compression.

Two zstandard dictionaries are built from windows of good and of bad labelled texts. A text is
compressed window by window with each; it is like the texts whose dictionary makes it smaller.
The difference of the compressed sizes, divided by the size of the text, becomes a score by
logistic calibration on labelled texts that neither dictionary has seen, weighted to
the labels' true shares. The calibration also knows the compressed share itself and how short the
text is, since a short text's difference says less.

Learning uses at most `per_class` documents of each class, half of them for the dictionaries
(`windows` windows each) and half for calibration: a documented bound that does not
depend on the corpus. Scoring reads whole texts.

Defined results: NULL and empty texts have difference 0 and get the calibrated score of that; without
labels of both classes the score is the share of class 1 (0.5 without labels); repeated rows give
repeated results; an empty table gives an empty result; columns other than the id and the
text never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import class_counts, id_remainder, labelled_sample, logistic_fit

WINDOW, WINDOWS, DICTIONARY, LEVEL = 512, 3, 64_000, 1
PER_CLASS, STEADY = 4000, 100  # STEADY: bytes added to a text's size, so that short texts stay near 0


def cut(text: str, window: int = WINDOW) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i:i + window] for i in range(0, len(raw), window)]


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    beta: np.ndarray | None = None

    def compressors(self):
        made = (zstandard.ZstdCompressionDict(d) for d in (self.good, self.bad))
        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                         write_dict_id=False) for d in made]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def measures(text: str, good, bad) -> tuple[float, float, float]:
    """Of a text's size: the part by which the bad dictionary leaves more than the good one; the part the
    better one leaves (repetition leaves little); and how short the text is, from 1 down to 0."""
    more = best = size = 0
    for part in cut(text):
        g, b = len(good.compress(part)), len(bad.compress(part))
        more += b - g
        best += min(g, b)
        size += len(part)
    return more / (size + STEADY), best / (size + STEADY), STEADY / (size + STEADY)


def _dictionary(parts: list[bytes]) -> bytes:
    """Trained on the windows; few or tiny ones make a dictionary of plain content."""
    usable = [p for p in parts if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, usable, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(usable)[-DICTIONARY:] or b"\0" * 8


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for y, draw, text in zip(b["y"], b["draw"], b["text"]):
            parts = cut(text)
            some = np.random.default_rng(int(draw) & 0xFFFFFFFF).permutation(len(parts))[:WINDOWS]
            out += [(int(y), int(draw), k, parts[i]) for k, i in enumerate(some)]
        yield pd.DataFrame(out, columns=["y", "draw", "k", "part"])


def measured(texts: pd.Series, compressors) -> np.ndarray:
    return np.array([measures(t, *compressors) for t in texts.fillna("")], float).reshape(-1, 3)


def train(docs: DataFrame, labels: DataFrame, learned: Column, label: str = "quality", per_class: int = PER_CLASS):
    """A model, or the plain share of class 1 where there is nothing to learn from."""
    counts = class_counts(labels, label, learned)
    share = counts[1] / sum(counts) if sum(counts) else 0.5
    sample = labelled_sample(docs, labels, label, learned, per_class)
    for_dictionary = F.pmod(F.col("draw"), F.lit(2)) == 0
    parts = sample.filter(for_dictionary).select("y", "draw", "text").mapInPandas(
        _windows, "y int, draw long, k int, part binary").toPandas().sort_values(["y", "draw", "k", "part"])
    by_class = [parts.loc[parts["y"] == y, "part"].tolist() for y in (0, 1)]
    if not all(by_class):
        return share
    model = CompressionModel(_dictionary(by_class[1]), _dictionary(by_class[0]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = model.compressors()
        for b in batches:
            yield pd.DataFrame(measured(b["text"], compressors), columns=["a", "b", "c"]).assign(y=b["y"].to_numpy(float))

    seen = sample.filter(~for_dictionary).select("y", "text").mapInPandas(
        run, "a double, b double, c double, y double").toPandas().sort_values(["y", "a", "b", "c"])
    y = seen["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return share
    # both classes are drawn alike; weights bring back their shares
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.beta = logistic_fit(seen[["a", "b", "c"]].to_numpy(), y, weight, ridge=1e-6)
    return model


def scored(model: CompressionModel | float, text: str = "text") -> Column:
    """Score of a text column, 0 to 1."""
    if not isinstance(model, CompressionModel):
        return F.lit(float(model))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors()
        for texts in batches:
            yield pd.Series(model.score(measured(texts, compressors)))

    return run(F.col(text))


def label(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; a quarter of the ids is never learned from."""
    held_out = id_remainder(4) == 2
    model = train(docs, labels, ~held_out)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), scored(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
