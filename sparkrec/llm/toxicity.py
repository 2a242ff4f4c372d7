"""Toxicity of texts that may disguise their words.

A character trigram model is counted over all documents. Tokens with more than one path through their lattice
(signs beside letters, separators between letters, repeated letters, look-alike letters), and single letters with white space
between them, are decoded by Viterbi under that model (see `noisy`); where a token of letters has no more readings than
are kept, all of them are taken. Other tokens have a single path and stay. Words are runs of letters of any script. The restored words are scored by evidence learned
from labelled documents: for words and word beginnings, a lower confidence bound of the logarithm by which
they are likelier in toxic documents. A document's strongest words and its number of words become a score by a
logistic calibration, in which no document's evidence was learned from its own fold.

Evidence and calibration use at most `per_class` documents of each class, and the FEATURES features most frequent in toxic
documents against others: documented bounds of the classifier that do not depend on the corpus; trigrams are counted over all rows, and whole texts are scored.

Defined results: NULL and empty texts have no evidence and get the calibrated score of that; without labels of both
classes the score is the share of class 1 (0 without labels); repeated rows give repeated results; an
empty table gives an empty result; columns other than the id and the text never enter a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import class_counts, id_remainder, labelled_sample, logistic_fit, text_of
from sparkrec.llm.noisy import DOUBLED, LETTER, MIXED, SIZE, SPACED, SUSPECT, CharModel, decode, lowered, squeezed, trigram_counts
from sparkrec.session import durable

PER_CLASS = 6000
PREFIXES = (3, 4, 5, 6, 7, 8)
LEAST_DOCS, LEAST_EVIDENCE, FEATURES, FOLDS = 4, 0.5, 50_000, 3
WORDS = re.compile(f"{LETTER}+")
EDGE = re.compile(r"^[^\w@$!|+(€£¡*#]+|[^\w@$]+$")
TAIL = re.compile(r"\${2,}$")  # money or junk, or letters
READINGS = 4
CACHE, LONG = 200_000, 80  # tokens remembered; longer ones are read in parts


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all documents: at most SIZE**3 sums per task, added up by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE ** 3, np.int64)
        for b in batches:
            for text in b["text"]:
                for k in range(0, len(text), 1 << 20):
                    total += trigram_counts(lowered(text[k:k + (1 << 20)])) if len(text) > 20_000 else 0
            short = [t for t in b["text"] if len(t) <= 20_000]
            for k in range(0, len(short), 200):
                total += trigram_counts(lowered(" ".join(short[k:k + 200])))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    sums = docs.select(text_of().alias("text")).mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # bounded by the alphabet
    out = np.zeros(SIZE ** 3, np.int64)
    out[found["at"].to_numpy(np.int64)] = found["n"]
    return out


class Restorer(dict):
    """token -> words read from it; emptied when `limit` is reached."""

    def __init__(self, model: CharModel, limit: int = CACHE):
        super().__init__()
        self.model, self.limit = model, limit

    def __missing__(self, token: str) -> tuple[str, ...]:
        words = tuple(dict.fromkeys(self._read(token)))
        if len(token) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[token] = words
        return words

    def _read(self, token: str) -> list[str]:
        core = token if token.isalpha() else EDGE.sub("", token)
        if core.isalpha() and (core.isascii() or not MIXED.search(core)):
            return squeezed(core, READINGS) or [core, *self._decoded(core)] if DOUBLED.search(core) else [core]
        said = WORDS.findall(token)
        for core in dict.fromkeys((TAIL.sub("", core), core)):
            if " " not in core and not SUSPECT.search(core) and not (not core.isascii() and MIXED.search(core)):
                continue
            said += self._decoded(core)
        return said

    def _decoded(self, core: str) -> Iterator[str]:
        for k in range(0, len(core), LONG // 2):  # parts overlap by half, so no disguised word is cut
            for reading in decode(core[k:k + LONG], self.model, READINGS):
                yield from WORDS.findall(reading)
            if k + LONG >= len(core):
                break

    def words(self, text: str) -> set[str]:
        """Distinct words of a text, as they stand and as they are restored."""
        text = lowered(text)
        out = set(chain.from_iterable(map(self.__getitem__, set(text.split()))))
        for m in SPACED.finditer(text):
            out.update(self[m.group(0)])
        return out


def features(word: str) -> list[str]:
    """The whole word, and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)]


class Evidence(dict):
    """word -> its strongest feature's evidence, 0 if there is none."""

    def __init__(self, learned: dict[str, float], limit: int = CACHE):
        super().__init__()
        self.learned, self.limit = learned, limit

    def __missing__(self, word: str) -> float:
        get = self.learned.get
        best = max([0.0, *(get(f, 0.0) for f in features(word))])
        if len(self) >= self.limit:
            self.clear()
        self[word] = best
        return best


def measures(words: set[str], evidence: Evidence) -> tuple[float, float, float, float]:
    """Of a text's distinct words: the strongest evidence, the next, the sum of the six after them, and how many words there are."""
    top = sorted(filter(None, map(evidence.__getitem__, words)), reverse=True)[:8]
    top += [0.0] * (8 - len(top))
    return top[0], top[1], sum(top[2:]), math.log1p(len(words))


@dataclass
class ToxicModel:
    trigrams: np.ndarray
    learned: dict[str, float]
    beta: np.ndarray | None = None

    def reader(self):
        restorer = Restorer(CharModel(self.trigrams))
        evidence = Evidence(self.learned)
        return lambda text: measures(restorer.words(text), evidence)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = x.reshape(-1, 4) @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def count_features(sample: DataFrame, trigrams: np.ndarray) -> pd.DataFrame:
    """feature, bad0.., fine0..: documents of each class and fold with a feature.

    Counted by Spark over the sample (y, fold, text); the FEATURES that are most bad come back.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(CharModel(trigrams))
        for b in batches:
            for at in range(0, len(b), 64):  # a few documents at a time: each has many features
                part = b.iloc[at:at + 64]
                rows = [(f, int(y), int(k)) for y, k, text in zip(part["y"], part["fold"], part["text"])
                        for f in {f for w in restorer.words(text) for f in features(w)}]
                yield pd.DataFrame(rows, columns=["feature", "y", "fold"])

    sums = [F.sum(((F.col("y") == y) & (F.col("fold") == k)).cast("int")).alias(f"{name}{k}")
            for y, name in ((1, "bad"), (0, "fine")) for k in range(FOLDS)]
    seen = sample.select("y", "fold", "text").mapInPandas(each, "feature string, y int, fold int").groupBy("feature").agg(*sums)
    bad = sum((F.col(f"bad{k}") for k in range(1, FOLDS)), F.col("bad0"))
    fine = sum((F.col(f"fine{k}") for k in range(1, FOLDS)), F.col("fine0"))
    return seen.filter((bad >= LEAST_DOCS) & (bad * 2 > fine)).orderBy(F.desc(bad / (fine + 1)), "feature").limit(FEATURES).toPandas()


def evidence_of(counts: pd.DataFrame, sizes: dict[tuple[int, int], int], without: int | None = None) -> dict[str, float]:
    """feature -> two standard errors below the logarithm of the ratio of its rates in both classes, one fold left out."""
    folds = [k for k in range(FOLDS) if k != without]
    bad = sum(counts[f"bad{k}"] for k in folds).to_numpy(float) + 0.5
    fine = sum(counts[f"fine{k}"] for k in folds).to_numpy(float) + 0.5
    n_bad, n_fine = (sum(sizes.get((y, k), 0) for k in folds) + 1 for y in (1, 0))
    bound = np.log(bad / n_bad) - np.log(fine / n_fine) - 2 * np.sqrt(1 / bad + 1 / fine)
    return {f: float(e) for f, e in zip(counts["feature"], bound) if e >= LEAST_EVIDENCE}


def train(docs: DataFrame, labels: DataFrame, learned: Column, label: str = "toxic", per_class: int = PER_CLASS):
    """A model, or the plain share of class 1 where there is nothing to learn from."""
    counts = class_counts(labels, label, learned)
    share = counts[1] / sum(counts) if sum(counts) else 0.0
    if min(counts) == 0:
        return share
    sample = durable(labelled_sample(docs, labels, label, learned, per_class).withColumn(
        "fold", F.pmod(F.col("draw"), F.lit(FOLDS)).cast("int")))
    sizes = {(r["y"], r["fold"]): r["count"] for r in sample.groupBy("y", "fold").count().collect()}
    if len({y for y, _ in sizes}) < 2:
        return share
    trigrams = corpus_trigrams(docs)
    counts = count_features(sample, trigrams)
    apart = [evidence_of(counts, sizes, k) for k in range(FOLDS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, evidence = Restorer(CharModel(trigrams)), [Evidence(e) for e in apart]
        for b in batches:
            rows = [(float(y), *measures(restorer.words(t), evidence[k])) for y, k, t in zip(b["y"], b["fold"], b["text"])]
            yield pd.DataFrame(rows, columns=["y", "a", "b", "c", "d"])

    seen = sample.select("y", "fold", "text").mapInPandas(
        run, "y double, a double, b double, c double, d double").toPandas().sort_values(["y", "a", "b", "c", "d"])
    y = seen["y"].to_numpy()
    # both classes are drawn alike; weights bring back their shares
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = logistic_fit(seen[["a", "b", "c", "d"]].to_numpy(), y, weight, ridge=1e-5)
    return ToxicModel(trigrams, evidence_of(counts, sizes), beta)


def scored(model: ToxicModel | float, text: str = "text") -> Column:
    """Score of a text column, 0 to 1."""
    if not isinstance(model, ToxicModel):
        return F.lit(float(model))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = model.reader()
        for texts in batches:
            yield pd.Series(model.score(np.array([read(t) for t in texts.fillna("")], float)))

    return run(F.col(text))


def label(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; a fifth of the ids is never learned from."""
    held_out = id_remainder(5) == 0
    model = train(docs, labels, ~held_out)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), scored(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
