"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from sparkrec.session import durable

# The white space of the contracts, [\x20\x09-\x0D], as a character class and as single characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The column, NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def identified(docs: DataFrame, stored: bool) -> DataFrame:
    """(doc, rid): whole rows, and a row's file and place in it, the same for every reader.

    `stored` says that `docs` are files just as they were read; other rows are stored first.
    """
    source = docs if stored else durable(docs)
    where = source.metadataColumn("_metadata")
    rid = F.struct(where["file_path"].alias("file"), where["row_index"].alias("row"))
    return source.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), rid.alias("rid"))


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `divisor`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters that are not white space.

    Counts the places where a word starts: a space is put in front, every white
    space becomes a space, so a word starts after each space that a non-space follows.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the keys of `left` are kept."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, same, how).drop(*[f"__{k}" for k in keys])


def drawn(df: DataFrame, key: str, limit: int, *order: Column | str) -> DataFrame:
    """About `limit` rows per key (never more), the first by `draw` and `order`.

    A key is split into parts by `draw`, each limited on its own: Spark then trims every
    map task to a part's limit before the shuffle, which it only does for small limits, and a hot key meets in
    several tasks of that size.
    """
    parts = -(-limit // 500)
    part = F.pmod(F.shiftright("draw", 7), F.lit(parts))
    rank = F.row_number().over(W.partitionBy(key, "__part").orderBy("draw", *order))
    return (
        df.withColumn("__part", part).withColumn("__rank", rank)
        .filter(F.col("__rank") <= limit // parts).drop("__part", "__rank")
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learned: Column, per_class: int) -> DataFrame:
    """(doc_id, text, y, draw): at most `per_class` documents of each class, drawn by hash of the id.

    The ids are drawn from the labels first, so what is sent to every executor has at most
    2 * per_class rows, and only drawn documents leave their partition. The documents
    are limited once more, for ids that occur often.
    """
    known = labels.filter(learned & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("y")).withColumn("draw", F.xxhash64("doc_id"))
    ids = drawn(known, "y", per_class, "doc_id")
    found = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")
    return drawn(found, "y", per_class, "doc_id", F.xxhash64("text"))


def class_counts(labels: DataFrame, label: str, learned: Column) -> tuple[int, int]:
    """Learned rows of class 0 and of class 1."""
    zero, one = labels.filter(learned).agg(
        F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))).first()
    return zero, one


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Coefficients and intercept of a weighted logistic regression, by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * weight.sum())
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * beta
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        beta -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return beta
