"""Item vectors, user states, dot-product scores and exact top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sparkrec.functions.arrays import dot, l2_normalize, ordered_values
from sparkrec.operators.ordering import first_per_key
from sparkrec.operators.products import SCORE_DIGITS, multiply, multiply_once

SHARED_BYTES = 128 << 20  # of weights that travel to every executor


# ------------------------------------------------------------------ item vectors and user states
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _layer_norm(x: np.ndarray, weight: np.ndarray, bias: np.ndarray, eps: float = 1e-12) -> np.ndarray:
    centred = x - x.mean(-1, keepdims=True)
    return centred / np.sqrt((centred**2).mean(-1, keepdims=True) + eps) * weight + bias


def mean_categories(categories: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Mean of the category rows, padding (0) left out."""
    idx = np.stack(categories).astype(int)
    mask = (idx != 0)[..., None].astype(table.dtype)
    return (table[idx] * mask).sum(1) / np.maximum(mask.sum(1), 1.0)


def with_category_vectors(items: DataFrame, table: DataFrame, width: int) -> DataFrame:
    """`items` plus `category_vec`: the mean of their rows of `table` (category, vec), zeros without any.

    The join meets on categories; they are averaged per item before anything wide is shuffled on.
    """
    each = items.select("item_idx", F.explode("categories").alias("category")).filter("category <> 0").join(table, "category")
    means = each.groupBy("item_idx").agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(width)]).alias("category_vec"))
    zero = F.array_repeat(F.lit(0.0), width)
    return items.join(means, "item_idx", "left").withColumn("category_vec", F.coalesce("category_vec", zero))


def item_vectors(items: DataFrame, weights: dict[str, np.ndarray], fusion: str = "gate") -> DataFrame:
    """(item_idx, item_id, vec) from identity and attributes.

    `items` carries the per-row tables already joined: id_vec, store_vec (arrays),
    categories (indices), price (index), train_count, and text_vec if text is used.
    `weights` holds only the small shared matrices: category, price, text_w, text_b,
    feat_w, feat_b, norm_w, norm_b, gate_w, gate_b. A category table can be joined as well, as
    `category_vec` (see `with_category_vectors`); one above SHARED_BYTES is. The gate takes the
    popularity signal where `gate_w` has a column for it.
    """
    table = weights.get("category")
    if table is not None and table.nbytes > SHARED_BYTES and "category_vec" not in items.columns:
        rows = pd.DataFrame({"category": np.arange(len(table)), "vec": list(table.astype(float))})
        items = with_category_vectors(items, items.sparkSession.createDataFrame(rows, "category int, vec array<double>"), table.shape[1])
        weights = {k: w for k, w in weights.items() if k != "category"}
    shared = items.sparkSession.sparkContext.broadcast(weights)
    top = items.agg(F.max("train_count")).first()[0] or 0
    scale = float(np.log1p(top)) if top > 0 else 1.0

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for batch in batches:
            if batch.empty:
                continue
            counts = batch["train_count"].to_numpy(dtype=float)
            known = (counts > 0)[:, None].astype(float)
            e = np.stack(batch["id_vec"]).astype(float) * known
            if fusion == "id_only":
                h = e
            else:
                if "category_vec" in batch:
                    categories = np.stack(batch["category_vec"]).astype(float)
                else:
                    categories = mean_categories(list(batch["categories"]), w["category"])
                parts = [
                    categories,
                    np.stack(batch["store_vec"]).astype(float),
                    w["price"][batch["price"].to_numpy(dtype=int)],
                ]
                if "text_vec" in batch:
                    parts.append(np.stack(batch["text_vec"]).astype(float) @ w["text_w"].T + w["text_b"])
                f = np.concatenate(parts, axis=1) @ w["feat_w"].T + w["feat_b"]
                f = _layer_norm(f, w["norm_w"], w["norm_b"])
                if fusion == "sum":
                    h = e + f
                else:
                    signals = [e, f]
                    if w["gate_w"].shape[1] > 2 * e.shape[1]:
                        signals.append((np.log1p(counts) / scale)[:, None] * known)
                    g = _sigmoid(np.concatenate(signals, axis=1) @ w["gate_w"].T + w["gate_b"])
                    h = g * e + (1.0 - g) * f
            yield pd.DataFrame(
                {"item_idx": batch["item_idx"], "item_id": batch["item_id"], "vec": list(h.astype(np.float32))}
            )

    return items.mapInPandas(vectors, "item_idx long, item_id string, vec array<float>")


Backbone = Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class GRUBackbone:
    """One recurrent layer without bias, then a dense layer (gates in the order r, z, n)."""

    w_input: np.ndarray
    w_hidden: np.ndarray
    dense_w: np.ndarray
    dense_b: np.ndarray

    def __call__(self, vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, steps, _ = vectors.shape
        d = self.w_hidden.shape[1]
        h = np.zeros((n, d))
        for t in range(steps):
            xr, xz, xn = np.split(vectors[:, t] @ self.w_input.T, 3, axis=1)
            hr, hz, hn = np.split(h @ self.w_hidden.T, 3, axis=1)
            r, z = _sigmoid(xr + hr), _sigmoid(xz + hz)
            candidate = np.tanh(xn + r * hn)
            live = (t < lengths)[:, None]
            h = np.where(live, (1 - z) * candidate + z * h, h)
        return h @ self.dense_w.T + self.dense_b


def last_vector(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stand-in backbone: the vector at the last valid position."""
    return vectors[np.arange(len(lengths)), lengths - 1]


def history_vectors(users: DataFrame, items: DataFrame, sequence: str, max_len: int,
                    user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user, vectors): vectors of the latest ≤ max_len known items, oldest first.

    Unknown items are dropped before the cut; users without any known item are absent.
    """
    flat = users.select(user, F.posexplode(sequence).alias("pos", item))
    # places are cut before vectors are attached, so no more than max_len vectors per user move
    known = flat.join(items.select(item), item, "left_semi")
    newest = first_per_key(known, [user], [F.desc("pos")], max_len).join(items.select(item, "vec"), item)
    return newest.groupBy(user).agg(
        ordered_values(F.collect_list(F.struct("pos", "vec")), "vec").alias("vectors")
    )


def user_states(histories: DataFrame, backbone: Backbone, user: str = "user_id") -> DataFrame:
    """(user, state): the backbone at the last valid position, batch by batch."""
    kind = histories.schema[user].dataType.simpleString()

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows = [np.stack(v).astype(float) for v in batch["vectors"]]
            lengths = np.array([len(r) for r in rows])
            dense = np.zeros((len(rows), lengths.max(), rows[0].shape[1]))
            for i, r in enumerate(rows):
                dense[i, : len(r)] = r
            yield pd.DataFrame({user: batch[user], "state": list(backbone(dense, lengths))})

    return histories.select(user, "vectors").mapInPandas(states, f"{user} {kind}, state array<double>")


def last_item_states(histories: DataFrame, user: str = "user_id") -> DataFrame:
    """The stand-in backbone as a plain expression."""
    return histories.select(user, F.element_at("vectors", -1).cast("array<double>").alias("state"))


# ------------------------------------------------------------------ scores
def score_candidates(pairs: DataFrame, states: DataFrame, items: DataFrame,
                     user: str = "user_id", item: str = "item_id") -> DataFrame:
    """`pairs` plus `score`; unknown item or user without state scores 0.0."""
    # vectors travel only with pairs that have both, each pair once
    met = pairs.select(user, item).join(items.select(item), item, "left_semi").join(states.select(user), user, "left_semi").distinct()
    known = met.join(states, user).join(items.select(item, "vec"), item).select(
        user, item, F.when(F.col("state").isNotNull() & F.col("vec").isNotNull(), dot("state", "vec")).otherwise(0.0).alias("score"),
        F.lit(True).alias("__known"))
    return pairs.join(known, [user, item], "left").withColumn(
        "score", F.when(F.col("__known"), F.col("score")).otherwise(0.0)).drop("__known").select(*pairs.columns, "score")


def top_n(scores: DataFrame, user: str, item: str, n: int) -> DataFrame:
    """Best `n` scored items per user with their `rank`."""
    order = [F.desc(F.round("score", SCORE_DIGITS)), F.asc(item)]
    return first_per_key(scores, [user], order, n, "rank")


def max_abs_difference(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 1e-5) -> DataFrame:
    """Largest gap between two scorings of the same pairs, and whether it is tolerable."""
    both = a.select(*keys, F.col("score").alias("a")).join(b.select(*keys, F.col("score").alias("b")), keys)
    gap = F.max(F.abs(F.col("a") - F.col("b")))
    return both.agg(F.count("*").alias("pairs"), gap.alias("max_abs_diff")).withColumn(
        "consistent", F.col("max_abs_diff") < tolerance
    )


def text_vectors(catalog: DataFrame, embeddings: DataFrame, item: str = "item_id") -> DataFrame:
    """Catalog rows with their text vector, unit length; every row must have one."""
    joined = catalog.join(embeddings, item, "left")
    present = F.coalesce("embedding", F.raise_error("a catalog item has no text vector"))
    return joined.withColumn("text_vec", l2_normalize(present)).drop("embedding")


# ------------------------------------------------------------------ products with the whole catalog
def top_k(queries: DataFrame, catalog: DataFrame, k: int, **limits) -> DataFrame:
    """(query, item_idx, score, rank): the exact best `k` items of every query.

    `queries` is (query, vec[, skip_idx]); a skipped index never appears.
    """
    found = multiply(queries, catalog, k, **limits)
    pairs = F.posexplode(F.arrays_zip(F.col("ids").alias("item_idx"), F.col("scores").alias("score")))
    return found.select("query", pairs.alias("place", "hit")).select(
        "query", "hit.item_idx", "hit.score", (F.col("place") + 1).alias("rank"))


def shared_top_k(queries: DataFrame, catalog: DataFrame, k: int, **limits) -> tuple[DataFrame, DataFrame]:
    """(query, own) and (own, ids, scores): `top_k` as lists, best first, one for all queries of equal vectors."""
    asked, found = multiply_once(queries, catalog, k, **limits)
    return asked, found.select("own", "ids", "scores")


def rank_targets(queries: DataFrame, catalog: DataFrame, **limits) -> DataFrame:
    """(query, strict_rank, rank) of each target over the whole catalog.

    `queries` is (query, vec, target_idx). `strict_rank` counts higher scores only;
    `rank` also counts equal scores of lower index. No score ever leaves a task.
    Targets outside the catalog are absent.
    """
    counted = target_counts(queries, catalog, **limits)
    return counted.select("query", (F.col("above") + 1).alias("strict_rank"), (F.col("above") + F.col("tied") + 1).alias("rank"))


def target_counts(queries: DataFrame, catalog: DataFrame, **limits) -> DataFrame:
    """(query, target_idx, score, above, tied): the score of each target, and items above it or of equal score and lower index."""
    targets = catalog.select(F.col("item_idx").alias("target_idx"), F.col("vec").alias("target_vec"))
    scored = queries.join(targets, "target_idx").select(
        "query", "vec", F.array("target_idx").alias("targets"), F.array(F.round(dot("vec", "target_vec"), SCORE_DIGITS)).alias("bars"))
    counted = multiply(scored, catalog, 0, **limits)
    return counted.select("query", F.col("targets")[0].alias("target_idx"), F.col("bars")[0].alias("score"),
                          F.col("above")[0].alias("above"), F.col("tied")[0].alias("tied"))
