"""Catalog-wide item attributes: tokens, price buckets, vocabularies, encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.functions.arrays import ordered_values, pad_right
from sparkrec.functions.text import (
    MISSING, UNK, category_tokens, clean, positive_price, raw_categories, split_category_path,
)
from sparkrec.operators.contracts import unknown_references
from sparkrec.operators.ordering import dense_index, running_totals
from sparkrec.session import durable

# Fixed values of the attribute rules.
MIN_ITEMS = 5
PRICE_BUCKETS = 10
MAX_CATEGORIES = 3
ATTRIBUTES = ("categories", "store", "price_bucket")


def price_edges(prices: DataFrame, price: str, buckets: int = PRICE_BUCKETS) -> DataFrame:
    """One row with `edges`: interior quantiles, exact and linearly interpolated.

    Prices are reduced to counts per value first; only the two values around each
    quantile are gathered. No valid price gives empty edges.
    """
    per_value = (
        prices.select(positive_price(price).alias("v")).filter("v IS NOT NULL")
        .groupBy("v").agg(F.count("*").alias("n"))
    )
    ranked = running_totals(per_value, [F.asc("v")], {"upto": "n"})
    total = ranked.select(F.max("upto")).first()[0]
    if total is None:
        return ranked.agg(F.array().cast("array<double>").alias("edges"))
    places = [i / buckets * (total - 1) for i in range(1, buckets)]
    return ranked.agg(F.array(*[_value_at(p) for p in places]).alias("edges"))


def _value_at(place: float) -> Column:
    """Interpolated value at a rank (from 0) of a frame of (v, n, upto)."""
    low, high = math.floor(place), math.ceil(place)

    def at(rank: int) -> Column:
        inside = (F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank)
        return F.max(F.when(inside, F.col("v")))

    return at(low) + (at(high) - at(low)) * (place - low)


SKETCH_K = 800  # rank error of about 0.4 %


def price_sketches(prices: DataFrame, price: str, load: str, k: int = SKETCH_K) -> DataFrame:
    """(load, sketch): one quantile sketch per load, a few kilobytes each, merged on the map side."""
    valid = prices.select(F.col(load), positive_price(price).cast("double").alias("v")).filter("v IS NOT NULL")
    return valid.groupBy(load).agg(F.kll_sketch_agg_double("v", k).alias("sketch"))


def sketched_edges(sketches: DataFrame, buckets: int = PRICE_BUCKETS) -> DataFrame:
    """One row with `edges`: interior quantiles of all loads, within the rank error of their sketches.

    An opt-in for catalogs whose prices are not to be counted anew with every load: stored
    sketches are merged, no price is read. `price_edges` is exact. Without any price there are no edges.
    """
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.count("*").alias("n"))
    ranks = [F.kll_sketch_get_quantile_double("s", F.lit(i / buckets)) for i in range(1, buckets)]
    return merged.select(F.when(F.col("n") > 0, F.array(*ranks)).otherwise(F.array().cast("array<double>")).alias("edges"))


def price_bucket(price: Column, edges: Column, buckets: int = PRICE_BUCKETS) -> Column:
    """`p` + number of edges not above the price; `[MISSING]` without price or edges."""
    below = F.lit(0)
    for i in range(buckets - 1):
        below = below + F.when(F.get(edges, F.lit(i)) <= price, 1).otherwise(0)
    known = price.isNotNull() & (F.size(edges) > 0)
    return F.when(known, F.concat(F.lit("p"), below.cast("string"))).otherwise(F.lit(MISSING))


def frequent_categories(items: DataFrame, min_items: int = MIN_ITEMS) -> DataFrame:
    """(item_id, categories): space-joined tokens; rare ones become `[UNK]`, repeats go.

    `items` has item_id and `tokens`, at most a few per item.
    """
    flat = items.select("item_id", F.posexplode("tokens").alias("pos", "token"))
    per_item = flat.groupBy("item_id", "token").agg(F.min("pos").alias("pos"))
    frequent = (
        per_item.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= min_items)
        .select("token", F.col("token").alias("kept"))
    )
    mapped = (
        per_item.join(frequent, "token", "left")
        .groupBy("item_id", F.coalesce("kept", F.lit(UNK)).alias("mapped"))
        .agg(F.min("pos").alias("pos"))
        .groupBy("item_id")
        .agg(F.array_join(ordered_values(F.collect_list(F.struct("pos", "mapped")), "mapped"), " ")
             .alias("categories"))
    )
    return items.select("item_id").join(mapped, "item_id", "left").select(
        "item_id", F.coalesce("categories", F.lit(MISSING)).alias("categories")
    )


def frequent_store(items: DataFrame, min_items: int = MIN_ITEMS) -> DataFrame:
    """(item_id, store): `[MISSING]` without one, `[UNK]` below `min_items` items."""
    named = items.select("item_id", clean("store").alias("store"))
    known = (
        named.filter("store IS NOT NULL").groupBy("store").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_items).select("store", F.lit(True).alias("frequent"))
    )
    label = (
        F.when(F.col("store").isNull(), MISSING).when(F.col("frequent"), F.col("store")).otherwise(UNK)
    )
    return named.join(known, "store", "left").select("item_id", label.alias("store"))


def with_tokens(meta: DataFrame) -> DataFrame:
    """Catalog rows plus their category tokens."""
    levels = raw_categories(split_category_path("category_path"), "main_category", MAX_CATEGORIES)
    return meta.withColumn("tokens", category_tokens(levels))


def item_tokens(meta: DataFrame) -> DataFrame:
    """(item_id, store, price, tokens), stored: paths are taken apart once.

    The rows are dealt out first; a catalog of a few files would be the work of as many tasks.
    """
    dealt = meta.select("item_id", "main_category", "category_path", "store", "price").hint("rebalance")
    return durable(with_tokens(dealt).select("item_id", "store", "price", "tokens"))


def build_features(meta: DataFrame) -> DataFrame:
    """(item_id, categories, store, price_bucket) for every catalog item."""
    items = item_tokens(meta)
    edges = F.lit(price_edges(items, "price").first().edges).cast("array<double>")
    buckets = items.select("item_id", price_bucket(positive_price("price"), edges).alias("price_bucket"))
    return (
        frequent_categories(items)
        .join(frequent_store(items), "item_id")
        .join(buckets, "item_id")
    )


def _tokens(features: DataFrame) -> DataFrame:
    """(item_id, …, attribute, pos, token) in long form."""
    lists = [
        F.struct(
            F.lit(i).alias("attribute_no"), F.lit(a).alias("attribute"),
            (F.split(a, " ") if a == "categories" else F.array(a)).alias("tokens"),
        )
        for i, a in enumerate(ATTRIBUTES)
    ]
    spread = features.withColumn("__a", F.explode(F.array(*lists)))
    return spread.select(
        *features.columns, "__a.attribute_no", "__a.attribute",
        F.posexplode("__a.tokens").alias("pos", "token"),
    )


def fit_vocab(features: DataFrame, order: str = "item_id") -> DataFrame:
    """(attribute, token, token_idx): numbered by first appearance, from 1."""
    firsts = _tokens(features).groupBy("attribute_no", "attribute", "token").agg(
        F.min(F.struct(order, "pos")).alias("first")
    )
    numbered = dense_index(firsts, [F.asc("attribute_no"), F.asc("first"), F.asc("token")], "__n")
    starts = numbered.groupBy("attribute_no").agg(F.min("__n").alias("__start"))
    return numbered.join(F.broadcast(starts), "attribute_no").select(
        "attribute", "token", (F.col("__n") - F.col("__start") + 1).alias("token_idx")
    )


def encode_features(features: DataFrame, vocab: DataFrame, width: int = MAX_CATEGORIES) -> DataFrame:
    """(item_id, categories, store, price): indices; unknown tokens take the `[UNK]` index or 0."""
    fallback = vocab.filter(F.col("token") == UNK).select("attribute", F.col("token_idx").alias("unk_idx"))
    long = (
        _tokens(features.select("item_id", *ATTRIBUTES))
        .filter(F.col("pos") < width)
        .join(vocab, ["attribute", "token"], "left")
        .join(F.broadcast(fallback), "attribute", "left")
        .select("item_id", "attribute", "pos",
                F.coalesce("token_idx", "unk_idx", F.lit(0)).cast("int").alias("idx"))
    )
    attribute = F.col("attribute")
    cats = F.collect_list(F.when(attribute == "categories", F.struct("pos", "idx")))
    return long.groupBy("item_id").agg(
        pad_right(ordered_values(cats, "idx"), width).alias("categories"),
        F.max(F.when(attribute == "store", F.col("idx"))).alias("store"),
        F.max(F.when(attribute == "price_bucket", F.col("idx"))).alias("price"),
    )


def assemble_catalog(meta: DataFrame, counts: DataFrame, interactions: DataFrame | None = None) -> DataFrame:
    """Encoded attributes, train count and item index of the full catalog.

    With `interactions` the job fails where one of them is about an item that is not in the catalog.
    """
    features = durable(build_features(meta))
    encoded = encode_features(features, fit_vocab(features))
    indexed = dense_index(meta.select("item_id"), [F.asc("item_id")], "item_idx")
    if interactions is not None:
        # looked up once while the job runs, up to the first unknown item
        unknown = unknown_references(interactions, "item_id", meta, "item_id").limit(1)
        missing = F.raise_error("catalog: item_id: interacted items missing from the catalog").cast("boolean")
        indexed = indexed.filter(unknown.agg(F.when(F.count("*") > 0, missing).otherwise(True).alias("ok")).scalar())
    return indexed.join(encoded, "item_id").join(counts, "item_id", "left").select(
        "item_idx", "item_id", "categories", "store", "price",
        F.coalesce("train_count", F.lit(0)).cast("long").alias("train_count"),
    )


def dataset_facts(catalog: DataFrame, vocab: DataFrame, samples: DataFrame) -> DataFrame:
    """Sizes of the catalog, the vocabularies (padding included) and the splits."""
    items = catalog.agg(
        F.count("*").alias("items"), F.count_if(F.col("train_count") > 0).alias("items_with_train_count")
    )
    sizes = vocab.agg(*[
        (F.count_if(F.col("attribute") == a) + 1).alias(f"vocab_{a}") for a in ATTRIBUTES
    ])
    parts = samples.agg(*[
        F.count_if(F.col("split") == s).alias(f"{s}_samples") for s in ("train", "valid", "test")
    ])
    rows = items.unionByName(sizes, True).unionByName(parts, True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
