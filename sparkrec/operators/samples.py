"""Training samples from interaction histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.functions.arrays import last_n, ordered_values, pad_right
from sparkrec.operators.contracts import ContractError, duplicate_keys
from sparkrec.operators.ordering import (
    dense_index, first_per_key, positions, trailing_values,
)

MAX_LEN = 50
TRAIN, VALID, TEST = "train", "valid", "test"


def item_vocab(items: DataFrame, item: str = "product_id") -> DataFrame:
    """(item, item_idx): sorted distinct ids, from 1; 0 is the padding."""
    return dense_index(items.select(item).distinct(), [F.asc(item)], "item_idx")


def catalog_meta(items: DataFrame) -> DataFrame:
    """Item features under training names; a repeated id is an error."""
    if not duplicate_keys(items, "product_id").isEmpty():
        raise ContractError("catalog", ["product_id: duplicate value"])
    return items.select(
        F.col("product_id").alias("item_id"), "title", F.col("category").alias("main_category"),
        "category_path", F.col("brand").alias("store"), "price",
    )


def explode_sequences(users: DataFrame, times: str | None = "event_time_sequence") -> DataFrame:
    """One row per sequence entry, ordered by (user_id, ts, pos).

    Without times the position serves as time.
    """
    if times is None:
        return users.select("user_id", F.posexplode("item_sequence").alias("pos", "item_id")).select(
            "user_id", "item_id", F.col("pos").cast("double").alias("ts"), "pos"
        )
    zipped = F.arrays_zip(F.col("item_sequence").alias("item"), F.col(times).alias("at"))
    return users.select("user_id", F.posexplode(zipped).alias("pos", "e")).select(
        "user_id", F.col("e.item").alias("item_id"), F.col("e.at").alias("ts"), "pos"
    )


def index_sequences(users: DataFrame, vocab: DataFrame, sequence: str = "item_sequence",
                    strict: bool = True) -> DataFrame:
    """(user_id, items): vocabulary indices in order, unknown items dropped.

    `strict` refuses sequences that name an item outside the catalog.
    """
    flat = users.select("user_id", F.posexplode(sequence).alias("pos", "item"))
    known = flat.join(vocab.select(F.col(vocab.columns[0]).alias("item"), "item_idx"), "item", "left")
    entry = F.when(F.col("item_idx").isNotNull(), F.struct("pos", "item_idx"))
    if strict:
        entry = entry.otherwise(F.raise_error("item missing from the catalog"))
    return known.groupBy("user_id").agg(ordered_values(F.collect_list(entry), "item_idx").alias("items"))


def _prefixes(first_target: Column, last_target: Column) -> Column:
    return F.explode(
        F.when(last_target >= first_target, F.sequence(first_target, last_target)).otherwise(
            F.array().cast("array<int>"))
    )


def two_way_split(indexed: DataFrame) -> DataFrame:
    """(user_id, split, t, seq, target) from bounded sequences of ≥ 2 items.

    The last item is validated against the full prefix; earlier ones train.
    """
    n = F.size("items")
    return (
        indexed.filter(n >= 2)
        .select("user_id", "items", _prefixes(F.lit(1), n - 1).alias("t"))
        .select(
            "user_id",
            F.when(F.col("t") == n - 1, VALID).otherwise(TRAIN).alias("split"),
            "t",
            F.expr("slice(items, 1, t)").alias("seq"),
            F.get("items", "t").alias("target"),
        )
    )


def split_facts(indexed: DataFrame) -> DataFrame:
    n = F.size("items")
    return indexed.agg(
        F.coalesce(F.sum(F.when(n >= 2, n - 2)), F.lit(0)).alias("train_examples"),
        F.count_if(n >= 2).alias("val_examples"),
        F.count_if(n < 2).alias("skipped_users"),
    )


def truncate_pad(seq: Column | str, max_len: int) -> Column:
    """Last `max_len` entries, left-aligned, zero-filled."""
    return pad_right(last_n(seq, max_len), max_len)


def _split_name(t: Column, n: Column) -> Column:
    return F.when(t < n - 2, TRAIN).when(t == n - 2, VALID).otherwise(TEST)


def leave_one_out(indexed: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Three-way split of bounded sequences: users with fewer than 3 items are left out."""
    n = F.size("items")
    return (
        indexed.filter(n >= 3)
        .select("user_id", "items", _prefixes(F.lit(1), n - 1).alias("t"))
        .withColumn("prefix", F.expr(f"slice(items, greatest(1, t - {max_len} + 1), least(t, {max_len}))"))
        .select(
            "user_id", _split_name(F.col("t"), n).alias("split"), "t",
            pad_right("prefix", max_len).alias("seq"), F.size("prefix").alias("seq_len"),
            F.get("items", "t").alias("target"),
        )
    )


def leave_one_out_history(
    interactions: DataFrame, order: Sequence[Column], max_len: int = MAX_LEN, ranges: int | None = None,
    block: int = 100_000,
) -> DataFrame:
    """The same split over full histories (user_id, item_idx, …) of any length.

    No history is ever collected: each row looks back `max_len` places, in blocks.
    """
    placed = positions(interactions, ["user_id"], order, "pos", ranges)
    lengths = interactions.groupBy(F.col("user_id").alias("__user")).agg(F.count("*").alias("n")).filter("n >= 3")
    with_prefix = trailing_values(placed, ["user_id"], "pos", "item_idx", max_len, "prefix", block)
    t = (F.col("pos") - 1).cast("int")
    return (
        with_prefix.join(lengths, F.col("user_id").eqNullSafe(F.col("__user")))
        .filter("pos > 1")
        .select(
            "user_id", _split_name(t, F.col("n")).alias("split"), t.alias("t"),
            pad_right("prefix", max_len).alias("seq"), F.size("prefix").alias("seq_len"),
            F.col("item_idx").alias("target"),
        )
    )


def train_counts(interactions: DataFrame, catalog: DataFrame, order: Sequence[Column],
                 item: str = "item_id", holdout: int = 2) -> DataFrame:
    """Occurrences per catalog item without each user's last `holdout` interactions.

    All occurrences minus the held-out ones: only `holdout` rows per user are ranked.
    """
    held = first_per_key(interactions, ["user_id"], order, holdout)
    signed = interactions.select(item, F.lit(1).alias("w")).unionByName(held.select(item, F.lit(-1).alias("w")))
    counts = signed.groupBy(item).agg(F.sum("w").alias("train_count"))
    return catalog.select(item).join(counts, item, "left").select(
        item, F.coalesce("train_count", F.lit(0)).cast("long").alias("train_count")
    )


def popularity_signal(counts: DataFrame, count: str = "train_count", name: str = "popularity") -> DataFrame:
    """log1p(count) relative to the largest; zero everywhere if nothing was counted.

    The maximum is one scalar, looked up as a subquery.
    """
    top = counts.select(F.log1p(F.greatest(F.max(count), F.lit(0)).cast("double"))).scalar()
    value = F.log1p(F.greatest(F.col(count), F.lit(0)).cast("double"))
    return counts.withColumn(name, F.coalesce(F.try_divide(value, top), F.lit(0.0)))


def shared_negatives(batches: DataFrame, batch: str, vocab: DataFrame, k: int, seed: int) -> DataFrame:
    """`k` uniform item indices per batch out of 1..(rows of `vocab`); the same for any partitioning.

    A draw is the first 32 bits of the MD5 of batch, number and seed, modulo the size of the vocabulary.
    """
    key = F.concat_ws("/", F.col(batch).cast("string"), F.col("k").cast("string"), F.lit(str(seed)))
    bits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    drawn = batches.select(batch, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k"))
    return drawn.withColumn("item_idx", bits % vocab.agg(F.count("*")).scalar() + 1)

