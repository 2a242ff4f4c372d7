"""Batch intake: known-key skipping, insert-if-absent, batch statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.session import bounded_broadcast, durable


def skip_committed(df: DataFrame, committed: DataFrame, run_id: str = "_extraction_run_id") -> DataFrame:
    """Rows of loads that the target does not hold yet.

    Load ids are few and every row carries one, so they are counted and then sent to
    the rows rather than the rows to them.
    """
    done = bounded_broadcast(committed.select(run_id).distinct())
    return df.join(done, run_id, "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`new` with `inserted`: true for the first row of a key that is not yet present.

    `order` names the columns that decide which row is first, lowest first (NULL before all); of rows
    equal in them one is taken. The first row of a key is a minimum, combined on the map side, and rows meet
    it by their number, so a key with most of the rows costs one row per task.
    """
    if not order:
        raise ValueError("insert_if_absent needs an order: without one the inserted row is arbitrary")
    rows = durable(new.withColumn("__row", F.monotonically_increasing_id()))
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, "__row")).alias("__first"))
    present = existing.select(*keys).distinct()
    absent = first.join(present, list(keys), "left_anti").select(F.col("__first.__row").alias("__row"), F.lit(True).alias("inserted"))
    return rows.join(absent, "__row", "left").withColumn("inserted", F.coalesce("inserted", F.lit(False))).drop("__row")


def insert_counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count_if("inserted").alias("rows_inserted"),
        F.count_if(~F.col("inserted")).alias("rows_skipped"),
    )


def batch_stats(batch: DataFrame, train: DataFrame, item: str, rating: Column | str) -> DataFrame:
    """Rows, mean rating and share of rows about items unseen in `train`."""
    seen = train.select(item).distinct().withColumn("__seen", F.lit(True))
    value = F.col(rating) if isinstance(rating, str) else rating
    return batch.join(seen, item, "left").agg(
        F.count("*").alias("rows"),
        F.avg(value.cast("double")).alias("mean_rating"),
        F.avg(F.when(F.col("__seen").isNull(), 1.0).otherwise(0.0)).alias("unseen_share"),
    )


def drop_unknown(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` exists in `known`."""
    return df.join(known.select(column), column, "left_semi")


def unknown_counts(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """(kept, dropped) in one pass."""
    flags = known.select(column).distinct().withColumn("__known", F.lit(True))
    return df.join(flags, column, "left").agg(
        F.count_if(F.col("__known").isNotNull()).alias("rows_kept"),
        F.count_if(F.col("__known").isNull()).alias("rows_dropped"),
    )
