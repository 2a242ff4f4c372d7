"""Silver tables: newest version per key, watermark-driven merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkrec.operators.ordering import first_per_key

KEEP_STORED, NEWEST_INGEST = "stored", "ingested_at"
INGESTED_AT, UPDATED_AT = "_ingested_at", "updated_at"


def newest_first(df: DataFrame, ties: Sequence[str] = ()) -> list[Column]:
    return [F.desc(UPDATED_AT), F.desc(INGESTED_AT), *[F.col(c).desc_nulls_last() for c in ties]]


def latest_by_key(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key, by update time and then ingest time; lineage dropped.

    Spark keeps one row per key and map task before it shuffles.
    """
    return first_per_key(df, keys, newest_first(df, ties)).select(*columns)


def format_watermark(value: datetime | None) -> str | None:
    """ISO-8601 in UTC with microseconds."""
    if value is None:
        return None
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc).isoformat(timespec="microseconds")


def after_watermark(bronze: DataFrame, watermark: Column | str | None) -> DataFrame:
    """Rows ingested later than the watermark; without one, all."""
    if watermark is None:
        return bronze
    mark = F.lit(watermark).cast(bronze.schema[INGESTED_AT].dataType) if isinstance(watermark, str) else watermark
    return bronze.filter(F.col(INGESTED_AT) > mark)


def drop_stale(delta: DataFrame, stored: DataFrame, key: str, ties: str = KEEP_STORED) -> DataFrame:
    """Delta rows that are new or strictly newer than the stored row."""
    have = stored.select(F.col(key), F.col(UPDATED_AT).alias("__have"))
    newer = F.col(UPDATED_AT) > F.col("__have")
    if ties == NEWEST_INGEST:
        newer = F.col(UPDATED_AT) >= F.col("__have")
    return delta.join(have, key, "left").filter(F.col("__have").isNull() | newer).drop("__have")


def merge(stored: DataFrame, delta: DataFrame, key: str, ties: str = KEEP_STORED, order: Sequence[str] = ()) -> DataFrame:
    """Stored and delta rows in one full join, each labelled in `change`.

    kept, inserted, updated, unchanged (equal in every column, NULLs included) or
    stale (the delta row is not newer, the stored row stays). A key that `delta` holds twice
    fails the job; its rows are counted in the shuffle that the join needs anyway. `order`
    names columns that decide which row is newer, one after the other, NULL first; then the result does not
    depend on the order in which rows arrive.
    """
    columns = stored.columns
    left = stored.select(F.col(key), F.struct(*columns).alias("__old"))
    right = delta.select(F.col(key), F.struct(*columns).alias("__new")).withColumn(
        "__times", F.count(F.lit(1)).over(W.partitionBy(key)))
    old, new = F.col("__old"), F.col("__new")
    newer = new[UPDATED_AT] > old[UPDATED_AT]
    if ties == NEWEST_INGEST:
        newer = new[UPDATED_AT] >= old[UPDATED_AT]
    if order:
        newer = F.struct(*[new[c] for c in order]) > F.struct(*[old[c] for c in order])
    change = (
        F.when(F.col("__times") > 1, F.raise_error(f"{key} is not unique in the delta").cast("string"))
        .when(new.isNull(), "kept")
        .when(old.isNull(), "inserted")
        .when(~newer, "stale")
        .when(old.eqNullSafe(new), "unchanged")
        .otherwise("updated")
    )
    chosen = F.when(F.col("change").isin("kept", "stale"), old).otherwise(new)
    return (
        left.join(right, key, "full_outer")
        .withColumn("change", change)
        .withColumn("__row", chosen)
        .select("__row.*", "change")
    )


def change_counts(merged: DataFrame) -> DataFrame:
    """Counters of one merge, in one aggregate."""
    def n(*labels: str) -> Column:
        return F.count_if(F.col("change").isin(*labels))

    return merged.agg(
        n("inserted").alias("rows_inserted"),
        n("updated").alias("rows_updated"),
        n("inserted", "updated").alias("rows_upserted"),
        n("stale").alias("rows_skipped_stale"),
        n("inserted", "updated", "unchanged").alias("rows_after_dedup"),
    )


def digest(df: DataFrame) -> DataFrame:
    """Row count and order-free content digest."""
    return df.agg(
        F.count("*").alias("rows"),
        F.sum(F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")).alias("digest"),
    )


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows each side has that the other lacks, multiplicity included.

    One partial aggregate over both sides, so copies never meet in one task.
    """
    columns = sorted(left.columns)
    both = left.select(*columns, F.lit(1).alias("__side")).unionByName(
        right.select(*columns, F.lit(-1).alias("__side"))
    )
    net = both.groupBy(*columns).agg(F.sum("__side").alias("__net"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("__net", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("__net"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
