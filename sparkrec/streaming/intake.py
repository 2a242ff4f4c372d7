"""Interaction intake, continuous Silver upsert and session enrichment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkrec.operators import silver
from sparkrec.operators.contracts import EVENT_TYPES, Contract, validate
from sparkrec.session import durable
from sparkrec.sources.tables import Table


def rejection_reasons() -> Column:
    """Every reason to reject an interaction; the reference flags come from `flag_references`."""
    event, rating = F.col("event_type"), F.col("rating")
    is_rating = event == "rating"
    return F.array_compact(F.array(
        F.when(~F.coalesce(event.isin(*EVENT_TYPES), F.lit(False)), "event_type"),
        F.when(rating.isNotNull() & ~rating.between(1, 5), "rating_range"),
        F.when(F.coalesce(is_rating, F.lit(False)) & rating.isNull(), "rating_missing"),
        F.when(~F.coalesce(is_rating, F.lit(False)) & rating.isNotNull(), "rating_unexpected"),
        F.when(F.col("__user").isNull(), "unknown_user"),
        F.when(F.col("__product").isNull(), "unknown_product"),
    ))


def classify(events: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """`events` plus `reasons`, empty for good rows. Works on batches and streams."""
    known_users = users.select("user_id").distinct().withColumn("__user", F.lit(True))
    known_products = products.select("product_id").distinct().withColumn("__product", F.lit(True))
    return (
        events.join(known_users, "user_id", "left")
        .join(known_products, "product_id", "left")
        .withColumn("reasons", rejection_reasons())
        .drop("__user", "__product")
    )


def start_intake(stream: DataFrame, users: DataFrame, products: DataFrame, bronze: str, quarantine: str,
                 checkpoint: str) -> StreamingQuery:
    """Good rows to Bronze, rejected ones with their reasons to quarantine.

    Each batch owns one folder in both places, so a repeated batch replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        labelled = classify(batch, users, products).persist()
        good = labelled.filter(F.size("reasons") == 0).drop("reasons")
        good.write.mode("overwrite").parquet(f"{bronze}/batch={batch_id}")
        labelled.filter(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        labelled.unpersist()

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def upsert_batch(batch: DataFrame, batch_id: int, table: Table, columns: list[str], committed_at: datetime, counters: str,
                 order_ties: tuple[str, ...] = (), order: tuple[str, ...] = (), contract: Contract | None = None) -> None:
    """One micro-batch into the buckets of Silver that it touches. A repeated batch changes no row: nothing in it is newer.

    With `order` (kept in the table) the rows do not depend on how loads fall into batches.
    """
    newest, keys = silver.latest_by_key(batch, [table.key], columns, order_ties), batch
    if contract is not None:
        newest, keys = validate(durable(newest), contract), None
    if table.state() is None:
        table.overwrite(newest, committed_at)
        got = {"inserted": table.state().rows, "updated": 0, "unchanged": 0, "stale": 0}
    else:
        got = table.merge(newest, committed_at, order=order, keys=keys)
    row = {"batch_id": batch_id, **got}
    table.spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")


def start_silver_upsert(stream: DataFrame, table: Table, columns: list[str], committed_at: datetime,
                        counters: str, checkpoint: str, order_ties: tuple[str, ...] = (), order: tuple[str, ...] = (),
                        contract: Contract | None = None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, table, columns, committed_at, counters, order_ties, order, contract)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def drop_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Exact repeats of a row that arrive within `delay` of each other are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def enrich_recent(recents: DataFrame, histories: DataFrame, keep: int = 10) -> DataFrame:
    """Users of a (streamed) recent list with their stored history merged in."""
    none = F.array().cast("array<string>")
    past = histories.select("user_id", F.coalesce("item_sequence", none).alias("item_sequence"))
    joined = recents.join(past, "user_id", "left")
    both = F.concat(F.coalesce("item_sequence", none), "recent_items")
    size = F.size(both)
    return joined.withColumn("items", F.slice(both, F.greatest(size - keep + 1, F.lit(1)), keep)).drop("item_sequence")
