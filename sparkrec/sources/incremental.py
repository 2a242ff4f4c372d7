"""Cursor-driven reads of a changing source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkrec.sources.tables import Table

EPOCH = datetime(1970, 1, 1)  # fixed value: the cursor before the first run


def incremental_scan(
    df: DataFrame, cursor: str, last_value=EPOCH, inclusive: bool = False,
    seen: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """Rows with a cursor strictly above the last value.

    `inclusive` also takes rows at the last value; `seen` then removes the keys
    that an earlier run already delivered.
    """
    mark = last_value if isinstance(last_value, Column) else F.lit(last_value)
    rows = df.filter(F.col(cursor) >= mark) if inclusive else df.filter(F.col(cursor) > mark)
    if inclusive and seen is not None:
        rows = rows.join(seen.select(key, cursor), [key, cursor], "left_anti")
    return rows


def next_cursor(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.max(cursor).alias("last_value"))


def keyset_after(df: DataFrame, cursor: str, key: str, after: tuple, page: int | None = None) -> DataFrame:
    """Rows after (cursor, key) in that order; a page of them if a size is given.

    The leading `cursor >=` lets Parquet and JDBC sources skip what lies before.
    """
    at, last_key = F.lit(after[0]), F.lit(after[1])
    ahead = (F.col(cursor) > at) | ((F.col(cursor) == at) & (F.col(key) > last_key))
    rows = df.filter((F.col(cursor) >= at) & ahead)
    return rows if page is None else rows.orderBy(cursor, key).limit(page)


def read_jdbc(
    spark: SparkSession, url: str, table: str, cursor: str, last_value: datetime,
    partition_column: str, bounds: tuple[int, int], partitions: int,
) -> DataFrame:
    """Bulk form of the paged extract: ranges of the key, read in parallel."""
    condition = f"{cursor} > TIMESTAMP '{last_value:%Y-%m-%d %H:%M:%S.%f}'"
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"(SELECT * FROM {table} WHERE {condition}) AS delta")
        .options(partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
                 numPartitions=partitions)
        .load()
    )


def extract(df: DataFrame, staging: str, state: Table, cursor: str, run_at: datetime, run_id: str) -> int:
    """Stage one increment. The cursor moves only after the data is complete, so a
    failed run leaves it where it was and the next one reads everything again."""
    before = state.state()
    last_value = EPOCH if before is None else before.watermark
    delta = incremental_scan(df, cursor, last_value)
    facts = delta.agg(F.count("*").alias("n"), F.max(cursor).cast("timestamp").alias("w")).first()
    if facts.n == 0:
        return 0
    delta.filter(F.col(cursor) <= F.lit(facts.w)).write.mode("overwrite").parquet(f"{staging}/load={run_id}")
    state.record(facts.w, facts.n, run_at)
    return facts.n
