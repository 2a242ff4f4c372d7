"""Exports, keyed lookup tables, reports, baselines and lineage."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkrec.session import path_exists


def without_decimals(df: DataFrame) -> DataFrame:
    """Decimals as double; every other column as it is."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def export_snapshot(df: DataFrame, path: str) -> None:
    without_decimals(df).write.mode("overwrite").parquet(path)


def keyed_lookup(df: DataFrame, key: str, values: str, written_at: datetime, ttl_days: int = 7) -> DataFrame:
    """(key, value as JSON list, expires_at)."""
    return df.select(
        F.col(key).alias("key"), F.to_json(values).alias("value"),
        F.lit(written_at + timedelta(days=ttl_days)).alias("expires_at"),
    )


def write_lookup(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_lookup(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    """Entries that have not expired."""
    return spark.read.parquet(path).filter(F.col("expires_at") > F.lit(now))


def save_report(df: DataFrame, root: str, job: str, at: datetime) -> str:
    """One JSON report per run, in a folder named by its time."""
    path = f"{root}/{job}/ts={at:%Y%m%dT%H%M%S}"
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def latest_report(spark: SparkSession, root: str, job: str, schema: T.StructType | str) -> DataFrame:
    """Rows of the newest report, found in a listing of the folders; only that report is read."""
    if not path_exists(spark, f"{root}/{job}"):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(f"{root}/{job}")
    newest = files.agg(F.max(F.regexp_extract("path", r"/ts=([^/]+)/[^/]*$", 1)).alias("ts")).first().ts
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/{job}/ts={newest}")


META = "model_version string, rows long, silver_version int, source string, created_at timestamp"


def write_baseline(
    df: DataFrame, root: str, model_version: str, silver_version: int | None, source: str, created_at: datetime
) -> dict:
    """Baseline rows first, the one-row description last."""
    df.write.mode("overwrite").parquet(f"{root}/current")
    spark = df.sparkSession
    rows = spark.read.parquet(f"{root}/current").count()
    meta = (model_version, rows, silver_version, source, created_at)
    spark.createDataFrame([meta], META).coalesce(1).write.mode("overwrite").parquet(f"{root}/meta")
    return {"model_version": model_version, "rows": rows, "silver_version": silver_version, "source": source}


def read_meta_row(spark: SparkSession, root: str):
    return spark.read.schema(META).parquet(f"{root}/meta").first() if path_exists(spark, f"{root}/meta") else None


def read_baseline(spark: SparkSession, root: str) -> tuple[DataFrame, dict]:
    """The baseline of the production model if it was written completely, else the seed one."""
    meta = read_meta_row(spark, root)
    if meta is not None and path_exists(spark, f"{root}/current"):
        return spark.read.parquet(f"{root}/current"), {
            "source": "current", "model_version": meta.model_version, "rows": meta.rows,
        }
    return spark.read.parquet(f"{root}/train"), {"source": "train", "model_version": None}


LINEAGE = "run_id string, table_name string, version int, rows long"


def record_lineage(spark: SparkSession, path: str, run_id: str, tables: dict) -> DataFrame:
    """Which version of which table a run read, and how many rows it had."""
    rows = [
        (run_id, name, None if state is None else state.version, None if state is None else state.rows)
        for name, state in ((n, t.state()) for n, t in tables.items())
    ]
    out = spark.createDataFrame(rows, LINEAGE)
    out.coalesce(1).write.mode("append").parquet(path)
    return out
