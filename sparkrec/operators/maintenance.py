"""Upkeep of versioned tables: which files an expiry may remove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def expired_snapshots(snapshots: DataFrame, cutoff: Column) -> DataFrame:
    """`snapshots` (snapshot_id, committed_at, is_ref) plus `expired`: older than the
    cutoff and not the current version, a branch or a tag."""
    return snapshots.withColumn("expired", (F.col("committed_at") < cutoff) & ~F.col("is_ref"))


def expired_files(snapshots: DataFrame, files: DataFrame, cutoff: Column) -> DataFrame:
    """Paths used by expired snapshots only. Nothing is deleted here.

    `files` is (snapshot_id, path). One partial aggregate per path instead of two
    sets and their difference.
    """
    flagged = files.join(expired_snapshots(snapshots, cutoff).select("snapshot_id", "expired"), "snapshot_id")
    return flagged.groupBy("path").agg(F.bool_and("expired").alias("all_expired")).filter("all_expired").select("path")
