"""Feature lookups: latest row per entity and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from sparkrec.operators.ordering import carry_forward, first_per_key

TTL = timedelta(days=3650)


def latest_features(features: DataFrame, entity: str, stamp: str, ties: Sequence[str] = ()) -> DataFrame:
    order = [F.desc(stamp), *[F.desc(c) for c in ties]]
    return first_per_key(features, [entity], order)


def lookup(entities: DataFrame, latest: DataFrame, entity: str, sequences: Sequence[str] = ()) -> DataFrame:
    """Features for a list of entities; unknown ones get NULL, sequences get []."""
    joined = entities.select(entity).distinct().join(latest, entity, "left")
    empty = {c: F.coalesce(F.col(c), F.array().cast(latest.schema[c].dataType)) for c in sequences}
    return joined.withColumns(empty) if empty else joined


def point_in_time(
    events: DataFrame,
    features: DataFrame,
    entity: str,
    event_ts: str,
    feature_ts: str,
    ttl: timedelta = TTL,
    ties: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Each event with the newest feature row not after it and not older than `ttl`.

    Both sides go into one timeline, features before events of the same instant,
    and the last feature row is carried along: one shuffle, no fan-out.
    """
    values = [c for c in features.columns if c not in (entity,)]
    packed = F.struct(*values)
    left = events.select(
        F.col(entity).alias("__entity"), F.col(event_ts).alias("__ts"), F.lit(1).alias("__side"),
        F.struct(*events.columns).alias("__event"),
        F.lit(None).cast(features.select(packed.alias("x")).schema["x"].dataType).alias("__feature"),
        F.lit(None).cast(features.select(F.struct(*(ties or [feature_ts])).alias("x")).schema["x"].dataType).alias("__tie"),
    )
    right = features.select(
        F.col(entity).alias("__entity"), F.col(feature_ts).alias("__ts"), F.lit(0).alias("__side"),
        F.lit(None).cast(left.schema["__event"].dataType).alias("__event"),
        packed.alias("__feature"),
        F.struct(*(ties or [feature_ts])).alias("__tie"),
    )
    order = [F.asc("__ts"), F.asc("__side"), F.asc("__tie")]
    carried = carry_forward(left.unionByName(right), ["__entity"], order, "__feature", "__found", ranges)
    age_ok = F.col("__found")[feature_ts] >= F.col("__ts") - F.lit(ttl)
    found = F.when(age_ok, F.col("__found"))
    return carried.filter("__side = 1").select(
        "__event.*", *[found[c].alias(f"feature_{c}" if c in events.columns else c) for c in values]
    )


def materialize_window(features: DataFrame, stamp: str, after, upto) -> DataFrame:
    """Feature rows newer than the last run, up to the end of this one."""
    return features.filter((F.col(stamp) > after) & (F.col(stamp) <= upto))


def sequence_skew(offline: DataFrame, online: DataFrame, entity: str, sequence: str) -> DataFrame:
    """Entities whose sequences differ between the two stores (absent counts as different)."""
    a = offline.select(entity, F.col(sequence).alias("offline_sequence"))
    b = online.select(entity, F.col(sequence).alias("online_sequence"))
    return a.join(b, entity, "full_outer").filter(
        ~F.col("offline_sequence").eqNullSafe(F.col("online_sequence"))
    )
