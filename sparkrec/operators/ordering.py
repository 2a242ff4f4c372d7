"""Exact order-dependent results without a single-task sort.

Everything here rests on one idea: sort by ranges into a durable table, so each
row carries the number of its range partition and its offset inside it; add up
sizes per partition; combine. No task ever holds more than one range partition,
however uneven the keys are, because ranges are cut on the full (unique) order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkrec.session import durable

_AT, _PART, _BASE = "__at", "__part", "__base"


def _ranged(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """`df` in range partitions (`ranges` of them, or as Spark finds fit); `__part` is the range, `__at` the place inside all."""
    placed = (
        (df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn(_AT, F.monotonically_increasing_id())
    )
    return durable(placed).withColumn(_PART, F.shiftright(_AT, 33))


def _local_offset() -> Column:
    return F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))


def _before(order_col: str, *keys: str):
    window = W.partitionBy(*keys).orderBy(order_col)
    return window.rowsBetween(W.unboundedPreceding, -1)


def dense_index(df: DataFrame, order: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers following `order` over the whole frame.

    The one window without a key runs over one row per range partition.
    """
    ranged = _ranged(df, order)
    sizes = ranged.groupBy(_PART).agg(F.count("*").alias("__n"))
    bases = sizes.select(
        _PART, F.coalesce(F.sum("__n").over(_before(_PART)), F.lit(0)).alias(_BASE)
    )
    return (
        ranged.join(F.broadcast(bases), _PART)
        .withColumn(name, F.col(_BASE) + _local_offset() + F.lit(start))
        .drop(_AT, _PART, _BASE)
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], totals: dict[str, str], following: dict[str, str] | None = None
) -> DataFrame:
    """Inclusive running sums over the whole frame, `totals` = {new name: column}.

    `following` = {new name: column} adds the value of that column in the next row.
    """
    following = following or {}
    ranged = _ranged(df, order)
    firsts = [F.min_by(c, _AT).alias(f"__first_{n}") for n, c in following.items()]
    sums = [F.sum(c).alias(f"__sum_{n}") for n, c in totals.items()]
    sizes = ranged.groupBy(_PART).agg(F.count("*").alias("__n"), *sums, *firsts)
    ahead = W.orderBy(_PART)
    bases = sizes.select(
        _PART,
        *[F.coalesce(F.sum(f"__sum_{n}").over(_before(_PART)), F.lit(0)).alias(f"__base_{n}") for n in totals],
        *[F.lead(f"__first_{n}").over(ahead).alias(f"__next_{n}") for n in following],
    )
    inside = W.partitionBy(_PART).orderBy(_AT)
    out = ranged.join(F.broadcast(bases), _PART)
    for n, c in totals.items():
        local = F.sum(c).over(inside.rowsBetween(W.unboundedPreceding, 0))
        out = out.withColumn(n, F.col(f"__base_{n}") + local)
    for n, c in following.items():
        out = out.withColumn(n, F.coalesce(F.lead(c).over(inside), F.col(f"__next_{n}")))
    spare = [c for c in out.columns if c.startswith("__")]
    return out.drop(*spare)


def _by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ranges: int | None) -> DataFrame:
    """Ranges over keys, then order: a range holds whole keys, but for its first and its last one."""
    return _ranged(df, [*[F.col(k).asc_nulls_first() for k in keys], *order], ranges)


def _inside(keys: Sequence[str]):
    """The rows of a key inside a range; no larger than a range, however hot the key."""
    return W.partitionBy(_PART, *keys).orderBy(_AT)


def _continued(ranged: DataFrame, keys: Sequence[str], piece: Column, over) -> DataFrame:
    """`ranged` with `__carried`: for keys that began in an earlier range, `over` of their earlier pieces.

    At most the first key of a range goes on from the one before, so what is sent to
    every task has one row per range. Keys are compared NULL-safe.
    """
    pieces = ranged.groupBy(_PART, *keys).agg(piece.alias("__piece"))
    carried = pieces.withColumn("__carried", over("__piece", _before(_PART, *keys))).withColumn(
        "__earlier", F.count("*").over(_before(_PART, *keys))).filter("__earlier > 0")
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    few = F.broadcast(carried.select(F.col(_PART).alias("__in"), *[F.col(k).alias(n) for k, n in names.items()], "__carried"))
    same = F.col(_PART) == F.col("__in")
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return ranged.join(few, same, "left").drop("__in", *names.values())


def ranged_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """`df` stored in ranges of keys and order, for several `carried` values and windows `inside` from one sort."""
    return _by_key(df, keys, order, ranges)


def inside(keys: Sequence[str]):
    """Window over the rows of a key in a range of `ranged_by_key`, up to the current one."""
    return _inside(keys).rowsBetween(W.unboundedPreceding, 0)


def carried(ranged: DataFrame, keys: Sequence[str], piece: Column, over, name: str) -> DataFrame:
    """`ranged` with `name`: `over` (`F.sum`, `F.max`, …) of a key's pieces in the ranges before; NULL where it starts here."""
    met = _continued(ranged, keys, piece, lambda c, window: over(c).over(window))
    return met.withColumnRenamed("__carried", name)


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, ranges: int | None = None
) -> DataFrame:
    """1-based place of each row inside its key; NULL is a key like any other."""
    ranged = _by_key(df, keys, order, ranges)
    met = _continued(ranged, keys, F.count("*"), lambda c, window: F.sum(c).over(window))
    place = F.row_number().over(_inside(keys)) + F.coalesce("__carried", F.lit(0))
    return met.withColumn(name, place.cast("long")).select(*df.columns, name)


def trailing_values(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, width: int, name: str, block: int = 100_000
) -> DataFrame:
    """Array of the up to `width` values before each row of its key, oldest first.

    Rows are cut into blocks of `block` places; each block also receives the last
    `width` rows of the block before it, so a task sees block + width rows at most.
    """
    at = F.col(pos) - 1
    own = F.floor(at / block)
    near_end = (at % block) >= (block - width)
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("__block", F.explode(copies)).withColumn("__own", F.col("__block") == own)
    frame = W.partitionBy(*keys, "__block").orderBy(pos).rowsBetween(-width, -1)
    return (
        spread.withColumn(name, F.collect_list(value).over(frame))
        .filter("__own")
        .drop("__block", "__own")
    )


def _latest(payload: str, window) -> Column:
    return F.last(payload, ignorenulls=True).over(window)


def _running(df, keys, order, payload, name, ranges, over, piece, join) -> DataFrame:
    """Cumulative value per key: a window inside each range, joined with the value of the ranges before it."""
    ranged = _by_key(df, keys, order, ranges)
    met = _continued(ranged, keys, piece(payload), over)
    upto = _inside(keys).rowsBetween(W.unboundedPreceding, 0)
    return met.withColumn(name, join(over(payload, upto), F.col("__carried"))).select(*df.columns, name)


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], payload: str, name: str, ranges: int | None = None,
) -> DataFrame:
    """Latest non-NULL `payload` at or before each row of its key."""
    def piece(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(_AT)))

    return _running(df, keys, order, payload, name, ranges, _latest, piece, F.coalesce)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str, ranges: int | None = None,
) -> DataFrame:
    """Largest `value` at or before each row of its key."""
    def over(c: str, window) -> Column:
        return F.max(c).over(window)

    return _running(df, keys, order, value, name, ranges, over, F.max, F.greatest)


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str, ranges: int | None = None,
) -> DataFrame:
    """`value` of the row before, NULL for the first of a key."""
    ranged = _by_key(df, keys, order, ranges)
    met = _continued(ranged, keys, F.max_by(value, _AT), lambda c, window: F.last(c).over(window))
    first = F.row_number().over(_inside(keys)) == 1
    before = F.when(first, F.col("__carried")).otherwise(F.lag(value).over(_inside(keys)))
    return met.withColumn(name, before).select(*df.columns, name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank: str = "__rank") -> DataFrame:
    """The first `n` rows per key. Spark trims every map task to `n` rows per key
    before the shuffle, so a hot key costs n rows per task."""
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(rank) <= n)
    return kept.drop(rank) if rank.startswith("__") else kept
