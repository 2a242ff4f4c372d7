"""Sliding request metrics: rate, p95 latency, error ratio, cache hit ratio.

All of them are sums, so a batch first reduces the log to one row per slide-long
pane and path; windows are put together from panes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Upper bounds of the latency buckets, in seconds; beyond the last is +Inf.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
SLIDE = 15
N_BUCKETS = len(LATENCY_BOUNDS) + 1


def counters() -> list[Column]:
    """Sums over a request log with ts, path, status, latency (seconds), cache (hit/miss/NULL)."""
    latency = F.col("latency")
    bounds = (None, *LATENCY_BOUNDS, None)
    buckets = []
    for i in range(N_BUCKETS):
        low, high = bounds[i], bounds[i + 1]
        inside = F.lit(True)
        if low is not None:
            inside = inside & (latency > low)
        if high is not None:
            inside = inside & (latency <= high)
        buckets.append(F.count_if(inside).alias(f"b{i}"))
    return [
        F.count("*").alias("requests"),
        F.count_if(F.col("status") >= 500).alias("errors"),
        F.count_if(F.col("cache") == "hit").alias("hits"),
        F.count("cache").alias("lookups"),
        *buckets,
    ]


def _names() -> list[str]:
    return ["requests", "errors", "hits", "lookups", *[f"b{i}" for i in range(N_BUCKETS)]]


def sliding(log: DataFrame, seconds: int, by: list[str], slide: int = SLIDE) -> DataFrame:
    """Counters per window of `seconds`, one window per `slide` seconds: (window_start, by…)."""
    pane = F.window("ts", f"{slide} seconds").alias("pane")
    panes = log.groupBy(pane, *by).agg(*counters())
    back = F.sequence(F.lit(0), F.lit(seconds // slide - 1))
    windows = panes.withColumn("back", F.explode(back)).withColumn(
        "window_start", F.col("pane.start") - F.make_dt_interval(secs=(F.col("back") * slide).cast("decimal(18,6)"))
    )
    return windows.groupBy("window_start", *by).agg(*[F.sum(c).alias(c) for c in _names()])


def sliding_stream(log: DataFrame, seconds: int, by: list[str], slide: int = SLIDE,
                   delay: str = "1 minute") -> DataFrame:
    """The same counters over a stream, closed windows only (append mode)."""
    timed = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    window = F.window("ts", f"{seconds} seconds", f"{slide} seconds").alias("w")
    return timed.groupBy(window, *by).agg(*counters()).select(
        F.col("w.start").alias("window_start"), *by, *_names()
    )


def request_rate(windows: DataFrame, seconds: int) -> DataFrame:
    return windows.withColumn("rate", F.col("requests") / seconds)


def error_ratio(windows: DataFrame) -> DataFrame:
    return windows.withColumn("error_ratio", F.try_divide("errors", "requests"))


def cache_hit_ratio(windows: DataFrame) -> DataFrame:
    return windows.withColumn("hit_ratio", F.try_divide("hits", "lookups"))


def latency_quantile(windows: DataFrame, q: float, name: str) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket that holds the rank.

    Beyond the last finite bound the bound itself is returned; no traffic gives NULL.
    """
    rank = F.col("requests") * F.lit(q)
    lows = (0.0, *LATENCY_BOUNDS)
    value = F.lit(None).cast("double")
    for i in reversed(range(N_BUCKETS)):
        upto = sum((F.col(f"b{j}") for j in range(1, i + 1)), F.col("b0"))
        before = upto - F.col(f"b{i}")
        if i == N_BUCKETS - 1:
            inside = F.lit(lows[i])
        else:
            inside = lows[i] + (LATENCY_BOUNDS[i] - lows[i]) * F.try_divide(rank - before, F.col(f"b{i}"))
        value = F.when(upto >= rank, inside).otherwise(value)
    return windows.withColumn(name, F.when(F.col("requests") > 0, value))
