"""Intake, session signals, request metrics and continuous upserts, as batches and as streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sparkrec.plans import inputs as I, ranking_queries as R
from sparkrec.plans.inputs import with_
from sparkrec.plans.registry import query
from sparkrec.session import scratch_dir
from sparkrec.sources.tables import Table
from sparkrec.streaming import intake, request_metrics as rm, sessions


def raw_stream(spark, sf, name: str = "events") -> DataFrame:
    """The given table as a file stream."""
    schema = I.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def drain(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there and return what it wrote."""
    root = scratch_dir(stream.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    stream.writeStream.foreachBatch(write).outputMode(mode).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{root}/out").drop("batch")


def _users(spark, sf):
    return I.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"))


LABELLED = """labelled AS (SELECT event_id, concat_ws(',',
    CASE WHEN event_type NOT IN ('view', 'cart', 'purchase', 'rating') THEN 'event_type' END,
    CASE WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating_range' END,
    CASE WHEN event_type = 'rating' AND rating IS NULL THEN 'rating_missing' END,
    CASE WHEN event_type <> 'rating' AND rating IS NOT NULL THEN 'rating_unexpected' END,
    CASE WHEN user_id NOT IN (SELECT 'u' || CAST(c_custkey AS VARCHAR) FROM customer) THEN 'unknown_user' END,
    CASE WHEN product_id NOT IN (SELECT product_id FROM products) THEN 'unknown_product' END) AS reasons FROM stream)"""


@query("k1_intake", with_(I.EVENTS, I.PRODUCTS, LABELLED) + "SELECT event_id, reasons FROM labelled")
def _(spark, sf):
    labelled = intake.classify(I.events(spark, sf), _users(spark, sf), I.products(spark, sf))
    return labelled.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query("k1_intake_stream", with_(I.EVENTS, I.PRODUCTS, LABELLED) + """
SELECT CASE WHEN reasons = '' THEN 'bronze' ELSE 'quarantine' END AS sink, event_id FROM labelled""")
def _(spark, sf):
    root = scratch_dir(spark)
    stream = I.events(spark, sf, raw_stream(spark, sf))
    intake.start_intake(stream, _users(spark, sf), I.products(spark, sf), f"{root}/bronze", f"{root}/quarantine",
                        f"{root}/checkpoint").awaitTermination()
    good, bad = spark.read.parquet(f"{root}/bronze"), spark.read.parquet(f"{root}/quarantine")
    return good.select(F.lit("bronze").alias("sink"), "event_id").unionByName(
        bad.select(F.lit("quarantine").alias("sink"), "event_id"))


RECENT_SQL = with_(I.EVENTS, R.RECENT)


@query("k2_recent_items", RECENT_SQL + """
SELECT user_id, array_to_string(recent_items, ',') AS recent_items, last_ts, last_ts + INTERVAL 1800 SECOND AS expires_at FROM recents""")
def _(spark, sf):
    return sessions.recent_items(I.events(spark, sf)).withColumn("recent_items", F.array_join("recent_items", ","))


@query("k2_recent_items_stream", RECENT_SQL + """
SELECT user_id, array_to_string(recent_items, ',') AS recent_items, last_ts FROM recents""")
def _(spark, sf):
    live = drain(sessions.recent_items_stream(I.events(spark, sf, raw_stream(spark, sf))), "update")
    lists = live.filter(F.size("recent_items") > 0)  # expired lists come back empty
    newest = lists.groupBy("user_id").agg(F.max_by("recent_items", "last_ts").alias("recent_items"), F.max("last_ts").alias("last_ts"))
    return newest.select("user_id", F.array_join("recent_items", ",").alias("recent_items"),
                         F.col("last_ts").cast("timestamp_ntz").alias("last_ts"))


SESSIONS = with_(I.EVENTS, """
marked AS (SELECT *, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) < 1800000000 THEN 0 ELSE 1 END AS opens
  FROM stream WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked),
closed AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS last_ts, COUNT(*) AS events FROM numbered GROUP BY user_id, session)""")


@query("k3_sessions", SESSIONS + "SELECT * FROM closed")
def _(spark, sf):
    return sessions.inactivity_sessions(I.events(spark, sf))


@query("k3_sessions_stream", SESSIONS + """
SELECT user_id, session_start, last_ts, events FROM closed
WHERE last_ts + INTERVAL 1799999999 MICROSECOND <= date_trunc('millisecond', (SELECT MAX(ts) FROM stream)) - INTERVAL 10 MINUTE""")
def _(spark, sf):
    out = drain(sessions.inactivity_sessions_stream(I.events(spark, sf, raw_stream(spark, sf))), "append")
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), "events")


def windows_sql(seconds: int, by: str = "", where: str = "TRUE") -> str:
    key = f", {by}" if by else ""
    return f"""win AS (SELECT window_start{key}, COUNT(*) AS requests, COUNT(*) FILTER (WHERE status >= 500) AS errors,
    COUNT(*) FILTER (WHERE cache = 'hit') AS hits, COUNT(cache) AS lookups, list(latency) AS latencies FROM
  (SELECT *, time_bucket(INTERVAL 15 SECOND, ts) - to_seconds(15 * unnest(range(0, {seconds // rm.SLIDE}))) AS window_start FROM requests)
  GROUP BY window_start{key})"""


def _log(spark, sf):
    return I.request_log(spark, sf)


def _start(df):
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("k4_request_rate", with_(I.REQUESTS, windows_sql(60, "path")) + """
SELECT window_start, path, round(requests / 60, 6) AS rate FROM win""")
def _(spark, sf):
    out = rm.request_rate(rm.sliding(_log(spark, sf), 60, ["path"]), 60)
    return _start(out.select("window_start", "path", F.round("rate", 6).alias("rate")))


@query("k4_request_rate_stream", with_(I.REQUESTS, windows_sql(60, "path")) + """
SELECT window_start, path, round(requests / 60, 6) AS rate FROM win
WHERE window_start + INTERVAL 60 SECOND <= date_trunc('millisecond', (SELECT MAX(ts) FROM requests)) - INTERVAL 1 MINUTE""")
def _(spark, sf):
    closed = drain(rm.sliding_stream(I.request_log(spark, sf, raw_stream(spark, sf)), 60, ["path"]), "append")
    out = rm.request_rate(closed, 60)
    return _start(out.select("window_start", "path", F.round("rate", 6).alias("rate")))


BOUNDS = ", ".join(str(b) for b in rm.LATENCY_BOUNDS)


P95 = f"""
cum AS (SELECT window_start, path, requests, b, i, len(list_filter(latencies, lambda x: x <= b)) AS upto
  FROM (SELECT *, unnest([{BOUNDS}]) AS b, unnest(range(1, {len(rm.LATENCY_BOUNDS) + 1})) AS i FROM win)),
steps AS (SELECT *, lag(upto, 1, 0) OVER w AS before, lag(b, 1, 0.0) OVER w AS low FROM cum WINDOW w AS (PARTITION BY window_start, path ORDER BY i)),
quantiles AS (SELECT window_start, path, round(COALESCE(arg_min(low + (b - low) * (requests * 0.95 - before) / (upto - before), i)
  FILTER (WHERE upto >= requests * 0.95), {rm.LATENCY_BOUNDS[-1]}), 6) AS p95 FROM steps GROUP BY window_start, path)"""
# windows that the watermark has passed when the stream has read everything
CLOSED = """
WHERE window_start + INTERVAL 300 SECOND <= date_trunc('millisecond', (SELECT MAX(ts) FROM requests)) - INTERVAL 1 MINUTE"""


def closed_windows(spark, sf, by: list[str], measure) -> DataFrame:
    """A measure of five-minute windows, computed on the stream; closed windows only."""
    stream = rm.sliding_stream(I.request_log(spark, sf, raw_stream(spark, sf)), 300, by)
    return drain(measure(stream), "append")


@query("k5_latency_p95", with_(I.REQUESTS, windows_sql(300, "path"), P95) + "SELECT * FROM quantiles")
def _(spark, sf):
    out = rm.latency_quantile(rm.sliding(_log(spark, sf), 300, ["path"]), 0.95, "p95")
    return _start(out.select("window_start", "path", F.round("p95", 6).alias("p95")))


@query("k6_error_ratio", with_(I.REQUESTS, windows_sql(300)) + """
SELECT window_start, round(errors / requests, 6) AS error_ratio FROM win""")
def _(spark, sf):
    out = rm.error_ratio(rm.sliding(_log(spark, sf), 300, []))
    return _start(out.select("window_start", F.round("error_ratio", 6).alias("error_ratio")))


@query("k7_cache_hit_ratio", with_(I.REQUESTS, windows_sql(300)) + """
SELECT window_start, round(hits / nullif(lookups, 0), 6) AS hit_ratio FROM win""")
def _(spark, sf):
    out = rm.cache_hit_ratio(rm.sliding(_log(spark, sf), 300, []))
    return _start(out.select("window_start", F.round("hit_ratio", 6).alias("hit_ratio")))


@query("k5_latency_p95_stream", with_(I.REQUESTS, windows_sql(300, "path"), P95) + "SELECT * FROM quantiles" + CLOSED)
def _(spark, sf):
    out = closed_windows(spark, sf, ["path"], lambda w: rm.latency_quantile(w, 0.95, "p95"))
    return _start(out.select("window_start", "path", F.round("p95", 6).alias("p95")))


@query("k6_error_ratio_stream", with_(I.REQUESTS, windows_sql(300)) + """
SELECT window_start, round(errors / requests, 6) AS error_ratio FROM win""" + CLOSED)
def _(spark, sf):
    out = closed_windows(spark, sf, [], rm.error_ratio)
    return _start(out.select("window_start", F.round("error_ratio", 6).alias("error_ratio")))


@query("k7_cache_hit_ratio_stream", with_(I.REQUESTS, windows_sql(300)) + """
SELECT window_start, round(hits / nullif(lookups, 0), 6) AS hit_ratio FROM win""" + CLOSED)
def _(spark, sf):
    out = closed_windows(spark, sf, [], rm.cache_hit_ratio)
    return _start(out.select("window_start", F.round("hit_ratio", 6).alias("hit_ratio")))


@query("k8_stream_upsert", with_(I.BRONZE, I.SILVER) + "SELECT * FROM silver")
def _(spark, sf):
    root = scratch_dir(spark)
    bronze = I.bronze_interactions(spark, sf)
    # loads arrive one file set at a time, so later ones bring late and older versions
    bronze.repartition("_extraction_run_id").write.partitionBy("_extraction_run_id").parquet(f"{root}/loads")
    source = spark.read.parquet(f"{root}/loads")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/loads")
    target = Table(spark, f"{root}/silver", "interaction_id", buckets=8)
    intake.start_silver_upsert(
        stream, target, [*I.SILVER_COLUMNS, "_ingested_at"], datetime(2026, 1, 2), f"{root}/counters", f"{root}/checkpoint",
        I.TIES, order=("updated_at", "_ingested_at", *I.TIES)).awaitTermination()
    return target.read().select(*I.SILVER_COLUMNS)


@query("k9_enrich", with_(I.BRONZE, I.SILVER, I.USERS, I.EVENTS, R.RECENT) + """
SELECT user_id, array_to_string(j[greatest(1, len(j) - 9):], ',') AS items, array_to_string(recent_items, ',') AS recent_items
FROM (SELECT user_id, recent_items, list_concat(COALESCE(item_sequence, []), recent_items) AS j FROM recents LEFT JOIN users USING (user_id))""")
def _(spark, sf):
    out = intake.enrich_recent(R.recents(spark, sf), I.user_sequences(spark, sf))
    return out.select("user_id", F.array_join("items", ",").alias("items"), F.array_join("recent_items", ",").alias("recent_items"))


@query("k9_enrich_stream", with_(I.BRONZE, I.SILVER, I.USERS, I.EVENTS, R.RECENT) + """
SELECT user_id, array_to_string(j[greatest(1, len(j) - 9):], ',') AS items
FROM (SELECT user_id, list_concat(COALESCE(item_sequence, []), recent_items) AS j FROM recents LEFT JOIN users USING (user_id))""")
def _(spark, sf):
    live = sessions.recent_items_stream(I.events(spark, sf, raw_stream(spark, sf)))
    lists = live.filter(F.size("recent_items") > 0)  # the SQL knows no expiry
    # every batch looks histories up; they are computed once, before the stream starts
    merged = drain(intake.enrich_recent(lists, I.user_table(spark, sf)), "update")
    newest = merged.groupBy("user_id").agg(F.max_by("items", "last_ts").alias("items"))
    return newest.select("user_id", F.array_join("items", ",").alias("items"))
