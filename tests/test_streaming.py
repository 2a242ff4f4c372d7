from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import silver
from sparkrec.sources import tables
from sparkrec.sources.tables import Table
from sparkrec.streaming import intake, request_metrics as rm, sessions

T0 = datetime(2026, 1, 1)
EVENT = "event_id long, user_id string, product_id string, ts timestamp"


def events(spark, *data):
    """(user, item, seconds)"""
    return spark.createDataFrame([(i, u, p, T0 + timedelta(seconds=s)) for i, (u, p, s) in enumerate(data)], EVENT)


def write_batches(path, *frames):
    """One file per frame, read in this order."""
    import os
    import time

    for i, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{path}/b{i}")
        for name in os.listdir(f"{path}/b{i}"):
            os.utime(f"{path}/b{i}/{name}", (time.time() + i * 10 - 1000,) * 2)


def stream(spark, path, schema, per_trigger=1):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
            .option("recursiveFileLookup", "true").parquet(path))


def drain(df, mode, root):
    def write(batch, batch_id):
        batch.withColumn("b", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/n={batch_id}")

    df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{root}/cp").trigger(
        availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(f"{root}/out").drop("n")


def test_recent_items_keep_and_expire(spark):
    data = [("a", f"i{n}", n) for n in range(30)] + [("b", "old", 0), ("b", "new", 1800)] + [("c", "x", 0), ("c", "y", 1799)]
    got = {r.user_id: r.recent_items for r in sessions.recent_items(events(spark, *data)).collect()}
    assert got == {"a": [f"i{n}" for n in range(10, 30)], "b": ["new"], "c": ["x", "y"]}
    alive = sessions.alive_at(sessions.recent_items(events(spark, *data)), F.lit(T0 + timedelta(seconds=1830)))
    assert {r.user_id for r in alive.collect()} == {"b", "c"}


def test_streamed_lists_equal_the_batch_whatever_the_arrival(spark, tmp_path):
    data = [("hot" if n % 3 == 0 else f"u{n % 7}", f"i{n}", (n * 613) % 20000) for n in range(600)]
    df = events(spark, *data)
    parts = [df.filter(F.col("event_id") % 3 == i) for i in range(3)]  # interleaved: late rows in every batch
    write_batches(str(tmp_path / "in"), *parts)
    live = sessions.recent_items_stream(stream(spark, str(tmp_path / "in"), EVENT), delay="10 hours")
    out = drain(live, "update", str(tmp_path)).groupBy("user_id").agg(F.max_by("recent_items", "b").alias("r"))
    want = {r.user_id: r.recent_items for r in sessions.recent_items(df).collect()}
    assert {r.user_id: r.r for r in out.collect()} == want


def test_expired_lists_come_back_empty(spark, tmp_path):
    write_batches(str(tmp_path / "in"), events(spark, ("a", "x", 0), ("a", "y", 5)),
                  spark.createDataFrame([(99, "zz", "x", T0 + timedelta(days=2))], EVENT),
                  spark.createDataFrame([(100, "zz", "x", T0 + timedelta(days=3))], EVENT))
    out = drain(sessions.recent_items_stream(stream(spark, str(tmp_path / "in"), EVENT)), "update", str(tmp_path))
    mine = out.filter("user_id = 'a'").orderBy("b").collect()
    assert [list(r.recent_items) for r in mine] == [["x", "y"], []]
    assert all((r.expires_at - r.last_ts).total_seconds() == 1800 for r in mine)


def test_sessions_batch_and_stream(spark, tmp_path, rows):
    data = [("a", "x", 0), ("a", "x", 1799), ("a", "x", 1799 + 1800), ("b", "x", 5), ("b", "x", 1790), ("b", "x", 3400)]
    df = events(spark, *data)
    got = rows(sessions.inactivity_sessions(df), "user_id", "events")
    assert got == [("a", 1.0), ("a", 2.0), ("b", 3.0)]
    far = spark.createDataFrame([(99, "zz", "x", T0 + timedelta(days=2))], EVENT)
    write_batches(str(tmp_path / "in"), df, far)
    closed = drain(sessions.inactivity_sessions_stream(stream(spark, str(tmp_path / "in"), EVENT)), "append", str(tmp_path))
    assert rows(closed.filter("user_id <> 'zz'"), "user_id", "events") == got


def test_intake_splits_and_repeats_replace_themselves(spark, tmp_path, rows):
    schema = "event_id long, user_id string, product_id string, event_type string, rating double"
    data = [(1, "u", "p", "view", None), (2, "u", "p", "rating", 4.0), (3, "u", "p", "rating", None), (4, "u", "p", "cart", 3.0),
            (5, "u", "p", "stare", None), (6, "x", "q", "view", None), (7, "u", "p", "rating", 6.0)]
    df = spark.createDataFrame(data, schema)
    users, products = spark.createDataFrame([("u",)], "user_id string"), spark.createDataFrame([("p",)], "product_id string")
    reasons = {r.event_id: r.reasons for r in intake.classify(df, users, products).collect()}
    assert reasons == {1: [], 2: [], 3: ["rating_missing"], 4: ["rating_unexpected"], 5: ["event_type"],
                       6: ["unknown_user", "unknown_product"], 7: ["rating_range"]}
    write_batches(str(tmp_path / "in"), df.filter("event_id < 4"), df.filter("event_id >= 4"))
    for run in ("one", "two"):  # the second run repeats every batch into the same folders
        intake.start_intake(stream(spark, str(tmp_path / "in"), schema), users, products, str(tmp_path / "bronze"),
                            str(tmp_path / "bad"), str(tmp_path / run)).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "bronze")), "event_id") == [(1.0,), (2.0,)]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 5


def test_continuous_upsert_skips_late_versions(spark, tmp_path):
    schema = "interaction_id long, rating double, updated_at timestamp, _ingested_at timestamp"
    columns = ["interaction_id", "rating", "updated_at"]

    def load(at, *entries):
        return spark.createDataFrame(
            [(i, r, T0 + timedelta(minutes=m), T0 + timedelta(minutes=at)) for i, m, r in entries], schema)

    loads = [load(1, (1, 9, 5.0), (2, 1, 1.0)), load(2, (1, 3, 2.0), (3, 1, None)), load(3, (2, 4, 4.0), (3, 1, None))]
    write_batches(str(tmp_path / "in"), *loads)
    table = Table(spark, str(tmp_path / "silver"), "interaction_id")
    intake.start_silver_upsert(stream(spark, str(tmp_path / "in"), schema), table, columns, T0,
                               str(tmp_path / "counters"), str(tmp_path / "cp")).awaitTermination()
    everything = loads[0].unionByName(loads[1]).unionByName(loads[2])
    full = silver.latest_by_key(everything, ["interaction_id"], columns)
    assert tuple(silver.difference_counts(table.read(), full).first()) == (0, 0)
    counters = spark.read.parquet(str(tmp_path / "counters")).orderBy("batch_id").collect()
    assert [r.stale for r in counters] == [0, 1, 1] and [r.inserted for r in counters] == [2, 1, 0]
    before = silver.digest(table.read()).first()
    intake.upsert_batch(loads[2], 2, table, columns, T0, str(tmp_path / "counters"))
    assert silver.digest(table.read()).first() == before


def test_upsert_reads_a_batch_once_and_does_not_store_it(spark, tmp_path, monkeypatch):
    schema = "interaction_id long, rating double, updated_at timestamp, _ingested_at timestamp"
    table = Table(spark, str(tmp_path / "silver"), "interaction_id", buckets=4)
    batches = [spark.createDataFrame([(i, float(n), T0 + timedelta(minutes=(i * n) % 5), T0) for i in range(30)], schema) for n in (1, 2, 3)]
    stored = []
    monkeypatch.setattr(tables, "durable", stored.append)
    for n, batch in enumerate(batches):
        intake.upsert_batch(batch, n, table, batch.columns, T0, str(tmp_path / "counters"), order=("updated_at", "rating"))
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    full = silver.latest_by_key(everything, ["interaction_id"], batches[0].columns, ("rating",))
    assert not stored and tuple(silver.difference_counts(table.read(), full).first()) == (0, 0)


def log(spark, *data):
    """(seconds, path, status, latency, cache)"""
    return spark.createDataFrame([(T0 + timedelta(seconds=s), *r) for s, *r in data], "ts timestamp, path string, status int, latency double, cache string")


def test_sliding_metrics(spark):
    df = log(spark, (0, "/h", 200, 0.02, "hit"), (10, "/h", 500, 0.3, "miss"), (50, "/h", 200, 20.0, None), (70, "/s", 200, 0.001, "hit"))
    by_path = {(r.window_start, r.path): r for r in rm.request_rate(rm.sliding(df, 60, ["path"]), 60).collect()}
    assert by_path[T0, "/h"].rate == pytest.approx(3 / 60) and by_path[T0 - timedelta(seconds=45), "/h"].requests == 2
    assert len([k for k in by_path if k[1] == "/s"]) == 4
    total = {r.window_start: r for r in rm.cache_hit_ratio(rm.error_ratio(rm.sliding(df, 300, []))).collect()}
    assert total[T0].error_ratio == 0.25 and total[T0].hit_ratio == pytest.approx(2 / 3)
    late = total[T0 + timedelta(seconds=45)]
    assert late.hit_ratio == 1.0 and late.error_ratio == 0.0
    q = {r.window_start: r.p for r in rm.latency_quantile(rm.sliding(df, 60, ["path"]).filter("path = '/h'"), 0.5, "p").collect()}
    assert q[T0] == pytest.approx(0.25 + 0.25 * 0.5)  # rank 1.5 lies half way into (0.25, 0.5]
    tail = rm.latency_quantile(rm.sliding(df, 60, ["path"]).filter("path = '/h'"), 0.95, "p").collect()
    assert {r.p for r in tail if r.window_start == T0} == {10.0}


def test_streamed_windows_equal_the_batch(spark, tmp_path, rows):
    data = [(n * 7 % 400, f"/{n % 3}", 200 if n % 5 else 500, n / 100, "hit" if n % 2 else "miss") for n in range(300)]
    df, schema = log(spark, *data), "ts timestamp, path string, status int, latency double, cache string"
    write_batches(str(tmp_path / "in"), df, log(spark, (99999, "/end", 200, 0.1, None)))
    closed = drain(rm.sliding_stream(stream(spark, str(tmp_path / "in"), schema), 60, ["path"]), "append", str(tmp_path))
    want = rm.sliding(df, 60, ["path"])
    names = sorted(want.columns)
    assert rows(closed.filter("path <> '/end'"), *names) == rows(want, *names)


def test_repeats_are_dropped(spark, tmp_path):
    df = events(spark, ("a", "x", 0), ("a", "y", 1))
    write_batches(str(tmp_path / "in"), df, df)
    once = intake.drop_repeats(stream(spark, str(tmp_path / "in"), EVENT), ["event_id"], "ts", "1 hour")
    assert drain(once, "append", str(tmp_path)).count() == 2


def test_enrich_stream_with_history(spark, tmp_path):
    history = spark.createDataFrame([("a", [f"h{i}" for i in range(10)])], "user_id string, item_sequence array<string>")
    write_batches(str(tmp_path / "in"), events(spark, ("a", "x", 0), ("b", "y", 1)))
    live = sessions.recent_items_stream(stream(spark, str(tmp_path / "in"), EVENT))
    got = {r.user_id: r["items"] for r in drain(intake.enrich_recent(live, history), "update", str(tmp_path)).collect()}
    assert got == {"a": [f"h{i}" for i in range(1, 10)] + ["x"], "b": ["y"]}


def test_enrich_stream_computes_histories_once(spark, monkeypatch):
    from oracle import SMALL
    from sparkrec.plans import inputs
    from sparkrec.plans.catalog import QUERIES

    computed = spark.sparkContext.accumulator(0)

    def counted(user):
        computed.add(1)
        return user

    plain = inputs.user_sequences
    users = plain(spark, SMALL).count()
    monkeypatch.setattr(inputs, "user_sequences", lambda *a: plain(*a).withColumn(
        "user_id", F.udf(counted, "string").asNondeterministic()("user_id")))
    assert QUERIES["k9_enrich_stream"](spark, SMALL).count() > 0
    assert computed.value == users
