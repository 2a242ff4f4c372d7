from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkrec.session import ship_package
from sparkrec.sources import sinks
from sparkrec.sources.store import FileStore, push_lookup

AT = datetime(2026, 1, 1)
FILES = "sparkrec.sources.store.FileStore"


def lookup(spark, n, tag):
    df = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.array(F.lit(tag)).alias("v"))
    return sinks.keyed_lookup(df, "k", "v", AT, 7)


@pytest.fixture()
def place(spark, tmp_path):
    ship_package(spark)
    return str(tmp_path / "store")


def test_published_run_is_read_until_it_expires(spark, place):
    store = FileStore(place)
    assert store.read(AT) == {}
    push_lookup(lookup(spark, 50, "a").repartition(5), FILES, place, "r1")
    assert store.read(AT + timedelta(days=6)) == {f"k{i}": '["a"]' for i in range(50)}
    assert store.read(AT + timedelta(days=7)) == {}
    push_lookup(lookup(spark, 3, "b"), FILES, place, "r2")
    assert store.read(AT) == {f"k{i}": '["b"]' for i in range(3)}


def test_repeated_runs_and_tasks_replace_themselves(spark, place):
    for n in (40, 9):
        push_lookup(lookup(spark, n, "a").repartition(4), FILES, place, "r1")
    assert set(FileStore(place).read(AT)) == {f"k{i}" for i in range(9)}
    store = FileStore(place)
    for _ in range(2):  # a task that runs twice
        store.stage("r9", 0, iter([("x", "1", None), ("y", "2", None)]))
    store.publish("r9", [0])
    assert store.read(AT) == {"x": "1", "y": "2"}


def test_failed_tasks_leave_no_half_rows(spark, place):
    push_lookup(lookup(spark, 5, "a"), FILES, place, "r1")
    broken = lookup(spark, 5000, "b").repartition(6).withColumn(
        "value", F.when(F.col("key") == "k4321", F.raise_error("lost").cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        push_lookup(broken, FILES, place, "r2")
    assert FileStore(place).read(AT) == {f"k{i}": '["a"]' for i in range(5)}
    import os
    assert not [f for f in os.listdir(f"{place}/runs/r2") if f.endswith(".jsonl")] if os.path.exists(f"{place}/runs/r2") else True


def test_missing_options_are_refused(spark, place):
    with pytest.raises(Exception, match="missing"):
        push_lookup(lookup(spark, 1, "a"), FILES, place, "")


def test_late_tasks_of_a_dropped_run_leave_nothing(spark, place):
    store = FileStore(place)
    store.stage("r3", 0, iter([("x", "1", None)]))
    store.drop("r3")
    store.stage("r3", 1, iter([("y", "2", None)]))  # a task that the abort did not wait for
    assert not list(store.root.glob("runs/r3/*.jsonl"))
    push_lookup(lookup(spark, 3, "a"), FILES, place, "r3")  # the run is repeated
    assert set(store.read(AT)) == {"k0", "k1", "k2"}
