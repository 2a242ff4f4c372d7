from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import contracts, ingest, maintenance, silver
from sparkrec.session import scratch_dir
from sparkrec.sources.tables import Table, sync_silver

BASE = datetime(2026, 11, 1)
COLUMNS = ["interaction_id", "rating", "updated_at"]
SCHEMA = "interaction_id long, rating double, updated_at timestamp, _ingested_at timestamp"


def load(spark, *loads):
    """loads = (ingest minute, [(id, updated minute, rating)])."""
    rows = [
        (i, r, BASE + timedelta(minutes=m), BASE + timedelta(minutes=at))
        for at, entries in loads for i, m, r in entries
    ]
    return spark.createDataFrame(rows, SCHEMA)


class Pipe:
    def __init__(self, spark):
        self.spark, self.table, self.loads = spark, Table(spark, scratch_dir(spark)), []

    def run(self, *loads, **options):
        self.loads += loads
        return sync_silver(load(self.spark, *self.loads), self.table, "interaction_id", COLUMNS, BASE, **options)

    def ratings(self):
        return {r.interaction_id: r.rating for r in self.table.read().collect()}


@pytest.fixture()
def pipe(spark):
    return Pipe(spark)


def test_first_run_is_full_and_keeps_newest(pipe):
    report = pipe.run((10, [(1, 1, 4.0), (2, 1, 4.0)]), (20, [(2, 5, 2.0), (3, 1, 4.0)]))
    assert report["mode"] == "full" and report["rows_inserted"] == 3
    assert pipe.ratings() == {1: 4.0, 2: 2.0, 3: 4.0}
    assert report["watermark_after"] == "2026-11-01T00:20:00.000000+00:00"


def test_no_new_data_commits_nothing(pipe):
    pipe.run((10, [(1, 1, 4.0)]))
    commit = pipe.table.state().commit
    report = pipe.run()
    assert (report["mode"], report["rows_scanned"]) == ("incremental", 0)
    assert pipe.table.state().commit == commit


def test_insert_only(pipe):
    pipe.run((10, [(1, 1, 4.0), (2, 1, 4.0)]))
    report = pipe.run((20, [(3, 1, 4.0)]))
    assert (report["rows_inserted"], report["rows_updated"], report["rows_scanned"]) == (1, 0, 1)


def test_newer_version_updates(pipe):
    pipe.run((10, [(1, 1, 3.0)]))
    report = pipe.run((20, [(1, 9, 5.0)]))
    assert (report["rows_inserted"], report["rows_updated"]) == (0, 1)
    assert pipe.ratings() == {1: 5.0}


def test_stale_version_is_skipped(pipe):
    pipe.run((10, [(1, 9, 5.0)]))
    report = pipe.run((20, [(1, 2, 1.0), (2, 1, 4.0)]))
    assert (report["rows_skipped_stale"], report["rows_inserted"]) == (1, 1)
    assert pipe.ratings() == {1: 5.0, 2: 4.0}


def test_all_stale_moves_only_the_watermark(pipe):
    pipe.run((10, [(1, 9, 5.0)]))
    before = pipe.table.state()
    report = pipe.run((20, [(1, 2, 1.0)]))
    after = pipe.table.state()
    assert report["rows_upserted"] == 0 and after.version == before.version and after.watermark > before.watermark


def test_duplicates_inside_a_delta(pipe):
    pipe.run((10, [(1, 1, 4.0)]))
    pipe.run((20, [(1, 3, 2.0), (1, 7, 4.0)]), (21, [(2, 5, 1.0)]), (22, [(2, 5, 3.0)]))
    assert pipe.ratings() == {1: 4.0, 2: 3.0}


def test_incremental_equals_full_refresh_after_every_load(spark, pipe):
    loads = [
        (10, [(i, 1, 4.0) for i in range(1, 6)]), (20, [(2, 4, None), (6, 1, 4.0)]), (30, [(3, 0, 1.0)]),
        (40, [(4, 8, 4.0), (4, 9, 5.0), (7, 2, 4.0)]), (50, [(2, 4, None)]), (60, [(1, 3, None), (8, 1, None)]),
    ]
    for entry in loads:
        pipe.run(entry)
        full = silver.latest_by_key(load(spark, *pipe.loads), ["interaction_id"], COLUMNS)
        counts = silver.difference_counts(pipe.table.read(), full).first()
        assert (counts.only_left, counts.only_right) == (0, 0)
        assert silver.digest(pipe.table.read()).first() == silver.digest(full).first()
    assert pipe.ratings()[2] is None


def test_identical_row_with_null_is_no_update(spark):
    rows = load(spark, (10, [(1, 1, None)])).select(*COLUMNS)
    newer = rows.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 MINUTE"))
    same = silver.change_counts(silver.merge(rows, rows, "interaction_id", silver.NEWEST_INGEST)).first()
    assert (same.rows_inserted, same.rows_updated) == (0, 0)
    assert silver.change_counts(silver.merge(rows, newer, "interaction_id")).first().rows_updated == 1


def test_equal_update_time_needs_the_option(spark):
    for ties, expected in ((silver.KEEP_STORED, 1.0), (silver.NEWEST_INGEST, 3.0)):
        p = Pipe(spark)
        p.run((10, [(1, 5, 1.0)]))
        report = p.run((20, [(1, 5, 3.0)]), ties=ties)
        assert p.ratings() == {1: expected}
        assert report["rows_skipped_stale"] == (1 if expected == 1.0 else 0)


def test_failed_run_changes_nothing(pipe, monkeypatch):
    pipe.run((10, [(1, 1, 4.0)]))
    before = pipe.table.state()

    def broken(*_a, **_k):
        raise RuntimeError("lost")

    monkeypatch.setattr(Table, "_commit", broken)
    with pytest.raises(RuntimeError):
        pipe.run((20, [(2, 1, 4.0)]))
    monkeypatch.undo()
    assert pipe.table.state() == before and pipe.ratings() == {1: 4.0}
    assert pipe.run()["rows_inserted"] == 1


def test_full_refresh_resets(pipe):
    pipe.run((10, [(1, 5, 1.0)]))
    report = pipe.run((20, [(1, 5, 3.0)]), full_refresh=True)
    assert report["mode"] == "full" and pipe.ratings() == {1: 3.0}


def test_drop_stale_keeps_new_and_newer(spark, rows):
    stored = load(spark, (10, [(1, 5, 1.0), (2, 5, 1.0)])).select(*COLUMNS)
    delta = load(spark, (20, [(1, 6, 2.0), (2, 5, 2.0), (3, 0, 2.0)])).select(*COLUMNS)
    assert rows(silver.drop_stale(delta, stored, "interaction_id"), "interaction_id") == [(1.0,), (3.0,)]


def test_skip_committed_second_run_adds_nothing(spark, rows):
    loads = spark.createDataFrame([("run-a", 1), ("run-b", 2)], "_extraction_run_id string, v int")
    committed = loads.filter("_extraction_run_id = 'run-a'")
    fresh = ingest.skip_committed(loads, committed)
    assert rows(fresh, "_extraction_run_id") == [("run-b",)]
    assert ingest.skip_committed(loads, loads).count() == 0


def test_compaction_keeps_rows_and_watermark(spark, pipe):
    pipe.run((10, [(i, 1, 4.0) for i in range(50)]))
    table = pipe.table
    table.overwrite(table.read().repartition(6), BASE)
    mark, before = table.state().watermark, silver.digest(table.read()).first()
    assert table.file_count() > 1 and table.compact(BASE)
    assert table.file_count() == 1 and table.state().watermark == mark
    assert silver.digest(table.read()).first() == before
    assert not table.compact(BASE)
    table.overwrite(table.read().repartition(6), BASE)
    assert table.compact(BASE, file_bytes=table.files()[1] // 3) and 1 < table.file_count() < 6


def test_compaction_counts_files_by_what_sorted_rows_take(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    key = F.pmod(F.xxhash64("id"), F.lit(20_000))
    table.overwrite(spark.range(80_000).select(key.alias("key"), F.concat(F.lit("u"), key.cast("string")).alias("user")).repartition(4), BASE)
    before, (files, size) = silver.digest(table.read()).first(), table.files()
    assert files == 4 and table.compact(BASE, file_bytes=size // 2)
    assert table.file_count() == 1 and silver.digest(table.read()).first() == before
    assert not table.compact(BASE, file_bytes=size // 2)


def test_expired_files_are_those_of_expired_snapshots_only(spark, rows):
    snapshots = spark.createDataFrame(
        [(1, BASE, False), (2, BASE + timedelta(days=1), True), (3, BASE + timedelta(days=9), False),
         (4, BASE + timedelta(days=20), True)], "snapshot_id int, committed_at timestamp, is_ref boolean")
    files = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "b"), (3, "c"), (3, "d"), (4, "d")], "snapshot_id int, path string")
    cutoff = F.lit(BASE + timedelta(days=10))
    assert rows(maintenance.expired_files(snapshots, files, cutoff)) == [("a",), ("c",)]
    assert rows(maintenance.expired_files(snapshots, files, F.lit(BASE))) == []


def test_contract_reports_everything_at_once(spark):
    contract = contracts.SILVER_INTERACTIONS
    good = (1, "u", "p", "view", None, BASE, BASE, BASE)
    schema = "interaction_id long, user_id string, product_id string, event_type string, rating string, event_time timestamp, created_at timestamp, updated_at timestamp"
    bad = [good, (1, None, "p", "stare", "9", BASE, BASE, BASE), (2, "u", "p", "rating", "x", BASE, BASE, BASE)]
    with pytest.raises(contracts.ContractError) as caught:
        contracts.validate(spark.createDataFrame(bad, schema), contract)
    text = " ".join(caught.value.problems)
    for part in ("interaction_id: unique", "user_id: not_null", "event_type: one_of", "rating: in_range", "rating: type"):
        assert part in text
    ok = contracts.validate(spark.createDataFrame([good], schema), contract)
    assert ok.schema["rating"].dataType.simpleString() == "decimal(2,1)"
    with pytest.raises(contracts.ContractError) as caught:
        contracts.validate(spark.createDataFrame([good], schema).drop("user_id").withColumn("extra", F.lit(1)), contract)
    assert len(caught.value.problems) == 2
    good_rows, rejected = contracts.split_valid(spark.createDataFrame(bad, schema), contract)
    assert good_rows.count() == 1 and rejected.count() == 2


def test_unknown_reference_fails_the_job(spark):
    df = spark.createDataFrame([("a",), ("b",)], "item string")
    known = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(Exception, match="missing from id"):
        contracts.require_references(df, "item", known, "id").collect()
    assert contracts.require_references(df.filter("item = 'a'"), "item", known, "id").count() == 1


def bucket_files(table):
    """{bucket: (version, files)} of the current version."""
    from pathlib import Path

    parts = table.state().parts
    return {b: (v, sorted(p.name for p in Path(table.root, "data", f"v={v}", f"__bucket={b}").glob("*.parquet")))
            for b, v in enumerate(parts) if v}


def test_a_small_delta_rewrites_only_its_bucket(spark, pipe):
    pipe.run((10, [(i, 1, 4.0) for i in range(500)]))
    table = pipe.table
    before, first = bucket_files(table), table.read()
    assert len(before) == 64 and {v for v, _ in before.values()} == {1}
    pipe.run((20, [(7, 9, 1.0)]))
    after = bucket_files(table)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and after[changed[0]][0] == 2
    # the written version holds that bucket alone, with the rows that share it
    import os
    assert os.listdir(f"{table.root}/data/v=2").count(f"__bucket={changed[0]}") == 1
    assert sum(n.startswith("__bucket=") for n in os.listdir(f"{table.root}/data/v=2")) == 1
    assert pipe.ratings() == {i: 1.0 if i == 7 else 4.0 for i in range(500)} and table.state().rows == 500
    assert {r.rating for r in first.collect()} == {4.0}  # readers of the version before are not disturbed
    assert {r.rating for r in table.read(1).collect()} == {4.0}


def test_merge_reads_only_touched_buckets(spark, pipe):
    pipe.run((10, [(i, 1, 4.0) for i in range(500)]))
    table = pipe.table
    parts = table.state().parts
    some = table._read_parts(parts, [3, 5])
    from dataclasses import replace
    keyed = replace(table, key="interaction_id")
    assert {r[0] for r in some.select(keyed.bucket_of()).distinct().collect()} == {3, 5}
    assert len(some.inputFiles()) == 2 < len(table.read().inputFiles())


def test_new_keys_fill_empty_buckets(spark, pipe):
    pipe.run((10, [(1, 1, 4.0)]))
    assert len(bucket_files(pipe.table)) == 1
    pipe.run((20, [(i, 1, 2.0) for i in range(2, 9)]))
    assert pipe.ratings() == {1: 4.0, **{i: 2.0 for i in range(2, 9)}} and pipe.table.state().rows == 8


def test_repeated_keys_in_a_delta_fail_the_merge(spark, pipe):
    pipe.run((10, [(1, 1, 4.0)]))
    before = pipe.table.state()
    twice = load(spark, (20, [(2, 5, 1.0), (2, 6, 2.0)])).select(*COLUMNS)
    from dataclasses import replace
    with pytest.raises(Exception, match="not unique"):
        replace(pipe.table, key="interaction_id").merge(twice, BASE)
    assert pipe.table.state() == before and pipe.ratings() == {1: 4.0}
    with pytest.raises(Exception, match="not unique"):
        silver.merge(pipe.table.read(), twice, "interaction_id").collect()


def test_empty_table_takes_rows_later(spark, pipe):
    report = pipe.run((10, []))
    assert report["rows_inserted"] == 0 and pipe.table.read().columns == COLUMNS and pipe.ratings() == {}
    pipe.run((20, [(1, 1, 4.0)]))
    assert pipe.ratings() == {1: 4.0}


def test_order_columns_make_arrival_irrelevant(spark, rows):
    columns = [*COLUMNS, "_ingested_at"]
    loads = [load(spark, (at, [(1, 5, r), (2, m, r)])) for at, m, r in ((1, 9, 1.0), (2, 3, None), (3, 9, 4.0))]
    order = ("updated_at", "_ingested_at", "rating")
    want = rows(silver.latest_by_key(loads[0].union(loads[1]).union(loads[2]), ["interaction_id"], columns, ("rating",)))
    import itertools
    for turn in itertools.permutations(loads):
        table = Table(spark, scratch_dir(spark), "interaction_id", buckets=4)
        table.overwrite(turn[0].select(*columns), BASE)
        for one in turn[1:]:
            table.merge(one.select(*columns), BASE, order=order)
        assert rows(table.read(), *columns) == want


def test_contract_is_checked_between_dedup_and_commit(spark):
    contract = contracts.Contract("t", tuple(contracts.SILVER_INTERACTIONS.fields[i] for i in (0, 4, 7)), "interaction_id")
    table = Table(spark, scratch_dir(spark))
    good = load(spark, (10, [(1, 1, 4.0), (2, 1, None)]))
    sync_silver(good, table, "interaction_id", COLUMNS, BASE, contract=contract)
    before = table.state()
    bad = good.unionByName(load(spark, (20, [(1, 1, 9.0), (3, 5, 3.0), (2, 7, 8.0)])))  # the newest version of 2 is bad
    with pytest.raises(contracts.ContractError, match="in_range"):
        sync_silver(bad, table, "interaction_id", COLUMNS, BASE, contract=contract)
    assert table.state() == before
    mended = good.unionByName(load(spark, (20, [(2, 7, 8.0), (3, 5, 3.0)]), (21, [(2, 8, 3.0)])))
    assert sync_silver(mended, table, "interaction_id", COLUMNS, BASE, contract=contract)["rows_upserted"] == 2


@pytest.mark.parametrize("name", ["c6_full_refresh", "c8_incremental_equals_full"])
def test_bronze_is_computed_once(spark, monkeypatch, name):
    from oracle import SMALL
    from sparkrec.plans import inputs
    from sparkrec.plans.catalog import QUERIES

    computed = spark.sparkContext.accumulator(0)

    def counted(product):
        computed.add(1)
        return product

    plain = inputs.bronze_interactions
    versions = plain(spark, SMALL).count()
    monkeypatch.setattr(inputs, "bronze_interactions", lambda *a: plain(*a).withColumn(
        "product_id", F.udf(counted, "string").asNondeterministic()("product_id")))
    assert QUERIES[name](spark, SMALL).count() > 0
    assert computed.value == versions
