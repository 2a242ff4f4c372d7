import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import decisions
from sparkrec.operators.contracts import BRONZE_INTERACTIONS, ContractError
from sparkrec.sources import incremental, sinks, staging
from sparkrec.sources.tables import Table

AT = datetime(2026, 1, 1)


def source(spark, *minutes):
    rows = [(i, AT + timedelta(minutes=m)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, "id long, updated_at timestamp")


def test_cursor_is_strict_and_inclusive_reads_do_not_repeat(spark, rows):
    df = source(spark, 1, 2, 2, 3)
    mark = AT + timedelta(minutes=2)
    assert rows(incremental.incremental_scan(df, "updated_at", mark), "id") == [(3.0,)]
    assert incremental.incremental_scan(df, "updated_at").count() == 4
    seen = df.filter("id < 2")
    again = incremental.incremental_scan(df, "updated_at", mark, inclusive=True, seen=seen, key="id")
    assert rows(again, "id") == [(2.0,), (3.0,)]


def test_keyset_pages_cover_everything_once(spark):
    df, got, after = source(spark, 1, 2, 2, 2, 5, 5), [], (datetime(1970, 1, 1), -1)
    while True:
        page = incremental.keyset_after(df, "updated_at", "id", after, 2).collect()
        if not page:
            break
        got += [r.id for r in page]
        after = (page[-1].updated_at, page[-1].id)
    assert got == [0, 1, 2, 3, 4, 5]


def test_failed_extract_leaves_the_cursor(spark, tmp_path, monkeypatch):
    state, stage = Table(spark, str(tmp_path / "state")), str(tmp_path / "staging")
    assert incremental.extract(source(spark, 1, 2), stage, state, "updated_at", AT, "a") == 2
    cursor = state.state().watermark
    monkeypatch.setattr(Table, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        incremental.extract(source(spark, 1, 2, 3), stage, state, "updated_at", AT, "b")
    monkeypatch.undo()
    assert state.state().watermark == cursor
    assert incremental.extract(source(spark, 1, 2, 3, 4), stage, state, "updated_at", AT, "b") == 2
    assert incremental.extract(source(spark, 1, 2, 3, 4), stage, state, "updated_at", AT, "c") == 0
    assert spark.read.parquet(stage).count() == 4


def bronze(spark, n, start=0):
    rows = [(start + i, "u", "p", "view", AT, AT, AT, "run", AT) for i in range(n)]
    return spark.createDataFrame(
        rows, "interaction_id long, user_id string, product_id string, event_type string, event_time timestamp, "
        "created_at timestamp, updated_at timestamp, _extraction_run_id string, _ingested_at timestamp")


def test_staging_restores_optional_columns_and_refuses_missing_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    assert staging.read_staging(spark, str(tmp_path / "none"), BRONZE_INTERACTIONS).count() == 0
    bronze(spark, 3).write.parquet(f"{path}/a")
    rated = bronze(spark, 2, 10).withColumn("rating", F.lit(4).cast("decimal(2,1)")).withColumn("surplus", F.lit(1))
    rated.write.parquet(f"{path}/b")
    frame = staging.read_staging(spark, path, BRONZE_INTERACTIONS)
    assert frame.columns == BRONZE_INTERACTIONS.names and frame.count() == 5
    assert frame.filter("rating IS NULL").count() == 3
    bronze(spark, 1, 20).drop("user_id").write.parquet(f"{path}/c")
    with pytest.raises(ContractError, match="user_id"):
        staging.read_staging(spark, path, BRONZE_INTERACTIONS)


def test_typed_tsv_and_metadata_lines(spark, tmp_path, rows):
    (tmp_path / "x.inter").write_text("user_id:token\titem_id:token\ttimestamp:float\nu1\ti1\t12.5\n")
    assert rows(staging.read_inter(spark, str(tmp_path / "x.inter"))) == [("u1", "i1", 12.5)]
    lines = [{"parent_asin": "a", "title": "A", "price": "$3", "average_rating": 4.1}, {"parent_asin": "b", "title": "B"}]
    (tmp_path / "meta.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    wanted = spark.createDataFrame([("a",)], "item_id string")
    meta = staging.read_meta(spark, str(tmp_path / "meta.jsonl"), wanted)
    assert "average_rating" not in meta.columns and rows(meta, "parent_asin", "price") == [("a", "$3")]


def test_reports_newest_wins(spark, tmp_path):
    root = str(tmp_path)
    assert sinks.latest_report(spark, root, "drift", "v long").count() == 0
    for hour, value in ((9, 1), (11, 3), (10, 2)):
        sinks.save_report(spark.createDataFrame([(value,)], "v long"), root, "drift", datetime(2026, 1, 1, hour))
    assert sinks.latest_report(spark, root, "drift", "v long").first().v == 3


def test_lookup_expires(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, v array<string>")
    sinks.write_lookup(sinks.keyed_lookup(df, "k", "v", AT, 7), str(tmp_path / "l"))
    assert sinks.read_lookup(spark, str(tmp_path / "l"), AT + timedelta(days=6)).first().value == '["x","y"]'
    assert sinks.read_lookup(spark, str(tmp_path / "l"), AT + timedelta(days=7)).count() == 0


def test_export_turns_decimals_into_doubles(spark, tmp_path):
    df = spark.sql("SELECT CAST(1.25 AS DECIMAL(12,2)) AS price, 'a' AS id")
    sinks.export_snapshot(df, str(tmp_path / "e"))
    assert dict(spark.read.parquet(str(tmp_path / "e")).dtypes) == {"price": "double", "id": "string"}


def test_baseline_moves_with_production(spark, tmp_path):
    root = str(tmp_path / "b")
    spark.createDataFrame([("a", 1.0)] * 5, "parent_asin string, rating double").write.parquet(f"{root}/train")
    frame, info = sinks.read_baseline(spark, root)
    assert (info["source"], frame.count()) == ("train", 5)
    silver = Table(spark, str(tmp_path / "silver"))
    rows = spark.createDataFrame([(f"p{i}", 3.0) for i in range(8)], "product_id string, rating double")
    silver.overwrite(rows, AT)
    silver.overwrite(rows.limit(2), AT)
    assert not decisions.refresh_baseline(root, silver, None, 1, AT)["refreshed"]
    assert not decisions.refresh_baseline(root, silver, "7", None, AT)["refreshed"]
    moved = decisions.refresh_baseline(root, silver, "7", 1, AT)
    assert (moved["source"], moved["rows"]) == ("silver_snapshot", 8)
    frame, info = sinks.read_baseline(spark, root)
    assert (info["source"], info["model_version"], frame.count()) == ("current", "7", 8)
    assert not decisions.refresh_baseline(root, silver, "7", 1, AT)["refreshed"]
    gone = decisions.refresh_baseline(root, silver, "8", 55, AT)
    assert (gone["source"], gone["rows"]) == ("silver_current", 2)


def test_lineage_rows(spark, tmp_path, rows):
    table, empty = Table(spark, str(tmp_path / "t")), Table(spark, str(tmp_path / "none"))
    table.overwrite(source(spark, 1, 2), AT)
    sinks.record_lineage(spark, str(tmp_path / "runs"), "r1", {"silver": table, "gold": empty})
    assert rows(spark.read.parquet(str(tmp_path / "runs"))) == [("r1", "gold", None, None), ("r1", "silver", 1.0, 2.0)]


def test_scratch_tables_go_where_the_session_says():
    from types import SimpleNamespace

    from sparkrec.session import CHECKPOINT_DIR, scratch_dir

    named = SimpleNamespace(conf={CHECKPOINT_DIR: "s3://shared/checkpoints/"})
    assert scratch_dir(named).startswith("s3://shared/checkpoints/sparkrec-")
    assert scratch_dir(named) != scratch_dir(named)
