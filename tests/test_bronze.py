from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from sparkrec.operators import contracts
from sparkrec.operators.contracts import Contract, ContractError, Field, one_of
from sparkrec.sources import staging
from sparkrec.sources.bronze import Bronze, staged_contract

AT = datetime(2026, 1, 2)
CONTRACT = Contract("t", (
    Field("id", T.LongType()), Field("kind", T.StringType(), rules=(one_of("a", "b"),)),
    Field("price", T.DecimalType(12, 2), nullable=True, rules=(contracts.at_least(0),)),
    Field("_extraction_run_id", T.StringType()), Field("_ingested_at", T.TimestampType())), "id")


def stage(spark, path, load, rows, kind="decimal(12,2)"):
    """rows = [(id, kind, price)] as one staged load; kind None leaves the price out."""
    df = spark.createDataFrame([(i, k, None if p is None else str(p), load) for i, k, p in rows], "id long, kind string, price string, _load_id string")
    df = df.drop("price") if kind is None else df.withColumn("price", F.col("price").cast(kind))
    df.coalesce(1).write.parquet(f"{path}/{load}")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_drifting_types_are_cast_per_schema(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    for load, kind, price in (("l1", "int", 3), ("l2", "double", 2.5), ("l3", "string", "1.25"), ("l4", "decimal(12,2)", "7.10"),
                              ("l5", "bigint", 4), ("l6", None, None), ("l7", "int", 5)):
        stage(spark, path, load, [(int(load[1]), "a", price), (10 + int(load[1]), "a", None)], kind)
    assert len(staging.schema_groups(spark, path)) == 6  # l1 and l7 are alike
    frame = staging.read_staging(spark, path, staged_contract(CONTRACT))
    assert dict(frame.dtypes)["price"] == "decimal(12,2)"
    got = {i: p for i, p in rows(frame, "id", "price") if i < 10}
    assert got == {1: 3.0, 2: 2.5, 3: 1.25, 4: 7.1, 5: 4.0, 6: None, 7: 5.0}


def test_nulls_of_required_columns_are_rows_and_missing_columns_an_error(spark, tmp_path):
    path = str(tmp_path / "s")
    stage(spark, path, "l1", [(1, None, 3)])
    assert staging.read_staging(spark, path, staged_contract(CONTRACT)).filter("kind IS NULL").count() == 1
    spark.createDataFrame([(2, "l2")], "id long, _load_id string").coalesce(1).write.parquet(f"{path}/l2")
    with pytest.raises(ContractError, match="kind: column missing in 1 files"):
        staging.read_staging(spark, path, staged_contract(CONTRACT))


def test_loads_are_committed_once_with_good_and_rejected_rows(spark, tmp_path):
    path, target = str(tmp_path / "s"), Bronze(spark, str(tmp_path / "bronze"), CONTRACT)
    assert target.build(path, AT)["load_ids_committed"] == [] and target.read().count() == 0
    known = spark.createDataFrame([("a",)], "name string")
    stage(spark, path, "l1", [(1, "a", 3), (2, "c", 3), (3, "a", -1), (4, None, -2), (5, "b", None)])
    report = target.build(path, AT, {"kind": (known, "name")})
    assert report == {"rows_committed": 1, "rows_rejected": 4, "load_ids_committed": ["l1"]}
    assert ids(target.read()) == [1] and target.read().columns == CONTRACT.names
    failed = {r.id: sorted((f.column_name, f.check_name) for f in r.failures) for r in target.rejected().collect()}
    assert failed == {2: [("kind", "one_of"), ("kind", "reference")], 3: [("price", "at_least_0")],
                      4: [("kind", "not_null"), ("price", "at_least_0")], 5: [("kind", "reference")]}
    commits = target.states().count()
    assert target.build(path, AT)["load_ids_committed"] == [] and target.states().count() == commits
    stage(spark, path, "l2", [(6, "a", 1)], "int")
    assert target.build(path, AT)["load_ids_committed"] == ["l2"] and ids(target.read()) == [1, 6]
    assert {r._extraction_run_id for r in target.read().collect()} == {"l1", "l2"}


def test_strict_builds_and_lost_builds_leave_nothing(spark, tmp_path, monkeypatch):
    path, target = str(tmp_path / "s"), Bronze(spark, str(tmp_path / "bronze"), CONTRACT)
    stage(spark, path, "l1", [(1, "a", 3), (2, "c", 3)])
    with pytest.raises(ContractError, match="1 rows rejected"):
        target.build(path, AT, strict=True)
    assert target.read().count() == 0 and target.rejected().count() == 0
    monkeypatch.setattr(Bronze, "_commit", lambda *_a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        target.build(path, AT)
    monkeypatch.undo()
    assert target.read().count() == 0
    assert target.build(path, AT)["rows_committed"] == 1 and ids(target.read()) == [1]


def test_compaction_keeps_rows_loads_and_rejected(spark, tmp_path, rows):
    path, target = str(tmp_path / "s"), Bronze(spark, str(tmp_path / "bronze"), CONTRACT)
    for n in range(4):
        stage(spark, path, f"l{n}", [(n, "a", n), (100 + n, "x", 1)])
        target.build(path, AT)
    before, bad = rows(target.read()), rows(target.rejected(), "id")
    assert len(target._folders(True)) == 4 and target.compact(AT)
    assert len(target._folders(True)) == 1 and rows(target.read()) == before and rows(target.rejected(), "id") == bad
    assert not target.compact(AT)
    stage(spark, path, "l9", [(9, "b", 1)])
    assert target.build(path, AT)["load_ids_committed"] == ["l9"]  # earlier loads stay known
    assert ids(target.read()) == [0, 1, 2, 3, 9]
