import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.operators import decisions, drift


def cold(spark, n, n_true):
    return spark.range(n).select((F.col("id") < n_true).alias("is_cold_start_item"))


@pytest.mark.parametrize("n,n_true,expected", [(14769, 1, 0.004844), (1000, 600, 0.5238), (18456, 1370, 0.1626), (18456, 1380, 0.1632)])
def test_published_cold_start_scores(spark, n, n_true, expected):
    got = drift.categorical_drift(cold(spark, 14748, 0), cold(spark, n, n_true), ["is_cold_start_item"]).first()
    assert got.drift_score == pytest.approx(expected, abs=6e-5) and got.drift_detected == (expected >= 0.1)


def frame(spark, ratings, n_cold=0):
    return spark.createDataFrame([(float(r), i < n_cold) for i, r in enumerate(ratings)], "rating double, is_cold_start_item boolean")


def test_drift_summary(spark):
    columns = ["rating", "is_cold_start_item"]
    same = frame(spark, [1, 3, 5] * 600)
    quiet = drift.drift_summary(drift.categorical_drift(same, same.repartition(9), columns)).first()
    assert (quiet.dataset_drift, quiet.drifted_columns, quiet.share_of_drifted_columns) == (False, "", 0.0)
    loud = drift.drift_summary(drift.categorical_drift(frame(spark, [3, 4, 5] * 300), frame(spark, [1, 2] * 450, 540), columns)).first()
    assert (loud.dataset_drift, loud.drifted_columns, loud.share_of_drifted_columns) == (True, "is_cold_start_item,rating", 1.0)
    with pytest.raises(Exception, match="no drift verdict"):
        drift.drift_summary(drift.categorical_drift(same, same, columns).limit(0)).collect()


def test_numeric_drift_matches_sorted_samples(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(0, 2, 400), 1), np.round(rng.normal(1, 3, 400), 1)
    expected = np.abs(np.sort(a) - np.sort(b)).mean() / a.std()
    make = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double").repartition(6)
    got = drift.numeric_drift(make(a), make(b), "x").first()
    assert got.drift_score == pytest.approx(expected) and got.drift_detected
    assert drift.numeric_drift(make(a), make(a), "x").first().drift_score == pytest.approx(0.0)


def test_cold_flags_and_coverage(spark):
    base = spark.createDataFrame([("a",), ("a",)], "product_id string")
    now = spark.createDataFrame([("a",), ("b",), ("b",)], "product_id string")
    got = drift.cold_start_ratio(drift.flag_cold_items(now, base, "product_id")).first()
    assert (got.current_rows, got.cold_start_ratio) == (3, 0.6667)
    assert drift.vocab_coverage(now, base, "product_id").first().coverage == 0.5
    assert drift.vocab_coverage(now.limit(0), base, "product_id").first().coverage is None


SIGNALS = "dataset_drift boolean, current_rows long, reference_rows long, hours_since_last_train double, production_age_days double"


@pytest.mark.parametrize("row,reasons", [
    ((False, 10100, 10000, 72.0, 3.0), []),
    ((True, 10300, 10000, 72.0, 3.0), ["dataset_drift"]),
    ((True, 10150, 10000, 72.0, 3.0), []),
    ((False, 12500, 10000, 72.0, 3.0), ["new_rows_ratio"]),
    ((False, 10100, 10000, 72.0, 20.0), ["model_age"]),
    ((True, 13000, 10000, 2.0, 20.0), []),
    ((True, 13000, 10000, 72.0, 20.0), ["model_age", "dataset_drift", "new_rows_ratio"]),
    ((False, 18456, 14748, None, 3.0), ["new_rows_ratio"]),
    ((False, 10100, 10000, 72.0, None), ["no_production_model"]),
    ((None, 10100, 10000, 72.0, 3.0), []),
    ((False, 10, 0, 72.0, 3.0), ["new_rows_without_reference"]),
    ((False, 9000, 10000, 72.0, 3.0), []),
])
def test_retrain_rules(spark, row, reasons):
    got = decisions.retrain_decision(spark.createDataFrame([row], SIGNALS)).first()
    assert got.reasons == reasons and got.retrain == bool(reasons)
    assert got.new_rows == max(0, row[1] - row[2])


def test_signals_count_against_the_latest_trained_version(spark):
    reports = spark.createDataFrame([(1, False, 100, 100), (2, True, 100, 150)], "ts int, dataset_drift boolean, baseline_rows long, current_rows long")
    schema = "version string, created_at timestamp, silver_rows long, is_production boolean"
    versions = [("9", datetime(2026, 1, 1), 110, True), ("10", datetime(2026, 1, 3), 140, False)]
    got = decisions.collect_signals(reports, spark.createDataFrame(versions, schema), datetime(2026, 1, 4)).first()
    assert (got.dataset_drift, got.current_rows, got.reference_rows, got.reference_source) == (True, 150, 140, "latest_version")
    assert (got.hours_since_last_train, got.production_age_days) == (24.0, 3.0)
    versions[1] = ("10", datetime(2026, 1, 3), None, False)
    got = decisions.collect_signals(reports, spark.createDataFrame(versions, schema), datetime(2026, 1, 4)).first()
    assert (got.reference_rows, got.reference_source) == (100, "drift_baseline")
    none = decisions.collect_signals(reports, spark.createDataFrame([], schema), datetime(2026, 1, 4)).first()
    assert none.hours_since_last_train is None and none.production_age_days is None and not math.isnan(none.reference_rows)


def test_no_report_is_an_error(spark):
    reports = spark.createDataFrame([], "ts int, dataset_drift boolean, baseline_rows long, current_rows long")
    versions = spark.createDataFrame([("1", datetime(2026, 1, 1), 5, True)], "version string, created_at timestamp, silver_rows long, is_production boolean")
    with pytest.raises(Exception, match="no drift report"):
        decisions.collect_signals(reports, versions, datetime(2026, 1, 4)).collect()


def test_each_column_gets_the_test_its_values_call_for(spark):
    rows = [(i % 5, float(i), str(i % 9), i % 2 == 0, None) for i in range(200)]
    df = spark.createDataFrame(rows, "stars int, price double, name string, flag boolean, none double")
    assert drift.many_valued(df, ["stars", "price", "name", "flag", "none"]) == ["price"]
    got = {r.column_name: r.stattest for r in drift.column_drift(df, df, ["stars", "price", "name", "flag"]).collect()}
    assert got == {"stars": "jensenshannon", "price": "wasserstein_norm", "name": "jensenshannon", "flag": "jensenshannon"}
    moved = df.withColumn("price", df["price"] + 100).withColumn("is_cold_start_item", df["flag"])
    report = drift.drift_report(df, moved, ["stars", "price"]).first()
    assert (report.baseline_rows, report.current_rows, report.current_cold_start_ratio, report.drifted_columns) == (200, 200, 0.5, "price")
    assert report.dataset_drift and [s.column_name for s in report.column_scores] == ["price", "stars"]
