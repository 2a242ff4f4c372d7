"""Drift, coverage and retrain decisions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sparkrec.operators import decisions, drift
from sparkrec.plans import inputs as I
from sparkrec.plans.inputs import with_
from sparkrec.plans.registry import query
from sparkrec.session import durable, scratch_dir
from sparkrec.sources import sinks
from sparkrec.sources.sinks import read_baseline
from sparkrec.sources.tables import Table

# the baseline is what had happened by then; current is everything
CUT = "1995-03-01 00:00:00"
SIDES = (I.BRONZE, I.SILVER, f"""
baseline AS (SELECT product_id, rating FROM silver WHERE event_time < TIMESTAMP '{CUT}'),
flagged AS (SELECT product_id, rating, product_id NOT IN (SELECT product_id FROM baseline) AS cold FROM silver)""")


def sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    silver = I.silver_table(spark, sf)
    baseline = silver.filter(F.col("event_time") < I.ntz(CUT))
    current = drift.flag_cold_items(silver, baseline, "product_id")
    return baseline.withColumn("is_cold_start_item", F.lit(False)), current


@query("j1_cold_start", with_(*SIDES) + """
SELECT COUNT(*) AS current_rows, round(AVG(CASE WHEN cold THEN 1.0 ELSE 0.0 END), 4) AS cold_start_ratio FROM flagged""")
def _(spark, sf):
    return drift.cold_start_ratio(sides(spark, sf)[1])


JS = """counted AS (
  SELECT 'rating' AS column_name, CAST(rating AS VARCHAR) AS value, 1 AS r, 0 AS c FROM baseline WHERE rating IS NOT NULL
  UNION ALL SELECT 'rating', CAST(rating AS VARCHAR), 0, 1 FROM flagged WHERE rating IS NOT NULL
  UNION ALL SELECT 'is_cold_start_item', 'false', 1, 0 FROM baseline
  UNION ALL SELECT 'is_cold_start_item', CAST(cold AS VARCHAR), 0, 1 FROM flagged),
shares AS (SELECT column_name, value, SUM(r) / SUM(SUM(r)) OVER (PARTITION BY column_name) AS p,
  SUM(c) / SUM(SUM(c)) OVER (PARTITION BY column_name) AS q FROM counted GROUP BY column_name, value),
js AS (SELECT column_name, sqrt(greatest(SUM(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS drift_score FROM shares GROUP BY column_name)"""
COLUMNS = ("rating", "is_cold_start_item")


@query("j2_categorical_drift", with_(*SIDES, JS) + """
SELECT column_name, 'jensenshannon' AS stattest, round(drift_score, 6) AS drift_score, drift_score >= 0.1 AS drift_detected FROM js""")
def _(spark, sf):
    scores = drift.categorical_drift(*sides(spark, sf), COLUMNS)
    return scores.withColumn("drift_score", F.round("drift_score", 6))


@query("j3_numeric_drift", """
WITH halves AS (SELECT value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS r FROM events),
v AS (SELECT value, SUM(r) AS r, COUNT(*) - SUM(r) AS c FROM halves GROUP BY value),
cdf AS (SELECT value, SUM(r) OVER (ORDER BY value) / (SELECT SUM(r) FROM v) AS f, SUM(c) OVER (ORDER BY value) / (SELECT SUM(c) FROM v) AS g,
  lead(value) OVER (ORDER BY value) AS next_value FROM v)
SELECT 'value' AS column_name, 'wasserstein_norm' AS stattest,
  round(SUM(abs(f - g) * (next_value - value)) / (SELECT greatest(stddev_pop(value), 0.001) FROM halves WHERE r = 1), 6) AS drift_score,
  SUM(abs(f - g) * (next_value - value)) / (SELECT greatest(stddev_pop(value), 0.001) FROM halves WHERE r = 1) >= 0.1 AS drift_detected FROM cdf""")
def _(spark, sf):
    events, middle = I.table(spark, sf, "events"), I.ntz("2024-01-16 00:00:00")
    scores = drift.numeric_drift(events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle), "value")
    return scores.withColumn("drift_score", F.round("drift_score", 6))


@query("j4_drift_summary", with_(*SIDES, JS) + """
SELECT AVG(CASE WHEN drift_score >= 0.1 THEN 1.0 ELSE 0.0 END) AS share_of_drifted_columns,
  COALESCE(string_agg(CASE WHEN drift_score >= 0.1 THEN column_name END, ',' ORDER BY column_name), '') AS drifted_columns,
  AVG(CASE WHEN drift_score >= 0.1 THEN 1.0 ELSE 0.0 END) >= 0.5 AS dataset_drift FROM js""")
def _(spark, sf):
    return drift.drift_summary(drift.categorical_drift(*sides(spark, sf), COLUMNS))


@query("j5_vocab_coverage", with_(I.PRODUCTS, I.VECTORS) + """
SELECT COUNT(*) AS active_items, COUNT(h.product_id) AS items_known, round(COUNT(h.product_id) / COUNT(*), 4) AS coverage
FROM products p LEFT JOIN h ON h.product_id = p.product_id""")
def _(spark, sf):
    return drift.vocab_coverage(I.products(spark, sf), I.vectors(spark, sf), "product_id")


@query("j6_refresh_baseline", with_(I.BRONZE, I.SILVER) + f"""
SELECT 'silver_snapshot' AS moved, product_id AS parent_asin, CAST(rating AS DOUBLE) AS rating FROM silver
WHERE event_time < TIMESTAMP '{CUT}'""")
def _(spark, sf):
    root, at = scratch_dir(spark), datetime(2026, 1, 2)
    silver, history = I.silver_table(spark, sf), Table(spark, f"{root}/silver")
    history.overwrite(silver.filter(F.col("event_time") < I.ntz(CUT)), at)
    history.overwrite(silver, at)
    result = decisions.refresh_baseline(f"{root}/baseline", history, "7", 1, at)
    rows, _info = read_baseline(spark, f"{root}/baseline")
    return rows.withColumn("moved", F.lit(result["source"]))


# every order is one reading of the signals
@query("j7_retrain_decision", """
WITH s AS (SELECT o_orderkey AS run, o_orderstatus = 'F' AS dataset_drift, CAST(floor(o_totalprice) AS BIGINT) AS current_rows,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey * 100 END AS reference_rows,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey % 100 AS DOUBLE) END AS hours_since_last_train,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_orderkey % 30 AS DOUBLE) END AS production_age_days FROM orders),
n AS (SELECT *, greatest(0, current_rows - reference_rows) AS new_rows FROM s),
d AS (SELECT *, COALESCE(hours_since_last_train < 24, FALSE) AS cooldown, CASE WHEN reference_rows > 0 THEN new_rows / reference_rows END AS ratio FROM n),
e AS (SELECT *, CASE WHEN cooldown THEN '' ELSE concat_ws(',',
    CASE WHEN production_age_days IS NULL THEN 'no_production_model' WHEN production_age_days >= 14 THEN 'model_age' END,
    CASE WHEN dataset_drift AND new_rows >= 200 THEN 'dataset_drift' END,
    CASE WHEN new_rows > 0 AND ratio IS NULL THEN 'new_rows_without_reference' WHEN new_rows > 0 AND ratio >= 0.2 THEN 'new_rows_ratio' END) END AS reasons FROM d)
SELECT run, new_rows, round(ratio, 6) AS new_rows_ratio, cooldown, reasons, reasons <> '' AS retrain FROM e""")
def _(spark, sf):
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    signals = I.table(spark, sf, "orders").select(
        key.alias("run"), (F.col("o_orderstatus") == "F").alias("dataset_drift"),
        F.floor("o_totalprice").cast("long").alias("current_rows"),
        F.when(priority == "5-LOW", 0).otherwise(F.col("o_custkey") * 100).alias("reference_rows"),
        F.when(priority != "1-URGENT", (key % 100).cast("double")).alias("hours_since_last_train"),
        F.when(priority != "2-HIGH", (key % 30).cast("double")).alias("production_age_days"))
    out = decisions.retrain_decision(signals)
    return out.select("run", "new_rows", F.round("new_rows_ratio", 6).alias("new_rows_ratio"), "cooldown",
                      F.array_join("reasons", ",").alias("reasons"), "retrain")


# day of the year: a number of many values
DATED = (I.BRONZE, I.SILVER, f"""
dated AS (SELECT *, dayofyear(event_time) AS day FROM silver),
baseline AS (SELECT * FROM dated WHERE event_time < TIMESTAMP '{CUT}'),
flagged AS (SELECT *, product_id NOT IN (SELECT product_id FROM baseline) AS cold FROM dated)""", JS, """
days AS (SELECT day, SUM(r) AS r, SUM(c) AS c FROM (SELECT day, 1 AS r, 0 AS c FROM baseline UNION ALL SELECT day, 0, 1 FROM flagged) GROUP BY day),
steps AS (SELECT day, SUM(r) OVER (ORDER BY day) / (SELECT SUM(r) FROM days) AS f, SUM(c) OVER (ORDER BY day) / (SELECT SUM(c) FROM days) AS g,
  lead(day) OVER (ORDER BY day) AS next_day FROM days),
scores AS (SELECT column_name, 'jensenshannon' AS stattest, drift_score FROM js UNION ALL
  SELECT 'day', 'wasserstein_norm', (SELECT SUM(abs(f - g) * (next_day - day)) FROM steps) / (SELECT greatest(stddev_pop(day), 0.001) FROM baseline)),
report AS (SELECT (SELECT COUNT(*) FROM baseline) AS baseline_rows, (SELECT COUNT(*) FROM flagged) AS current_rows,
  (SELECT round(AVG(CAST(cold AS INT)), 4) FROM flagged) AS current_cold_start_ratio,
  AVG(CAST(drift_score >= 0.1 AS INT)) AS share_of_drifted_columns,
  COALESCE(string_agg(CASE WHEN drift_score >= 0.1 THEN column_name END, ',' ORDER BY column_name), '') AS drifted_columns,
  AVG(CAST(drift_score >= 0.1 AS INT)) >= 0.5 AS dataset_drift FROM scores)""")


def saved_report(spark, sf) -> DataFrame:
    """The report of the drift job, written and read again; an older one lies beside it."""
    root = scratch_dir(spark)
    dated = durable(I.silver_table(spark, sf).withColumn("day", F.dayofyear("event_time")))
    baseline = dated.filter(F.col("event_time") < I.ntz(CUT))
    current = drift.flag_cold_items(dated, baseline, "product_id")
    calm = baseline.withColumn("is_cold_start_item", F.lit(False))
    sinks.save_report(drift.drift_report(calm, calm, (*COLUMNS, "day")), root, "data_drift", datetime(2026, 1, 1))
    sinks.save_report(drift.drift_report(calm, current, (*COLUMNS, "day")), root, "data_drift", datetime(2026, 1, 2))
    return sinks.latest_report(spark, root, "data_drift", drift.REPORT)


@query("j4_drift_report", with_(*DATED) + """
SELECT report.*, column_name, stattest, round(drift_score, 6) AS drift_score, drift_score >= 0.1 AS drift_detected FROM report CROSS JOIN scores""")
def _(spark, sf):
    out = saved_report(spark, sf).withColumn("s", F.explode("column_scores")).drop("column_scores")
    return out.select("*", "s.column_name", "s.stattest", F.round("s.drift_score", 6).alias("drift_score"), "s.drift_detected").drop("s")


# the chain from report to decision: orders play the trained versions
@query("j8_collect_signals", with_(*DATED, """
v AS (SELECT arg_max((o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END), o_orderkey) AS latest,
  MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS production_at FROM orders),
signals AS (SELECT dataset_drift, current_rows, COALESCE(latest[2], baseline_rows) AS reference_rows,
  CASE WHEN latest[2] IS NULL THEN 'drift_baseline' ELSE 'latest_version' END AS reference_source,
  date_diff('second', latest[1], TIMESTAMP '2001-09-01') / 3600 AS hours_since_last_train,
  date_diff('second', production_at, TIMESTAMP '2001-09-01') / 86400 AS production_age_days FROM report, v),
n AS (SELECT *, greatest(0, current_rows - reference_rows) AS new_rows FROM signals)""") + """
SELECT *, CASE WHEN hours_since_last_train < 24 THEN '' ELSE concat_ws(',',
  CASE WHEN production_age_days IS NULL THEN 'no_production_model' WHEN production_age_days >= 14 THEN 'model_age' END,
  CASE WHEN dataset_drift AND new_rows >= 200 THEN 'dataset_drift' END,
  CASE WHEN new_rows > 0 AND reference_rows = 0 THEN 'new_rows_without_reference'
       WHEN new_rows > 0 AND new_rows / reference_rows >= 0.2 THEN 'new_rows_ratio' END) END AS reasons FROM n""")
def _(spark, sf):
    reports = saved_report(spark, sf).withColumn("ts", F.lit(1))
    versions = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("version"), F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("silver_rows"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_production"))
    signals = decisions.collect_signals(reports, versions, datetime(2001, 9, 1))
    out = decisions.retrain_decision(signals)
    return out.select(*signals.columns, "new_rows", F.array_join("reasons", ",").alias("reasons"))
