"""Data drift between a baseline and current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkrec.operators.ordering import running_totals
from sparkrec.session import durable

# Public defaults of the drift tests.
COLUMN_THRESHOLD = 0.1
DATASET_SHARE = 0.5
MIN_SPREAD = 0.001
FEW_VALUES = 5


def flag_cold_items(current: DataFrame, baseline: DataFrame, item: str) -> DataFrame:
    """`current` plus is_cold_start_item: the item never occurs in the baseline."""
    known = baseline.select(item).distinct().withColumn("__known", F.lit(True))
    return current.join(known, item, "left").withColumn(
        "is_cold_start_item", F.col("__known").isNull()
    ).drop("__known")


def cold_start_ratio(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count("*").alias("current_rows"),
        F.round(F.avg(F.col("is_cold_start_item").cast("double")), 4).alias("cold_start_ratio"),
    )


def _sides(reference: DataFrame, current: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(column_name, value, r, c): counts per value of each column on both sides, in one pass."""
    def long(df: DataFrame, is_current: int) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(n).alias("column_name"), v.alias("value")) for n, v in values.items()])
        return df.select(F.explode(entries).alias("e"), F.lit(is_current).alias("side"))

    both = long(reference, 0).unionByName(long(current, 1))
    return (
        both.groupBy(F.col("e.column_name"), F.col("e.value"))
        .agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
        .filter("value IS NOT NULL")
    )


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) of the value shares, per column."""
    counts = _sides(reference, current, {c: F.col(c).cast("string") for c in columns})
    totals = counts.groupBy("column_name").agg(F.sum("r").alias("rn"), F.sum("c").alias("cn"))
    p, q = F.col("r") / F.col("rn"), F.col("c") / F.col("cn")
    mid = (p + q) / 2
    part = F.when(p > 0, p * F.ln(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.ln(q / mid)).otherwise(0.0)
    score = F.sqrt(F.greatest(F.sum(part) / 2, F.lit(0.0)))
    return _verdict(
        counts.join(F.broadcast(totals), "column_name").groupBy("column_name").agg(score.alias("drift_score")),
        "jensenshannon",
    )


def numeric_drift(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Wasserstein distance of the two distributions over the reference's spread.

    Rows shrink to counts per value; both cumulative counts are formed by ranges.
    """
    value = F.col(column).cast("double")
    counts = _sides(reference, current, {column: value})
    steps = running_totals(counts, [F.asc("value")], {"ru": "r", "cu": "c"}, {"next_value": "value"})
    rn, cn = steps.select(F.max("ru")).scalar(), steps.select(F.max("cu")).scalar()
    area = F.abs(F.col("ru") / rn - F.col("cu") / cn) * (F.col("next_value") - F.col("value"))
    n = F.sum("r")
    mean = F.sum(F.col("value") * F.col("r")) / n
    moments = steps.agg(mean.alias("mean"), n.alias("n"))
    centre = moments.select("mean").scalar()
    variance = F.sum((F.col("value") - centre) ** 2 * F.col("r")) / n
    scored = steps.agg((F.sum(area) / F.greatest(F.sqrt(variance), F.lit(MIN_SPREAD))).alias("drift_score"))
    return _verdict(scored.select(F.lit(column).alias("column_name"), "drift_score"), "wasserstein_norm")


def _verdict(scores: DataFrame, test: str) -> DataFrame:
    return scores.select(
        "column_name", F.lit(test).alias("stattest"), "drift_score",
        (F.col("drift_score") >= COLUMN_THRESHOLD).alias("drift_detected"),
    )


def many_valued(reference: DataFrame, columns: Sequence[str]) -> list[str]:
    """The numeric columns with more than FEW_VALUES distinct values, from one pass over the reference.

    Distinct values are counted by sketches that merge on the map side; they are exact
    far beyond the limit that matters here.
    """
    numeric = [c for c in columns if isinstance(reference.schema[c].dataType, T.NumericType)]
    if not numeric:
        return []
    distinct = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"))).alias(c) for c in numeric]
    counts = reference.agg(*distinct).first()
    return [c for c in numeric if (counts[c] or 0) > FEW_VALUES]


def column_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, stattest, drift_score, drift_detected) of every column, each by the test its values call for.

    Many-valued numbers are compared by their distributions, everything else by shares of values.
    """
    many = many_valued(reference, columns)
    few = [c for c in columns if c not in many]
    parts = ([categorical_drift(reference, current, few)] if few else []) + [numeric_drift(reference, current, c) for c in many]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


REPORT = ("baseline_rows long, current_rows long, current_cold_start_ratio double, share_of_drifted_columns double, "
          "drifted_columns string, dataset_drift boolean, column_scores array<struct<column_name:string,stattest:string,"
          "drift_score:double,drift_detected:boolean>>")


def drift_report(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for `sinks.save_report`: row counts of both sides, the dataset verdict and the score of each column.

    `current` carries is_cold_start_item (`flag_cold_items`); at least one column must give a verdict.
    """
    scores = durable(column_drift(reference, current, columns))
    entry = F.struct("column_name", "stattest", "drift_score", "drift_detected")
    cold = F.avg(F.col("is_cold_start_item").cast("double"))
    rows = scores.agg(F.array_sort(F.collect_list(entry)).alias("column_scores"))
    for part in (reference.agg(F.count("*").alias("baseline_rows")), drift_summary(scores),
                 current.agg(F.count("*").alias("current_rows"), F.round(cold, 4).alias("current_cold_start_ratio"))):
        rows = rows.unionByName(part, True)  # one row each
    return rows.agg(*[F.max(c).alias(c) for c in (f.split()[0] for f in REPORT.split(", "))])


def drift_summary(scores: DataFrame) -> DataFrame:
    """Share and names of drifted columns and the dataset verdict; no column is an error."""
    share = F.avg(F.col("drift_detected").cast("double"))
    return scores.agg(
        F.coalesce(share, F.raise_error("no drift verdict").cast("double")).alias("share_of_drifted_columns"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column_name")))), ",")
        .alias("drifted_columns"),
    ).withColumn("dataset_drift", F.col("share_of_drifted_columns") >= DATASET_SHARE)


def vocab_coverage(active: DataFrame, vocab: DataFrame, item: str) -> DataFrame:
    """Known share of the active items, NULL without any."""
    known = vocab.select(item).distinct().withColumn("__known", F.lit(1))
    return active.select(item).distinct().join(known, item, "left").agg(
        F.count("*").alias("active_items"),
        F.count("__known").alias("items_known"),
        F.round(F.avg(F.coalesce("__known", F.lit(0)).cast("double")), 4).alias("coverage"),
    )
