"""Choosing among trained candidates and promoting versions, over run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.operators.ordering import carried, inside, previous_value, ranged_by_key


def default_candidate(candidates: DataFrame) -> str:
    """The first listed candidate; an empty list is an error."""
    first = candidates.agg(F.min_by("candidate", "list_order")).first()[0]
    if first is None:
        raise ValueError("there are no candidates to choose from")
    return first


def paired_margins(per_sample: DataFrame, default: str, z: float = 1.0) -> DataFrame:
    """Per non-default candidate: mean paired difference, its standard error, z, eligibility.

    `per_sample` is (candidate, sample, ndcg); candidates scored on other samples than
    the default show up in `mismatched`.
    """
    base = per_sample.filter(F.col("candidate") == default).select("sample", F.col("ndcg").alias("base"))
    others = per_sample.filter(F.col("candidate") != default)
    size = base.agg(F.count("*")).scalar()
    diff = F.col("ndcg") - F.col("base")
    n, mean = F.count(diff), F.avg(diff)
    se = F.coalesce(F.stddev_samp(diff) / F.sqrt(n), F.lit(0.0))
    out = others.join(base, "sample", "left").groupBy("candidate").agg(
        F.count("*").alias("n"),
        (F.max(size) - n + (F.count("*") - n)).alias("mismatched"),
        F.coalesce(mean, F.lit(0.0)).alias("diff"),
        se.alias("se"),
    )
    return out.withColumn("z", F.when(F.col("se") > 0, F.col("diff") / F.col("se"))).withColumn(
        "eligible", (F.col("diff") > 0) & (F.col("diff") > z * F.col("se"))
    )


def select_winner(candidates: DataFrame, margins: DataFrame, default: str | None = None) -> DataFrame:
    """One row: the best eligible candidate, else the default.

    `candidates` is (candidate, val_ndcg, n_params, list_order). Highest score wins,
    then fewer parameters, then list order. Without `default` the first listed candidate
    is it. Sample sets that differ are an error.
    """
    default = default or default_candidate(candidates)
    # one row per candidate of the training run
    problem = F.when(F.max("mismatched") > 0, F.raise_error("a candidate lacks samples of the default, or has others"))
    checked = margins.agg(F.coalesce(problem.cast("int"), F.lit(0)).alias("bad"))
    ranked = candidates.join(margins.select("candidate", "eligible"), "candidate", "left").filter(
        F.coalesce("eligible", F.lit(False)) | (F.col("candidate") == default)
    )
    order = F.struct(
        F.coalesce("eligible", F.lit(False)).alias("e"), F.col("val_ndcg").alias("s"),
        (-F.col("n_params")).alias("p"), (-F.col("list_order")).alias("o"),
    )
    best = ranked.agg(F.max_by("candidate", order).alias("winner"))
    both = best.unionByName(checked, True).agg(F.max("winner").alias("winner"), F.max("bad").alias("bad"))
    return both.filter("bad = 0").select("winner", F.lit(default).alias("default"))


def decide_promotion(runs: DataFrame, min_delta: float = 0.0) -> DataFrame:
    """`runs` plus promote and comparison, row by row.

    Columns: candidate_metric, production_version, production_metric,
    champion_version, champion_metric. Without production the first version is
    promoted; scored against the current production on the same split it must be
    strictly better by more than `min_delta`; else the own-split numbers decide,
    ties included.
    """
    first = F.col("production_version").isNull()
    same = F.col("champion_metric").isNotNull() & F.col("champion_version").eqNullSafe(F.col("production_version"))
    better = F.col("candidate_metric") > F.col("champion_metric") + min_delta
    legacy = F.coalesce(F.col("candidate_metric") >= F.col("production_metric"), F.lit(False))
    return runs.withColumns({
        "comparison": F.when(first, "first").when(same, "same_split").otherwise("legacy"),
        "promote": F.when(first, True).when(same, better).otherwise(legacy),
    })


def lift_over_popularity(metric: Column, popularity: Column) -> Column:
    """Ratio, NULL when the popularity number is missing or 0."""
    return F.try_divide(metric, F.nullif(popularity, F.lit(0.0)))


def latest_version(versions: DataFrame, version: str = "version") -> DataFrame:
    """Versions are numbers stored as text: the largest number wins."""
    return versions.agg(F.max_by(version, F.col(version).cast("int")).alias("version"))


def metric_trend(versions: DataFrame, metric: str, model: str = "model", ranges: int | None = None) -> DataFrame:
    """The metric per version in numeric order, with its change."""
    number = F.col("version").cast("int")
    before = previous_value(versions, [model], [number.asc()], metric, "__before", ranges)
    return before.withColumn("change", F.col(metric) - F.col("__before")).drop("__before")


def early_stopping(epochs: DataFrame, patience: int, run: str = "run", metric: str = "metric",
                   ranges: int | None = None) -> DataFrame:
    """(run, best_epoch, epochs_run) by replaying the per-epoch metric of each run.

    An epoch that reaches the best so far (ties count) becomes the best; training
    stops after more than `patience` epochs in a row below it.
    """
    keys, place, good = [run], F.col("__place"), F.col("__good")
    # one stored sort; place, best and last good epoch are carried over its ranges one after the other
    ranged = carried(ranged_by_key(epochs, keys, [F.asc("epoch")], ranges), keys, F.count("*"), F.sum, "__n")
    ranged = carried(ranged, keys, F.max(metric), F.max, "__m")
    upto = inside(keys)
    placed = ranged.withColumn("__place", F.count("*").over(upto) + F.coalesce("__n", F.lit(0))).withColumn(
        "__good", F.when(F.col(metric) >= F.greatest(F.max(metric).over(upto), "__m"), place))
    marked = carried(placed, keys, F.max("__good"), F.max, "__g").withColumn(
        "__last_good", F.greatest(F.max("__good").over(upto), "__g"))
    stops = marked.groupBy(run).agg(
        F.min(F.when(place - F.col("__last_good") > patience, place)).alias("__stop"))
    ran = marked.join(stops, marked[run].eqNullSafe(stops[run]), "left").drop(stops[run]).filter(
        F.col("__stop").isNull() | (place <= F.col("__stop")))
    return ran.groupBy(run).agg(
        F.max(F.when(good.isNotNull(), F.col("epoch"))).alias("best_epoch"), F.count("*").alias("epochs_run")
    )
