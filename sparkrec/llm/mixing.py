"""Mixing sources to target weights by entropy balancing.

Each document i of a source gets a rate r_i between 0 and `cap` copies. Among all rates
that meet the source's token target, the ones closest in entropy to equal rates are
exponentially tilted by the document's size: r = cap * p / (1 + p) with
p = exp(a + b * size), the tilt b being the dual variable of the token constraint. The
dual is convex and is solved by Newton iterations; each is one distributed sum over a
histogram (source, size, documents), since a rate depends on nothing else. Rates are
then rounded into whole copies by systematic sampling: documents of a source stand in
order of size, the rates are added up, and a document gets one copy for each whole
number passed. Every copy count is the rate rounded down or up, and of several starting
points the one that comes nearest to the token target is taken.

Defined results: NULL text has size 0; documents of size 0 take no tokens (they are given
`cap` / 2 rate like any other size at tilt 0); NULL is a source of its own, last in
order; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import identified, join_null_safe, word_count
from sparkrec.operators.ordering import dense_index, running_totals
from sparkrec.session import durable

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
ROUNDS, TOLERANCE = 40, 1e-9
TINY = 1e-7  # sums of equal rates must not lose a whole number to rounding


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size, docs).

    Targets are weight times a common level, cut at `cap` times the source's size. The
    level is found exactly: sources in order of size over weight are cut first.
    """
    each = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    placed = dense_index(each, _by_source(), "at", start=0)
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.withColumn("weight", F.element_at(kinds, (F.col("at") % len(weights) + 1).cast("int")))
    limit = (cap * F.col("source_size")).alias("limit")
    weighed = durable(weighed.select("source", "source_size", "at", "weight", limit))
    ordered = running_totals(
        weighed.withColumn("ratio", F.col("limit") / F.col("weight")),
        [F.col("ratio"), F.col("at")], {"limits": "limit", "weights": "weight"})
    total, all_weight = weighed.agg(share * F.sum("source_size"), F.sum("weight")).first()
    if total is None:  # no sources
        return weighed.select("source", "source_size", F.col("limit").alias("target"))
    # a source is cut while the level without it and those before lies at or above its ratio
    room = (total - (F.col("limits") - F.col("limit"))) / (all_weight - (F.col("weights") - F.col("weight")))
    left = all_weight - F.col("weights")
    level = F.when(left > 0, (total - F.col("limits")) / left)  # for the others, if this source is the last one cut
    cut = room >= F.col("ratio")
    last, any_cut = ordered.agg(
        F.max_by(level, F.when(cut, F.struct("ratio", "at"))), F.coalesce(F.max(cut), F.lit(False))).first()
    shared = F.lit(last if any_cut else total / all_weight).cast("double")
    target = F.least("limit", F.coalesce(F.col("weight") * shared, F.col("limit")))
    return weighed.select("source", "source_size", target.alias("target"))


def tilted_rate(tilt: Column, offset: Column, size: Column, cap: float = CAP) -> Column:
    """cap * sigmoid(offset + tilt * size)."""
    return cap / (1 + F.exp(-(offset + tilt * size)))


def solve_tilts(sizes: DataFrame, targets: DataFrame, cap: float = CAP, rounds: int = ROUNDS,
                tolerance: float = TOLERANCE) -> DataFrame:
    """(source, offset, tilt, source_size, target): the tilt that meets each token target.

    The tilt is measured per mean size of the source. Newton steps are kept inside a
    bracket that always holds the solution, so every start converges. A target at the
    cap, or none at all, has no finite tilt: the offset alone then gives all or nothing.
    """
    means = sizes.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"))
    full = cap * F.col("source_size")
    state = durable(
        join_null_safe(means, targets, ["source"])
        .withColumn("edge", F.when(F.col("target") >= full, 1).when(F.col("target") <= 0, -1).otherwise(0))
        .withColumn("tilt", F.log(F.try_divide(F.col("target"), full - F.col("target"))))
        .withColumn("tilt", F.when(F.col("edge") == 0, F.coalesce("tilt", F.lit(0.0))).otherwise(F.lit(0.0)))
        .withColumn("low", F.lit(-60.0)).withColumn("high", F.lit(60.0)).withColumn("off", F.lit(1.0))
    )
    for _ in range(rounds):
        if state.filter((F.col("edge") == 0) & (F.col("off") > tolerance)).isEmpty():
            break
        state = durable(_newton_step(sizes, state, cap))
    offset = F.when(F.col("edge") == 0, 0.0).otherwise(F.col("edge") * 1e9)
    tilt = F.when(F.col("edge") == 0, F.coalesce(F.try_divide("tilt", "mean"), F.lit(0.0))).otherwise(0.0)
    return state.select("source", offset.alias("offset"), tilt.alias("tilt"), "source_size", "target")


def _newton_step(sizes: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """One step for every source: value and slope of the dual's gradient, summed over all documents."""
    at = join_null_safe(sizes, state, ["source"])
    x = F.try_divide(F.col("size"), F.col("mean"))
    p = 1 / (1 + F.exp(-F.col("tilt") * x))
    sums = at.filter("edge = 0 AND mean > 0").select(
        "source", (cap * p * F.col("size") * F.col("docs")).alias("value"),
        (cap * p * (1 - p) * x * F.col("size") * F.col("docs")).alias("slope"),
    ).groupBy("source").agg(F.sum("value").alias("value"), F.sum("slope").alias("slope"))
    moved = join_null_safe(state, sums, ["source"], "left")
    miss = F.col("target") - F.col("value")
    low = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(miss < 0, F.col("tilt")).otherwise(F.col("high"))
    return (
        moved.withColumn("low", low).withColumn("high", high)
        .withColumn("next", F.col("tilt") + F.try_divide(miss, F.col("slope")))
        .withColumn("next", F.when((F.col("next") > F.col("low")) & (F.col("next") < F.col("high")), F.col("next"))
                    .otherwise((F.col("low") + F.col("high")) / 2))
        .withColumn("off", F.coalesce(F.abs(miss) / F.greatest(F.col("target"), F.lit(1.0)), F.lit(0.0)))
        .withColumn("tilt", F.coalesce(F.when(F.col("off") > 0, F.col("next")), F.col("tilt")))
        .select(*state.columns)
    )


def copies(rows: DataFrame, cap: float = CAP, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """Rows (doc_id, source, size, rid) with source_size, target, rate and whole copies."""
    sizes = durable(rows.groupBy("source", "size").agg(F.count("*").alias("docs")))
    tilts = durable(solve_tilts(sizes, durable(source_targets(sizes, weights, share, cap)), cap))
    rated = join_null_safe(sizes, tilts, ["source"]).withColumn(
        "rate", tilted_rate(F.col("tilt"), F.col("offset"), F.col("size"), cap))
    # in order of source and size: documents and rates before each size
    ahead = durable(running_totals(
        rated.withColumn("part", F.col("rate") * F.col("docs")), [*_by_source(), F.col("size")],
        {"upto": "part", "docs_upto": "docs"}))
    first = ahead.groupBy("source").agg(F.min(F.col("upto") - F.col("part")).alias("zero"))
    ahead = join_null_safe(ahead, first, ["source"]).select(
        "source", "size", "docs", "source_size", "target", "rate", (F.col("docs_upto") - F.col("docs")).alias("low"),
        (F.col("upto") - F.col("part") - F.col("zero")).alias("begin"))
    ahead = join_null_safe(ahead, durable(_starts(ahead)), ["source"])
    # the same order, and among equal sizes by hash, id and row
    order = [*_by_source(), F.col("size"), F.xxhash64("doc_id"), F.col("doc_id"), F.col("rid")]
    placed = dense_index(rows, order, "place", start=0)
    met = join_null_safe(placed, ahead, ["source", "size"])
    return met.withColumn("copies", _passed(F.col("place") - F.col("low"))).drop("begin", "start", "docs", "low", "place")


def _by_source() -> list[Column]:
    return [F.col("source").isNull(), F.col("source")]


def _starts(ahead: DataFrame, tries: int = 32) -> DataFrame:
    """(source, start): where each source's count of whole numbers begins.

    Any start between 0 and 1 is a fair rounding; of `tries` starts the one is used whose
    tokens come nearest to the target. Copies of all documents of one size follow from
    the rates before and after them, so the sums run over the histogram.
    """
    def tokens(start: float) -> Column:
        begin = F.col("begin") + start + TINY
        return F.sum(F.col("size") * (F.floor(begin + F.col("docs") * F.col("rate")) - F.floor(begin)))

    starts = [(k + 0.5) / tries for k in range(tries)]
    sums = ahead.groupBy("source").agg(
        F.max("target").alias("target"), *[tokens(u).alias(f"t{k}") for k, u in enumerate(starts)])
    misses = [F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(u).alias("start"))
              for k, u in enumerate(starts)]
    return sums.select("source", F.array_min(F.array(*misses))["start"].alias("start"))


def _passed(at: Column) -> Column:
    """Whole numbers between the sum of rates before a document and after it, counted from the start."""
    before = F.col("begin") + F.col("start") + at * F.col("rate") + TINY
    return F.least(F.floor(before + F.col("rate")) - F.floor(before), F.ceil(F.col("rate"))).cast("long")


def slim(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, rid) of every document, stored, so that row numbers stay."""
    return durable(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        F.monotonically_increasing_id().alias("rid")))


def label(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    return copies(slim(docs), cap, weights, share).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, stored: bool = False) -> DataFrame:
    """The mixed corpus: every document as often as it has copies, with all its columns.

    `stored`: `docs` are files as they were read. Rows are known by their file and place.
    """
    known = identified(docs, stored)
    rows = durable(known.select(
        F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").cast("string").alias("source"),
        word_count(F.col("doc.text")).alias("size"), "rid"))
    times = copies(rows, cap, weights, share).filter("copies > 0").select("rid", "copies").hint("shuffle_hash")
    return known.join(times, "rid").select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")
