"""Exact products of queries with a catalog, pruned by bounds, without all pairs.

The catalog is ordered by the length of its vectors and cut into blocks that double in size.
Round by round, the queries that are not settled meet the next block: in groups of bounded
size, each group's partition holds its queries first and then streams the block's rows, longest
first. A task holds its queries, their best rows so far and one batch of items. Equal queries are multiplied once. A product is
at most the product of lengths (Cauchy-Schwarz); so a query is settled, and leaves, once its k-th score
and the scores of its targets are above its length times the longest vector that is left, and a
task stops reading a block once that holds for all its queries. Only k rows and the counters
of a query ever leave a task. There is one plan for all sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkrec.operators.ordering import dense_index, first_per_key
from sparkrec.session import durable

# Scores are compared at this precision, so the order does not depend on summation order.
SCORE_DIGITS = 9
SLACK = 1e-8  # above what rounding can add to a bound
BLOCK_ROWS = 65_536  # of the first block
GROUP_ROWS = 8_192  # queries of a group
TILE_CELLS = 4_000_000  # scores held at once by one task
PAIRS_AT_ONCE = 100_000  # multiplied in double by one task
SINGLE_LENGTH = 1e18  # of vectors whose products fit single precision
LEAST = float(np.finfo(np.float32).min)
NO_ITEM = -1

STATE = ("vec array<double>, skip_idx long, targets array<long>, bars array<double>, ids array<long>, scores array<double>, "
         "above array<long>, tied array<long>, done boolean")


def _length(vec: str) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _padded(column: pa.Array, width: int, fill) -> np.ndarray:
    """Lists of at most `width` values as a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), width), fill, dtype=np.int64 if isinstance(fill, int) else float)
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    kept = values[np.arange(values.shape[1])[None, :] < sizes[:, None]] if values.size else values.ravel()
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(kept))


def _places(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the cells that are set, row by row; a flat search is several times faster than one over both axes."""
    return np.divmod(np.flatnonzero(cells), cells.shape[1])


class _Group:
    """Queries of one group, and what is known about them so far."""

    def __init__(self, parts: list[pa.RecordBatch], k: int) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        self.query, self.vec, self.k = rows["query"], _rows(rows["vec"]), k
        self.skip = rows["skip_idx"].to_numpy(zero_copy_only=False)
        self.n_targets = np.diff(rows["targets"].offsets.to_numpy())
        width = int(self.n_targets.max(initial=0))
        self.targets, self.bars = _padded(rows["targets"], width, NO_ITEM), _padded(rows["bars"], width, np.inf)
        self.above, self.tied = _padded(rows["above"], width, 0), _padded(rows["tied"], width, 0)
        self.ids, self.scores = _padded(rows["ids"], k, NO_ITEM), _padded(rows["scores"], k, -np.inf)
        self.length = np.sqrt((self.vec**2).sum(1))

    def open(self, longest: float) -> np.ndarray:
        """Queries for which a vector of this length may still matter."""
        bound = self.length * longest + SLACK
        waiting = np.minimum(self.scores[:, -1] if self.k else np.inf, self.bars.min(axis=1, initial=np.inf))
        return np.flatnonzero(waiting <= bound)

    def meet(self, ids: np.ndarray, matrix: np.ndarray, queries: np.ndarray) -> None:
        """Single precision rules out most cells; only those its error leaves open are multiplied in double."""
        step = max(1, TILE_CELLS // (len(ids) + self.k))
        order = np.argsort(ids)
        longest = float(np.sqrt((matrix**2).sum(1)).max())
        single = max(longest, float(self.length[queries].max(initial=0))) < SINGLE_LENGTH  # False for NaN
        if single:
            narrow = matrix.astype(np.float32)
        for start in range(0, len(queries), step):
            q = queries[start:start + step]
            at, own = self._own(ids, order, self.skip[q])
            if single:
                rough = self.vec[q].astype(np.float32) @ narrow.T
                rough[own, at] = -np.inf
                if self._meet_rough(q, ids, matrix, order, rough, longest):
                    continue
            scores = np.round(self.vec[q] @ matrix.T, SCORE_DIGITS)
            scores[own, at] = -np.inf
            for t in range(self.targets.shape[1]):
                bar, target = self.bars[q, t][:, None], self.targets[q, t][:, None]
                self.above[q, t] += ((scores > bar) & (ids[None, :] != target)).sum(1)
                self.tied[q, t] += ((scores == bar) & (ids[None, :] < target)).sum(1)
            if self.k:
                self._keep_best(q, ids, scores)

    @staticmethod
    def _own(ids: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among `ids`, row) of the `wanted` ids that are there."""
        at = order[np.minimum(np.searchsorted(ids, wanted, sorter=order), len(ids) - 1)]
        own = np.flatnonzero(ids[at] == wanted)
        return at[own], own

    def _meet_rough(self, q: np.ndarray, ids: np.ndarray, matrix: np.ndarray, order: np.ndarray, rough: np.ndarray, longest: float) -> bool:
        """Counters and best rows from single-precision scores; False, and nothing changed, if too many cells stay open."""
        error = self.length[q] * longest * (matrix.shape[1] + 8) * 2.0**-23 + SLACK
        room, counted = max(rough.size // 8, 4 * self.k * len(q)), []

        def column(bound: np.ndarray) -> np.ndarray:
            return np.maximum(bound, LEAST).astype(np.float32)[:, None]

        for t in range(self.targets.shape[1]):
            bar, target = self.bars[q, t], self.targets[q, t]
            higher = rough > column(bar + error)
            above, (at, own) = np.count_nonzero(higher, axis=1), self._own(ids, order, target)
            above[own] -= higher[own, at]
            row, item = _places(higher ^ (rough >= column(bar - error)))
            if len(row) > room:
                return False
            score = self._exact(q[row], matrix, item)
            above += np.bincount(row[(score > bar[row]) & (ids[item] != target[row])], minlength=len(q))
            counted.append((t, above, np.bincount(row[(score == bar[row]) & (ids[item] < target[row])], minlength=len(q))))
        if self.k:
            floor = self.scores[q, -1] - error
            row, item = _places(rough >= column(floor))
            if len(row) > len(q) * 4 * self.k:
                # the k best of the tile are no lower than its k-th rough score less the error of both
                cut = max(rough.shape[1] - self.k, 0)
                floor = np.maximum(floor, np.partition(rough, cut, axis=1)[:, cut] - 2 * error)
                row, item = _places(rough >= column(floor))
            if len(row) > room:
                return False
            if len(row):
                self._merge(q, ids, row, item, self._exact(q[row], matrix, item))
        for t, above, tied in counted:
            self.above[q, t] += above
            self.tied[q, t] += tied
        return True

    def _exact(self, rows: np.ndarray, matrix: np.ndarray, items: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for start in range(0, len(rows), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            out[part] = np.einsum("ij,ij->i", self.vec[rows[part]], matrix[items[part]])
        return np.round(out, SCORE_DIGITS)

    def _keep_best(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """The k best of what was kept and of a tile: score descending, then index ascending."""
        floor = self.scores[q, -1]
        row, column = _places((scores >= floor[:, None]) & (scores > -np.inf))
        if not len(row):
            return
        if len(row) > len(q) * 4 * self.k:
            # all at or above the k-th score of the tile stay, so that ties are decided by index
            cut = max(scores.shape[1] - self.k, 0)
            floor = np.maximum(floor, np.partition(scores, cut, axis=1)[:, cut])
            row, column = _places((scores >= floor[:, None]) & (scores > -np.inf))
        self._merge(q, ids, row, column, scores[row, column])

    def _merge(self, q: np.ndarray, ids: np.ndarray, row: np.ndarray, column: np.ndarray, score: np.ndarray) -> None:
        kept_row, kept_at = np.nonzero(self.ids[q] != NO_ITEM)
        row = np.concatenate([kept_row, row])
        value = np.concatenate([self.scores[q][kept_row, kept_at], score])
        item = np.concatenate([self.ids[q][kept_row, kept_at], ids[column]])
        by = np.lexsort((item, -value, row))
        row, value, item = row[by], value[by], item[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        self.ids[q[row[best]], place[best]] = item[best]
        self.scores[q[row[best]], place[best]] = value[best]

    def result(self, longest: float | None) -> pa.RecordBatch:
        """State after a block; settled queries leave their vectors behind. `longest`: of the blocks that follow."""
        n = len(self.query)
        done = np.ones(n, bool)
        if longest is not None:
            done[self.open(longest)] = False
        found = (self.ids != NO_ITEM).sum(1)
        return pa.RecordBatch.from_arrays(
            [self.query, _lists(self.vec, np.where(done, 0, self.vec.shape[1])), pa.array(self.skip), _lists(self.targets, self.n_targets),
             _lists(self.bars, self.n_targets), _lists(self.ids, found), _lists(self.scores, found),
             _lists(self.above, self.n_targets), _lists(self.tied, self.n_targets), pa.array(done)],
            ["query", "vec", "skip_idx", "targets", "bars", "ids", "scores", "above", "tied", "done"])


def _round(batches: Iterator[pa.RecordBatch], k: int, longest: float | None) -> Iterator[pa.RecordBatch]:
    """Rows arrive by group, its queries before its items, items longest first."""
    number, parts, group, still = None, [], None, True
    for batch in batches:
        groups, kinds = batch["group"].to_numpy(), batch["kind"].to_numpy()
        cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(kinds) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(groups)]):
            if start == end:
                continue
            piece = batch.slice(start, end - start)
            if number != groups[start]:
                if parts or group is not None:
                    yield (group or _Group(parts, k)).result(longest)
                number, parts, group, still = groups[start], [], None, True
            if kinds[start] == 0:
                parts.append(piece)
            elif parts or group is not None:
                group = group or _Group(parts, k)
                parts = []
                if still:
                    matrix = _rows(piece["vec"])
                    queries = group.open(float(np.sqrt((matrix**2).sum(1)).max()))
                    still = len(queries) > 0
                    if still:
                        group.meet(piece["item_idx"].to_numpy(), matrix, queries)
    if parts or group is not None:
        yield (group or _Group(parts, k)).result(longest)


def multiply(queries: DataFrame, catalog: DataFrame, k: int,
             block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query, ids, scores, targets, bars, above, tied): the best `k` items, and counters for targets.

    queries: (query, vec[, skip_idx][, targets, bars]); `bars` are the scores of the targets.
    above: items that score higher than a target; tied: equal scores of lower index.
    """
    asked, found = multiply_once(queries, catalog, k, block_rows, group_rows)
    return asked.join(found, "own").drop("own")


def multiply_once(queries: DataFrame, catalog: DataFrame, k: int,
                  block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(query, own) and (own, ids, scores, targets, bars, above, tied): like `multiply`, equal queries share a result."""
    spark = queries.sparkSession
    group_rows = max(1, min(group_rows, TILE_CELLS // max(k, 1)))  # a group's best rows are no more than a tile
    empty = {"skip_idx": F.lit(NO_ITEM).cast("long"), "targets": F.array().cast("array<long>"), "bars": F.array().cast("array<double>")}
    for name, value in empty.items():
        if name not in queries.columns:
            queries = queries.withColumn(name, value)
    zeros = F.transform("targets", lambda _: F.lit(0).cast("long"))
    asked = queries.select(
        F.col("query").alias("asked"), F.col("vec").cast("array<double>").alias("vec"), F.col("skip_idx").cast("long").alias("skip_idx"),
        F.col("targets").cast("array<long>").alias("targets"), F.transform("bars", lambda b: F.round(b, SCORE_DIGITS)).alias("bars"),
        zeros.alias("above"), zeros.alias("tied"), F.monotonically_increasing_id().alias("own"))
    # users with the same last item have the same state: each stands for those with its vector, skipped index and targets
    same = W.partitionBy("vec", "skip_idx", "targets", "bars")
    asked = durable(durable(asked).withColumn("query", F.min("own").over(same)))
    state = asked.filter("own = query").select(
        "query", "vec", "skip_idx", "targets", "bars", F.array().cast("array<long>").alias("ids"),
        F.array().cast("array<double>").alias("scores"), "above", "tied", F.lit(False).alias("done"))
    items = catalog.select(F.col("item_idx").cast("long").alias("item_idx"), F.col("vec").cast("array<double>").alias("vec"))
    items = dense_index(items.withColumn("length", _length("vec")), [F.desc("length"), F.asc("item_idx")], "at", 0)
    items = items.withColumn("block", F.floor(F.log2(F.col("at") / block_rows + 1)).cast("int"))
    blocks = items.groupBy("block").agg(F.max("length").alias("longest")).orderBy("block").collect()

    schema, done = f"query long, {STATE}", []
    for at, block in enumerate(blocks):
        longest = blocks[at + 1].longest if at + 1 < len(blocks) else None
        waiting = state.count()
        if not waiting:
            break
        groups = max(2 * spark.sparkContext.defaultParallelism, -(-waiting // group_rows))
        left = state.drop("done").select(
            F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"),
            F.lit(NO_ITEM).cast("long").alias("item_idx"), "*")
        right = items.filter(F.col("block") == block.block).select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"),
            "at", "item_idx", "vec")
        # a partition per group: by a hash of its number some would hold several and others none
        mixed = left.unionByName(right, allowMissingColumns=True).repartitionById(groups, "group").sortWithinPartitions("group", "kind", "at")
        out = durable(mixed.mapInArrow(lambda batches, last=longest: _round(batches, k, last), schema))
        done.append(out.filter("done"))
        state = out.filter("NOT done")
    result = state
    for part in done:
        result = result.unionByName(part)
    found = result.select(F.col("query").alias("own"), "ids", "scores", "targets", "bars", "above", "tied")
    return asked.select(F.col("asked").alias("query"), F.col("query").alias("own")), found


def hand_out(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """`asked` (query, own, …) joined with the lists of `k` rows in `found` (own, …), to be unfolded where they meet.

    A list goes to as many places as its queries need, so that a place unfolds about TILE_CELLS rows however many
    queries share the list; no unfolded row is shuffled.
    """
    spark, share = asked.sparkSession, max(1, TILE_CELLS // max(k, 1))
    places = durable(asked.groupBy("own").agg(F.ceil(F.count("*") / share).alias("places")))
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-asked.count() // share))
    left = asked.join(places, "own").withColumn("place", F.pmod(F.xxhash64("query"), "places")).drop("places")
    right = found.join(places, "own").withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1))).drop("places")
    # numbers of partitions are given, since the lists are small beside what they unfold to
    return left.repartition(parts, "own", "place").join(right.repartition(parts, "own", "place"), ["own", "place"]).drop("own", "place")


def multiply_in_buckets(queries: DataFrame, catalog: DataFrame, k: int,
                        block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query, item_idx, score): the best `k` items among those that share a bucket with a query.

    queries: (query, vec, buckets[, skip_idx]); catalog: (item_idx, vec, buckets). A bucket's queries are cut into
    groups of about `group_rows` and its items into blocks of about `block_rows`, and each group meets
    each block in a partition of its own: a bucket of any size is worked on by many tasks, none of which
    holds more than its queries and one batch of items. At most k rows leave per query, bucket and block.
    """
    if "skip_idx" not in queries.columns:
        queries = queries.withColumn("skip_idx", F.lit(NO_ITEM).cast("long"))
    left = queries.select("query", F.col("vec").cast("array<double>").alias("vec"), F.col("skip_idx").cast("long").alias("skip_idx"),
                          F.explode(F.array_distinct("buckets")).alias("bucket"))
    right = catalog.select(F.col("item_idx").cast("long").alias("item_idx"), F.col("vec").cast("array<double>").alias("vec"),
                           F.explode(F.array_distinct("buckets")).alias("bucket"))
    asked, held = left.groupBy("bucket").agg(F.count("*").alias("asked")), right.groupBy("bucket").agg(F.count("*").alias("held"))
    cuts = durable(asked.join(held, "bucket").select(
        "bucket", F.ceil(F.col("asked") / group_rows).alias("groups"), F.ceil(F.col("held") / block_rows).alias("blocks")))

    def placed(rows: DataFrame, kind: int, key: str, own: str, other: str) -> DataFrame:
        mine, theirs = F.pmod(F.xxhash64(key), F.col(own)), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        met = rows.join(cuts, "bucket").withColumn("mine", mine).select("*", theirs.alias("theirs"))
        at = ("mine", "theirs") if kind == 0 else ("theirs", "mine")
        return met.select(F.xxhash64("bucket", *at).alias("group"), F.lit(kind).alias("kind"), *rows.drop("bucket").columns)

    none, no_score = F.array().cast("array<long>"), F.array().cast("array<double>")
    asking = placed(left, 0, "query", "groups", "blocks").select(
        "*", none.alias("targets"), no_score.alias("bars"), none.alias("ids"), no_score.alias("scores"),
        none.alias("above"), none.alias("tied"), F.lit(NO_ITEM).cast("long").alias("item_idx"))
    mixed = asking.unionByName(placed(right, 1, "item_idx", "blocks", "groups"), allowMissingColumns=True)
    kind = queries.schema["query"].dataType.simpleString()
    met = mixed.repartition("group").sortWithinPartitions("group", "kind").mapInArrow(
        lambda batches: _round(batches, k, None), f"query {kind}, {STATE}")
    hits = met.select("query", F.explode(F.arrays_zip(F.col("ids").alias("item_idx"), F.col("scores").alias("score"))).alias("hit"))
    found = hits.select("query", "hit.item_idx", "hit.score").groupBy("query", "item_idx").agg(F.max("score").alias("score"))
    return first_per_key(found, ["query"], [F.desc("score"), F.asc("item_idx")], k)
