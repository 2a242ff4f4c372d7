"""Merkle manifest of a table, every row proved by way of one octopus multiproof per block of leaves.

A leaf is the SHA-256 of a row's fields. The leaves of a source, by document id, form a tree
of runs of 16; the roots of the sources form the tree above them. All hashes are lowercase hex.

Leaves are cut into chunks that are whole subtrees, and chunks are dealt to blocks. A block
derives the interiors of its chunks itself; from the shapes of the trees it computes the least
set of nodes it lacks on all its paths together, and fetches these once, in one join with the
table of upper nodes (a 4096th of the leaves). It then derives the interiors its paths share
and expands the proof of every leaf on the spot, so proofs are never stored or shuffled.

Defined results: NULL fields are written as `-`; NULL ids come first in their source and count
as empty text where an id is hashed; the NULL source is a source like any other and comes
first; repeated rows are leaves of their own, and rows of equal id are ordered by their leaf;
the proof of the only leaf of the only source is the hash of nothing; texts of any length are
hashed whole, inside the scan; an empty table gives an empty result; other columns, whatever
their names, are not read. A hot source is many chunks, none larger than `CHUNK`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import id_remainder, lowered
from sparkrec.operators.ordering import dense_index, positions
from sparkrec.session import durable

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 4
FAN = 1 << BITS
CHUNK_LEVEL = 3
CHUNK = FAN ** CHUNK_LEVEL  # leaves of a chunk, and about the leaves of a block
TOP = "^"  # the tree over the sources; keys of sources are empty or begin with "="


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(text: Column | None = None) -> Column:
    """Hash of a row; `text` stands in for the text of the row."""
    fields = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def height(n: int) -> int:
    """Levels above `n` nodes until one remains."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def missing(held: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Least set of (level, place) that with the nodes at places `held` of `n` gives every path to the root."""
    held, level, out = set(held), 0, []
    while n > 1:
        runs = {i >> BITS for i in held}
        out += [(level, i) for r in sorted(runs) for i in range(r << BITS, min(n, (r + 1) << BITS)) if i not in held]
        held, n, level = runs, -(-n // FAN), level + 1
    return out


class Nodes:
    """Known nodes of the trees; interiors are derived once and kept."""

    def __init__(self) -> None:
        self.at: dict[tuple[str, int, int], str] = {}

    def derive(self, tree: str, held: Iterable[int], n: int) -> str:
        """All interiors above the nodes at places `held` of `n`, level by level; the root."""
        held, level = set(held), 0
        while n > 1:
            held = {i >> BITS for i in held}
            for i in held:
                run = range(i << BITS, min(n, (i + 1) << BITS))
                self.at[tree, level + 1, i] = digest(self.at[tree, level, j] for j in run)
            n, level = -(-n // FAN), level + 1
        return self.at[tree, level, 0]

    def path(self, tree: str, place: int, n: int) -> list[tuple[str, str]]:
        """Siblings (left, right) of a node on each level up to the root of its tree."""
        steps, level = [], 0
        while n > 1:
            low, high = place >> BITS << BITS, min(n, ((place >> BITS) + 1) << BITS)
            run = [self.at[tree, level, i] for i in range(low, high)]
            steps.append(("".join(run[: place - low]), "".join(run[place - low + 1:])))
            place, n, level = place >> BITS, -(-n // FAN), level + 1
        return steps


def _chunk_levels(leaves: list[str], chunk: int) -> list[list[str]]:
    """Levels of a chunk from its leaves to its root; a first chunk that is not full is the whole tree."""
    whole = chunk == 0 and len(leaves) < CHUNK
    levels = [leaves]
    for _ in range(height(len(leaves)) if whole else CHUNK_LEVEL):
        now = levels[-1]
        levels.append([digest(now[i:i + FAN]) for i in range(0, len(now), FAN)])
    return levels


def _chunks(rows: pd.DataFrame):
    for (key, chunk), group in rows.groupby(["key", "chunk"], sort=True):
        yield key, int(chunk), group.sort_values("place")


def _chunk_roots(rows: pd.DataFrame) -> pd.DataFrame:
    out = [(rows["block"].iloc[0], key, chunk, _chunk_levels(group["leaf"].tolist(), chunk)[-1][0])
           for key, chunk, group in _chunks(rows)]
    return pd.DataFrame(out, columns=["block", "tree", "place", "hash"])


def _grown(nodes: DataFrame) -> list[DataFrame]:
    """All levels of many trees, (tree, level, place, n, hash); n is the number of nodes of the tree on the level.

    nodes: (tree, place, n, hash) of level 0. Trees of one node are finished.
    """
    levels = [durable(nodes.withColumn("level", F.lit(0)))]
    while levels[-1].agg(F.max("n")).first()[0] not in (None, 1):
        run = F.array_sort(F.collect_list(F.struct("place", "hash")))
        up = (
            levels[-1].filter("n > 1")
            .groupBy("tree", F.shiftright("place", BITS).alias("place"), F.ceil(F.col("n") / FAN).alias("n"),
                     (F.col("level") + 1).alias("level"))
            .agg(F.sha2(F.array_join(F.transform(run, lambda s: s["hash"]), ""), 256).alias("hash"))
        )
        levels.append(durable(up))
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _wanted(chunks: pd.DataFrame) -> pd.DataFrame:
    """What a block has to fetch for all its chunks, and on the tree of the sources above them."""
    block, out = chunks["block"].iloc[0], []
    for tree, group in chunks.groupby("tree"):
        out += [(block, tree, level, at) for level, at in missing(group["place"].tolist(), int(group["n"].iloc[0]))]
    out += [(block, TOP, level, at) for level, at in missing(chunks["source_at"].tolist(), int(chunks["sources"].iloc[0]))]
    return pd.DataFrame(out, columns=["block", "tree", "level", "place"])


def _fold(steps: list[tuple[str, str]], start: str) -> str:
    for left, right in steps:
        start = digest((left, start, right))
    return start


def _expanded(rows: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
    """Proofs of a block's leaves. facts: its chunks (no level) and the nodes it fetched."""
    nodes, out = Nodes(), []
    fetched = facts[facts["fetched"]]
    nodes.at.update(zip(zip(fetched["tree"], fetched["level"].astype(int), fetched["place"].astype(int)), fetched["hash"]))
    chunks = facts[~facts["fetched"]]
    nodes.at.update(((f.tree, 0, int(f.place)), f.hash) for f in chunks.itertuples())
    subroots, tops = {}, {}
    for tree, group in chunks.groupby("tree"):
        subroots[tree] = nodes.derive(tree, group["place"].astype(int), int(group["n"].iloc[0]))
        tops[tree] = int(group["source_at"].iloc[0])
        nodes.at[TOP, 0, tops[tree]] = subroots[tree]
    sources, sizes = int(chunks["sources"].iloc[0]), dict(zip(chunks["tree"], chunks["n"].astype(int)))
    nodes.derive(TOP, tops.values(), sources)
    for key, chunk, group in _chunks(rows):
        levels = _chunk_levels(group["leaf"].tolist(), chunk)
        above = nodes.path(key, chunk, sizes[key]) + nodes.path(TOP, tops[key], sources)
        inner: dict[int, tuple[list[tuple[str, str]], str]] = {}  # steps above a run of leaves, and their text
        folded: dict[tuple[int, str], str] = {}
        for at, (doc_id, leaf, changed) in enumerate(zip(group["doc_id"], levels[0], group["changed"])):
            run = at >> BITS
            if run not in inner:
                steps, i = [], run
                for now in levels[1:-1]:
                    low = i >> BITS << BITS
                    steps.append(("".join(now[low:i]), "".join(now[i + 1:low + FAN])))
                    i >>= BITS
                steps += above
                inner[run] = steps, "".join(a + b for a, b in steps)
            steps, text = inner[run]
            low, start = run << BITS, changed if isinstance(changed, str) else leaf
            if len(levels) > 1:
                left, right = "".join(levels[0][low:at]), "".join(levels[0][at + 1:low + FAN])
                start = digest((left, start, right))
            else:
                left = right = ""
            if (run, start) not in folded:
                folded[run, start] = _fold(steps, start)
            out.append((doc_id, leaf, subroots[key], digest((left, right, text)), folded[run, start]))
    return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


def tampered() -> Column:
    """Rows that the contract tampers with: 5 divides the checksum of the id."""
    return id_remainder(5) == 0


def label(docs: DataFrame, changed: Column | None = None, chunk_rows: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    changed: the rows whose text arrives with A-Z in lower case when proofs are checked;
    chunk_rows: about how many leaves make a block.
    """
    changed = tampered() if changed is None else changed
    rows = durable(docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), leaf_of().alias("leaf"),
        F.when(changed, leaf_of(lowered(F.col("text")))).alias("changed")))
    blocks = 1 + rows.count() // chunk_rows
    placed = positions(rows, ["key"], [F.col("id").asc_nulls_first(), F.col("leaf")], "place")
    chunk = F.shiftright(F.col("place") - 1, BITS * CHUNK_LEVEL)
    placed = durable(placed.withColumn("chunk", chunk).withColumn(
        "block", F.pmod(F.xxhash64("key", "chunk"), F.lit(blocks))).drop("id"))

    roots = durable(placed.select("block", "key", "chunk", "place", "leaf").groupBy("block").applyInPandas(
        _chunk_roots, "block long, tree string, place long, hash string"))
    sizes = roots.groupBy("tree").agg(F.count("*").alias("n"))
    roots = roots.join(sizes, "tree")
    lower = _grown(roots.select("tree", "place", "n", "hash"))
    subroots = _union(lower).filter("n = 1").select("tree", "hash")
    sources = durable(dense_index(subroots, [F.col("tree")], "source_at", start=0))
    count = sources.count()
    top = _grown(sources.select(
        F.lit(TOP).alias("tree"), F.col("source_at").alias("place"), F.lit(count).cast("long").alias("n"), "hash"))
    root = top[-1].select("hash").first()

    chunks = durable(roots.join(sources.select("tree", "source_at"), "tree").withColumn("sources", F.lit(count)))
    wanted = chunks.groupBy("block").applyInPandas(_wanted, "block long, tree string, level long, place long")
    upper = _union(lower + top).select("tree", F.col("level").cast("long").alias("level"), "place", "hash")
    fetched = wanted.join(upper, ["tree", "level", "place"]).withColumn("fetched", F.lit(True))
    facts = fetched.unionByName(chunks.withColumn("fetched", F.lit(False)), allowMissingColumns=True)
    proved = placed.groupBy("block").cogroup(facts.groupBy("block")).applyInPandas(
        _expanded, "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(root.hash if root else None).cast("string")
    return proved.select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
