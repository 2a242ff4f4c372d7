"""Exact deduplication against immutable snapshots.

Two texts are equal when they are identical without white space. A snapshot (rows
that were deduplicated earlier and never change) is grouped by the SHA-256 of that
normal form and its digests are put into static binary-fuse filters, one per hash
bucket. Incoming rows are grouped by digest among themselves; only the digests that
a filter of their bucket lets pass meet the snapshot's groups in an exact join on the
digest. Every group of more than one row is then compared byte by byte, and rows of a
group whose bytes differ (a collision) are grouped by their bytes instead.

Of equal texts the row with the most code points in the original text stays, then the
smallest id (NULL ids last), then the first of otherwise identical rows.

Defined results: NULL text counts as empty; all texts of white space only form one
group; an empty table gives an empty result; other columns, whatever their names, are
never read by `label` and are passed through by `keep_one`. Nothing is capped: groups
are counted with map-side combining, so a hot digest costs one row per task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm import fuse
from sparkrec.llm.common import SPACES, id_remainder, identified, text_of
from sparkrec.session import durable

BUCKET_KEYS = 100_000  # digests per filter


def normal_form(text: str = "text") -> Column:
    """The text without white space."""
    return F.translate(text_of(text), SPACES, "")


def digest_of(text: str = "text", bits: int = 256) -> Column:
    """SHA-256 of the normal form; fewer `bits` only in tests, to see collisions."""
    full = F.unhex(F.sha2(normal_form(text).cast("binary"), 256))
    return full if bits == 256 else F.substring(full, 1, bits // 8)


def _rows(docs: DataFrame, snapshot: Column, bits: int, rid: Column, *more: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.length(text_of()).cast("long").alias("n_cp"),
        digest_of(bits=bits).alias("digest"),
        F.coalesce(snapshot, F.lit(False)).alias("old"),
        rid.alias("rid"), *more,
    )


def _best() -> Column:
    """Sorts the row that stays first."""
    return F.struct((-F.col("n_cp")).alias("short"), F.col("id").isNull().alias("unnamed"), "id", "rid")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(_best()).alias("best"))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    made = fuse.build(group["key"].to_numpy())
    return pd.DataFrame([(group["bucket"].iloc[0], str(made.seed), made.segment, made.segments, made.slots)],
                        columns=["bucket", "seed", "segment", "segments", "slots"])


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One static filter per hash bucket of the snapshot's digests."""
    return _keyed(groups, buckets).select("bucket", "key").groupBy("bucket").applyInPandas(
        _build, "bucket long, seed string, segment long, segments long, slots binary")


def _keyed(groups: DataFrame, buckets: int) -> DataFrame:
    # two hashes: the key must not be constant modulo the number of buckets inside one
    return groups.withColumn("key", F.xxhash64("digest")).withColumn(
        "bucket", F.pmod(F.hash("digest"), F.lit(buckets)).cast("long"))


def _screen(group: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    hit = pd.Series(False, index=group.index)
    for f in filters.itertuples():
        made = fuse.FuseFilter(int(f.seed), f.segment, f.segments, f.slots)
        hit |= made.contains(group["key"].to_numpy())
    return pd.DataFrame({"digest": group["digest"], "maybe": hit})


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """(digest, maybe): does a filter of the digest's bucket let it pass?"""
    keyed = _keyed(groups, buckets).select("bucket", "key", "digest")
    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(
        _screen, "digest binary, maybe boolean")


def group_digests(rows: DataFrame) -> DataFrame:
    """(digest, n, best) of all rows, snapshot and incoming, by way of the filters."""
    old = durable(_grouped(rows.filter("old")))
    new = durable(_grouped(rows.filter("NOT old")))
    buckets = 1 + max(old.count(), new.count()) // BUCKET_KEYS
    passed = durable(screen(new, durable(build_filters(old, buckets)), buckets))
    new = new.join(passed, "digest")
    merged = (
        old.unionByName(new.filter("maybe").drop("maybe"))
        .groupBy("digest").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    )
    return merged.unionByName(new.filter("NOT maybe").drop("maybe"))


def collisions(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests of groups whose bytes are not all the same: least and greatest differ."""
    several = groups.filter("n > 1").select("digest").hint("shuffle_hash")
    met = texts.join(several, "digest", "left_semi").withColumn("salt", F.pmod(F.hash("bytes", "rid"), F.lit(64)))
    # the salt splits the rows of a hot digest over tasks; each task sends one row on
    return met.repartition("digest", "salt").groupBy("digest").agg(
        F.min("bytes").alias("a"), F.max("bytes").alias("b")).filter("a <> b").select("digest")


def resolve(texts: DataFrame, rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and groups with a column `variant`: empty, or the bytes where a digest collided.

    texts: (digest, id, n_cp, rid, bytes) of all rows.
    """
    clash = durable(collisions(texts, groups))
    none = F.lit(b"").alias("variant")
    rows = rows.select("digest", "id", "n_cp", "rid", none)
    groups = groups.select("digest", "n", "best", none)
    if clash.isEmpty():
        return rows, groups
    apart = durable(texts.join(clash, "digest", "left_semi").withColumnRenamed("bytes", "variant"))
    split = apart.groupBy("digest", "variant").agg(F.count("*").alias("n"), F.min(_best()).alias("best"))
    return (
        rows.join(clash, "digest", "left_anti").unionByName(apart),
        groups.join(clash, "digest", "left_anti").unionByName(split),
    )


def label(docs: DataFrame, snapshot: Column | None = None, bits: int = 256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `snapshot` tells the rows of the immutable snapshot; by default half of the ids.
    """
    old = id_remainder(2) == 0 if snapshot is None else snapshot
    rid = F.monotonically_increasing_id()
    rows = durable(_rows(docs, old, bits, rid))
    groups = durable(group_digests(rows))
    texts = _rows(docs, old, bits, rid, normal_form().cast("binary").alias("bytes")).drop("old")
    rows, groups = resolve(texts, rows, groups)
    best = groups.select("digest", "variant", "n", F.col("best.id").alias("keep_id"), F.col("best.rid").alias("keep"))
    out = rows.join(best, ["digest", "variant"])
    return out.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("rid") == F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, snapshot: Column | None = None, bits: int = 256, stored: bool = False) -> DataFrame:
    """The documents that stay, with all their columns. `stored`: `docs` are files as they were read.

    Rows are known by their file and place, so every later step, and every task run
    again after a lost executor, means the same rows.
    """
    old = id_remainder(2) == 0 if snapshot is None else snapshot
    known = identified(docs, stored)
    flat = known.select("doc.doc_id", "doc.text", "rid")
    rows = durable(_rows(flat, old, bits, F.col("rid")))
    groups = durable(group_digests(rows))
    texts = _rows(flat, old, bits, F.col("rid"), normal_form().cast("binary").alias("bytes")).drop("old")
    rows, groups = resolve(texts, rows, groups)
    gone = (
        rows.join(groups.filter("n > 1").select("digest", "variant", F.col("best.rid").alias("keep")), ["digest", "variant"])
        .filter("rid <> keep").select("rid").hint("shuffle_hash")
    )
    return known.join(gone, "rid", "left_anti").select("doc.*")
