"""Table directories: a folder per written version, and a state row written last.

A table is cut into buckets by a hash of its key. A merge reads and writes only the buckets
that its delta touches; the state row names, for every bucket, the version that holds it.
Folders are never written twice, so a run that dies before its state row changes nothing and
can be repeated, and earlier versions stay readable.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sparkrec.operators import silver
from sparkrec.operators.contracts import Contract, validate
from sparkrec.session import durable, path_exists, scratch_dir

FILE_BYTES = 512 << 20  # of a compacted file
RANGE_BYTES = 64 << 20  # sorted by one task of a compaction
DENSE = "zstd"  # of compacted files
BUCKETS = 64
BUCKET, VERSION = "__bucket", "v"
STATE = "commit int, version int, watermark timestamp, rows long, committed_at timestamp, parts array<int>"
CHANGES = ("inserted", "updated", "unchanged", "stale")


def _listed(spark: SparkSession, *paths: str) -> tuple[int, int]:
    """(files, bytes) below the paths, from a listing."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(list(paths))
    n, size = listed.select("path", "length").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return n, size


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Add rows, cast to the table schema if one is given."""
    if schema is not None:
        df = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    df.write.mode("append").parquet(path)


@dataclass(frozen=True)
class Table:
    """`key` cuts the table into `buckets`; choose them so that a bucket is a few files.

    A delta of random keys touches about as many buckets as it has rows, up to all of them.
    """

    spark: SparkSession
    root: str
    key: str | None = None
    buckets: int = BUCKETS

    def _version_path(self, version: int) -> str:
        return f"{self.root}/data/{VERSION}={version}"

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def states(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/state"):
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.root}/state")

    def state(self):
        """Newest state row, or None before the first commit."""
        newest = self.states().orderBy(F.desc("commit")).limit(1).collect()
        return newest[0] if newest else None

    def _read_parts(self, parts: Sequence[int | None], wanted: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of the wanted buckets (all by default); None where none of them has a folder."""
        held = defaultdict(list)
        for bucket in range(len(parts)) if wanted is None else wanted:
            if parts[bucket]:
                held[parts[bucket]].append(bucket)
        paths = [f"{self._version_path(v)}/{BUCKET}={b}" for v, buckets in held.items() for b in buckets]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths).drop(VERSION, BUCKET)

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or those of an earlier version."""
        current = self.state()
        if version is None:
            if current is None:
                raise LookupError(f"{self.root} has no committed version")
            version = current.version
        elif current is not None and version != current.version:
            of_version = self.states().filter(F.col("version") == version).orderBy(F.desc("commit")).limit(1).collect()
            current = of_version[0] if of_version else None
        if current is not None and current.parts is not None:
            rows = self._read_parts(current.parts)
            if rows is not None:
                return rows
        return self.spark.read.parquet(self._version_path(version))

    def read_as_of(self, version: int | None) -> tuple[DataFrame, str, int]:
        """(rows, source, version used): the asked version, or the current one if it is gone."""
        if version is not None:
            try:
                return self.read(version), "snapshot", version
            except AnalysisException as error:
                if "PATH_NOT_FOUND" not in str(error):
                    raise
        current = self.state().version
        return self.read(current), "current", current

    def _write(self, df: DataFrame, version: int, *counts: Column, codec: str | None = None) -> dict:
        """Write a version; counts and the buckets it holds come from the same write.

        They are observed behind the last shuffle, where a task that runs again is counted once.
        """
        seen, path = Observation(), self._version_path(version)
        rows = F.count(F.lit(1)).alias("rows")
        if self.key is None:
            df.observe(seen, rows, *counts).write.mode("overwrite").parquet(path, compression=codec)
            return {**seen.get, "held": None}
        plain = [c for c in df.columns if c != "change"]
        placed = df.withColumn(BUCKET, self.bucket_of()).hint("rebalance", BUCKET).observe(
            seen, rows, F.collect_set(BUCKET).alias("held"), *counts)
        placed.select(*plain, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        got = seen.get
        if not got["rows"]:  # a folder that still tells the columns
            df.select(*plain).write.mode("overwrite").parquet(path)
        return got

    def overwrite(self, df: DataFrame, committed_at: datetime, watermark: datetime | None = None, codec: str | None = None) -> int:
        """Replace the whole content; without a new watermark the old one stays."""
        before = self.state()
        version = 1 if before is None else before.version + 1
        if watermark is None and before is not None:
            watermark = before.watermark
        got = self._write(df, version, codec=codec)
        parts = None if got["held"] is None else [version if b in set(got["held"]) else None for b in range(self.buckets)]
        self._commit(version, watermark, got["rows"], committed_at, parts)
        return version

    def merge(self, delta: DataFrame, committed_at: datetime, watermark: datetime | None = None,
              ties: str = silver.KEEP_STORED, order: Sequence[str] = (), keys: DataFrame | None = None) -> dict:
        """Merge rows unique by key into the buckets they touch; counts by kind of change.

        Without an inserted or updated row only the watermark moves. `keys` is a frame with the keys of `delta`, as often as
        it likes, that tells the touched buckets; then `delta` is read once, so it is not stored and stays placed by key.
        """
        before = self.state()
        table = replace(self, buckets=len(before.parts))
        if keys is None:
            keys = delta = durable(delta)
        touched = sorted(r[0] for r in keys.select(table.bucket_of()).distinct().collect())
        stored = self._read_parts(before.parts, touched)
        stored = self.spark.createDataFrame([], delta.schema) if stored is None else stored.select(*delta.columns)
        version = before.version + 1
        counts = {c: 0 for c in CHANGES}
        if touched:
            labels = [F.count_if(F.col("change") == c).alias(c) for c in CHANGES]
            got = table._write(silver.merge(stored, delta, self.key, ties, order), version, *labels)
            counts = {c: got[c] for c in CHANGES}
        mark = before.watermark if watermark is None else watermark
        if counts["inserted"] + counts["updated"]:
            parts = [version if b in set(got["held"]) else p for b, p in enumerate(before.parts)]
            self._commit(version, mark, before.rows + counts["inserted"], committed_at, parts)
        elif mark != before.watermark:
            self.move_watermark(mark, committed_at)
        return counts

    def move_watermark(self, watermark: datetime, committed_at: datetime) -> None:
        """Same data, later watermark."""
        before = self.state()
        self._commit(before.version, watermark, before.rows, committed_at, before.parts)

    def record(self, watermark: datetime, rows: int, committed_at: datetime) -> None:
        """A state row without data of its own (cursors of extracts)."""
        self._commit(0, watermark, rows, committed_at)

    def _commit(self, version, watermark, rows, committed_at, parts=None) -> None:
        before = self.state()
        commit = 1 if before is None else before.commit + 1
        row = self.spark.createDataFrame([(commit, version, watermark, rows, committed_at, parts)], STATE)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/state")

    def files(self) -> tuple[int, int]:
        """(files, bytes) of the current version, from a listing; contents are not read."""
        state = self.state()
        paths = [self._version_path(state.version)] if state.parts is None else [
            f"{self._version_path(v)}/{BUCKET}={b}" for b, v in enumerate(state.parts) if v]
        return _listed(self.spark, *paths) if paths else (0, 0)

    def file_count(self) -> int:
        return self.files()[0]

    def compact(self, committed_at: datetime, file_bytes: int = FILE_BYTES) -> bool:
        """Rewrite into files of about `file_bytes`; a table that has no more of them is left alone.

        Rows of a table without a key are sorted by range and compressed first, and what they take
        then decides on the number of files: in order they take less than in the order they came.
        """
        n, size = self.files()
        wanted = max(1, -(-size // file_bytes))
        if n <= wanted:
            return False
        if self.key is not None:
            self.overwrite(self.read().repartition(wanted), committed_at)
        else:
            self.overwrite(self._dense(self.read(), max(wanted, size // RANGE_BYTES), file_bytes), committed_at, codec=DENSE)
        return True

    def _dense(self, rows: DataFrame, ranges: int, file_bytes: int) -> DataFrame:
        """Sorted rows in as many partitions as files of `file_bytes` hold them; a partition is read by one task."""
        order = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType)]
        placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order) if order else rows.repartition(ranges)
        path = scratch_dir(self.spark)
        placed.write.mode("overwrite").parquet(path, compression=DENSE)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        files = max(1, -(-_listed(self.spark, path)[1] // file_bytes))
        # without a shuffle, unless files are smaller than the pieces that are read
        return stored.coalesce(files) if stored.rdd.getNumPartitions() >= files else stored.repartition(files)


def sync_silver(
    bronze: DataFrame,
    table: Table,
    key: str,
    columns: list[str],
    committed_at: datetime,
    full_refresh: bool = False,
    ties: str = silver.KEEP_STORED,
    order_ties: tuple[str, ...] = (),
    contract: Contract | None = None,
) -> dict:
    """Bring a Silver table up to date with Bronze and report what happened.

    The rows of a delta are stored first, so they are read once and what is counted is what
    is merged. Rows are checked against `contract` between dedup and commit. Data and counters
    come from the same write; the state row with the new watermark follows last.
    """
    if table.key is None:
        table = replace(table, key=key)
    before = table.state()
    mark = None if before is None else before.watermark
    full = full_refresh or mark is None or before.parts is None
    if full:
        # Bronze is not copied: a row that arrives after this look is left for the next run
        facts = _facts(bronze)
        scanned = bronze if facts.w is None else bronze.filter(F.col(silver.INGESTED_AT) <= F.lit(facts.newest))
    else:
        needed = list(dict.fromkeys([*columns, silver.INGESTED_AT]))
        scanned = durable(bronze.filter(F.col(silver.INGESTED_AT) > F.lit(mark)).select(*needed))
        facts = _facts(scanned)
    report = {
        "mode": "full" if full else "incremental", "rows_scanned": facts.n,
        "rows_inserted": 0, "rows_updated": 0, "rows_upserted": 0,
        "rows_skipped_stale": 0, "rows_after_dedup": 0,
        "watermark_before": silver.format_watermark(mark),
        "watermark_after": silver.format_watermark(mark),
    }
    if not full and facts.n == 0:
        return report
    newest = silver.latest_by_key(scanned, [key], columns, order_ties)
    if contract is not None:
        newest = validate(durable(newest), contract)
    if full:
        table.overwrite(newest, committed_at, facts.w)
        rows = table.state().rows
        report |= {"rows_inserted": rows, "rows_upserted": rows, "rows_after_dedup": rows}
    else:
        got = table.merge(newest, committed_at, facts.w, ties)
        upserted = got["inserted"] + got["updated"]
        report |= {
            "rows_inserted": got["inserted"], "rows_updated": got["updated"], "rows_upserted": upserted,
            "rows_skipped_stale": got["stale"], "rows_after_dedup": upserted + got["unchanged"],
        }
    report["watermark_after"] = silver.format_watermark(facts.w or mark)
    return report


def _facts(rows: DataFrame):
    """Number of rows and latest ingest time, as stored and as a timestamp."""
    newest = F.max(silver.INGESTED_AT)
    return rows.agg(F.count("*").alias("n"), newest.alias("newest"), newest.cast("timestamp").alias("w")).first()
