"""Bronze: staged loads are checked and appended, each once.

A commit is a folder with its good and its rejected rows, and a state row written last. Readers
take the folders that state rows name, so a build that dies leaves nothing behind that is read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from sparkrec.operators import contracts, ingest
from sparkrec.operators.contracts import Contract, Field
from sparkrec.session import path_exists
from sparkrec.sources.staging import read_staging
from sparkrec.sources.tables import FILE_BYTES

RUN, INGESTED, LOAD = "_extraction_run_id", "_ingested_at", "_load_id"
STATE = ("commit int, replaces int, loads array<string>, rows long, rejected long, committed_at timestamp")


def staged_contract(contract: Contract) -> Contract:
    """What a staged file holds: the source columns and the load that wrote it."""
    source = tuple(f for f in contract.fields if f.name not in (RUN, INGESTED))
    return Contract(f"staged {contract.name}", (*source, Field(LOAD, T.StringType())), contract.key)


@dataclass(frozen=True)
class Bronze:
    spark: SparkSession
    root: str
    contract: Contract

    def states(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/state"):
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.root}/state")

    def _folders(self, good: bool) -> list[str]:
        """Folders that hold the rows: a compaction stands for all commits before it, rejected rows stay where they are."""
        commits = self.states().select("commit", "replaces", "rows", "rejected").orderBy("commit").collect()
        since = max((c.commit for c in commits if c.replaces is not None), default=0) if good else 0
        return [f"{self.root}/data/commit={c.commit}/good={str(good).lower()}" for c in commits
                if c.commit >= since and (c.rows if good else c.rejected)]

    def read(self) -> DataFrame:
        """Rows of all commits."""
        paths = self._folders(True)
        return self.spark.read.schema(self.contract.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.contract.schema)

    def rejected(self) -> DataFrame:
        """Rows that were turned away, with what they failed."""
        failures = T.ArrayType(T.StructType([T.StructField("column_name", T.StringType()), T.StructField("check_name", T.StringType())]))
        schema = T.StructType([*self.contract.schema.fields, T.StructField("failures", failures)])
        paths = self._folders(False)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def loads(self) -> DataFrame:
        return self.states().select(F.explode("loads").alias(RUN)).distinct()

    def _commit(self, commit: int, replaces: int | None, loads: list[str], rows: int, rejected: int, at: datetime) -> None:
        row = self.spark.createDataFrame([(commit, replaces, loads, rows, rejected, at)], STATE)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/state")

    def _next(self) -> int:
        return 1 + (self.states().agg(F.max("commit")).first()[0] or 0)

    def build(self, staging: str, ingested_at: datetime, references: dict[str, tuple[DataFrame, str]] | None = None,
              strict: bool = False) -> dict:
        """Append the staged loads that are not committed yet; one pass writes good and rejected rows.

        A row is rejected for every rule of the contract that it breaks and every reference
        (column: (known rows, their column)) that does not exist. `strict` commits nothing if a
        row is rejected and raises with the counts. Loads without rows are not committed.
        """
        staged = read_staging(self.spark, staging, staged_contract(self.contract))
        fresh = ingest.skip_committed(staged.withColumnRenamed(LOAD, RUN), self.loads())
        stamped = contracts.stamp_lineage(fresh, F.col(RUN), ingested_at)
        checked = contracts.check_rows(stamped, self.contract)
        for column, (known, known_column) in (references or {}).items():
            flags = known.select(F.col(known_column).alias(column)).distinct().withColumn("__known", F.lit(True))
            unknown = F.array(F.struct(F.lit(column).alias("column_name"), F.lit("reference").alias("check_name")))
            checked = checked.join(flags, column, "left").withColumn(
                "failures", F.when(F.col("__known").isNull() & F.col(column).isNotNull(), F.concat("failures", unknown))
                .otherwise(F.col("failures"))).drop("__known")
        seen, good, commit = Observation(), F.size("failures") == 0, self._next()
        kept = checked.select(*self.contract.names, "failures", good.alias("good"))
        kept.observe(seen, F.count_if("good").alias("rows"), F.count_if(~F.col("good")).alias("rejected"),
                     F.sort_array(F.collect_set(RUN)).alias("loads")).write.mode("overwrite").partitionBy("good").parquet(
            f"{self.root}/data/commit={commit}")
        got = seen.get
        report = {"rows_committed": 0, "rows_rejected": got["rejected"], "load_ids_committed": []}
        if strict and got["rejected"]:
            raise contracts.ContractError(self.contract.name, [f"{got['rejected']} rows rejected"])
        if got["rows"] or got["rejected"]:
            self._commit(commit, None, got["loads"], got["rows"], got["rejected"], ingested_at)
            report |= {"rows_committed": got["rows"], "load_ids_committed": list(got["loads"])}
        return report

    def compact(self, at: datetime, file_bytes: int = FILE_BYTES) -> bool:
        """Rewrite the good rows of all commits into files of about `file_bytes`; few enough files are left alone."""
        paths = self._folders(True)
        if not paths:
            return False
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
        n, size = files.select("path", "length").agg(F.count("*"), F.sum("length")).first()
        wanted = max(1, -(-size // file_bytes))
        if n <= wanted:
            return False
        commit, seen = self._next(), Observation()
        # where state rows are written while this runs, they are later commits and stay
        self.read().repartition(wanted).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{self.root}/data/commit={commit}/good=true")
        self._commit(commit, commit - 1, [], seen.get["rows"], 0, at)
        return True
