"""Staged Parquet loads whose columns drift between files."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkrec.operators.contracts import Contract, ContractError, conform, fill_missing_optional
from sparkrec.session import path_exists

FILES_PER_TASK = 200


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, form): names and types of each file's columns; NULL where only Spark can open the path."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs, parquet

    for batch in batches:
        forms = []
        for path in batch["path"]:
            try:
                files, place = fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and path[6] != "/" else path)
            except (ArrowInvalid, ArrowNotImplementedError, OSError):
                forms.append(None)
                continue
            forms.append("; ".join(f"{f.name} {f.type}" for f in sorted(parquet.read_schema(place, filesystem=files), key=lambda f: f.name)))
        yield pd.DataFrame({"path": batch["path"], "form": pd.Series(forms, dtype=object)})


def schema_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The Parquet files below `path`, grouped by the names and types of their columns.

    Contents are not read: files are listed, and their footers are read by tasks.
    """
    if not path_exists(spark, path):
        return []
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path")
    tasks = 1 + files.count() // FILES_PER_TASK
    groups = defaultdict(list)
    for row in files.repartition(tasks).mapInPandas(_footers, "path string, form string").collect():
        form = row.form
        if form is None:
            form = "; ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted(spark.read.parquet(row.path).schema, key=lambda f: f.name))
        groups[form].append(row.path)
    return [sorted(groups[form]) for form in sorted(groups)]


def read_staging(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """All files below `path` in contract form, one cast per distinct schema.

    Files may disagree on the type of a column (a price as integer, double, decimal or text) and
    lack optional ones, which read as NULL; other columns are dropped. A required column that
    some file lacks is an error, with the number of such files; NULLs in a required column are
    rows like others here and found by `contracts.validate`. Nothing there gives an empty typed frame.
    """
    groups = schema_groups(spark, path)
    if not groups:
        return spark.createDataFrame([], contract.schema)
    frames = [spark.read.parquet(*paths) for paths in groups]
    required = [f.name for f in contract.fields if not f.nullable]
    lacking = {c: sum(len(g) for g, f in zip(groups, frames) if c not in f.columns) for c in required}
    problems = [f"{c}: column missing in {n} files" for c, n in lacking.items() if n]
    if problems:
        raise ContractError(contract.name, problems)
    first, *rest = [conform(fill_missing_optional(f, contract), contract) for f in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def read_batches(spark: SparkSession, *paths: str) -> DataFrame:
    """Several batch files as one frame, columns by name."""
    first, *rest = [spark.read.parquet(p) for p in paths]
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def query_view(df: DataFrame, sql: str = "SELECT * FROM {t}") -> DataFrame:
    """Ad-hoc SQL over `df`, written `{t}`; no view of the session is touched."""
    return df.sparkSession.sql(sql, t=df)


def read_inter(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated interactions whose header carries type suffixes (`user_id:token`)."""
    raw = spark.read.csv(path, sep="\t", header=True)
    plain = raw.toDF(*[c.split(":")[0] for c in raw.columns])
    return plain.select("user_id", "item_id", F.col("timestamp").cast("double").alias("timestamp"))


# Metadata fields that are kept, and fields that leak the future.
META_SCHEMA = (
    "parent_asin string, title string, main_category string, categories array<string>, "
    "store string, price string"
)
LEAKY_FIELDS = ("average_rating", "rating_number", "bought_together")


def read_meta(spark: SparkSession, path: str, items: DataFrame, item: str = "item_id") -> DataFrame:
    """Item metadata lines, wanted fields only, for the given items."""
    wanted = items.select(F.col(item).alias("parent_asin"))
    return spark.read.schema(META_SCHEMA).json(path).join(wanted, "parent_asin", "left_semi")


def drop_leaky(df: DataFrame) -> DataFrame:
    return df.drop(*LEAKY_FIELDS)
