"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(name: str = "sparkrec", **conf: str) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC time."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: list[str] = []
_shipped: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the shared folder the cluster names for checkpoints.

    Only a local session (one machine) that names none gets a temporary folder, one per
    process; on a cluster a folder of one machine would lose rows, so that is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        if not _fallback:
            _fallback.append(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = _fallback[0]
    return f"{root.rstrip('/')}/sparkrec-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


# A side of at most this many narrow rows may be sent to every executor.
BROADCAST_ROWS = 1_000_000


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to a table in the shared folder and read it back.

    Cuts the lineage: partition-dependent columns (range-partition numbers, row
    offsets) stay the same for every later reader and after executor loss.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if it is counted to be small; otherwise left to shuffle."""
    stored = durable(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Clusters usually get it through `--py-files`; this covers sessions started
    without it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "sparkrec.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
