import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 8g pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from sparkrec.session import build_session

    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        # tiny inputs: compiling plans would cost more than running them
        "spark.sql.codegen.wholeStage": "false"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Sorted plain tuples of a frame."""
    from oracle import plain

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=repr)

    return collect
