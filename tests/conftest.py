from __future__ import annotations

import pytest

from charloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def col(spark):
    """Apply a ``Column -> Column`` function to a list of strings."""
    from pyspark.sql import functions as F

    def run(f, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in rows]

    return run
