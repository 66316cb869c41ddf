"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Names the number of partitions a caller wants its input tables dealt into; unset, scan splits stay.
INPUT_PARTITIONS = "charloom.input.partitions"


def build_session(app: str = "charloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Rankings up to this limit drop rows before their shuffle; token rankings go to 5,000.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="charloom-"))
    return sc.getCheckpointDir().rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the staging folder."""
    return f"{staging_root(spark)}/charloom-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the staging folder and read it back.

    Cuts the lineage with files that outlive a lost executor. Use it where a result is read more than
    once, or where a value depends on the physical layout and must not be evaluated twice.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the caller asked for (``INPUT_PARTITIONS``), else as it is.

    Spark never splits a parquet row group, so a table of one row group is one task. Dealing it out is up to the
    caller, whatever its size, and by no key, so that later joins need the exchanges that a large input needs.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df
