"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# A dimension below both bounds is sent to every executor.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def settings(**extra: str) -> dict[str, str]:
    """Settings the jobs rely on; a cluster keeps its own sizes."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Long expressions are built call by call; do not record a stack for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    return {**base, **extra}


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, **more: str
) -> SparkSession:
    """A session on this machine, for tests and for the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("augury")
    extra = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
    }
    for key, value in settings(**extra, **more).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh one only in local sessions that name none."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="augury-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one written table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage reliably: rows, and their order within tasks, no longer change."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def is_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Whether a table is within both bounds, by a bounded look at its row widths.

    ``take`` opens a few partitions at a time and stops at ``max_rows + 1`` rows, so a
    large table costs no more than that. Meant for tables as read, not for results of
    large joins or aggregates.
    """
    width = F.octet_length(F.to_json(F.struct("*"))).alias("width")
    seen = df.select(width).take(max_rows + 1)
    return len(seen) <= max_rows and sum(row["width"] or 0 for row in seen) <= max_bytes


def broadcast_if_small(df: DataFrame, **bounds: int) -> DataFrame:
    """Hint a broadcast only for a side proven small.

    Any other side comes back unhinted: the join is then a shuffle join whose form AQE
    picks from measured sizes, and whose skewed keys it splits.
    """
    return F.broadcast(df) if is_small(df, **bounds) else df


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this machine's files import the package from where it lies."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def spread(scan: DataFrame) -> DataFrame:
    """Give a small scan as many tasks as there are cores.

    For thin rows in few file splits that feed costly expressions. A scan with more
    splits than cores, which is any large one, comes back as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
