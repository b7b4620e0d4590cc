"""Session helpers: lineage cuts, input parallelism, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in rows, that ``small_side`` broadcasts (two longs a row: about 32 MB as a hash relation).
BROADCAST_ROWS = 400_000


def local_session(app: str = "framemill", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-node session as tests and bench use it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _checkpoint_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where that is unset on a single node (tests) a temporary one is made.

    On a cluster without that setting it is an error: executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(shared or _own_folder(context.master))
    return context._jsc.sc().getCheckpointDir().get()


def _own_folder(master: str) -> str:
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="framemill-checkpoint-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path for written tables in the folder that all executors share."""
    return f"{_checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def task_target(spark: SparkSession) -> int:
    """Number of tasks a CPU-bound stage should have at least."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a CPU-heavy input only when its scan has fewer splits than the cluster has cores.

    The split count comes from the plan; no rows are read. An input that a shuffle made is left as it is.
    """
    spark = df.sparkSession
    execution = df._jdf.queryExecution()
    if execution.executedPlan().nodeName() == "AdaptiveSparkPlan" or execution.toRdd().getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(task_target(spark), *[F.col(k) for k in keys])


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of ``df`` only when its counted rows stay under ``limit``; else Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def arrow_batches(spark: SparkSession) -> None:
    """Large Arrow batches for the vectorised operators (rows stay bounded by the row count)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
