"""Session settings the operators are tuned for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from subsmart.sources.files import folder_bytes

# Adaptive execution sizes shuffle partitions, converts joins of small sides and
# splits skewed ones, so the settings below hold from local[8] to a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Capturing a call site for every column expression costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

# Input per shuffle partition.
SHUFFLE_BYTES = 256 << 20
UNKNOWN_BYTES = 1 << 62


def fit_shuffles(spark: SparkSession, *locations: str) -> int:
    """Raise the number of shuffle partitions to suit the input at ``locations``.

    Adaptive execution merges partitions that turn out small but cannot add any, so
    the number must follow the input; it is never lowered.
    """
    return _raise_shuffles(spark, sum(folder_bytes(spark, location) for location in locations))


def fit_shuffles_to(spark: SparkSession, frames: Iterable[DataFrame]) -> int:
    """The same for frames, by what the planner knows of their size without running anything."""
    return _raise_shuffles(spark, sum(planned_bytes(frame) for frame in frames))


def planned_bytes(frame: DataFrame) -> int:
    """Bytes of the files that a frame scans, or the planner's estimate of other leaves."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    # The planner takes a leaf that it knows nothing of for the largest there is.
    return sum(size for size in map(int, sizes) if size < UNKNOWN_BYTES)


def _raise_shuffles(spark: SparkSession, size: int) -> int:
    key = "spark.sql.shuffle.partitions"
    configured = int(spark.conf.get(key))
    chosen = max(configured, size // SHUFFLE_BYTES)
    if chosen != configured:
        spark.conf.set(key, str(chosen))
    return chosen


def local_session(cores: str = "8", app: str = "subsmart", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local_only = {
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SETTINGS, **local_only, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
