"""Reading the text tables and keeping intermediate results."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from subsmart.operators.spread import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Bounds on what a Python task holds at once: rows and bytes of one Arrow batch.
BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python tasks by rows and bytes.

    Tasks find this package where the driver does; a cluster may also ship it as a file.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Later reads do not depend on the executors that computed it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
