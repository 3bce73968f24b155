"""Scans that keep rows which break the declared schema apart, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsmart.schemas import SOURCES
from subsmart.sources.files import exists

# The columns that a source's rows must have.
REQUIRED = {
    "accounts": ["id", "signup_date"],
    "subscriptions": ["account_id", "start_date"],
    "usage_events": ["account_id", "event_id", "event_time"],
    "object_counts_daily": ["date", "account_id"],
}
CORRUPT = "_corrupt_record"
MALFORMED = "malformed row"
REJECTS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("raw", T.StringType()),
    ]
)


def read_text(spark: SparkSession, name: str, location: str, fmt: str = "csv", **options: str) -> DataFrame:
    """Source ``name`` as text columns, with the file of each row and rows that are not whole.

    For ``csv`` and ``json``. Nothing is cast, so no value stops the scan or is lost.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"{fmt} has types of its own; read it with read_source")
    texts = [T.StructField(field.name, T.StringType()) for field in SOURCES[name]]
    schema = T.StructType([*texts, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.format(fmt).schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return reader.options(**options).load(location).select("*", F.col("_metadata.file_path").alias("_file"))


def _typed(field: T.StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def _exact(field: T.StructField) -> Column:
    """Whether the cast keeps the value: a decimal must not be rounded or cut."""
    if isinstance(field.dataType, T.DecimalType):
        wide = F.col(field.name).try_cast(T.DecimalType(38, 18))
        return wide.isNull() | (_typed(field).cast(T.DecimalType(38, 18)) == wide)
    return F.lit(True)


def reasons(name: str) -> Column:
    """Why a text row of source ``name`` breaks its schema; empty where it does not."""
    found = [F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED))]
    for field in SOURCES[name]:
        text, kind = F.col(field.name), field.dataType.simpleString()
        if not isinstance(field.dataType, T.StringType):
            bad = text.isNotNull() & (_typed(field).isNull() | ~_exact(field))
            found.append(F.when(bad, F.lit(f"{field.name}: not a {kind}")))
        if field.name in REQUIRED[name]:
            found.append(F.when(F.col(CORRUPT).isNull() & text.isNull(), F.lit(f"{field.name}: missing")))
    return F.array_compact(F.array(*found))


def route(spark: SparkSession, name: str, texts: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_text`` that fit the schema of source ``name``, and the others.

    One scan writes every row once, to one of two folders below ``root``; a row with several
    faults is one reject with all its reasons. Accepted rows have the declared types;
    rejects have ``REJECTS``: the source, the file, the reasons and the row as JSON, or as it
    stands in the file where it is malformed.
    """
    schema = SOURCES[name]
    own = F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})
    tagged = texts.withColumn("_reasons", reasons(name))
    bad = F.size("_reasons") > 0
    path = f"{root.rstrip('/')}/{name}"
    tagged.select(
        *(F.when(~bad, _typed(field)).alias(field.name) for field in schema),
        F.when(bad, F.struct(
            F.lit(name).alias("source"),
            F.col("_file").alias("file"),
            F.col("_reasons").alias("reasons"),
            F.coalesce(CORRUPT, own).alias("raw"),
        )).alias("_reject"),
        bad.alias("_rejected"),
    ).write.mode("overwrite").partitionBy("_rejected").parquet(path)
    accepted = _part(spark, path, False, schema)
    rejected = _part(spark, path, True, T.StructType([T.StructField("_reject", REJECTS)]))
    return accepted, rejected.select("_reject.*")


def _part(spark: SparkSession, path: str, rejected: bool, schema: T.StructType) -> DataFrame:
    folder = f"{path}/_rejected={str(rejected).lower()}"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def reject_report(rejects: DataFrame, name: str) -> DataFrame:
    """Rejected rows by reason, in the form of the quality report; no faults, one passing row.

    ``failures`` counts rows; a row with two faults counts under both.
    """
    counted = rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("failures")
    )
    column = F.when(F.col("reason") == MALFORMED, "").otherwise(F.split_part("reason", F.lit(":"), F.lit(1)))
    found = counted.select(
        F.lit(name).alias("table"),
        column.alias("column"),
        F.concat(F.lit("schema: "), "reason").alias("check"),
        F.lit("fail").alias("status"),
        "failures",
    )
    none = rejects.agg(F.count("*").alias("failures")).filter("failures = 0").select(
        F.lit(name).alias("table"), F.lit("").alias("column"), F.lit("schema").alias("check"),
        F.lit("pass").alias("status"), "failures",
    )
    return found.unionByName(none)
