"""Scans of the raw sources with pinned schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subsmart.schemas import SOURCES


def read_source(
    spark: SparkSession, name: str, location: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Scan source ``name`` from files at ``location``.

    The schema is declared, never inferred: no footer sampling, and only the
    columns used downstream are read from columnar formats.
    """
    reader = spark.read.format(fmt).schema(SOURCES[name])
    return reader.options(**options).load(location)


def source_table(spark: SparkSession, name: str, table: str | None = None) -> DataFrame:
    """Scan source ``name`` from a catalog table."""
    return require_columns(spark.table(table or name), name)


def require_columns(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it has every column declared for source ``name``."""
    missing = [field.name for field in SOURCES[name] if field.name not in df.columns]
    if missing:
        raise ValueError(f"source {name} lacks columns: {', '.join(missing)}")
    return df
