"""Hash keys of the dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stand-in for NULL and the separator decide the hash, so they
# must be exactly these for keys to agree with tables built elsewhere.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of ``columns``; a NULL hashes like a value of its own."""
    if not columns:
        raise ValueError("a surrogate key needs at least one column")
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TEXT))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
