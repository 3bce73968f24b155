"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.operators.spread import settle

BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
# Rows of one cell, the unit that is sorted in one place.
CELL_ROWS = 50_000
OFFSET_STEPS = 1 << 20


def word_count(text: Column) -> Column:
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")
    return F.size(found).cast("long")


def size_band(size: Column) -> Column:
    """Rises with ``size``; at most eight bands to each doubling."""
    octave = F.length(F.bin(size)).cast("int")
    drop = F.greatest(octave - 4, F.lit(0))
    return octave * 16 + F.call_function("shiftright", size, drop).cast("int")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], max_copies: int, share: float = 1.0
) -> DataFrame:
    """Targets of sources: ``source_size`` shared out by weight, none above its limit.

    ``sizes`` has one row per source (``source``, ``source_size``). Sources in code-point
    order, null last, take ``weights`` in turn. A target stops at ``max_copies`` times its
    source's size; the excess goes to the others by weight until none is above. Sorted by
    limit per weight, the sources that stop are a prefix, so one pass finds them. The
    windows run over one row per source, not over documents.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    limit = F.col("source_size").cast("double") * max_copies
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(F.lit([float(w) for w in weights]), (turn + 1).cast("int")).alias("weight"),
        limit.alias("limit"),
    )
    before = Window.orderBy(
        (F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    totals = weighed.select(
        "*",
        (F.sum(F.col("source_size")).over(everything) * F.lit(share)).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("limit").over(before), zero).alias("limit_before"),
        F.coalesce(F.sum("weight").over(before), zero).alias("weight_before"),
    )
    stops = F.col("limit") * (F.col("weights") - F.col("weight_before")) <= F.col("weight") * (
        F.col("total") - F.col("limit_before")
    )
    marked = totals.withColumn("stops", stops)
    stopped = lambda name: F.sum(F.when(F.col("stops"), F.col(name)).otherwise(zero)).over(everything)
    rest = F.try_divide(
        F.col("weight") * (F.col("total") - stopped("limit")),
        F.col("weights") - stopped("weight"),
    )
    return marked.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("limit")).otherwise(rest).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_copies: int = 3,
    seed: str = "mix",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``max_copies``).

    Each document of a source expects ``target / source_size`` copies. In the order of
    size, the running sum of the expected copies plus one offset per source, drawn from
    ``seed``, crosses integers; a document is taken once per integer crossed. As
    neighbours in that order are alike in size, the words taken come near the target.

    The order within a source is cut into cells (size bands, split by a hash of the id
    where a band has more than ``cell_rows`` rows), so a source that holds most rows is
    sorted in many places; sums over cells give each its place. Documents move once.

    Null texts have size 0, a null source is a source, rows that repeat are separate
    documents. A source without words has target 0 and gives no copies. Columns whose
    names clash with the added ones are replaced.
    """
    added = ["size", "source_size", "target", "copies"]
    docs = docs.drop(*added)
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn(
        "_band", size_band(F.col("size"))
    )
    bands = settle(
        sized.groupBy("source", "_band").agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    )
    sources = source_targets(
        bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies
    )
    # At most rows / cell_rows of these, so the broadcast is bounded.
    large = bands.filter(F.col("rows") > cell_rows).select(
        F.struct("source", "_band").alias("_large"),
        F.ceil(F.col("rows") / cell_rows).alias("_buckets"),
    )
    tie = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # Rows of one id are told apart by text, so that no order of rows decides, and hot ids split.
    text_tie = F.xxhash64(F.coalesce("text", F.lit("")))
    celled = (
        sized.withColumn("_tie", tie)
        .withColumn("_text_tie", text_tie)
        .join(F.broadcast(large), F.struct("source", "_band") == F.col("_large"), "left")
        .withColumn("_bucket", F.coalesce(F.pmod(F.xxhash64("_tie", "_text_tie"), F.col("_buckets")), F.lit(0)))
        .withColumn("_cell", F.struct("source", "_band", "_bucket"))
        .drop("_large", "_buckets")
    )
    along = (
        Window.partitionBy("source")
        .orderBy("_band", "_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = (
        celled.groupBy("source", "_band", "_bucket")
        .agg(F.count("*").alias("rows"))
        .withColumn("_before", F.coalesce(F.sum("rows").over(along), F.lit(0)))
    )
    step = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 5), 16, 10)
    plan = (
        cells.join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_each", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
        .select(
            F.struct("source", "_band", "_bucket").alias("_place"),
            "_before",
            "source_size",
            "target",
            "_each",
            (step.cast("double") / OFFSET_STEPS).alias("_offset"),
        )
    )
    within = Window.partitionBy("_cell").orderBy("size", "_tie", F.col("doc_id").asc_nulls_last(), "_text_tie")
    rank = F.col("_before") + F.row_number().over(within)
    crossed = lambda n: F.floor(n * F.col("_each") + F.col("_offset"))
    placed = celled.join(plan, F.col("_cell") == F.col("_place")).withColumn("_rank", rank)
    copies = crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)
    return placed.withColumn(
        "copies", F.least(copies, F.ceil(F.col("_each"))).cast("long")
    ).select(*docs.columns, *added)


def expand_copies(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per copy, with its number from 1 in ``copy``."""
    return (
        mixed.filter(F.col("copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*columns, "copy")
    )


def op1_mixing(spark, sf_dir) -> DataFrame:
    """Each document with the words that the mix takes of it."""
    from subsmart.llm.tables import read

    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from DOCS
), sizes as (
  select source, sum(size)::bigint as source_size, (sum(size) * 3)::double as lim from sized group by source
), weighed as (
  select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from sizes
), totals as (
  select *, (sum(source_size) over ())::double as total, sum(weight) over () as weights,
    coalesce(sum(lim) over b, 0) as lim_before, coalesce(sum(weight) over b, 0) as weight_before
  from weighed window b as (order by lim / weight, source nulls last rows between unbounded preceding and 1 preceding)
), marked as (
  select *, lim * (weights - weight_before) <= weight * (total - lim_before) as stops from totals
), targets as (
  select source, source_size, case when stops then lim else weight
      * (total - sum(case when stops then lim else 0 end) over ())
      / nullif(weights - sum(case when stops then weight else 0 end) over (), 0) end as target
  from marked
), ranked as (
  select s.*, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) as each_one,
    ('0x' || substr(md5(concat('mix', coalesce(s.source, ''))), 1, 5))::int::double / 1048576 as start,
    row_number() over (partition by s.source order by size, md5(concat('mix', coalesce(doc_id::varchar, ''))), doc_id nulls last) as n
  from sized s join targets t on s.source is not distinct from t.source
)
"""

ORACLE = (
    SQL.replace("DOCS", "documents")
    + """
select doc_id, size, source_size, target,
  size * least(floor(n * each_one + start) - floor((n - 1) * each_one + start), ceil(each_one))::bigint as taken
from ranked
"""
)
