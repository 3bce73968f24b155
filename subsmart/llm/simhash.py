"""SimHash near-duplicates, found by signatures with one bit left out."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.llm.components import components
from subsmart.llm.tables import bound_batches, read, stored
from subsmart.operators.spread import sized

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64


def simhash(text: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of a text: bit i is set if it is in over half of the shingles' hashes.

    Words are runs without ASCII white space, A-Z in lower case; a shingle is ``k``
    consecutive words joined by spaces, or all of fewer. Repeated shingles count as often
    as they occur. Without words the fingerprint is zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends][: max(1, len(words) - k + 1)]
    digest = xxhash.xxh64_digest
    hashes = b"".join(
        [digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[min(k, len(words)) - 1 :])]
    )
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BITS // 8), axis=1)
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(bits)).tobytes(), "big")


def _add_fingerprints(k: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            prints = np.array([simhash(x or b"", k) for x in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(prints.view(np.int64))], ["doc_id", "text_key", "print"]
            )

    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` and ``print`` (64 bits as a long) of every document."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    return rows.mapInArrow(_add_fingerprints(k), "doc_id long, text_key long, print long")


def text_key() -> Column:
    """A number by which texts of one id are told apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Shift and width of the fewest segments of which one differs by one bit at most.

    With ``m`` segments, more than 2 m - 1 differing bits are needed to put two into each.
    """
    m = distance // 2 + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def _masked(bits: Column, mask: int) -> Column:
    return bits.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def signatures(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints`` with one row for each segment and each bit of it left out.

    Two fingerprints have equal rows (``slot``, ``rest``) exactly if the segment's other
    bits agree; ``slot`` is the place of the bit that is left out.
    """
    variants = []
    for shift, width in segments(distance):
        whole = ((1 << width) - 1) << shift
        for i in range(shift, shift + width):
            variants.append(
                F.struct(F.lit(i).alias("slot"), _masked(F.col("print"), whole & ~(1 << i)).alias("rest"))
            )
    return prints.select("print", F.explode(F.array(*variants)).alias("v")).select("print", "v.*")


def near_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (``print``) at most ``distance`` bits apart.

    Each pair comes once: from its lowest segment that differs by at most one bit, at that
    bit, or at the segment's first bit if none differs. The verification is part of the
    join, so candidates that fail it are never rows.
    """
    index = signatures(prints, distance)
    left = index.withColumnRenamed("print", "a")
    right = index.withColumnRenamed("print", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(-1)
    for shift, width in reversed(segments(distance)):
        part = _masked(differ, ((1 << width) - 1) << shift)
        at = F.when(part == 0, F.lit(shift))
        lowest = F.bit_count(part.bitwiseAND(-part) - 1).cast("int")
        first = F.when(F.bit_count(part) <= 1, F.coalesce(at, lowest)).otherwise(first)
    return (
        left.join(right, ["slot", "rest"])
        .filter((F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & (F.col("slot") == first))
        .select("a", "b")
    )


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a``, ``b`` that connect what ``near_pairs`` connects, without listing all of those.

    In each bucket of equal signatures every fingerprint meets the least one first, which
    gives it a few links, one for each of its buckets at most. Then only those outside the
    bucket's largest group so far meet all others, as within a group nothing is left to
    connect. So the links of near copies grow with their number, not with its square.
    """
    bucket = Window.partitionBy("slot", "rest")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    least = signatures(prints, distance).select(F.min("print").over(bucket).alias("a"), F.col("print").alias("b"))
    stars = stored(least.filter((F.col("a") < F.col("b")) & near).distinct())
    groups = components(stars)
    sizes = groups.join(groups.groupBy("root").agg(F.count("*").alias("size")), "root")
    tagged = stored(
        prints.join(sizes.withColumnRenamed("node", "print"), "print", "left").select(
            "print", F.coalesce("root", "print").alias("group"), F.coalesce("size", F.lit(1)).alias("size")
        )
    )
    index = signatures(prints, distance).join(tagged, "print")
    largest = F.max(F.struct("size", "group")).over(bucket)["group"]
    rows = index.withColumn("main", F.col("group") == largest)
    left = rows.filter("not main").select("slot", "rest", F.col("print").alias("a"), F.col("group").alias("_group"))
    right = rows.select("slot", "rest", F.col("print").alias("b"), "group", "main")
    once = F.col("main") | (F.col("a") < F.col("b"))
    cross = left.join(right, ["slot", "rest"]).filter(near & once & (F.col("_group") != F.col("group")))
    return stored(stars.unionByName(cross.select("a", "b")).distinct())


def near_duplicates(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``text_key``, ``print``, ``component_id`` and ``root`` of every document.

    Documents are linked if their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the least id reachable over links, ``root`` numbers the component. Equal fingerprints are one
    node, so copies in any number cost nothing beyond counting.

    Null and empty texts have fingerprint zero and link like others. Repeated ids are
    separate rows of one result; a null id is never a component's id, unless all ids of
    the component are null. Other columns are not read.
    """
    own = stored(fingerprints(docs, k))
    nodes = own.groupBy("print").agg(F.min("doc_id").alias("first"))
    linked = components(links(own.select("print").distinct(), distance)).withColumnRenamed("node", "print")
    rooted = nodes.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    classes = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(classes, "root").select("print", "component_id", "root")
    return own.join(by_print, "print").select("doc_id", "text_key", "print", "component_id", "root")


def keep_one(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one of each component.

    It is the one of the least id (null last), of rows with that id the least text key,
    and of rows equal in both any one. What goes is looked up, not what stays, so texts
    move only if too many go for a broadcast.
    """
    found = stored(near_duplicates(docs, k, distance))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    keepers = found.groupBy("root").agg(F.min(order).alias("kept"))
    judged = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("rows")).join(keepers, "root")
    stays = F.col("kept").eqNullSafe(order)
    names = [F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")]
    gone = sized(stored(judged.filter(~stays).select(*names))).frame
    repeated = sized(stored(judged.filter(stays & (F.col("rows") > 1)).select(*names)))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    left = docs.withColumn("_text_key", text_key()).join(gone, same, "left_anti")
    if repeated.rows != 0:
        once = left.join(repeated.frame, same, "left_semi").dropDuplicates(["doc_id", "_text_key"])
        left = left.join(repeated.frame, same, "left_anti").unionByName(once)
    return left.select(*docs.columns)


def op6_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
