"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsmart.llm import words
from subsmart.llm.tables import bound_batches, read, stored

SHINGLE = 5
# One in so many shingle hashes is retained.
SCALE = 5


def sketches(column: pa.Array, scale: int = SCALE, k: int = SHINGLE) -> list[np.ndarray]:
    """A sorted array of retained hashes for each text.

    Retained are all distinct hashes of the text's ``k``-word shingles (lower-cased, split
    at ASCII white space) below 2**64 / ``scale``, and its least hash whatever it is, so
    only a text without words has an empty sketch. Both rules survive merging: the sketch
    of a union is the union of sketches, without the least of a part that is neither
    below the threshold nor the least of all.
    """
    data, begins = words.joined(pc.utf8_lower(column))
    starts, ends, firsts = words.spans(~words.SPACE[data], begins)
    hashes, begins = words.shingle_hashes(words.word_hashes(data, starts, ends), firsts, k)
    bound = np.uint64((1 << 64) // scale)
    low = hashes < bound
    out = []
    for a, b in zip(begins[:-1], begins[1:]):
        kept = np.unique(hashes[a:b][low[a:b]])
        if not len(kept) and a < b:
            kept = hashes[a:b].min(keepdims=True)
        out.append(kept)
    return out


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all of both; 1 for two empty sketches."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    if not len(a):
        return 1.0
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def compact(sketch: np.ndarray) -> np.ndarray:
    """The low 24 bits of the retained hashes, sorted: three bytes each instead of eight.

    A hash that a document of n retained ones lacks is taken for one of them with a chance of
    n / 2**24, which is far below the error of a sketch of n hashes.
    """
    return np.unique((sketch & np.uint64(0xFFFFFF)).astype(np.uint32))


def as_bytes(sketch: np.ndarray) -> bytes:
    """Three bytes for each number, in order; none for an empty sketch."""
    return sketch.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    values = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def fingerprint_texts(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """``docs`` (any columns) with ``fingerprint``: the retained hashes of ``text``, sorted."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("fingerprint")

    def add(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _lists(sketches(batch.column(at), scale))],
                [*batch.schema.names, "fingerprint"],
            )

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(add, f"{kinds}, fingerprint array<long>")


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, contained_next double"
)
# What the first and the last document of a range leave for the ranges beside it.
EDGE = f"part int, {EDITED}, head string, tail string, tail_id long"
FIELDS = [x.split()[0] for x in EDGE.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), *[pa.float64()] * 3]


def edited_text(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids, texts, following, scale: int) -> list[list]:
    """Columns of ``EDITED`` for documents and the texts that follow them."""
    edited = [edited_text(a, b) for a, b in zip(texts, following)]
    own, new, after = (
        [compact(sketch) for sketch in sketches(pa.array(x, pa.string()), scale)] for x in (texts, edited, following)
    )
    return [
        list(ids),
        [len(x) for x in texts],
        [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        [as_bytes(sketch) for sketch in own],
        [as_bytes(sketch) for sketch in new],
        [resemblance(a, b) for a, b in zip(own, new)],
        [resemblance(a, b) for a, b in zip(own, after)],
        [containment(b, a) for a, b in zip(own, after)],
    ]


def _in_order(scale: int):
    """Compares each document of a sorted range with the next one of the range."""

    def batch_of(part, columns, heads, tails, tail_ids):
        kinds = [pa.int32(), *KINDS, pa.string(), pa.string(), pa.int64()]
        columns = [[part] * len(heads), *columns, heads, tails, tail_ids]
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for kind, x in zip(kinds, columns)], FIELDS)

    def run(batches):
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "").to_pylist()
            if not ids:
                continue
            blank = [[None]] * 8
            if last is None:
                yield batch_of(part, blank, [texts[0]], [None], [None])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            if len(ids) > 1:
                columns = _compared(ids[:-1], texts[:-1], texts[1:], scale)
                none = [None] * (len(ids) - 1)
                yield batch_of(part, columns, none, none, none)
            last = ids[-1], texts[-1]
        if last is not None:
            yield batch_of(part, [[None]] * 8, [None], [last[1]], [last[0]])

    return run


def _edges(scale: int):
    """Compares the last document of every range with the first of the next range.

    The rows are the two texts that each range left, in order; the last meets the first.
    """

    def run(batches):
        for batch in batches:
            ids, texts, after = (x.to_pylist() for x in batch.columns)
            columns = _compared(ids, texts, after, scale)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for kind, x in zip(KINDS, columns)], FIELDS[1:9])

    return run


def compare_edited(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last half of the code points replaced by as many from the
    beginning of the next document, in descending order of ``doc_id``; the last document
    meets the first. A fingerprint is its ``compact`` sketch, six hex digits a number.
    ``near_edited`` and ``near_next`` are the resemblance of the fingerprint to that of the
    edited text and of the next document, ``contained_next`` the share of the next document
    that this one contains.

    Documents are sorted into ranges, so each meets the next where it lies and texts move
    once; only the first and last text of each range meet in a second step.

    Null texts are empty. Null ids come last; rows with one id are ordered by text. A
    single document is its own next one. Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, F.col("text").asc_nulls_first())
    )
    found = stored(ranged.mapInArrow(_in_order(scale), EDGE))
    heads = found.filter(F.col("head").isNotNull()).select(F.col("part").alias("_part"), F.col("head").alias("next"))
    tails = found.filter(F.col("tail").isNotNull()).select("part", "tail_id", "tail")
    # One number for each range that has documents; their texts are joined to it.
    after = Window.orderBy("_part")
    everywhere = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(
        "_part",
        F.coalesce(F.lead("_part").over(after), F.first("_part").over(everywhere)).alias("_next"),
    )
    edges = (
        tails.join(following, F.col("part") == F.col("_part"))
        .drop("_part")
        .join(heads, F.col("_next") == F.col("_part"))
        .select("tail_id", "tail", "next")
    )
    compared = (
        found.filter(F.col("edited_sha256").isNotNull())
        .select(*FIELDS[1:9])
        .unionByName(edges.mapInArrow(_edges(scale), EDITED))
    )
    text = lambda name: F.lower(F.hex(name))
    return compared.withColumns({c: text(c) for c in ("fingerprint", "edited_fingerprint")})


def op9_fingerprints(spark, sf_dir) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    return compare_edited(read(spark, sf_dir, "documents"))
