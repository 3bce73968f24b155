"""Token counts from the pieces of distinct pre-tokens."""

from __future__ import annotations

import importlib
import os
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.llm.tables import bound_batches, read, stored

TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
# The most frequent pre-tokens, whose pieces every task gets: a fixed number of at most so
# many bytes each, 3 MB in all. Longer ones, whole texts in scripts without spaces, are joined.
FREQUENT = 50_000
FREQUENT_BYTES = 64
# Distinct pre-tokens, and their bytes, that a task gathers before it passes their counts on.
GATHERED = 200_000
GATHERED_BYTES = 32 << 20


def tokenizer_path(name: str = TOKENIZER, folder: str = TOKENIZERS) -> str:
    """The file's place, from the folder's own ``path``."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.path(name)


_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer, loaded once by each Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _LOADED[path] = loaded
    return _LOADED[path]


def pre_tokens(text: bytes) -> list[bytes]:
    """Runs of bytes without ASCII white space; no token of the vocabulary crosses one."""
    return text.split()


def _utf8(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _frequencies(batches):
    """Pre-tokens of a task with their counts, passed on whenever many are gathered."""
    seen: Counter = Counter()
    held = 0

    def out():
        keys = pa.array(seen.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(seen.values(), pa.int64())], ["piece_of", "n"]
        )

    for batch in batches:
        for text in _utf8(batch.column(0)):
            seen.update(pre_tokens(text))
            held += len(text)  # no less than what it adds
            if len(seen) >= GATHERED or held >= GATHERED_BYTES:
                if len(seen) >= GATHERED or sum(map(len, seen)) >= GATHERED_BYTES:
                    yield out()
                    seen.clear()
                held = sum(map(len, seen))
    yield out()


def _pieces(path: str):
    def count(batches):
        encode = tokenizer(path).encode_batch
        for batch in batches:
            found = encode(batch.column(0).to_pylist(), add_special_tokens=False)
            sizes = pa.array([len(x.ids) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], [*batch.schema.names, "pieces"])

    return count


def _by_document(known):
    """Rows of two kinds: a document with the pieces of its frequent pre-tokens, and its
    other pre-tokens with their frequency."""

    def count(batches):
        pieces = known.value
        for batch in batches:
            rows, of, n, size, doc = [], [], [], [], []
            ids = batch.column(0).to_pylist()
            for row, text in zip(ids, _utf8(batch.column(1))):
                total = 0
                for word, times in Counter(pre_tokens(text)).items():
                    got = pieces.get(word)
                    if got is None:
                        rows.append(row), of.append(word), n.append(times)
                    else:
                        total += got * times
                doc.append(total), size.append(len(text))
            places = pa.array([*ids, *rows], pa.int64())
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    places,
                    pa.concat_arrays([pa.nulls(len(ids), pa.string()), pa.array(of, pa.binary()).cast(pa.string())]),
                    pa.array([*doc, *n], pa.int64()),
                    pa.concat_arrays([pa.array(size, pa.int64()), none]),
                    pa.concat_arrays([batch.column(2), none]),
                ],
                ["row", "piece_of", "n", "n_bytes", "doc_id"],
            )

    return count


def token_counts(
    docs: DataFrame, path: str | None = None, frequent: int = FREQUENT, limit: int = LIMIT
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every document.

    A pre-token is a run without ASCII white space. The library tokenises each distinct
    one once; no ids of documents are made. A document's pieces are the sum over its
    pre-tokens of frequency times pieces. The ``frequent`` most common short pre-tokens, a
    fixed number, are summed where the documents lie; the others are joined by pre-token.
    Of those only a long one can be common; adaptive execution splits it, as it is one row
    on the other side.

    Null texts are empty and have no tokens. Every row counts as a document, also when ids
    repeat or are null. Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path = path or tokenizer_path()
    texts = docs.select("text")
    counted = (
        texts.mapInArrow(_frequencies, "piece_of string, n long")
        .groupBy("piece_of")
        .agg(F.sum("n").alias("n"))
    )
    pieces = stored(counted.mapInArrow(_pieces(path), "piece_of string, n long, pieces long"))
    short = pieces.filter(F.octet_length("piece_of") <= FREQUENT_BYTES)
    top = short.orderBy(F.desc("n"), "piece_of").limit(frequent).select("piece_of", "pieces")
    known = {row[0].encode(): row[1] for row in top.collect()}
    shared = spark.sparkContext.broadcast(known)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "text", F.col("doc_id").cast("long")
    ).mapInArrow(
        _by_document(shared), "row long, piece_of string, n long, n_bytes long, doc_id long"
    )
    # A document's own row gets a key that no pre-token has (they hold no space).
    own = F.concat(F.lit(" "), F.col("row").cast("string"))
    keyed = rows.withColumn("_key", F.coalesce("piece_of", own))
    looked_up = keyed.join(
        pieces.select(F.col("piece_of").alias("_key"), "pieces"), "_key", "left"
    )
    return (
        looked_up.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def op10_token_counts(spark, sf_dir) -> DataFrame:
    """Tokens of every document."""
    return token_counts(read(spark, sf_dir, "documents"))
