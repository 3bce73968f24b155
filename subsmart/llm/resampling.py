"""Resampling documents by their importance for a target distribution."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm.places import placed
from subsmart.llm.tables import bound_batches, read, stored

# Words are runs of ASCII letters, digits and all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
# Code points that are split into words at once; a longer word is never cut.
PIECE = 1 << 16
# Buckets of features that a task remembers.
REMEMBERED = 1 << 18

_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` code points that end where no word is cut."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = _BETWEEN.search(text, begin + PIECE)
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def features(text: str, split, longest: int = LONGEST_RUN) -> tuple[int, int, Counter]:
    """Words, features and the count of each feature of ``text``.

    Features are the runs of 1 to ``longest`` words, joined by one space. The windows slide
    over the offset pairs that the pre-tokeniser gives for the lower-cased text.
    """
    n_words, found = 0, Counter()
    tail: list[str] = []
    for piece in _pieces(text.encode().translate(_LOWER).decode()):
        pairs = [pair for _, pair in split.pre_tokenize_str(piece)]
        words = [piece[a:b] for a, b in pairs]
        n_words += len(words)
        found.update(words)
        if longest > 1:
            # Runs that end in this piece may begin in the one before.
            words, old = tail + words, len(tail)
            for k in range(2, longest + 1):
                first = max(0, old - k + 1)
                found.update(" ".join(words[i : i + k]) for i in range(first, len(words) - k + 1))
            tail = words[-(longest - 1) :]
    n_features = sum(max(0, n_words - k + 1) for k in range(1, longest + 1))
    return n_words, n_features, found


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and its histogram: ``buckets`` and ``counts``.

    A feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``. ``text`` itself
    is not returned.
    """
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("text", "n_words", "n_features", "buckets", "counts")]

    def count(batches):
        split, known = _splitter(), {}
        for batch in batches:
            sizes, totals, at, places, numbers = [], [], [0], [], []
            for text in batch.column(len(names)).to_pylist():
                n_words, n_features, found = features(text or "", split, longest)
                histogram: dict[int, int] = {}
                for feature, n in found.items():
                    bucket = known.get(feature)
                    if bucket is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        bucket = known[feature] = zlib.crc32(feature.encode()) % buckets
                    histogram[bucket] = histogram.get(bucket, 0) + n
                sizes.append(n_words), totals.append(n_features)
                places.extend(histogram), numbers.extend(histogram.values())
                at.append(len(places))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(sizes, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int64())),
                ],
                [*names, "n_words", "n_features", "buckets", "counts"],
            )

    kinds = "".join(f"`{name}` {kind}, " for name, kind in docs.select(*names).dtypes)
    added = "n_words long, n_features long, buckets array<int>, counts array<long>"
    return docs.select(*names, "text").mapInArrow(count, kinds + added)


def _totals(counted: DataFrame) -> DataFrame:
    return counted.select(F.inline(F.arrays_zip("buckets", "counts"))).groupBy("buckets").agg(
        F.sum("counts").alias("total")
    )


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``gain`` of every bucket, from the histograms of raw and target texts.

    The gain is the floored 1000-fold logarithm of the ratio of the bucket's shares in the
    target and in the raw texts, one feature added to each bucket.
    """
    every = raw.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for name, counted in (("s", raw), ("t", target)):
        all_of = _totals(counted).select(F.col("buckets").cast("long").alias("bucket"), F.col("total").alias(name))
        every = every.join(all_of, "bucket", "left").fillna(0, name)
    whole = lambda df: F.lit(float(df.agg(F.coalesce(F.sum("n_features"), F.lit(0))).first()[0]))
    size = float(buckets)
    share = (F.col("t").cast("double") + 1.0) * (whole(raw) + size) / (
        (F.col("s").cast("double") + 1.0) * (whole(target) + size)
    )
    return every.select("bucket", F.floor(F.log(share) * 1000.0).alias("gain"))


def _weighed(gains: np.ndarray, names: list[str]):
    """Adds ``weight``: the floored mean of the gains of a document's features."""

    def add(batches):
        table = gains.value
        for batch in batches:
            places, counts = (batch.column(batch.schema.get_field_index(c)) for c in ("buckets", "counts"))
            n = batch.column(batch.schema.get_field_index("n_features")).to_numpy(zero_copy_only=False)
            begins = places.offsets.to_numpy()
            values = table[places.values.to_numpy()] * counts.values.to_numpy()
            sums = np.concatenate([[0], np.cumsum(values)])
            weight = (sums[begins[1:]] - sums[begins[:-1]]) // np.maximum(n, 1)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight, pa.int64())], [*names, "weight"])

    return add


def noise(key: Column, seed: str = SEED) -> Column:
    """The floored 1000-fold of a Gumbel draw that ``seed`` and ``key`` fix; a null key is empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    A document's weight is the mean gain of its features towards the texts of ``target``.
    Adding a Gumbel draw and taking the highest scores draws without replacement in
    proportion to the weights' exponentials. Of the N documents with at least
    ``least_words`` words, ``percent * N / 100`` (floored) are drawn and ranked from 1;
    ``rank`` is null for all others. Equal scores go by ``doc_id``, nulls last.

    Texts are split once; their histograms, one entry per distinct bucket, are stored. Gains
    are a table of ``buckets`` rows, which every task gets. Ranks come from a sort into
    ranges.

    Null and empty texts have no features and weight 0. Rows that repeat are documents of
    their own, with the same noise. Very long texts are split in pieces. Columns with the
    added names are replaced.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("text", "n_words", "n_features", "weight", "score", "rank")]
    counted = stored(bucket_counts(docs.select(*names, "text"), buckets, longest))
    wanted = stored(bucket_counts(target.select("text"), buckets, longest))
    table = np.zeros(buckets, np.int64)
    for bucket, gain in bucket_gains(counted, wanted, buckets).collect():
        table[bucket] = gain
    kept = [*names, "n_words", "n_features"]
    kinds = "".join(f"`{name}` {kind}, " for name, kind in counted.select(*kept).dtypes)
    weighed = counted.mapInArrow(_weighed(spark.sparkContext.broadcast(table), kept), f"{kinds}weight long")
    eligible = F.col("n_words") >= least_words
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    numbered = stored(scored.withColumn("_row", F.monotonically_increasing_id()))
    drawn = numbered.filter(eligible).count() * percent // 100
    order = [eligible.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()]
    ranked = placed(numbered, order)
    rank = F.when(eligible & (F.col("pos") < drawn), F.col("pos") + 1)
    return ranked.select(*kept, "weight", "score", rank.alias("rank"))


def op11_resampling(spark, sf_dir) -> DataFrame:
    """Weights of all documents towards the benchmark, and the tenth that is drawn."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 as a fold over bytes with the usual table of 256 remainders.
CRC_TABLE = """
crc_table as (
  select list(list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as crcs
  from (select unnest(range(256))::bigint as b)
)"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of ``text``, where ``crcs`` is in scope."""
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::bigint)"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {octets}), "
        "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"
    )


ORACLE = rf"""
with {CRC_TABLE}, worded as (
  select row_number() over () as rid, doc_id, false as wanted, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
  union all
  select null, null, true, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  from benchmark
), features as (
  select rid, wanted, unnest(w) as f from worded
), bucket_of as (
  select f, {crc_sql("f")} % 10000 as bucket from (select distinct f from features), crc_table
), counted as (
  select bucket, count(*) filter (not wanted) as s, count(*) filter (wanted) as t
  from features join bucket_of using (f) group by bucket
), gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
      / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
  from counted
), weights as (
  select rid, floor(sum(gain)::double / count(*))::bigint as weight
  from features join bucket_of using (f) join gains using (bucket) where not wanted group by rid
), scored as (
  select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296))))::bigint as score
  from worded left join weights using (rid) where not wanted
), ranked as (
  select *, n_features >= 20 as eligible, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_features >= 20) over () as n
  from scored
)
select doc_id, n_features, weight, score, case when eligible and place <= 10 * n // 100 then place end::bigint as rank from ranked
"""
