"""Benchmark decontamination by winnowing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsmart.llm.tables import read
from subsmart.operators.spread import settle, sized

# Words are runs of ASCII letters, digits and all characters beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
# Words of a gram. Of every WINDOW - GRAM + 1 consecutive grams the least hash is kept, so
# texts that share WINDOW consecutive words keep a common fingerprint.
GRAM = 6
# A document is contaminated if one word in so many is hit.
SHARE = 20


def words(text: Column) -> Column:
    """The words of ``text`` with A-Z in lower case."""
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def word_count(text: Column) -> Column:
    # Splitting is several times faster than matching words.
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_CASED), "")
    return F.size(found).cast("long")


def _starts(n: Column, k: int) -> Column:
    """Places from 1 at which ``k`` of ``n`` words begin."""
    return F.when(n >= k, F.sequence(F.lit(1), n - (k - 1))).otherwise(F.array().cast("array<int>"))


def _whole_window(m: int):
    """From a place, the window of ``m`` words there with the hash of all of them."""
    return lambda i: F.struct(
        F.xxhash64(F.slice("_hashes", i, m), F.lit(m)).alias("print"), i.alias("at"), F.lit(m).alias("n")
    )


def with_fingerprints(texts: DataFrame, short: list[int]) -> DataFrame:
    """``texts`` (with ``text``) and ``words`` and ``prints``: a fingerprint per window.

    The fingerprint of a window of ``WINDOW`` words is the least hash of its grams, and
    stands at the window's start. For each length in ``short``, windows of that many words
    follow, with the hash of all their words. Each is a struct of ``print``, ``at``, ``n``.
    """
    hashed = texts.withColumn("words", words(F.coalesce("text", F.lit("")))).withColumn(
        "_hashes", F.transform("words", lambda w: F.xxhash64(w))
    )
    grams = F.transform(
        _starts(F.size("_hashes"), GRAM),
        lambda i: F.xxhash64(*[F.get("_hashes", i + (j - 1)) for j in range(GRAM)]),
    )
    width = WINDOW - GRAM + 1
    whole = F.transform(
        _starts(F.size("_grams"), width),
        lambda i: F.struct(
            F.array_min(F.slice("_grams", i, width)).alias("print"),
            i.alias("at"),
            F.lit(WINDOW).alias("n"),
        ),
    )
    parts = [F.transform(_starts(F.size("_hashes"), m), _whole_window(m)) for m in short]
    prints = F.concat(whole, *parts) if parts else whole
    return hashed.withColumn("_grams", grams).withColumn("prints", prints).drop("_hashes", "_grams")


def _window_text(at: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", at, n), " ")


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Windows of the benchmark (``item``, ``window``, ``print``) and the lengths below ``WINDOW``.

    Kept in the shared folder, as three steps read them.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    lengths = F.size(words(F.coalesce("text", F.lit(""))))
    short = [
        row[0]
        for row in items.select(lengths.alias("n"))
        .filter((F.col("n") > 0) & (F.col("n") < WINDOW))
        .distinct()
        .orderBy("n")
        .collect()
    ]
    windows = (
        with_fingerprints(items, short)
        # Outer, as the planner would test for an empty array below the projections, and so
        # split and hash an item's words again for each of them.
        .select("item", "words", F.explode_outer("prints").alias("p"))
        # An item of fewer words is one window, an item of more has whole ones only.
        .filter("p is not null")
        .filter((F.col("p.n") == WINDOW) | (F.col("p.n") == F.size("words")))
        .select("item", _window_text(F.col("p.at"), F.col("p.n")).alias("window"), "p.print")
        .distinct()
    )
    return settle(windows), short


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Results by text key: ``n_hit``, ``n_items`` and ``items`` of every text with a hit.

    Documents and benchmark join on fingerprints; each common one is a seed. In the texts
    with seeds, the windows that a seed stands for are compared word by word with the
    benchmark's, so hits are exact: no shared window is missed, and none is made up by a
    hash. Equal texts have one result.
    """
    windows, short = item_windows(benchmark)
    texts = docs.select("text", text_key(F.col("text")).alias("key"))
    known = sized(windows.select("print").distinct()).frame
    prints = with_fingerprints(texts.filter("text is not null"), short).select(
        "key", F.explode(F.array_distinct(F.col("prints.print"))).alias("print")
    )
    seeds = settle(prints.join(known, "print").groupBy("key").agg(F.collect_set("print").alias("seeds")))
    seeded = texts.join(sized(seeds).frame, "key")
    extended = (
        with_fingerprints(seeded, short)
        .select(
            "key",
            "words",
            F.explode_outer(F.filter("prints", lambda p: F.array_contains("seeds", p["print"]))).alias("p"),
        )
        .filter("p is not null")
        .select("key", "p.at", "p.n", _window_text(F.col("p.at"), F.col("p.n")).alias("window"))
    )
    by_window = sized(windows.select("window", "item")).frame
    hits = settle(extended.join(by_window, "window").select("key", "at", "n", "item").distinct())
    # Windows of a text in order; each adds the words beyond the furthest end so far.
    before = (
        Window.partitionBy("key")
        .orderBy("at", "n")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("at") + F.col("n")
    reached = F.greatest(F.coalesce(F.max(end).over(before), F.lit(0)), F.col("at"))
    covered = (
        hits.select("key", "at", "n")
        .distinct()
        .withColumn("new", F.greatest(end - reached, F.lit(0)))
        .groupBy("key")
        .agg(F.sum("new").alias("n_hit"))
    )
    items = (
        hits.select("key", "item")
        .distinct()
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return covered.join(items, "key").withColumn("n_items", F.size("items").cast("long"))


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    A word is hit inside any occurrence of ``WINDOW`` consecutive words of an item, or of
    a whole item of fewer words. Contaminated is a document of which at least one word in
    ``SHARE`` is hit. Null and empty texts have no words and are not contaminated; items
    without words have no window; items with equal ids are one item, a null id is the
    empty string. Columns with the added names are replaced.
    """
    added = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    docs = docs.drop(*added)
    found = sized(settle(contamination(docs, benchmark).withColumnRenamed("key", "_key"))).frame
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        docs.withColumn("n_words", word_count(F.col("text")))
        .join(found, text_key(F.col("text")) == F.col("_key"), "left")
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("long"))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))
        .select(*docs.columns, *added)
    )


def op7_decontamination(spark, sf_dir) -> DataFrame:
    """Benchmark words and items found in every document."""
    found = find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
with worded as (
  select row_number() over () as rid, doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from DOCS
), items as (
  select coalesce(item_id::varchar, '') as item, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from benchmark
), windows as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as win from (
    select item, w, least(len(w), 13) as n, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i
    from items where len(w) > 0)
), places as (
  select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as win from (
    select rid, w, n, unnest(range(1, len(w) - n + 2)) as i
    from worded, (select distinct n from windows) where len(w) >= n)
), hits as (
  select distinct rid, i, n, item from places join windows using (n, win)
), hit_words as (
  select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from hits) group by rid
), hit_items as (
  select rid, count(distinct item) as n_items, sha256(array_to_string(list_sort(list(distinct item)), ',')) as items_sha256
  from hits group by rid
), judged as (
  select rid, doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    coalesce(items_sha256, sha256('')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
  from worded left join hit_words using (rid) left join hit_items using (rid)
)
"""

ORACLE = (
    SQL.replace("DOCS", "documents")
    + "select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from judged"
)
