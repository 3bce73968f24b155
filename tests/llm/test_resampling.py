"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from subsmart.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def plain(docs, target, longest, buckets, percent, least_words):
    """``(doc_id, n_words, n_features, weight, score, rank)`` of rows ``(doc_id, text)``."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    split = [(i, *plain_features(t, longest)) for i, t in docs]
    raw = Counter(bucket(f) for _, _, runs in split for f in runs)
    wanted = Counter(bucket(f) for t in target for f in plain_features(t, longest)[1])
    s, t = sum(raw.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in raw}
    rows = []
    for i, n, runs in split:
        weight = sum(gain[bucket(f)] for f in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    last = lambda i: (i is None, i or 0)
    eligible = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], last(r[0])))
    drawn = len(eligible) * percent // 100
    ranks = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(eligible)]
    return sorted(ranks + [(*r, None) for r in rows if r[1] < least_words], key=repr)


def found(docs, target, **options):
    rows = resampling.resample(docs, target, **options)
    return sorted(
        (tuple(r) for r in rows.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr
    )


def test_words_and_pairs_of_all_documents(spark, documents, folder):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    texts = [r.text for r in target.collect()]
    for longest, buckets, percent in ((1, 10_000, 10), (2, 997, 37)):
        expected = plain(rows, texts, longest, buckets, percent, 20)
        assert found(documents, target, longest=longest, buckets=buckets, percent=percent) == expected


def test_odd_rows(spark, odd):
    target = spark.createDataFrame([("one two",), (None,), ("",)], "text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    expected = plain(rows, ["one two", None, ""], 1, 10_000, 50, 1)
    assert found(odd, target, percent=50, least_words=1) == expected
    out = resampling.resample(odd, target)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "size", "print", "n_words", "n_features", "weight", "score", "rank"]


def test_no_rows(spark, odd, empty):
    target = spark.createDataFrame([("one two",)], "text string")
    assert resampling.resample(empty, target).collect() == []
    rows = resampling.resample(odd, target.limit(0), percent=100, least_words=0).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, odd.count() + 1))


def test_pieces_cut_no_word(monkeypatch):
    text = "Ab cd-ef  ghi. " * 40 + "x" * 300 + " é́ y_z 9"
    split = resampling._splitter()
    for size in (1, 7, 50, 10_000):
        monkeypatch.setattr(resampling, "PIECE", size)
        for longest in (1, 3):
            n, total, seen = resampling.features(text, split, longest)
            words, runs = plain_features(text, longest)
            assert (n, total, seen) == (words, len(runs), Counter(runs))


def test_reruns_agree_over_other_partitions(spark, documents, folder):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert found(documents.repartition(7), target) == found(documents.coalesce(1), target)


def test_ranks_of_repeated_rows(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("a b c").alias("text")
    )
    ranks = found(docs, spark.createDataFrame([("a",)], "text string"), percent=100, least_words=3)
    assert sorted(r[5] for r in ranks) == list(range(1, 3001))
