"""Every operator over odd rows and over no rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from subsmart.llm import (
    decontamination,
    fingerprints,
    html_text,
    language,
    line_dedup,
    mixing,
    private_data,
    simhash,
    token_counts,
    toxicity,
)

LABELS = "doc_id long, toxic int"
ITEMS = "item_id long, text string"


def _benchmark(spark):
    from conftest import FILLER

    return spark.createDataFrame([(1, FILLER), (None, None), (2, ""), (3, "word word")], ITEMS)


def _labels(spark):
    return spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (7, None)], LABELS)


@pytest.fixture(params=["odd", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_mixing(docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.copies <= 3 for r in rows)
    assert all(r["size"] == len((r.text or "").split()) for r in rows if r.doc_id not in (8,))


def test_line_dedup(docs):
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == docs.count()
    assert all((r.n_chars or 0) == len(r.text or "") for r in rows)


def test_line_dedup_keeps_one(odd):
    kept = [r for r in line_dedup.dedup_lines(odd).collect() if r.text and "two" in r.text.lower()]
    assert [r.doc_id for r in kept] == [None]  # the least id, and null is least


def test_toxicity(spark, docs):
    rows = toxicity.score_toxicity(docs, toxicity.learned(docs, _labels(spark))).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_language(docs):
    rows = language.identify(docs, language.learned(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r.component_id for r in rows if r.print == 0} <= {2}


def test_keep_one(odd):
    kept = simhash.keep_one(odd)
    groups = {r.root for r in simhash.near_duplicates(odd).collect()}
    assert kept.count() == len(groups)
    assert kept.columns == odd.columns


def test_decontamination(spark, docs):
    rows = decontamination.find_contamination(docs, _benchmark(spark)).collect()
    assert len(rows) == docs.count()
    found = {(r.doc_id, r.n_hit, r.contaminated, tuple(r["items"])) for r in rows if r.n_hit}
    if rows:
        assert found == {(i, 16, True, ("1",)) for i in (1, None, 7)} | {(5, 60_000, True, ("3",))}


def test_no_benchmark(spark, odd):
    found = decontamination.find_contamination(odd, _benchmark(spark).limit(0))
    assert found.filter("contaminated").count() == 0


def test_private_data(docs):
    rows = private_data.replace_private(docs, "key").collect()
    assert len(rows) == docs.count()


def test_private_values_without_plain_letters(spark):
    same = ["password: ******", "secret: ......", "token: ½½½½½½"]
    changed = ["token: паролище", "token: κωδικός", "token=密碼密碼密碼", "token=١٢٣٤٥٦", "token: ab\u2028cd\u2028ef", "_@-.de"]
    few = [f"password: *****{i}" for i in range(10)]
    rows = list(enumerate(same + changed + few))
    out = {r.doc_id: r for r in private_data.replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    assert all((out[i].text == text) == (text in same) for i, text in rows)
    assert all(out[i].n_replaced == (text not in same) for i, text in rows)
    assert len({r.text for r in out.values()} | {text for _, text in rows}) == 2 * len(rows) - len(same)
    assert re.fullmatch("token: [а-я]{8}", out[3].text) and re.fullmatch("token=[٠-٩]{6}", out[6].text)


def test_fingerprints(docs):
    rows = fingerprints.compare_edited(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.fingerprint_texts(docs).count() == docs.count()


def test_token_counts(docs):
    tokenizer = token_counts.tokenizer(token_counts.tokenizer_path())
    count = lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    assert rows == sorted(
        (str(r.doc_id), len((r.text or "").encode()), count(r.text)) for r in docs.collect()
    )


def test_html(spark, docs):
    pages = docs.select(
        F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"), "size"
    )
    rows = html_text.extract(pages, ["page_id", "url"]).collect()
    assert len(rows) == docs.count()
    assert all(r.text is not None for r in rows)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, folder, docs, name, stage):
    narrow = docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = stage(spark, narrow, folder)
    assert out.columns[:5] == narrow.columns
    out.collect()
