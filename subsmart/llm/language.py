"""Languages of texts: script ranges, word scores and a most likely path over words."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm.tables import bound_batches, read

FOLDS, HELD_FOLD = 3, 1
UNKNOWN = "und"
BUCKETS = 1 << 15
# Added to every count of a letter group.
SMOOTHING = 0.5
# A script is a candidate for a language that writes at least this share of letters in it.
SCRIPT_SHARE = 0.001
# In nats: the most that one word can speak against a language, and the cost of a switch.
WORD_LIMIT = 8.0
SWITCH = 10.0
# Scores that are held at once.
HELD_SCORES = 4_000_000

# First code points of script ranges; a range lasts to the next one.
SCRIPT_STARTS = {
    0x0000: "Latin",
    0x0370: "Greek",
    0x0400: "Cyrillic",
    0x0530: "Armenian",
    0x0590: "Hebrew",
    0x0600: "Arabic",
    0x0700: "other",
    0x0900: "Devanagari",
    0x0980: "Bengali",
    0x0A00: "Indic",
    0x0E00: "Thai",
    0x0E80: "other",
    0x10A0: "Georgian",
    0x1100: "Hangul",
    0x1200: "Ethiopic",
    0x1380: "other",
    0x1E00: "Latin",
    0x1F00: "Greek",
    0x2000: "other",
    0x2C60: "Latin",
    0x2C80: "other",
    0x3040: "Kana",
    0x3100: "Han",
    0x3130: "Hangul",
    0x3190: "Han",
    0xA000: "other",
    0xAC00: "Hangul",
    0xD7B0: "other",
    0xF900: "Han",
    0xFB00: "Latin",
    0xFB07: "other",
    0xFB1D: "Hebrew",
    0xFB50: "Arabic",
    0xFE00: "other",
    0xFF21: "Latin",
    0xFF66: "Kana",
    0xFFA0: "Hangul",
    0x10000: "other",
    0x20000: "Han",
    0x30000: "other",
}
SCRIPTS = sorted(set(SCRIPT_STARTS.values()))
_RANGES = np.array(list(SCRIPT_STARTS), np.uint32)
_SCRIPT_OF_RANGE = np.array([SCRIPTS.index(x) for x in SCRIPT_STARTS.values()])

_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """True for code points of letters and of marks that combine with them."""
    if not _LETTERS:
        table = np.zeros(0x110000, bool)
        table[:0x33480] = [unicodedata.category(chr(i))[0] in "LM" for i in range(0x33480)]
        _LETTERS.append(table)
    return _LETTERS[0]


@dataclass
class Words:
    """Words of some texts, with the letter groups (three letters, edges included) of each."""

    firsts: np.ndarray  # first word of each text, and the end
    letters: np.ndarray  # letters of each word
    scripts: np.ndarray  # script of each word's first letter
    groups: np.ndarray  # bucket of each letter group
    begins: np.ndarray  # first group of each word


def find_words(texts: list[str]) -> Words:
    """Runs of letters, given lower-case texts."""
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=begins[1:])
    inside = letter_table()[points]
    code = np.where(inside, points, 0).astype(np.uint64)
    one = np.concatenate([[0], code[:-1]]).astype(np.uint64)
    two = np.concatenate([[0, 0], code[:-2]])[: len(code)].astype(np.uint64)
    two[one == 0] = 0
    group = (code * np.uint64(0x9E3779B1) + one * np.uint64(0x85EBCA77C2B2AE3D) + two * np.uint64(0xC2B2AE3D27D4EB4F))
    group = (group * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)
    used = (code > 0) | (one > 0)
    start = inside & (one == 0)
    starts = np.flatnonzero(start)
    end = np.flatnonzero(~inside & (one > 0))
    return Words(
        np.searchsorted(starts, begins),
        end - starts,
        _SCRIPT_OF_RANGE[np.searchsorted(_RANGES, points[starts], "right") - 1],
        group[used].astype(np.int64),
        np.cumsum(used)[starts] - 1,
    )


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language, log-likelihoods against their mean
    candidates: np.ndarray  # script x language

    @classmethod
    def fit(cls, languages: list[str], groups: np.ndarray, scripts: np.ndarray) -> Model:
        """From counts of letter groups (bucket x language) and letters (script x language)."""
        smooth = groups + SMOOTHING
        logs = np.log(smooth / smooth.sum(axis=0))
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        centred = logs - logs.mean(axis=1, keepdims=True)
        return cls(languages, centred.astype(np.float32), share >= SCRIPT_SHARE)

    def word_scores(self, words: Words) -> np.ndarray:
        """Word x language, 0 for the best language of a word."""
        if not len(words.begins):
            return np.zeros((0, len(self.languages)), np.float32)
        sums = np.add.reduceat(self.scores[words.groups], words.begins, axis=0)
        possible = self.candidates[words.scripts]
        possible |= ~possible.any(axis=1, keepdims=True)
        sums[~possible] = -np.inf
        return np.maximum(sums - sums.max(axis=1, keepdims=True), -WORD_LIMIT)


def best_paths(scores: np.ndarray, firsts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The most likely language of each word, if a change of language costs ``switch``.

    All texts advance together, the longest first, so each step is an array operation.
    """
    counts = np.diff(firsts)
    order = np.argsort(-counts, kind="stable")
    n, width = counts[order], scores.shape[1]
    labels = np.zeros(len(scores), np.int32)
    if not len(scores):
        return labels
    active = np.searchsorted(-n, -np.arange(n[0]), "left")  # texts of more than t words
    value = np.zeros((len(n), width), np.float32)
    back = np.empty((len(scores), width), np.int16)
    own = np.arange(width, dtype=np.int16)
    at = firsts[:-1][order]
    for t, k in enumerate(active):
        here, past = at[:k] + t, value[:k]
        jump = past.max(axis=1, keepdims=True) - np.float32(switch)
        stay = past >= jump
        back[here] = np.where(stay, own, past.argmax(axis=1)[:, None])
        value[:k] = np.where(stay, past, jump) + scores[here]
    state = value.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        here = at[:k] + t
        labels[here] = state[:k]
        state[:k] = back[here, state[:k]]
    return labels


def _chunks(texts: list[str], points: int):
    """Texts in pieces of about ``points`` code points."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= points:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _lowered(column) -> list[str]:
    return pc.utf8_lower(pc.fill_null(column, "")).to_pylist()


def _counts(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}

    def run(batches):
        groups = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPTS)), np.int64)
        for batch in batches:
            by_language: dict[int, list[str]] = {}
            for text, name in zip(_lowered(batch.column(0)), batch.column(1).to_pylist()):
                by_language.setdefault(index[name], []).append(text)
            for i, texts in by_language.items():
                for chunk in _chunks(texts, HELD_SCORES // 4):
                    words = find_words(chunk)
                    groups[i] += np.bincount(words.groups, minlength=BUCKETS)
                    scripts[i] += np.bincount(words.scripts, words.letters, len(SCRIPTS)).astype(np.int64)
        found = np.concatenate([groups, scripts], axis=1)
        language, cell = np.nonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language, pa.int32()), pa.array(cell, pa.int32()), pa.array(found[language, cell])],
            ["language", "cell", "n"],
        )

    return run


def train(labelled: DataFrame) -> Model:
    """A model from ``text`` and non-null ``lang`` of all rows of ``labelled``.

    Tasks count letter groups in fixed tables, of which only the sums reach the driver:
    languages times ``BUCKETS`` numbers, whatever the corpus.
    """
    bound_batches(labelled.sparkSession)
    rows = labelled.select("text", "lang").filter("lang is not null")
    languages = [row[0] for row in rows.select("lang").distinct().orderBy("lang").collect()]
    summed = (
        rows.mapInArrow(_counts(languages), "language int, cell int, n long")
        .groupBy("language", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((BUCKETS + len(SCRIPTS), max(len(languages), 1)), np.float64)
    language, cell, n = (summed.column(i).to_numpy() for i in range(3))
    counts[cell, language] = n
    return Model.fit(languages, counts[:BUCKETS], counts[BUCKETS:])


SPANS = "array<struct<lang:string,first_word:int,words:int,letters:long>>"


def _predict(shared, columns: list[str]):
    def run(batches):
        model = shared.value
        names = [*model.languages, UNKNOWN]
        width = max(len(model.languages), 1)
        for batch in batches:
            predicted, score, spans = [], [], []
            texts = _lowered(batch.column(batch.schema.get_field_index("text")))
            scores, letters, counts = [], [], [np.zeros(1, np.int64)]
            for chunk in _chunks(texts, max(HELD_SCORES // width, 1)):
                words = find_words(chunk)
                if model.languages:
                    scores.append(model.word_scores(words))
                letters.append(words.letters)
                counts.append(np.diff(words.firsts))
            firsts = np.cumsum(np.concatenate(counts))
            letters = np.concatenate([np.zeros(0, np.int64), *letters])
            if model.languages and scores:
                labels = best_paths(np.concatenate(scores), firsts)
            else:
                labels = np.full(len(letters), len(model.languages))
            for a, b in zip(firsts[:-1], firsts[1:]):
                part, weight = labels[a:b], letters[a:b]
                if a == b:
                    predicted.append(UNKNOWN), score.append(0.0), spans.append([])
                    continue
                share = np.bincount(part, weight, len(names)) / weight.sum()
                best = int(share.argmax())
                predicted.append(names[best]), score.append(float(share[best]) * (names[best] != UNKNOWN))
                cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [b - a]])
                spans.append(
                    [
                        {"lang": names[part[i]], "first_word": int(i), "words": int(j - i), "letters": int(weight[i:j].sum())}
                        for i, j in zip(cuts[:-1], cuts[1:])
                    ]
                )
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32()), ("letters", pa.int64())]))
            keep = [batch.column(batch.schema.get_field_index(name)) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(predicted, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kind)],
                [*columns, "lang_pred", "score", "spans"],
            )

    return run


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of ``docs`` with ``lang_pred``, ``score`` and ``spans``.

    Words are runs of letters. The script of a word leaves as candidates the languages
    that use it (all, if none does); letter groups give each candidate a score, and the
    most likely path over a text's words, with a cost for each change of language, labels
    spans. ``lang_pred`` has most letters, ``score`` is its share of them. A text that is
    null or has no letter is ``und`` with score 0 and has no spans; so is every text if
    nothing was learned. Columns with the added names are replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.drop("lang_pred", "score", "spans")
    columns = columns or docs.columns
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)
    shared = spark.sparkContext.broadcast(model)
    needed = docs.select(*dict.fromkeys([*columns, "text"]))
    return needed.mapInArrow(
        _predict(shared, columns), f"{kinds}, lang_pred string, score double, spans {SPANS}"
    )


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def learned(docs: DataFrame) -> Model:
    """A model from the documents that are not held out."""
    return train(docs.filter(fold(F.col("doc_id"), FOLDS) != HELD_FOLD))


def op5_language(spark, sf_dir) -> DataFrame:
    """Predicted language of every document."""
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, learned(docs), ["doc_id"])
    held = fold(F.col("doc_id"), FOLDS) == HELD_FOLD
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
