"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.llm import words
from subsmart.llm.language import fold
from subsmart.llm.tables import bound_batches, read
from subsmart.operators.spread import settle

FOLDS, HELD_FOLD = 5, 0
BUCKETS = 1 << 18
# Beside whole words, their first bytes are features, as endings vary.
PREFIXES = (4, 5, 6)
# The classifier is fitted on at most so many texts of either kind.
POSITIVE_ROWS, UNLABELLED_ROWS = 10_000, 40_000
# That a text has a word or beginning so often is a feature too.
REPEATS = (2, 3, 5)
# A feature takes part if toxic texts have it more often, with a likelihood ratio that is
# as unlikely by chance as so many standard errors. Unlike a distance in standard errors,
# the ratio is no larger for rare features, such as words of a few copies of one text.
STANDARD_ERRORS = 4.0
# And at least so many times as often as texts at large.
TIMES_AS_OFTEN = 2.0
# The class prior is taken to be so many times the toxic share of the labels, as a toxic
# text that is missed weighs more than a clean one that is not.
CAUTION = 1.5
EPOCHS, BATCHES, RATE, DECAY = 60, 8, 0.05, 1e-5

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _repeated(bucket: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the feature that something of ``bucket`` stands ``n`` times."""
    return (bucket * 31 + n * 7919) % BUCKETS


def features(column: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct features of each text, and each text's first (and the end).

    With ``used``, only buckets where it is True.
    """
    data, begins = words.joined(pc.utf8_lower(column))
    starts, ends, firsts = words.spans(_WORD[data], begins)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    if used is not None:
        every = np.arange(BUCKETS)
        needed = used | np.any([used[_repeated(every, n)] for n in REPEATS], axis=0)
    cells = []
    for k in (0, *PREFIXES):
        longer = slice(None) if k == 0 else ends - starts > k
        first = starts[longer]
        last = ends[longer] if k == 0 else first + k
        bucket = ((words.word_hashes(data, first, last) + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int64)
        cell = text[longer] * BUCKETS + bucket
        cells.append(cell if used is None else cell[needed[bucket]])
    distinct, times = np.unique(np.concatenate(cells), return_counts=True)
    levels = [distinct]
    for n in REPEATS:
        often = distinct[times >= n]
        levels.append(often - often % BUCKETS + _repeated(often % BUCKETS, n))
    distinct = np.unique(np.concatenate(levels))
    if used is not None:
        distinct = distinct[used[distinct % BUCKETS]]
    return distinct % BUCKETS, np.searchsorted(distinct // BUCKETS, np.arange(len(firsts)))


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def more_often(in_toxic: np.ndarray, toxic: int, in_all: np.ndarray, texts: int) -> np.ndarray:
    """Which features toxic texts have more often than all texts, beyond chance."""
    expected = (in_all + 0.5) / (texts + 1) * toxic
    k = in_toxic.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        having = np.where(k > 0, k * np.log(k / expected), 0)
        lacking = np.where(k < toxic, (toxic - k) * np.log((toxic - k) / (toxic - expected)), 0)
    unlikely = 2 * (having + lacking) > STANDARD_ERRORS**2
    return unlikely & (k > TIMES_AS_OFTEN * expected)


@dataclass
class Model:
    weights: np.ndarray  # one per bucket
    bias: float

    def scores(self, buckets: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return _sigmoid(self.bias + _sums(self.weights[buckets], firsts))


def _pick(buckets, firsts, rows):
    """The features of some rows, and the row of each."""
    size = firsts[rows + 1] - firsts[rows]
    offset = np.repeat(firsts[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return buckets[np.arange(size.sum()) + offset], np.repeat(np.arange(len(rows)), size)


def fit(positive, unlabelled, width: int, prior: float, seed: int = 0) -> tuple[np.ndarray, float]:
    """A linear classifier under the non-negative risk of positive-unlabelled learning.

    ``positive`` and ``unlabelled`` are features (below ``width``) of texts. With logistic loss l and class
    prior p the risk is p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]). Where a batch's second
    term is below 0 the step goes against it alone, so the classifier does not learn the
    unlabelled texts by heart.
    """
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(width), np.log(prior / (1 - prior))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    n_pos, n_un = len(positive[1]) - 1, len(unlabelled[1]) - 1
    step = 0
    for _ in range(EPOCHS):
        some = np.array_split(rng.permutation(n_pos), BATCHES)
        others = np.array_split(rng.permutation(n_un), BATCHES)
        for p_rows, u_rows in zip(some, others):
            if not len(p_rows) or not len(u_rows):
                continue
            step += 1
            p, p_of = _pick(*positive, p_rows)
            u, u_of = _pick(*unlabelled, u_rows)
            gp = bias + np.bincount(p_of, weights[p], len(p_rows))
            gu = bias + np.bincount(u_of, weights[u], len(u_rows))
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            dp_neg, du_neg = -prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
            if negative >= 0:
                dp, du = dp_neg - prior * _sigmoid(-gp) / len(gp), du_neg
            else:
                dp, du = -dp_neg, -du_neg
            slope = np.bincount(p, dp[p_of], width) + np.bincount(u, du[u_of], width)
            slope = np.append(slope + DECAY * weights, dp.sum() + du.sum())
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope * slope
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    return weights, float(bias)


def _frequencies(batches):
    """In how many of a task's texts each feature is: of all texts, and of the toxic ones."""
    found = np.zeros((2, BUCKETS), np.int64)
    texts = np.zeros(2, np.int64)
    for batch in batches:
        buckets, firsts = features(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        found[0] += np.bincount(buckets, minlength=BUCKETS)
        found[1] += np.bincount(buckets[np.repeat(toxic, np.diff(firsts))], minlength=BUCKETS)
        texts += len(toxic), toxic.sum()
    kind, bucket = np.nonzero(np.concatenate([found, texts[:, None]], axis=1))
    n = np.concatenate([found, texts[:, None]], axis=1)[kind, bucket]
    yield pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(n)], ["kind", "bucket", "n"]
    )


def _chosen_features(used: np.ndarray):
    def run(batches):
        for batch in batches:
            buckets, firsts = features(batch.column(0), used)
            lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(buckets, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), lists], ["kind", "found"])

    return run


def _least(ids: DataFrame, most: int, seed: str) -> DataFrame:
    """At most ``most`` distinct ids, those of the least hash; so they can be broadcast."""
    return settle(
        ids.filter("doc_id is not null")
        .distinct()
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(most)
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """A model from confirmed toxic texts and from texts as they come.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic`` (0 or 1).
    The class prior is ``CAUTION`` times the toxic share of all labelled rows. Features are
    words, their beginnings and how often they recur, of those that the toxic texts have
    more often than all texts; frequencies are counted over all of
    ``docs``. The classifier is fitted on a bounded sample of toxic texts and one of all
    texts. Without toxic texts every score is near 0.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    toxic, rows = labels.agg(F.sum((F.col("toxic") == 1).cast("long")), F.count("toxic")).first()
    nothing = Model(np.zeros(BUCKETS, np.float32), -10.0)
    if not toxic:
        return nothing
    prior = min(max(CAUTION * toxic / rows, 1e-4), 0.5)
    known = _least(labels.filter("toxic = 1").select("doc_id"), positive_rows, "positive")
    plain = _least(docs.select("doc_id"), unlabelled_rows, "unlabelled")
    flagged = docs.select("doc_id", "text").join(
        F.broadcast(known.select("doc_id", F.lit(True).alias("_toxic"))), "doc_id", "left"
    )
    is_toxic = F.coalesce("_toxic", F.lit(False))
    counted = (
        flagged.select("text", is_toxic.alias("toxic"))
        .mapInArrow(_frequencies, "kind int, bucket int, n long")
        .groupBy("kind", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    frequency = np.zeros((2, BUCKETS + 1))
    kind, bucket, n = (counted.column(i).to_numpy() for i in range(3))
    frequency[kind, bucket] = n
    texts, found = frequency[:, -1], frequency[:, :-1]
    if not texts.all():
        return nothing
    used = more_often(found[1], texts[1], found[0], texts[0])
    sampled = flagged.join(
        F.broadcast(plain.select("doc_id", F.lit(True).alias("_plain"))), "doc_id", "left"
    ).select("text", (F.when(is_toxic, 1).otherwise(0) + F.when(F.col("_plain"), 2).otherwise(0)).alias("kind"))
    table = (
        sampled.filter("kind > 0")
        .mapInArrow(_chosen_features(used), "kind int, found array<int>")
        .toArrow()
        .combine_chunks()
    )
    kinds, lists = table.column("kind").to_numpy(), table.column("found").to_pylist()
    places = np.cumsum(used) - 1
    of = lambda flag: _rows([places[x] for x, k in zip(lists, kinds) if k & flag])
    weights, bias = fit(of(1), of(2), int(used.sum()), prior)
    whole = np.zeros(BUCKETS, np.float32)
    whole[used] = weights
    return Model(whole, bias)


def _rows(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    firsts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64), firsts


def _score(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            found = model.scores(*features(batch.column(1), model.weights != 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.float64))], ["doc_id", "score"]
            )

    return run


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every document.

    Only the text decides. Null and empty texts have the score of a text without words.
    Repeated and null ids are rows of their own; other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_score(shared), "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows that are not held out."""
    kept = fold(F.col("doc_id"), FOLDS) != HELD_FOLD
    return train(docs.filter(kept), labels.filter(kept))


def op4_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    found = score_toxicity(docs, learned(docs, labels))
    held = fold(F.col("doc_id"), FOLDS) == HELD_FOLD
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
