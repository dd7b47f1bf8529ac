"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; other documents, whatever their label, are the
unlabelled mixture. Linear classifiers are trained in numpy to minimise the risk estimator
``prior * risk(positives as positive) + max(0, risk(unlabelled as negative) - prior *
risk(positives as negative))``: where the part for negatives would become negative, the step
goes the other way, so it cannot overfit the positives by calling the mixture clean. The score is
the mean probability of several classifiers, each trained on its own resampling.

Features are words, and words' first four or five bytes, by hash; a feature's value is the
logarithm of one plus its count in the text. Only features that positives have significantly more
often than the mixture get a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm import words
from tickflow.llm.tables import least_hashed, settle
from tickflow.llm.workers import lean

POSITIVES, UNLABELLED = 4_000, 8_000
"""Documents that classifiers are trained on at most, unless the caller says otherwise."""
CLASSIFIERS, STEPS, RATE, DECAY = 3, 200, 0.05, 1e-4
FEATURE_BITS, PREFIXES = 20, (4, 5)
MIN_DOCUMENTS, MIN_DEVIATIONS = 4, 5.0
HELD_OUT_FOLDS = 5
_ROWS_BACK = 1_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_FOLDS == 0, F.lit(False))


def _features(
    part: words.Slice, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) once for each feature that a text of the slice has.

    ``wanted`` flags the features to look for.
    """
    running, owners, keys, texts = part.running(), part.owners(), [], []
    for length in (0, *PREFIXES):
        long = np.flatnonzero(part.ends - part.starts >= length)
        ends = part.starts[long] + length if length else part.ends
        hashes = part.hashes(running, part.starts[long], ends)
        key = words.mix(hashes + np.uint64(length)) >> np.uint64(64 - FEATURE_BITS)
        text = owners[long].astype(np.uint64)
        if wanted is not None:
            found = wanted[key.astype(np.int64)]
            key, text = key[found], text[found]
        keys.append(key)
        texts.append(text)
    pairs = (np.concatenate(texts) << np.uint64(32)) | np.concatenate(keys)
    pairs, counts = np.unique(pairs, return_counts=True)
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), counts


_SAMPLE = "text_no long, positive boolean, unlabelled boolean, feature int, n int"


@lean
def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of every text, and feature -1 once; texts are numbered."""
    next_text = TaskContext.get().partitionId() << 40
    for batch in batches:
        for part in words.slices(batch["text"], words.ALPHANUMERIC):
            text, feature, count = _features(part)
            every = np.arange(len(part))
            text = np.concatenate([every, text])
            rows = pa.array(part.first + text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(next_text + text),
                    batch["positive"].take(rows),
                    batch["unlabelled"].take(rows),
                    pa.array(np.concatenate([np.full(len(part), -1), feature]).astype(np.int32)),
                    pa.array(np.concatenate([np.ones(len(part)), count]).astype(np.int32)),
                ],
                ["text_no", "positive", "unlabelled", "feature", "n"],
            )
            next_text += len(part)


def _document_counts(wanted: np.ndarray):
    """How many texts have each wanted feature; under feature -1, how many texts there are."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, texts = np.zeros(len(wanted), dtype=np.int64), 0
        for batch in batches:
            for part in words.slices(batch["text"], words.ALPHANUMERIC):
                feature, found = np.unique(_features(part, wanted)[1], return_counts=True)
                totals[feature] += found
                texts += len(part)
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(met, -1).astype(np.int32)), pa.array(np.append(totals[met], texts))], ["feature", "df"]
        )

    return count


@dataclass(frozen=True)
class Model:
    """Weights by feature (one column per classifier) and biases; no features: never toxic."""

    features: np.ndarray
    weights: np.ndarray
    biases: np.ndarray

    def scores(self, texts: np.ndarray, features: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
        """Mean probability for each of ``size`` texts from the features that have weights."""
        if not len(self.features):
            return np.zeros(size)
        place, value = np.searchsorted(self.features, features), np.log2(1 + counts)
        chances = [
            _sigmoid(np.bincount(texts, self.weights[place, k] * value, size) + bias)
            for k, bias in enumerate(self.biases)
        ]
        return np.mean(chances, axis=0)


NOTHING = Model(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


Side = tuple[np.ndarray, np.ndarray, np.ndarray, int]
"""Texts to learn from: (text, feature, value) where the value is not 0, and how many texts."""


def train(positive: Side, unlabelled: Side, size: int, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier over ``size`` features by the non-negative risk.

    Texts are resampled by weights drawn from ``seed``.
    """
    (p_text, p_feature, p_value, p_size), (u_text, u_feature, u_value, u_size) = positive, unlabelled
    rng = np.random.default_rng(seed)
    p_share, u_share = rng.exponential(size=p_size), rng.exponential(size=u_size)
    p_share, u_share = p_share / p_share.sum(), u_share / u_share.sum()
    weights, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        p = np.bincount(p_text, weights[p_feature] * p_value, p_size) + weights[-1]
        u = np.bincount(u_text, weights[u_feature] * u_value, u_size) + weights[-1]
        negative_risk = u_share @ np.logaddexp(0, u) - prior * (p_share @ np.logaddexp(0, p))
        if negative_risk >= 0:
            # The slopes of both risks of the positives add up to a constant.
            p_slope, u_slope = -prior * p_share, u_share * _sigmoid(u)
        else:
            p_slope, u_slope = prior * p_share * _sigmoid(p), -u_share * _sigmoid(u)
        slope = DECAY * weights
        slope[-1] = p_slope.sum() + u_slope.sum()
        slope[:-1] += np.bincount(p_feature, p_slope[p_text] * p_value, size)
        slope[:-1] += np.bincount(u_feature, u_slope[u_text] * u_value, size)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model:
    """Train on the rows that are not held out.

    The gradient steps see at most ``positives`` toxic documents and ``unlabelled`` others, those of
    least hashed doc_id. A feature gets a weight if at least MIN_DOCUMENTS of the toxic ones have it
    and their share is more than MIN_DEVIATIONS above that of all documents not held out; fewer
    documents could not pass the second test with any confidence.

    ``prior`` is the share of toxic documents; by default the share among those rows' labels
    less one standard error, as too large a prior makes the risk call clean texts toxic.
    """
    known = labels.select(F.col("doc_id").cast("long"), "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(~held_out())
    toxic = least_hashed(known.filter("toxic = 1").select("doc_id").distinct(), positives)
    numbers = docs.select(F.col("doc_id").cast("long")).filter("doc_id IS NOT NULL").filter(~held_out())
    mixture = least_hashed(numbers.distinct(), unlabelled)
    if prior is None:
        share, size = known.agg(F.avg((F.col("toxic") == 1).cast("double")), F.count("*")).head()
        prior = max(share - (share * (1 - share) / size) ** 0.5, share / 2) if size else 0.0
    picked = settle(
        toxic.withColumn("positive", F.lit(True)).join(mixture.withColumn("unlabelled", F.lit(True)), "doc_id", "full"),
        "picked",
        1,
    )
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")
    sample = settle(texts.mapInArrow(_sample_features, _SAMPLE), "sample")
    sizes = sample.filter("feature = -1").agg(F.count("positive"), F.count("unlabelled")).head()
    if not prior or not sizes[0] or not sizes[1]:
        return NOTHING

    often = sample.filter("feature >= 0").groupBy("feature").agg(F.count("positive").alias("n"))
    often = settle(often.filter(F.col("n") >= MIN_DOCUMENTS), "often", 1)
    # The mixture's frequencies are of all documents that are not held out, sampled or not.
    wanted = np.zeros(1 << FEATURE_BITS, dtype=bool)
    wanted[often.select("feature").toArrow()["feature"].to_numpy()] = True
    every = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL").filter(~held_out()).select("text")
    counts = every.mapInArrow(_document_counts(wanted), "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    frequency = settle(counts, "frequency", 1)
    total = frequency.filter("feature = -1").head()["df"]
    rate_p, rate_u = F.col("n") / sizes[0], F.coalesce("df", F.lit(0)) / total
    spread = F.sqrt((rate_u * (1 - rate_u) + 1 / total) * (1 / sizes[0] + 1 / total))
    telling = often.join(frequency, "feature", "left").filter((rate_p - rate_u) / spread > MIN_DEVIATIONS).select("feature")
    # At most 2**FEATURE_BITS rows.
    chosen = np.sort(telling.toArrow()["feature"].to_numpy().astype(np.int64))
    kept = F.broadcast(telling.unionByName(sample.sparkSession.sql("SELECT -1 AS feature")))
    sides = [F.col(name).isNotNull().alias(name) for name in ("positive", "unlabelled")]
    # As Arrow, for rows of Python objects take the driver some twenty times the memory.
    found = sample.join(kept, "feature").select("text_no", "feature", "n", *sides).toArrow()
    found = found.sort_by([("text_no", "ascending"), ("feature", "ascending")])

    def side(name: str) -> Side:
        rows = found.filter(found[name])
        numbers, text = np.unique(rows["text_no"].to_numpy(), return_inverse=True)
        feature, count = rows["feature"].to_numpy(), rows["n"].to_numpy()
        real = feature >= 0
        return text[real], np.searchsorted(chosen, feature[real]), np.log2(1 + count[real]), len(numbers)

    if not len(chosen):
        return NOTHING
    toxic_side, mixed_side = side("positive"), side("unlabelled")
    trained = [train(toxic_side, mixed_side, len(chosen), prior, seed) for seed in range(CLASSIFIERS)]
    return Model(chosen, np.stack([w for w, _ in trained], axis=1), np.array([b for _, b in trained]))


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << FEATURE_BITS, dtype=bool)
        wanted[model.features] = True
        for batch in batches:
            found = [
                model.scores(*_features(part, wanted), len(part))
                for part in words.slices(batch["text"], words.ALPHANUMERIC)
            ]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> DataFrame:
    """Score every whole text for toxicity.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are never looked
    at. Returns one row per row of ``docs``: doc_id, held_out (its label was kept from
    learning), score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without telling words. Repeated rows are scored
    alike. Rows without doc_id are scored but not learned from, and labels without doc_id or
    toxic teach nothing; a document with conflicting labels counts as toxic. Without toxic
    labels, every score is 0. No documents give no rows. ``prior``, ``positives`` and
    ``unlabelled`` are as in ``learn``.
    """
    model = learn(docs, labels, prior, positives, unlabelled)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    scored = rows.mapInArrow(lean(_scorer(model)), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic.

    Judged like ``toxicity``, row by row, without a join.
    """
    model = learn(docs, labels, prior)

    @lean
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The scorer gives one batch for each it takes, and takes no more before.
        score = _scorer(model)
        for batch in batches:
            # Some rows at a time, so that what goes back is not held twice as a whole.
            for first in range(0, len(batch), _ROWS_BACK):
                row = batch["row"].slice(first, _ROWS_BACK)
                text = pc.struct_field(row, "text")
                named = pa.RecordBatch.from_arrays([text, text], ["doc_id", "text"])
                for scored in score(iter([named])):
                    clean = pa.array(scored["score"].to_numpy() < 0.5)
                    yield pa.RecordBatch.from_arrays([row.filter(clean)], ["row"])

    rows = docs.select(F.struct(*(F.col(name) for name in docs.columns)).alias("row"))
    return rows.mapInArrow(judge, rows.schema).select("row.*")
