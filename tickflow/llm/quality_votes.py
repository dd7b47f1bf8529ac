"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is the set of its words and of its forms: its words' shapes, how often words are said again at
once, its size. Features weigh by the logarithm of their count and their rarity among all documents. The labelled texts' matrix is reduced by a
randomised singular value decomposition, whose right vectors turn any text into a short latent
vector. The labelled vectors go to every task, which takes the exact cosines of each document to all of
them, a block at a time; the nearest vote for their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm import words
from tickflow.llm.tables import least_hashed, settle
from tickflow.llm.toxicity import held_out

LABELLED = 3_000
"""Labelled rows that vote and that the vectors are fitted on, at most; those of least hashed doc_id."""
WORDS, FORMS = 3 << 10, 1 << 10
"""Features that words and forms are hashed to."""
FORM_WEIGHT = 2.0
RANK, OVERSAMPLE, POWERS = 48, 16, 3
NEIGHBOURS, SHARPNESS = 15, 8.0
"""How many labelled texts vote; a vote weighs as much as its cosine to this power."""
GOOD_FROM = 0.3
BLOCK_TEXTS = 512

_SHAPE, _ECHO, _SIZE = (np.uint64(k * 0x9E3779B97F4A7C15 % 2**64) for k in range(1, 4))
# Letters are alike but for their case, digits alike, every other byte is itself.
_KINDS = np.arange(256, dtype=np.uint8)
_KINDS[97:123] = _KINDS[128:] = 97
_KINDS[65:91] = 65
_KINDS[48:58] = 48


def _features(part: words.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) once for each feature that a text of the slice has.

    Features are words without regard to case, their shapes (what kinds of characters they run
    through), how often a word has just been said in a row, and how many words there are, the
    last two in powers of two.
    """
    owners, raw = part.owners().astype(np.uint64), part.data
    folded = words.Slice(part.first, words.LOWER[raw], part.offsets, part.starts, part.ends, part.bounds)
    own = folded.hashes(folded.running())
    # A shape leaves out every byte whose kind is that of the byte before it in its word.
    kinds = _KINDS[raw]
    change = np.ones(len(kinds) + 1, dtype=bool)
    change[1:-1] = kinds[1:] != kinds[:-1]
    change[part.starts] = True
    place = np.append(0, np.cumsum(change[:-1]))
    shapes = words.Slice(part.first, kinds[change[:-1]], part.offsets, place[part.starts], place[part.ends], part.bounds)
    shape = shapes.hashes(shapes.running())
    echo = np.zeros(len(own), dtype=bool)
    echo[1:] = (own[1:] == own[:-1]) & (owners[1:] == owners[:-1])
    at = np.arange(len(own))
    said = (at - np.maximum.accumulate(np.where(echo, 0, at)))[echo]
    said, size = (np.frexp(x.astype(float))[1].astype(np.uint64) for x in (np.minimum(said, 8), part.counts()))
    forms = words.mix(np.concatenate([shape ^ _SHAPE, said ^ _ECHO, size ^ _SIZE])) % np.uint64(FORMS) + np.uint64(WORDS)
    texts = np.concatenate([owners, owners, owners[echo], np.arange(len(part), dtype=np.uint64)])
    feature = np.concatenate([own % np.uint64(WORDS), forms])
    pairs, counts = np.unique((texts << np.uint64(32)) | feature, return_counts=True)
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), counts


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, words.Slice]]:
    for batch in batches:
        for part in words.slices(batch["text"], fold=words.SAME):
            yield batch, part


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts have each feature, and under feature -1 how many texts there are."""
    totals, texts = np.zeros(WORDS + FORMS, dtype=np.int64), 0
    for _, part in _texts(batches):
        totals += np.bincount(_features(part)[1], minlength=len(totals))
        texts += len(part)
    met = np.flatnonzero(totals)
    columns = [pa.array(np.append(met, -1).astype(np.int32)), pa.array(np.append(totals[met], texts))]
    yield pa.RecordBatch.from_arrays(columns, ["feature", "df"])


_LABELLED = "text_no long, label int, feature int, n int"


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of labelled texts, numbered within the partition."""
    number = TaskContext.get().partitionId() << 40
    for batch, part in _texts(batches):
        text, feature, count = _features(part)
        labels = batch["label"].take(pa.array(part.first + text))
        columns = [pa.array(number + text), labels, pa.array(feature.astype(np.int32)), pa.array(count.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["text_no", "label", "feature", "n"])
        number += len(part)


@dataclass(frozen=True)
class Model:
    """What turns texts into vectors, the labelled vectors, and their labels.

    ``share`` is that of good ones among them, the score where no neighbour is like a text.
    """

    weights: np.ndarray
    turn: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def latent(self, text: np.ndarray, feature: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
        """A unit vector for each text (or 0), from its features, which come in order of text."""
        found = np.zeros((size, self.turn.shape[1]), dtype=np.float32)
        value = (np.log2(1 + count) * self.weights[feature]).astype(np.float32)
        starts = np.searchsorted(text, np.arange(size + 1))
        step = BLOCK_TEXTS
        for first in range(0, size, step):
            a, b = starts[first], starts[min(first + step, size)]
            if a < b:
                # Every text has a feature, its size, so that none is left out of the sums.
                rows = self.turn[feature[a:b]] * value[a:b, None]
                found[first : first + step] = np.add.reduceat(rows, starts[first : min(first + step, size)] - a, axis=0)
        return _unit(found)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """The weighted share of good labels among each vector's nearest labelled ones."""
        found, near = np.empty(len(vectors)), min(NEIGHBOURS, len(self.labels))
        for first in range(0, len(vectors), BLOCK_TEXTS):
            cosine = vectors[first : first + BLOCK_TEXTS] @ self.vectors.T
            if near < len(self.labels):
                nearest = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            else:
                nearest = np.tile(np.arange(near), (len(cosine), 1))
            weight = np.clip(np.take_along_axis(cosine, nearest, axis=1), 0, 1).astype(float) ** SHARPNESS
            total = weight.sum(axis=1)
            good = (weight * self.labels[nearest]).sum(axis=1)
            found[first : first + BLOCK_TEXTS] = np.where(total > 0, good / np.where(total > 0, total, 1), self.share)
        return found


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def principal(matrix: np.ndarray, rank: int, seed: int = 0) -> np.ndarray:
    """The first right singular vectors of a matrix, as columns, by random projection and power steps."""
    rng = np.random.default_rng(seed)
    size = min(rank + OVERSAMPLE, *matrix.shape)
    basis, _ = np.linalg.qr(matrix @ rng.standard_normal((matrix.shape[1], size)).astype(matrix.dtype))
    for _ in range(POWERS):
        other, _ = np.linalg.qr(matrix.T @ basis)
        basis, _ = np.linalg.qr(matrix @ other)
    _, _, turned = np.linalg.svd(basis.T @ matrix, full_matrices=False)
    return turned[: min(rank, size)].T.copy()


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model | None:
    """Fit on at most ``labelled`` labelled rows that are not held out; nothing without labels.

    Rarity is counted over all documents. The driver holds the sample's features and a matrix of
    ``labelled`` times WORDS + FORMS 4-byte entries.
    """
    known = labels.select(F.col("doc_id").cast("long"), "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("label"))
    picked = settle(least_hashed(known, labelled), "picked", 1)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    taught = rows.join(F.broadcast(picked), "doc_id").select("doc_id", F.col("label").cast("int"), "text")
    # Rows of one doc_id are copies or clashes; the first text by order stands for it.
    taught = taught.groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    sample = settle(taught.mapInArrow(_labelled_features, _LABELLED), "labelled")
    if sample.isEmpty():
        return None
    counts = rows.select("text").mapInArrow(_frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    # At most a row per feature and one.
    frequency = {row["feature"]: row["df"] for row in counts.collect()}
    total = frequency.pop(-1)
    weights = np.full(WORDS + FORMS, np.log(1 + total))
    for feature, df in frequency.items():
        weights[feature] = np.log((1 + total) / (1 + df)) + 0.1
    weights[WORDS:] *= FORM_WEIGHT
    found = sample.orderBy("text_no", "feature").toArrow()
    number, text = np.unique(found["text_no"].to_numpy(), return_inverse=True)
    feature, count = found["feature"].to_numpy(), found["n"].to_numpy()
    label = np.zeros(len(number))
    label[text] = found["label"].to_numpy() == 1
    matrix = np.zeros((len(number), len(weights)), dtype=np.float32)
    matrix[text, feature] = np.log2(1 + count) * weights[feature]
    matrix /= np.maximum(np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None], 1e-9)
    model = Model(weights, principal(matrix, RANK).astype(np.float32), np.zeros((0, 0)), label, float(label.mean()))
    del matrix
    vectors = model.latent(text, feature, count, len(number))
    return Model(weights, model.turn, vectors, label, model.share)


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _texts(batches):
            scores = model.scores(model.latent(*_features(part), len(part)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(part.first, len(part)), pa.array(scores)], ["doc_id", "score"]
            )

    return score


def quality_votes(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """Score every whole text for quality.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns are never looked
    at. Returns one row per row of ``docs``: doc_id, held_out (its label was kept from learning),
    score (0 to 1, the weighted share of good neighbours), predicted (1 from 0.3 on).

    Null and empty texts have one feature, their size, and are scored like others; a text that is
    like no labelled one gets the share of good labels. Repeated rows are scored alike. Rows without
    doc_id are scored but not learned from, labels without doc_id or quality teach nothing; a
    document with conflicting labels counts as bad. Without labels, every score is 1. No documents
    give no rows.
    """
    model = learn(docs, labels, labelled)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        scored = rows.select("doc_id", F.lit(1.0).alias("score"))
    else:
        scored = rows.mapInArrow(_scorer(model), "doc_id long, score double")
    predicted = (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)
