import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickflow.llm import quality_votes as votes
from tickflow.llm import words
from tickflow.llm.toxicity import held_out

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"
TEXTS = ["", None, "one", "One one ONE one one", "a!! B?? c12 c34", "é é日 x", " \n\t ", "word " * 900, "AbC abc--def 12:30"]


def plain_features(text):
    """Features of a text by a slow reading: words, shapes, repeats, size."""
    split = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    lower = [w.encode().translate(bytes(words.LOWER)) for w in split]
    found, said = Counter(lower), 0
    for word in split:
        kinds = ["A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b >= 128 else "0" if 48 <= b <= 57 else chr(b) for b in word.encode()]
        found["shape", "".join(k for k, before in zip(kinds, [None, *kinds]) if k != before)] += 1
    for word, before in zip(lower[1:], lower):
        said = said + 1 if word == before else 0
        if said:
            found["said", min(said, 8).bit_length()] += 1
    found["size", len(split).bit_length()] += 1
    return found


def test_features_are_those_of_a_slow_reading():
    part = next(words.slices(pa.array(TEXTS), fold=words.SAME))
    text, feature, count = votes._features(part)
    names = {}
    for at, one in enumerate(TEXTS):
        expected, own = plain_features(one), text == at
        # As many features with the same counts; the same name has the same number everywhere.
        assert sorted(count[own].tolist()) == sorted(expected.values())
        for name, n in expected.items():
            numbers = set(feature[own][count[own] == n].tolist())
            names[name] = names.get(name, numbers) & numbers
            assert names[name]


def test_scores_are_weighted_votes_of_the_nearest():
    rng = np.random.default_rng(2)
    vectors = votes._unit(rng.normal(size=(70, 6)).astype(np.float32))
    labels = rng.integers(0, 2, 70).astype(float)
    model = votes.Model(np.ones(3), np.zeros((3, 6)), vectors, labels, 0.25)
    asked = votes._unit(np.concatenate([rng.normal(size=(600, 6)), np.zeros((1, 6))]).astype(np.float32))
    for vector, score in zip(asked, model.scores(asked)):
        cosine = [float(vector @ other) for other in vectors]
        nearest = sorted(range(70), key=lambda at: -cosine[at])[: votes.NEIGHBOURS]
        weight = [max(cosine[at], 0) ** votes.SHARPNESS for at in nearest]
        expected = sum(w * labels[at] for w, at in zip(weight, nearest)) / sum(weight) if sum(weight) else 0.25
        assert score == pytest.approx(expected, abs=1e-5)


def test_principal_equals_a_full_decomposition():
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(80, 30)) * np.geomspace(1, 1e-3, 30)
    _, _, turned = np.linalg.svd(matrix)
    found = votes.principal(matrix, 5)
    assert np.allclose(np.abs(turned[:5] @ found), np.eye(5), atol=1e-6)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for doc_id in range(400):
        text = " ".join(rng.choices(vocabulary, k=rng.randrange(5, 120)))
        if doc_id % 4 == 0:
            text = rng.choice([text.upper().replace(" ", "!! "), " ".join(f"{w} {w} {w} {w}" for w in text.split())])
        rows.append((doc_id, text))
        if doc_id % 3:
            labels.append((doc_id, int(doc_id % 4 != 0)))
    return rows, labels


def test_held_out_labels_are_found(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([*rows, (None, None), (900, ""), (0, rows[1][1])], DOCS).repartition(3)
    # Labels of held-out rows are turned round: they must not be learned from.
    out = {r.doc_id for r in docs.filter(held_out()).collect()}
    false = [(d, q if d not in out else 1 - q) for d, q in labels] + [(None, 1), (5000, 1), (7, None)]
    found = votes.quality_votes(docs, spark.createDataFrame(false, LABELS)).collect()
    assert len(found) == len(rows) + 3 and all(0 <= r.score <= 1 for r in found)
    right = [r.predicted == (r.doc_id % 4 != 0) for r in found if r.doc_id in out]
    assert sum(right) / len(right) > 0.95
    assert all(r.held_out == (r.doc_id in out) and r.predicted == (r.score >= 0.3) for r in found if r.doc_id is not None)


def test_tables_without_labels_or_rows(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:5], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in votes.quality_votes(docs, none).collect()] == [1.0] * 5
    empty = spark.createDataFrame([], DOCS)
    assert votes.quality_votes(empty, spark.createDataFrame(corpus[1], LABELS)).collect() == []
    one = votes.quality_votes(docs, spark.createDataFrame([(1, 0), (1, 1)], LABELS)).collect()
    assert len(one) == 5 and max(r.score for r in one) == 0.0


def test_other_columns_are_not_looked_at(spark, corpus):
    rows, labels = corpus
    plain = votes.quality_votes(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    wide = spark.createDataFrame([(*row, 1, "x", 2.0, 3) for row in rows], DOCS + ", label int, feature string, score double, quality int")
    more = spark.createDataFrame([(*row, "y", 0) for row in labels], LABELS + ", text string, label int")
    assert sorted(plain.collect()) == sorted(votes.quality_votes(wide, more).collect())
