import random
import zlib

import numpy as np
import pytest

from tickflow.llm import toxicity as tox


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = []
    for number in range(1200):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 80))]
        toxic = number % 8 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(("Idiot", "SCUM", "loser!", "vileone", "viletwo")))
        rows.append((number, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    docs = frame.select("doc_id", "text").cache()
    return docs, frame.filter("doc_id < 700").select("doc_id", "toxic"), frame


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    scored = tox.toxicity(docs, labels).join(truth.select("doc_id", "toxic"), "doc_id").collect()
    assert len(scored) == 1200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    unseen = [r for r in scored if r.held_out or r.doc_id >= 700]
    toxic = [r for r in unseen if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in unseen if not r.toxic) <= 0.03 * len(unseen)


def test_held_out_labels_are_not_learned(corpus, spark):
    docs, labels, _ = corpus
    flipped = labels.withColumn("toxic", tox.F.when(tox.held_out(), 1 - tox.F.col("toxic")).otherwise(tox.F.col("toxic")))
    one, two = (sorted(map(tuple, tox.toxicity(docs, table).collect())) for table in (labels, flipped))
    assert one == two


def test_nulls_repeats_and_no_labels(spark, corpus):
    docs, labels, _ = corpus
    odd = spark.createDataFrame(
        [(None, None, "x"), (None, "idiot scum loser", "x"), (-5, "", "y"), (-6, "scum idiot loser", None), (-6, "scum idiot loser", None)],
        "doc_id long, text string, score string",
    )
    taught = labels.unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    every = docs.withColumn("score", tox.F.lit("z")).unionByName(odd)
    scored = tox.toxicity(every, taught).filter("doc_id IS NULL OR doc_id < 0")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.predicted) for r in scored.collect())
    assert found == [(False, -6, 1), (False, -6, 1), (False, -5, 0), (True, 0, 0), (True, 0, 1)]
    kept = tox.drop_toxic(every, taught)
    assert kept.columns == every.columns and kept.filter("doc_id < 0").count() == 1
    none = labels.limit(0)
    assert {r.score for r in tox.toxicity(odd, none).collect()} == {0.0}
    assert tox.toxicity(odd.limit(0), labels).count() == 0


def test_risk_does_not_fit_positives_below_zero():
    """With the mixture's positives not told apart from clean ones, the bias stays put."""
    side = (np.arange(50), np.zeros(50, int), np.ones(50), 50)
    mixture = (np.arange(10), np.zeros(10, int), np.ones(10), 100)
    weights, bias = tox.train(side, mixture, 1, 0.1, 0)
    assert weights[0] + bias > 0 > bias


def test_rare_telling_words_get_weights(spark):
    """A word of under 2 % of the toxic documents and of no others tells, as the common ones do."""
    rng = random.Random(4)
    rows = []
    rare = [number for number in range(0, 8000, 20) if zlib.crc32(str(number).encode()) % 5][:6]
    for number in range(8000):
        words = [f"w{rng.randrange(300)}" for _ in range(20)]
        toxic = number % 20 == 0
        if toxic:
            words.append("qzkrare" if number in rare else "idiot")
        rows.append((number, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = tox.learn(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    part = next(tox.words.slices(tox.pa.array(["qzkrare"]), tox.words.ALPHANUMERIC))
    _, features, _ = tox._features(part)
    assert set(features) <= set(model.features.tolist())


def test_mixture_frequencies_are_of_all_documents(spark, corpus):
    """Which features tell does not depend on how many documents are sampled for training."""
    docs, labels, _ = corpus
    full = tox.learn(docs, labels)
    few = tox.learn(docs, labels, unlabelled=20)
    assert few.features.tolist() == full.features.tolist() and few.biases.tolist() != full.biases.tolist()


def test_training_follows_the_risk_estimator(monkeypatch):
    """Against a plain reading of the non-negative risk: its two parts, and steps along slopes
    that are found by differences."""
    import numpy as np

    from tickflow.llm import toxicity as t

    rng = np.random.default_rng(5)
    size, prior = 3, 0.4

    def side(count, shift):
        table = np.maximum(rng.normal(shift, 1, (count, size)), 0)
        text, feature = np.nonzero(table)
        return table, (text, feature, table[text, feature], count)

    (p_table, positive), (u_table, unlabelled) = side(6, 1.0), side(9, 0.2)
    draws = np.random.default_rng(11)
    p_share, u_share = draws.exponential(size=6), draws.exponential(size=9)
    p_share, u_share = p_share / p_share.sum(), u_share / u_share.sum()

    def parts(theta):
        p, u = p_table @ theta[:-1] + theta[-1], u_table @ theta[:-1] + theta[-1]
        soft = lambda x: sum(np.log1p(np.exp(-abs(v))) + max(v, 0) for v in [x])
        plus = prior * sum(w * soft(-v) for w, v in zip(p_share, p))
        minus = sum(w * soft(v) for w, v in zip(u_share, u)) - prior * sum(w * soft(v) for w, v in zip(p_share, p))
        return plus, minus

    def slope(of, theta):
        found = []
        for at in range(size + 1):
            step = np.zeros(size + 1)
            step[at] = 1e-6
            found.append((of(theta + step) - of(theta - step)) / 2e-6)
        return np.array(found)

    theta, first, second, turned = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1), 0
    steps = 120
    for step in range(1, steps + 1):
        _, minus = parts(theta)
        turned += minus < 0
        g = slope(lambda x: sum(parts(x)), theta) if minus >= 0 else slope(lambda x: -parts(x)[1], theta)
        g[:-1] += t.DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g**2
        theta = theta - t.RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    monkeypatch.setattr(t, "STEPS", steps)
    weights, bias = t.train(positive, unlabelled, size, prior, seed=11)
    assert np.allclose([*weights, bias], theta, atol=1e-3)
    assert turned, "the correction was never needed"
