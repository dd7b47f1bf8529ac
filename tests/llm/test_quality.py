import collections
import re

import numpy as np
import pytest

from tickflow.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    repeated = {i + k for i, window in enumerate(windows) if seen[window] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


TEXTS = [
    None, "", " \n\t", "one", "é ü 日本 x\x0by", "a\na\nb\n\n \na ", "a b c d e " * 3, "# * $ % & | < >",
    "Ten words are here so the base lets it pass now", "a b c d e f a b c d e g\n" * 2, "x" * 30_000, "w " * 25_000,
    "one two three four five six seven eight nine ten\r\none two three four five six seven eight nine ten",
]


def test_counts_equal_brute_force(spark):
    rows = [(number, text, 3, False) for number, text in enumerate(TEXTS)] + [(None, TEXTS[8], 3, None), (0, None, 3, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.quality_rules(docs, labels)
    found = sorted((tuple(r[:7]) for r in got.collect()), key=repr)
    assert found == sorted(((row[0], *brute(row[1])) for row in rows), key=repr)
    assert all(r.kept == (not r.base_failed) for r in got.collect())  # nothing learned
    assert quality.quality_rules(docs.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    rows = []
    for number in range(900):
        words = [f"w{k}" for k in rng.integers(0, 500, 40)]
        bad = number % 4 == 0
        if bad:
            words = [word + "###" if rng.random() < 0.5 else word for word in words]
        rows.append((number, " ".join(words), int(not bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return frame.select("doc_id", "text"), frame.filter("doc_id < 600").select("doc_id", "quality"), frame


def test_rules_are_learned_and_hold_on_other_rows(labelled):
    docs, labels, truth = labelled
    judged = quality.quality_rules(docs, labels).join(truth.filter("doc_id >= 600").select("doc_id", "quality"), "doc_id")
    wrong = judged.filter("kept <> (quality = 1)").count()
    assert wrong <= 3
    kept = quality.keep_good(docs.selectExpr("*", "1 AS n_words", "2 AS row"), labels)
    assert kept.columns == ["doc_id", "text", "n_words", "row"]
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in quality.quality_rules(docs, labels).filter("kept").collect()
    }


def test_learning_by_hand():
    table = {"a": np.arange(300.0), "b": np.zeros(300)}
    (rule,) = quality.learn(table, table["a"] > 199.5)
    assert [(c.feature, c.above) for c in rule] == [("a", True)] and 190 < rule[0].threshold < 205
    assert quality.learn(table, np.zeros(300, dtype=bool)) == []
    assert quality.learn({"a": np.zeros(0)}, np.zeros(0, dtype=bool)) == []


def test_both_learn_from_the_same_sample(spark, labelled, monkeypatch):
    docs, labels, _ = labelled
    short = spark.range(2000, 2600).selectExpr("id AS doc_id", "'too few words' AS text", "int(id % 2) AS quality")
    docs, labels = docs.unionByName(short.select("doc_id", "text")), labels.unionByName(short.select("doc_id", "quality"))
    seen, learn = [], quality.learn

    def watched(table, bad):
        seen.append([bad.tolist(), *(table[name].tolist() for name in sorted(table))])
        return learn(table, bad)

    monkeypatch.setattr(quality, "learn", watched)
    judged = quality.quality_rules(docs, labels, 200)
    kept = quality.keep_good(docs, labels, 200)
    assert len(seen[0][0]) == 200 and seen[0] == seen[1]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.filter("kept").collect())
