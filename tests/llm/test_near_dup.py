import random
import re

import pytest

from tickflow.llm.near_dup import keep_one, near_duplicates


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows):
    """Every pair of documents compared; None ids take no part."""
    sets = {number: shingles(text) for number, text in rows if number is not None}
    label = {number: number for number in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low, high = sorted((find(a), find(b)))
                    label[high] = low
    return {number: (len(sets[number]), find(number), find(number) == number) for number in sets}


def edited(rng, words, count):
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def family_rows():
    """Families of edited copies, a passage many share, and texts of their own."""
    rng = random.Random(3)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for family in range(6):
        base = [f"b{family}x{rng.randrange(400)}" for _ in range(rng.choice((12, 60, 150)))]
        for _ in range(12):
            rows.append(" ".join(edited(rng, base, rng.randrange(0, 7))))
    for _ in range(25):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))]
        rows.append(" ".join(own[:3] + passage + own[3:]))
    rows += ["a b c", "A  B\tC", "a b c d", "é É", "x", "x", ""]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark, family_rows):
    frame = spark.createDataFrame(family_rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame).collect()}
    assert got == brute(family_rows)


def test_nulls_repeats_and_other_columns(spark):
    text = "one two three four five six"
    rows = [
        (1, None, 5, True), (2, "", 5, True), (3, " \n", 5, None), (4, text, 5, True), (5, text.upper(), 5, True),
        (5, text.upper(), 5, True), (None, text, 5, True), (None, None, 5, True), (6, "word " * 20_000, 5, True),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, kept boolean")
    got = sorted(map(tuple, near_duplicates(frame).collect()), key=repr)
    expected = [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False),
        (None, 2, None, True), (None, 0, None, True), (6, 1, 6, True),
    ]
    assert got == sorted(expected, key=repr)
    assert keep_one(frame).columns == frame.columns
    assert keep_one(frame).count() == 7


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(frame).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(frame).count() == 0


def test_repeated_rows_stay_once(spark):
    text = "one two three four five six"
    rows = [(1, text)] * 3 + [(2, text)] * 2 + [(3, "other"), (4, None), (4, None)]
    rows += [(None, text), (None, text), (None, "lone"), (None, None), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS n").repartition(3)
    got = sorted((tuple(r) for r in keep_one(frame).collect()), key=repr)
    expected = [(1, text), (3, "other"), (4, None), (None, text), (None, "lone"), (None, None), (None, "")]
    assert got == sorted(((*row, 7) for row in expected), key=repr)
    assert near_duplicates(frame).count() == len(rows)
