import hashlib
import random
import re

from tickflow.llm.decontaminate import decontaminate, drop_contaminated

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    answers = []
    for number, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, item_text in items:
            listed = words_of(item_text)
            size = min(10, len(listed))
            for k in range(len(listed) - size + 1 if listed else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == listed[k : k + size]:
                        hit.update(range(at, at + size))
                        found.add(str(item)) if item is not None else None
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        answers.append((number, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(answers, key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["the", "of", "a", "über", "9", "Tea", "RUN"] + [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 3, 9, 10, 11, 25))))) for i in range(30)]
    items += [(3, "other words of an item met before"), (None, "nameless item"), (40, None), (41, "the the the the")]
    docs = []
    for number in range(60):
        parts = rng.choices(vocabulary, k=rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            listed = words_of(rng.choice(items)[1])
            begin = rng.randrange(0, max(1, len(listed) - 9))
            at = rng.randrange(0, len(parts) + 1)
            parts[at:at] = listed[begin : begin + rng.choice((9, 10, 14, 30))]
        docs.append((number, rng.choice((" ", "\n", ", ", "-")).join(parts)))
    docs += [(100, None), (101, ""), (102, "...!"), (103, "Nameless... ITEM"), (103, "Nameless... ITEM"), (None, "a nameless item")]
    got = decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_words int, window string")
    items = spark.createDataFrame([], "item_id long, text string, size int")
    none = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in decontaminate(docs, items).collect()] == [(1, 2, 0, 0, none, False)]
    item = spark.createDataFrame([(1, "b", 3)], "item_id long, text string, size int")
    assert decontaminate(docs.limit(0), item).count() == 0
    assert drop_contaminated(docs, item).count() == 0
    assert [tuple(r) for r in drop_contaminated(docs, items).collect()] == [(1, "a b", 7, "x")]


def test_rows_are_dropped_by_their_own_text(spark):
    rows = [
        (None, "clean without number"), (None, "holds the Secret item here"), (None, None), (7, "clean under seven"),
        (7, "the secret item again"), (7, ""), (8, "clean"), (8, "clean"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "secret item")], "item_id long, text string")
    kept = sorted(map(tuple, drop_contaminated(docs, items).collect()), key=repr)
    assert kept == sorted((row for row in rows if "ecret" not in (row[1] or "")), key=repr)
