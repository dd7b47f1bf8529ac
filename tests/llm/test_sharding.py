import hashlib
from collections import Counter

import pytest

from tickflow.llm import sharding


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(turns, slots):
    names, owners, looked = list(turns), [None] * slots, Counter()
    order = [name for name in names for _ in range(turns[name])]
    while True:
        for name in order:
            if None not in owners:
                return owners
            while True:
                slot = (number(f"offset {name}") + looked[name] * (number(f"skip {name}") % (slots - 1) + 1)) % slots
                looked[name] += 1
                if owners[slot] is None:
                    owners[slot] = name
                    break


@pytest.mark.parametrize("turns, slots", [({"a": 1}, 2), ({"a": 1, "b": 1, "c": 1}, 7), ({"a": 2, "b": 1, "é": 3}, 503)])
def test_table_equals_taking_turns(spark, turns, slots):
    table = sharding.lookup_table(spark, turns, slots).table.orderBy("slot").collect()
    assert [r.shard for r in table] == brute(turns, slots)


def test_shares_and_movement(spark):
    names = [f"s{k}" for k in range(10)]
    before = [r.shard for r in sharding.lookup_table(spark, names, 1009).table.orderBy("slot").collect()]
    after = [r.shard for r in sharding.lookup_table(spark, names[:-1], 1009).table.orderBy("slot").collect()]
    assert set(Counter(before).values()) <= {100, 101}
    moved = sum(a != b for a, b in zip(before, after) if a != names[-1])
    assert moved < 0.25 * 1009


def test_bad_arguments(spark):
    for names, slots in ([], 7), (["a", "a"], 7), (["a"], 8), (list("abcdefg"), 7), ({"a": 0}, 7), ([None], 7):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, names, slots)


def test_place(spark):
    lookup = sharding.lookup_table(spark, ["x", "y"], 101)
    rows = [(1, "a", 9, "s"), (1, "a", 9, "s"), (None, None, 9, "s"), (None, "", 9, "s"), (2, "a", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int, shard string")
    placed = sharding.place(frame, ["doc_id", "text"], lookup)
    assert placed.columns == ["doc_id", "text", "slot", "shard"] and placed.count() == 5
    owners = {r.slot: r.shard for r in lookup.table.collect()}
    for row in placed.collect():
        parts = ["-" if v is None else f"{len(str(v))}:{v}" for v in (row.doc_id, row.text)]
        assert row.slot == number("".join(parts)) % 101 and row.shard == owners[row.slot]
    assert sharding.place(frame.limit(0), ["doc_id"], lookup).count() == 0
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_write_shards(spark):
    from tickflow.settings import scratch_path

    rows = spark.range(500).selectExpr("id AS doc_id", "'same' AS source")
    table, path = sharding.lookup_table(spark, ["x", "y", "z"], 101), scratch_path(spark, "test-shards")
    sharding.write_shards(rows, ["doc_id"], table, path, files=2)
    counts = spark.read.parquet(path).groupBy("shard").count().collect()
    assert sum(r["count"] for r in counts) == 500 and {r.shard for r in counts} == {"x", "y", "z"}
