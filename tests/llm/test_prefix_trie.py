import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tickflow.llm.prefix_trie import SparseTable, prefix_trie

LAYOUT = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes by prefixes as tuples."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(text.encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, found in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(found) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            min(found), len(p), min(members[p[:-1]]) if p else None, len(found), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(found) if rebuilt[c] == p).encode()).hexdigest(),
        )
        for p, found in members.items()
    )


def found(spark, rows, layout=LAYOUT):
    return sorted(tuple(row) for row in prefix_trie(spark.createDataFrame(rows, layout)).collect())


def made(seed, conversations, longest, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        conv_id = rng.choice([c, c + 100, -c, c * 37])
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv_id, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    # A hot conversation: a third of all say the same.
    rows += [(10_000 + c, turn, "user", "same") for c in range(conversations // 2) for turn in range(7)]
    rows += [(20_000, turn, "user", "same") for turn in range(3)] + [(None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_nodes_equal_brute_force(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = made(partitions, 60, 9, ["", None, "a", "b", "é" * 30, "x" * 5000])
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_and_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []
    alone = [(7, 0, "user", "x")]
    assert found(spark, alone) == brute(alone)
    # Turnless: number 1 keeps what follows its first turns, of which the absent 0 has none.
    turnless = [(c, 0, "user", "x") for c in range(1, 9)]
    assert found(spark, turnless) == brute(turnless)
    repeated = [(100, 1, "user", "x")] * 4 + [(101, 1, "user", "x")] * 4
    assert found(spark, repeated) == brute(repeated)


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(c, turn, role, text) for c, (role, text) in enumerate([("a", "bc"), ("ab", "c"), ("abc", None)]) for turn in range(7)]
    assert found(spark, rows) == brute(rows)


def test_extra_columns_are_ignored(spark):
    clashing = ["place", "token", "chars", "path", "block", "at", "common", "bound", "first", "shared", "item", "stop", "member"]
    rows = made(5, 12, 4, ["a", "b"])
    wide = [(*row, *range(len(clashing))) for row in rows]
    layout = LAYOUT + "".join(f", {name} long" for name in clashing)
    assert found(spark, wide, layout) == brute(rows)


def test_sparse_table():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 17, 64):
        values = rng.integers(0, 6, size)
        table = SparseTable(values)
        for at in range(size):
            for last in range(at, size):
                assert table.least(np.array([at]), np.array([last]))[0] == values[at : last + 1].min()
            for bound in range(8):
                right, left = at, at
                while right + 1 < size and values[right + 1] >= bound:
                    right += 1
                while left > 0 and values[left] >= bound:
                    left -= 1
                assert table.reach_right(np.array([at]), np.array([bound]))[0] == right
                assert table.reach_left(np.array([at]), np.array([bound]))[0] == left
