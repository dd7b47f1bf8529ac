"""The trie of conversations' prefixes: a sparse table of minima over the sorted ones' common prefixes.

Conversations, as sequences of turns, are sorted; those that share a prefix are then neighbours. For
each one the number of turns it has in common with the one before is kept. The members of a prefix of
d turns are the longest run around any of them in which no such number is below d, so each prefix
finds its run alone: it searches for the left and the right end by halving steps, with the minima over
all runs of 1, 2, 4, ... places at hand. Nothing has to be visited in order, and no stack is kept.

The sorted order is cut into blocks, a task each, with a sparse table per block. Runs that leave a
block go on over whole blocks, by a sparse table over the blocks' minima, and end at a record: a place
whose number is less than all before it (or after it) in its block. A turn is told by the first 16 bytes
of a SHA-256 digest, a conversation by its turns' digests in a row; texts are read once and not moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.tables import settle

TURN_BYTES = 16
BLOCK_TURNS, MAX_BLOCKS = 200_000, 1 << 14
"""Turns per block, until that makes too many blocks: a few numbers of each are known everywhere."""
GROUP, SHARED = 100, 6
"""A conversation takes its first crc32 % SHARED turns from the first of its GROUP numbers."""
IDS_AT_ONCE = 8
"""Conversation numbers that differ in so many low bits only are joined into one text at once."""
_MOST = 2**31 - 1


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), token (what tells the turn) and chars of every turn."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.sha2(text, 256).alias("said"),
        F.char_length(text).cast("long").alias("chars"),
    )
    by = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    token = F.substring(F.sha2(F.concat("said", "role"), 256), 1, 2 * TURN_BYTES)
    return rows.select("conv_id", F.row_number().over(by).alias("place"), token.alias("token"), "chars")


def rebuild(turns: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first one of its group.

    ``turns`` as of ``ordered_turns``. Returns conv_id, path (the turns' tokens in a row) and chars
    (an entry per turn); a conversation may be left without turns.
    """
    shared = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    item = F.struct(F.lit(1).alias("part"), "place", "token", "chars").alias("item")
    own = turns.withColumn("shared", shared)
    named = own.select("conv_id", "shared", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first")).distinct()
    lent = turns.filter(F.col("place") < SHARED).withColumnRenamed("conv_id", "first")
    taken = named.join(lent, "first").filter("place <= shared")
    items = own.filter("place > shared").select("conv_id", item)
    items = items.unionByName(taken.select("conv_id", F.struct(F.lit(0).alias("part"), "place", "token", "chars").alias("item")))
    # Lists leave out nulls: a conversation without turns has an empty one.
    items = items.unionByName(named.select("conv_id", F.lit(None).cast(items.schema["item"].dataType).alias("item")))
    listed = items.groupBy("conv_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return listed.select(
        "conv_id", F.unhex(F.array_join("items.token", "")).alias("path"), F.col("items.chars").alias("chars")
    )


class SparseTable:
    """Minima of all runs of 1, 2, 4, ... entries of an array."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        rows, width = [np.asarray(values, dtype=np.int64)], 1
        while 2 * width <= self.size:
            shorter = rows[-1]
            longer = shorter.copy()
            longer[: self.size - width] = np.minimum(shorter[: self.size - width], shorter[width:])
            rows.append(longer)
            width *= 2
        self.rows = np.stack(rows)
        self.levels = np.frexp(np.arange(self.size + 1))[1].astype(np.int64) - 1

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum from ``first`` to ``last``, both included."""
        level = self.levels[last - first + 1]
        return np.minimum(self.rows[level, first], self.rows[level, last - (1 << level) + 1])

    def reach_right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last place up to which all entries after ``at`` are at least ``bound``."""
        at = at.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            ahead = at + (1 << level)
            near = np.minimum(at + 1, self.size - 1)
            at = np.where((ahead < self.size) & (self.rows[level, near] >= bound), ahead, at)
        return at

    def reach_left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place from which all entries after it and up to ``at`` are at least ``bound``."""
        at = at.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            ahead = at - (1 << level)
            near = np.maximum(ahead + 1, 0)
            at = np.where((ahead >= 0) & (self.rows[level, near] >= bound), ahead, at)
        return at


def _common(batch: pa.RecordBatch, before: bytes | None) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(turns in common with the path before, or -1 at the very first; turns, the last path)."""
    column = batch["path"]
    paths = pa.concat_arrays([pa.array([before or b""], column.type), column])
    offsets = np.frombuffer(paths.buffers()[1], np.int32)[paths.offset : paths.offset + len(paths) + 1].astype(np.int64)
    raw = paths.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    tokens = data.copy().view(np.uint64).reshape(-1, TURN_BYTES // 8)
    starts, sizes = (offsets - offsets[0])[:-1] // TURN_BYTES, np.diff(offsets) // TURN_BYTES
    common, depth = np.zeros(len(paths), dtype=np.int64), 0
    open_rows = np.arange(1, len(paths))
    while len(open_rows):
        open_rows = open_rows[np.minimum(sizes[open_rows], sizes[open_rows - 1]) > depth]
        same = tokens[starts[open_rows] + depth] == tokens[starts[open_rows - 1] + depth]
        open_rows = open_rows[same.all(axis=1)]
        common[open_rows] += 1
        depth += 1
    if before is None:
        common[1] = -1
    return common[1:], sizes[1:], column[-1].as_py()


_RANKED = "block int, at int, conv_id long, common int, n_turns int, chars array<long>, path binary"


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a sorted block; the first one's path is kept, and the last one's at -1."""
    block, at, before = TaskContext.get().partitionId(), 0, None
    names = [part.split()[0] for part in _RANKED.split(", ")]

    def rows(numbers, ids, common, sizes, chars, paths) -> pa.RecordBatch:
        head = pa.array(np.full(len(numbers), block, np.int32))
        narrow = [pa.array(x, pa.int32(), from_pandas=True) for x in (numbers, common, sizes)]
        return pa.RecordBatch.from_arrays([head, narrow[0], ids, narrow[1], narrow[2], chars, paths], names)

    for batch in batches:
        if not len(batch):
            continue
        first = batch["path"][0].as_py() if before is None else None
        common, sizes, before = _common(batch, before)
        shown = pa.array([first] + [None] * (len(batch) - 1), pa.binary())
        yield rows(np.arange(at, at + len(batch)), batch["conv_id"], common, sizes, batch["chars"], shown)
        at += len(batch)
    if before is not None:
        nothing = pa.array([None], pa.list_(pa.int64()))
        yield rows([-1], pa.array([None], pa.int64()), [None], [None], nothing, pa.array([before], pa.binary()))


@dataclass(frozen=True)
class Blocks:
    """What is known of every block that has rows, in order: at most MAX_BLOCKS of them.

    ``bounds`` are the turns its first conversation has in common with the one before (-1 without
    one), ``lows`` the least of all its numbers, ``leasts`` its least conversation number,
    ``lasts`` the turns of its last conversation.
    """

    numbers: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray
    lows: np.ndarray
    leasts: np.ndarray
    lasts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def next_bounds(self) -> np.ndarray:
        return np.append(self.bounds[1:], -2)


def _blocks(ranked: DataFrame) -> Blocks:
    found = sorted(
        ranked.filter("at >= 0").groupBy("block").agg(
            F.count("*").alias("size"), F.min(F.when(F.col("at") > 0, F.col("common"))).alias("low"),
            F.min("conv_id").alias("least"), F.max_by("n_turns", "at").alias("last"),
        ).collect()
    )
    numbers = [row["block"] for row in found]
    bounds = dict.fromkeys(numbers, -1)
    if len(numbers) > 1:
        pairs = ranked.sparkSession.createDataFrame(list(zip(numbers[1:], numbers)), "block int, before int")
        firsts = ranked.filter("at = 0").select("block", F.col("path").alias("a"))
        lasts = ranked.filter("at = -1").select(F.col("block").alias("before"), F.col("path").alias("b"))
        # How many turns both paths begin with.
        agree = F.expr(f"""
            aggregate(
                IF(least(length(a), length(b)) = 0, cast(array() AS array<int>),
                    sequence(1, cast(least(length(a), length(b)) / {TURN_BYTES} AS int))), 0,
                (n, k) -> IF(n = k - 1 AND substring(a, {TURN_BYTES} * n + 1, {TURN_BYTES})
                    = substring(b, {TURN_BYTES} * n + 1, {TURN_BYTES}), k, n)
            )
        """)
        edges = pairs.join(firsts, "block").join(lasts, "before").select("block", agree.alias("bound"))
        bounds |= {row["block"]: row["bound"] for row in edges.collect()}
    bound = np.array([bounds[number] for number in numbers], dtype=np.int64)
    low = np.array([_MOST if row["low"] is None else row["low"] for row in found], dtype=np.int64)
    return Blocks(
        np.array(numbers, dtype=np.int64), np.array([row["size"] for row in found], dtype=np.int64), bound,
        np.minimum(low, bound), np.array([row["least"] for row in found], dtype=np.int64),
        np.array([row["last"] for row in found], dtype=np.int64),
    )


def _records(filled: DataFrame) -> DataFrame:
    """The places of each block whose number is less than all before them (side 1) or after them (-1).

    A run of a prefix of d turns that comes from outside ends at the one with low < d <= high;
    ``least`` is of the conversations of the block inside it, ``turns`` of the last one, where the
    run is on the left of the place.
    """
    kept = []
    for side, order in ((1, F.col("at")), (-1, F.col("at").desc())):
        by = Window.partitionBy("block").orderBy(order)
        gone = by.rowsBetween(Window.unboundedPreceding, -1)
        least = F.min("conv_id").over(gone)
        seen = filled.select(
            "block", "at", F.col("common").alias("low"), F.coalesce(F.min("common").over(gone), F.lit(_MOST)).alias("high"),
            (least if side == 1 else F.least(least, "conv_id")).alias("least"),
            (F.lag("n_turns").over(by) if side == 1 else F.lit(None).cast("int")).alias("turns"),
        )
        kept.append(seen.filter("low < high").withColumn("side", F.lit(side)))
    return kept[0].unionByName(kept[1])


def _crossings(filled: DataFrame, blocks: Blocks) -> DataFrame:
    """Where the runs go that leave a block: block, side, depth, least, stop, turns.

    ``least`` is of all conversations of the run beyond the block; on the right, ``stop`` is the
    run's last place and ``turns`` are of the conversation there.
    """
    spark, lows, leasts = filled.sparkSession, SparseTable(blocks.lows), SparseTable(blocks.leasts)
    total = int(blocks.sizes.sum())
    open_sides = [(at, 1, int(bound)) for at, bound in enumerate(blocks.next_bounds) if bound >= 0]
    open_sides += [(at, -1, int(bound)) for at, bound in enumerate(blocks.bounds) if bound >= 0]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, count = blocks.starts, len(blocks.numbers)
        for batch in batches:
            at, side, depth = (batch[name].to_numpy().astype(np.int64) for name in ("at", "side", "depth"))
            right = lows.reach_right(at, depth) + 1
            left = lows.reach_left(np.maximum(at - 1, 0), depth)
            target = np.where(side == 1, right, left)
            first = np.where(side == 1, at + 1, target + 1)
            last = np.where(side == 1, target - 1, at - 1)
            any_between = first <= last
            between = np.full(len(at), 2**63 - 1)
            between[any_between] = leasts.least(first[any_between], last[any_between])
            inside = target < count
            known = np.minimum(target, count - 1)
            start = np.where(inside, starts[known], total)
            turns = blocks.lasts[np.maximum(target - 1, 0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blocks.numbers[at].astype(np.int32)), pa.array(side.astype(np.int32)),
                    pa.array(depth.astype(np.int32)), pa.array(blocks.numbers[known].astype(np.int32), mask=~inside),
                    pa.array(between, mask=~any_between), pa.array(start), pa.array(turns.astype(np.int32)),
                ],
                ["block", "side", "depth", "target", "between", "start", "end_turns"],
            )

    sides = spark.createDataFrame(open_sides, "at int, side int, bound int")
    wanted = sides.select("at", "side", F.explode(F.sequence(F.lit(0), "bound")).alias("depth"))
    layout = "block int, side int, depth int, target int, between long, start long, end_turns int"
    found = settle(wanted.mapInArrow(search, layout), "searched")
    records = _records(filled).withColumnsRenamed({"block": "target", "side": "record_side"})
    meets = (
        (found["target"] == records["target"]) & (found["side"] == records["record_side"])
        & (records["low"] < found["depth"]) & (found["depth"] <= records["high"])
    )
    return found.join(records, meets, "left").select(
        "block", "side", "depth", F.least("between", "least").alias("least"),
        (F.col("start") + F.coalesce("at", F.lit(0)) - 1).alias("stop"), F.coalesce("turns", "end_turns").alias("turns"),
    )


_FOUND = (
    "node boolean, block int, conv_id long, depth int, parent long, n_convs long, n_leaves long, saved long, "
    "stop long, member long, position long"
)


def _members(blocks: Blocks):
    """For cogroups of a block and the runs that leave it: its nodes, and for each conversation the
    node it ends at; sums of nodes whose run leaves the block are of the block only."""
    names = [part.split()[0] for part in _FOUND.split(", ")]
    number_at = {int(number): at for at, number in enumerate(blocks.numbers)}
    starts, next_bounds = blocks.starts, blocks.next_bounds

    def beyond(crossings: pa.Table, side: int, bound: int):
        rows = crossings.filter(pc.equal(crossings["side"], side)).sort_by("depth")
        if len(rows) != max(bound + 1, 0):
            raise ValueError("a run that leaves its block was not followed")
        return [np.append(rows[name].to_numpy(), 0).astype(np.int64) for name in ("least", "stop", "turns")]

    def members(key, rows: pa.Table, crossings: pa.Table) -> pa.Table:
        place = number_at[key[0].as_py()]
        rows = rows.sort_by("at")
        common, turns, ids = (rows[name].to_numpy().astype(np.int64) for name in ("common", "n_turns", "conv_id"))
        count, bound, next_bound = len(ids), int(common[0]), int(next_bounds[place])
        table, numbers = SparseTable(common), SparseTable(ids)
        right_least, right_stop, right_turns = beyond(crossings, 1, next_bound)
        left_least, _, _ = beyond(crossings, -1, bound)

        def run(at: np.ndarray, depth: np.ndarray):
            """(last place in the block, whether the run goes on, the run's least conversation)."""
            left, right = table.reach_left(at, depth), table.reach_right(at, depth)
            least = numbers.least(left, right)
            goes_left, goes_right = (left == 0) & (depth <= bound), (right == count - 1) & (depth <= next_bound)
            least = np.where(goes_left, np.minimum(least, left_least[np.clip(depth, 0, max(bound, 0))]), least)
            least = np.where(goes_right, np.minimum(least, right_least[np.clip(depth, 0, max(next_bound, 0))]), least)
            return right, goes_right, least

        # A prefix is a node where it comes first.
        new = turns - common
        at = np.repeat(np.arange(count), new)
        before = np.cumsum(new) - new
        depth = np.arange(len(at)) - before[at] + common[at] + 1
        right, leaves_block, least = run(at, depth)
        _, _, parent = run(at, np.maximum(depth - 1, 0))
        open_depth = np.clip(depth, 0, max(next_bound, 0))
        stop = np.where(leaves_block, right_stop[open_depth], starts[place] + right)
        n_convs = stop - (starts[place] + at) + 1
        childless = np.where(leaves_block, right_turns[open_depth], turns[right]) == depth
        chars = np.append(rows["chars"].combine_chunks().flatten().to_numpy(), 0)
        text_at = (np.cumsum(turns) - turns)[at] + depth - 1
        own = np.where(depth > 0, (n_convs - 1) * chars[np.where(depth > 0, text_at, -1)], 0)
        saved_by_row, leaves_by_row = (np.zeros(count, dtype=np.int64) for _ in range(2))
        np.add.at(saved_by_row, at, own)
        np.add.at(leaves_by_row, at, childless)
        saved_so_far, leaves_so_far = np.cumsum(saved_by_row), np.cumsum(leaves_by_row)
        # From the node down along its first member, then all that its other members add.
        running = np.cumsum(own) - own
        row_end = np.append(running, own.sum())[before + new]
        saved = row_end[at] - running + saved_so_far[right] - saved_so_far[at]
        leaves = leaves_by_row[at] + leaves_so_far[right] - leaves_so_far[at]
        _, _, ends_at = run(np.arange(count), turns)
        size = len(at) + count
        is_node = np.arange(size) < len(at)

        def column(nodes, rest, kind, mask=None):
            values = np.concatenate([nodes, rest])
            return pa.array(values.astype(kind), mask=None if mask is None else mask)

        blank = np.zeros(count, dtype=np.int64)
        no_stop = np.concatenate([~leaves_block, np.ones(count, dtype=bool)])
        return pa.table(
            [
                pa.array(is_node),
                pa.array(np.full(size, key[0].as_py(), np.int32)),
                column(least, ends_at, np.int64),
                column(depth, turns, np.int32),
                column(parent, blank, np.int64, np.concatenate([depth == 0, np.ones(count, dtype=bool)])),
                column(n_convs, blank, np.int64),
                column(leaves, leaves_so_far, np.int64),
                column(saved, saved_so_far, np.int64),
                column(stop, blank, np.int64, no_stop),
                column(np.zeros(len(at)), ids, np.int64, is_node),
                column(np.zeros(len(at)), starts[place] + np.arange(count), np.int64, is_node),
            ],
            names,
        )

    return members


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of its parts in a row, which come one after the other, joined by commas."""
    node, digest = None, None

    def finished() -> pa.RecordBatch:
        values = [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int32()), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(values, ["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        columns = (batch[name].to_pylist() for name in ("conv_id", "depth", "ids"))
        done = []
        for conv_id, depth, ids in zip(*columns):
            if node == (conv_id, depth):
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append(finished())
            node, digest = (conv_id, depth), hashlib.sha256(ids.encode())
        yield from done
    if node is not None:
        yield finished()


def _ends(rows: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of every node at which conversations end."""
    part = F.shiftright("member", IDS_AT_ONCE)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string")), ",")
    joined = rows.groupBy("conv_id", "depth", part.alias("part")).agg(ids.alias("ids"))
    near = joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part")
    return near.select("conv_id", "depth", "ids").mapInArrow(_hashed, "conv_id long, depth int, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    ``conversations`` needs conv_id, turn, role and text; other columns are ignored. Each
    conversation c is ordered by turn and rebuilt: its first h = crc32(c) % 6 turns are those of
    conversation c - c % 100 (as many as that has). Returns a row per distinct sequence of first
    turns: conv_id (the smallest that begins with it), depth (its turns, 0 at the root),
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256
    (of the numbers of those that are this sequence and no more, ascending, comma-joined).

    Null roles and texts are empty, a null turn comes first, equal turns of a conversation go by
    role and text; repeated rows are turns of their own. Rows without conv_id are left out. An
    empty table has no root and gives no rows. Texts may be of any length; of a conversation, only
    16 bytes a turn have to fit a task. The digest of a node's ends is taken in one task, which
    reads them in order and holds none.
    """
    spark = conversations.sparkSession
    turns = settle(ordered_turns(conversations), "turns")
    wanted = max(turns.count() // BLOCK_TURNS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_path = rebuild(turns).repartitionByRange(min(wanted, MAX_BLOCKS), "path", "conv_id")
    ranked = settle(by_path.sortWithinPartitions("path", "conv_id").mapInArrow(_rank, _RANKED), "ranked")
    blocks = _blocks(ranked)
    layout = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if not len(blocks.numbers):
        return spark.createDataFrame([], layout)
    bounds = [(int(number), int(bound)) for number, bound in zip(blocks.numbers, blocks.bounds)]
    bounds = F.broadcast(spark.createDataFrame(bounds, "block int, bound int"))
    filled = ranked.filter("at >= 0").drop("path").join(bounds, "block")
    filled = filled.withColumn("common", F.when(F.col("at") == 0, F.col("bound")).otherwise(F.col("common"))).drop("bound")
    if len(blocks.numbers) > 1:
        crossings = _crossings(filled.drop("chars"), blocks)
    else:
        crossings = spark.createDataFrame([], "block int, side int, depth int, least long, stop long, turns int")
    grouped = filled.groupBy("block").cogroup(crossings.groupBy("block"))
    found = settle(grouped.applyInArrow(_members(blocks), _FOUND), "nodes")

    # Sums over runs that go on beyond their block: up to the run's end, less all before the next block.
    rows = found.filter("NOT node")
    sums = {r["block"]: (r["saved"], r["leaves"]) for r in rows.groupBy("block").agg(
        F.max("saved").alias("saved"), F.max("n_leaves").alias("leaves")).collect()}
    before, total = [], (0, 0)
    for number in blocks.numbers.tolist():
        after = tuple(a + b for a, b in zip(total, sums[number]))
        before.append((number, *total, *after))
        total = after
    before = F.broadcast(spark.createDataFrame(
        before, "block int, saved_before long, leaves_before long, saved_after long, leaves_after long"))
    reached = rows.join(before, "block").select(
        F.col("position").alias("stop"),
        (F.col("saved") + F.col("saved_before")).alias("saved_there"),
        (F.col("n_leaves") + F.col("leaves_before")).alias("leaves_there"),
    )
    columns = ["conv_id", "depth", "parent", "n_convs", "n_leaves", "saved"]
    nodes = found.filter("node")
    long = nodes.filter("stop IS NOT NULL").join(before, "block").join(reached, "stop").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaves_there") - F.col("leaves_after"),
        "saved": F.col("saved") + F.col("saved_there") - F.col("saved_after"),
    })
    nodes = nodes.filter("stop IS NULL").select(*columns).unionByName(long.select(*columns))
    children = found.filter("node AND depth > 0").groupBy(
        F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    ends = _ends(rows.select("conv_id", "depth", "member"))
    return nodes.join(children, ["conv_id", "depth"], "left").join(ends, ["conv_id", "depth"], "left").select(
        "conv_id", F.col("depth").cast("long"), F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
