"""Benchmark decontamination by a prefix-filtered set join.

Every window of ten item words must be contained whole, so its necessary prefix is one token:
its rarest shingle of three words (of fewer, where the window is shorter), rare by document
frequency over the whole corpus. Documents are searched once for shingles that occur in any
window; those places are joined with the windows' prefix shingles, bounded by position, and a
place is confirmed when all of the window's shingles stand, as texts, where the window puts them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm import words
from tickflow.llm.tables import BROADCAST_ROWS, free_names, parts, settle, small
from tickflow.llm.workers import lean

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
FILTER_BITS = 25
"""The filter of known shingles has 2**FILTER_BITS bits, 4 MB, whatever the benchmark's size."""

_WINDOWS_PER_PART = 20_000

# Fixed by the contract: words after A-Z have become a-z.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({_WORD})"), F.lit(1))


def windows(items: DataFrame) -> DataFrame:
    """(item_id, window, size): each distinct window of each item, words joined by blanks."""
    listed = items.select("item_id", _words("text").alias("w")).filter("size(w) > 0")
    starts = F.expr(f"sequence(1, greatest(size(w) - {WINDOW_WORDS - 1}, 1))")
    cut = F.transform(starts, lambda at: F.array_join(F.slice("w", at, WINDOW_WORDS), " "))
    rows = listed.select("item_id", F.explode(F.array_distinct(cut)).alias("window"))
    return rows.select("item_id", "window", F.size(F.split("window", " ")).alias("size"))


def _window_shingles(distinct: DataFrame) -> DataFrame:
    """(window, size, at, shingle) for every place of a shingle in a window."""
    split = distinct.withColumn("w", F.split("window", " "))
    count = F.expr(f"sequence(1, greatest(size - {SHINGLE_WORDS - 1}, 1))")
    cut = F.transform(count, lambda at: F.array_join(F.slice("w", at, SHINGLE_WORDS), " "))
    return split.select("window", "size", F.posexplode(cut).alias("at", "shingle"))


def _shingle_hashes(texts: list[str], size: int) -> np.ndarray:
    """Hashes of shingles of one size, as ``words.runs`` gives them."""
    column = pa.array([text.replace(" ", "\n") for text in texts], pa.string())
    found = [part.hashes(part.running()) for part in words.slices(column, words.ALPHANUMERIC)]
    hashes = np.concatenate(found).reshape(-1, size)
    return np.concatenate([words.runs(row, size) for row in hashes])


def _probes(hashes: np.ndarray) -> list[np.ndarray]:
    """The two bits of each hash in the filter."""
    low = np.uint64((1 << FILTER_BITS) - 1)
    return [(hashes & low).astype(np.int64), ((hashes >> np.uint64(FILTER_BITS)) & low).astype(np.int64)]


@lean
def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, bits): what the shingles set in the filter's 64-bit words."""
    for batch in batches:
        sizes = batch["n"].to_numpy()
        for size in np.unique(sizes).tolist():
            texts = batch["shingle"].filter(pa.array(sizes == size)).to_pylist()
            at = np.unique(np.concatenate(_probes(_shingle_hashes(texts, size))))
            bits = np.uint64(1) << (at & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits.view(np.int64))], ["word", "bits"])


class _Known:
    """A Bloom filter of shingles: it has every known one, and few others.

    What passes by chance meets no window's shingle in the join, so the filter decides only how
    much is written.
    """

    def __init__(self, words_of_bits: list[tuple[int, int]]):
        self.bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
        for word, bits in words_of_bits:
            self.bits[word] = np.uint64(bits % 2**64)

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be known."""
        likely = np.arange(len(hashes))
        for probe in _probes(hashes):
            at = probe[likely]
            likely = likely[(self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
        return likely


_PLACES = "row_id long, doc_id long, n_words long, at long, lead int, shingle string, around string"


def _places(known, sizes: list[int]):
    """Finds every place of a shingle that passes the filter.

    Every document also gives one row without a shingle. ``around`` holds the words that a
    window over the place can cover, ``lead`` of them before it. Row numbers are unique in the
    table that the rows are written to.
    """

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in words.slices(batch["text"], words.ALPHANUMERIC):
                rows = next_row + np.arange(len(part))
                next_row += len(part)
                own = batch["doc_id"].slice(part.first, len(part))
                counts = part.counts()
                yield _place_rows(rows, own, counts, np.full(len(part), -1), None, None, None)
                hashes, owners = part.hashes(part.running()), part.owners()
                for size in sizes:
                    runs = words.runs(hashes, size)
                    at = known.value.among(runs)
                    at = at[owners[at] == owners[at + size - 1]] if len(at) else at
                    if not len(at):
                        continue
                    owner = owners[at]
                    low = np.maximum(part.bounds[owner], at - WINDOW_WORDS + size)
                    high = np.minimum(part.bounds[owner + 1], at + WINDOW_WORDS)
                    shingle, around = [], []
                    for begin, place, end in zip(low.tolist(), at.tolist(), high.tolist()):
                        text = [part.data[part.starts[k] : part.ends[k]].tobytes().decode() for k in range(begin, end)]
                        around.append(" ".join(text))
                        shingle.append(" ".join(text[place - begin : place - begin + size]))
                    yield _place_rows(
                        rows[owner], own.take(pa.array(owner)), counts[owner], at - part.bounds[owner], at - low, shingle, around
                    )

    return search


def _place_rows(rows, ids, counts, at, lead, shingle, around) -> pa.RecordBatch:
    size = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int64()),
            ids,
            pa.array(counts.astype(np.int64)),
            pa.array(at.astype(np.int64)),
            pa.nulls(size, pa.int32()) if lead is None else pa.array(lead.astype(np.int32)),
            pa.nulls(size, pa.string()) if shingle is None else pa.array(shingle, pa.string()),
            pa.nulls(size, pa.string()) if around is None else pa.array(around, pa.string()),
        ],
        ["row_id", "doc_id", "n_words", "at", "lead", "shingle", "around"],
    )


def contaminated_spans(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where item windows occur in documents.

    Returns three settled tables: one row per document (row_id, doc_id, n_words); one row per
    occurrence (row_id, start, size, window); and the windows of the items (item_id, window).
    ``row_id`` tells rows apart even where doc_id is null or repeated.
    """
    spark = docs.sparkSession
    item_windows = settle(windows(items), "windows")
    distinct = item_windows.select("window", "size").distinct()
    partitions = parts(item_windows.count(), _WINDOWS_PER_PART)
    shingles = settle(_window_shingles(distinct), "window-shingles", partitions)
    tokens = settle(
        shingles.select("shingle", F.least("size", F.lit(SHINGLE_WORDS)).alias("n")).distinct(),
        "tokens",
        partitions,
    )
    sizes = sorted(row["n"] for row in tokens.select("n").distinct().collect())
    bits = tokens.mapInArrow(_filter_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # At most 2**FILTER_BITS / 64 rows.
    known = spark.sparkContext.broadcast(_Known(bits.collect()))

    source = docs.select(F.col("doc_id").cast("long"), "text")
    found = settle(source.mapInArrow(_places(known, sizes), _PLACES), "places")
    places = found.filter("shingle IS NOT NULL")

    frequency = places.groupBy("shingle").agg(F.count("*").alias("n"))
    counted = shingles.join(frequency, "shingle").groupBy("window", "size").agg(
        F.min_by(F.struct("shingle", "at"), F.struct("n", "at")).alias("rarest"), F.count("*").alias("present")
    )
    # A window with a shingle that is nowhere is nowhere itself.
    prefix = settle(
        counted.filter(f"present = greatest(size - {SHINGLE_WORDS - 1}, 1)").select(
            "window", "size", F.col("rarest.shingle").alias("shingle"), F.col("rarest.at").alias("offset")
        ),
        "prefix",
    )
    start = F.col("at") - F.col("offset")
    covered = F.array_join(F.slice(F.split("around", " "), F.col("lead") - F.col("offset") + 1, F.col("size")), " ")
    met = places.join(small(prefix, BROADCAST_ROWS // 10), "shingle")
    spans = (
        met.filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .filter(covered == F.col("window"))
        .select("row_id", start.alias("start"), "size", "window")
    )
    documents = found.filter("shingle IS NULL").select("row_id", "doc_id", "n_words")
    return documents, settle(spans, "spans"), item_windows.select("item_id", "window")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """How much of each document is benchmark text.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Words
    are runs of digits, a-z (A-Z lowered) and characters beyond ASCII in the whole text. A window
    is ten consecutive words of an item, or a shorter item whole. Returns one row per row of
    ``docs``: doc_id, n_words, n_hit (words inside any occurrence of a window), n_items (items
    with occurring windows), items_sha256 (of their ids, sorted as texts, joined by commas) and
    contaminated (n_hit > 0).

    Null and empty texts have no words; an item without words matches nothing. Repeated rows get
    an answer each, and rows without doc_id too. An item_id on several rows is one item; an item
    without id hits words but is not counted. Empty tables are fine: no documents give no rows,
    no items hit nothing.
    """
    documents, spans, item_windows = contaminated_spans(docs, items)
    stretches = spans.groupBy("row_id").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("s")
    )
    first = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    folded = F.aggregate(
        "s",
        first,
        lambda seen, s: F.struct(
            (seen["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(seen["end"], s["start"]))).alias("hit"),
            F.greatest(seen["end"], s["end"]).alias("end"),
        ),
        lambda seen: seen["hit"],
    )
    hits = stretches.select("row_id", folded.alias("n_hit"))
    occurring = spans.select("row_id", "window").distinct()
    named = occurring.join(item_windows, "window").groupBy("row_id").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (
        documents.join(hits, "row_id", "left")
        .join(named, "row_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of any item.

    Each row is judged by its own text, whatever its doc_id: the search runs under a 64-bit hash of
    the text, which is the same wherever the row is read again, and equal texts have one verdict.
    """
    (name,) = free_names(docs, "lost")
    named = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    lost = decontaminate(named, items).filter("contaminated").select(F.col("doc_id").alias(name)).distinct()
    lost = small(settle(lost, "lost"))
    return docs.join(lost, F.xxhash64("text") == F.col(name), "left_anti").select(*docs.columns)
