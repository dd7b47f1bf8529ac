"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A signature has ``CHUNKS`` chunks of ``CHUNK`` symbols, each the low ``BITS`` bits of a MinHash
of the document's word shingles. Two documents are candidates if some chunk differs in at most
``ERRORS`` symbols. By the pigeonhole principle that finds every pair whose signatures differ in
fewer than ``CHUNKS * (ERRORS + 1)`` symbols; allowed errors are enumerated by leaving symbols
out, so candidates meet in an equi-join on the symbols that are left. A pair at the similarity
threshold of 0.75 misses all 16 chunks with a chance of 1e-7.

Documents with equal shingle sets are one class, and classes are compared, not copies. Within a
bucket (documents that share a key) pairs are not listed: every class is first compared with one
bucket leader. Classes whose buckets then still span several components are compared by a prefix
join on their rarest shingles, bounded by size and position, which no pair at the threshold can
escape and which the many middling pairs of a large family of edited copies do not pass. Every
link is confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm import words
from tickflow.llm.components import components
from tickflow.llm.tables import free_names, parts, settle, small
from tickflow.llm.workers import lean

SHINGLE_WORDS = 5
CHUNKS, CHUNK, ERRORS, BITS = 16, 5, 1, 16
SYMBOLS = CHUNKS * CHUNK
_KEYS_PER_PART = 250_000
_REPS_PER_PART = 20_000
_SETS_PER_PART, _PREFIXES_PER_PART = 2_000, 500
"""Rows of tables between the steps that one task writes at least, if there are as many."""
_CLASSES_PER_PART = 5_000
"""Classes whose keys one task makes: nearly all keys differ, so adding them up in that task takes
memory for each."""

_FACTORS = np.random.default_rng(7).integers(1, 2**63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_KEPT = [list(kept) for kept in combinations(range(CHUNK), CHUNK - ERRORS)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The symbols of a non-empty set of shingle hashes."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[at : at + 4096, None] * _FACTORS).min(0), out=least)
    return (least & np.uint64((1 << BITS) - 1)).astype(np.uint16)


@lean
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, signatures = [], [], []
        for part in words.slices(batch["text"]):
            hashes = part.hashes(part.running())
            for begin, end in zip(part.bounds[:-1], part.bounds[1:]):
                found = words.shingles(hashes[begin:end], SHINGLE_WORDS)
                counts.append(len(found))
                digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "signature"],
        )


def _symbols(column: pa.Array) -> np.ndarray:
    """Signatures as a matrix of symbols."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), SYMBOLS)


@lean
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per allowed set of chunk errors: what is left of the chunk, hashed."""
    for batch in batches:
        if not len(batch):
            continue
        symbols = _symbols(batch["signature"]).astype(np.uint64).reshape(-1, CHUNKS, CHUNK)
        for chunk in range(CHUNKS):
            for number, kept in enumerate(_KEPT):
                key = np.full(len(batch), chunk * len(_KEPT) + number + 1, dtype=np.uint64)
                for symbol in kept:
                    key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + symbols[:, chunk, symbol])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch["rep"]], ["key", "rep"])


@lean
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for part in words.slices(batch["text"]):
            hashes = part.hashes(part.running())
            for begin, end in zip(part.bounds[:-1], part.bounds[1:]):
                found.append(words.shingles(hashes[begin:end], SHINGLE_WORDS).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["rep"], batch["signature"], pa.array(found, pa.binary())], ["rep", "signature", "shingles"]
        )


@lean
def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that share a key and reach the similarity on their full sets."""
    for batch in batches:
        if not len(batch):
            continue
        errors = (_symbols(batch["signature_a"]) != _symbols(batch["signature_b"])).reshape(-1, CHUNKS, CHUNK)
        near = (errors.sum(2) <= ERRORS).any(1)
        good = []
        for row in np.flatnonzero(near):
            left = np.frombuffer(batch["shingles_a"][int(row)].as_buffer(), dtype=np.uint64)
            right = np.frombuffer(batch["shingles_b"][int(row)].as_buffer(), dtype=np.uint64)
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= 75 * (len(left) + len(right) - both):
                good.append(row)
        yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))


@lean
def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            found = np.frombuffer(batch["shingles"][row].as_buffer(), dtype=np.int64)
            rep, size = batch["rep"][row].as_py(), len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.full(size, rep)), pa.array(np.full(size, size))],
                ["shingle", "rep", "size"],
            )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("rep").alias(name),
            F.col("signature").alias(f"signature_{name}"),
            F.col("shingles").alias(f"shingles_{name}"),
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(_confirm, "a long, b long")


def _prefix_pairs(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs across components that may reach the similarity, by their rarest shingles.

    At 0.75, two sets share a shingle among the first ``size - ceil(0.75 * size) + 1`` of each
    in any common order, here rarest first; and what follows the first shared one must suffice
    for an overlap of 3/7 of both sizes.
    """
    rows = sets.mapInArrow(_shingle_rows, "shingle long, rep long, size long")
    common = rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    shared = rows.join(common, "shingle")
    # Shingles of one set alone come first in the order and meet nobody: only their number counts.
    order = Window.partitionBy("rep").orderBy("n", "shingle")
    whole = Window.partitionBy("rep")
    placed = shared.withColumn("rank", F.row_number().over(order)).withColumn("among", F.count("*").over(whole))
    placed = placed.withColumn("after", F.col("among") - F.col("rank")).filter(
        "size - after - 1 <= size - ceil(0.75 * size)"
    )
    prefix = settle(
        placed.select("shingle", "rep", "size", "after").join(labels, "rep"),
        "prefix",
        parts(labels.count(), _PREFIXES_PER_PART),
    )
    # In most postings one component prevails; only the others' rows look for partners.
    per_label = prefix.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    main = per_label.groupBy("shingle").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")
    )
    mixed = prefix.join(main.filter("labels > 1"), "shingle")
    lone = mixed.filter("label <> main")
    left, right = lone.alias("l"), mixed.alias("r")
    likely = left.join(
        right,
        (F.col("l.shingle") == F.col("r.shingle"))
        & (F.col("l.label") != F.col("r.label"))
        & (F.least("l.size", "r.size") * 4 >= F.greatest("l.size", "r.size") * 3)
        & ((F.least("l.after", "r.after") + 1) * 7 >= (F.col("l.size") + F.col("r.size")) * 3),
    )
    return likely.select(
        F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of near-duplicate documents.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per input row:
    ``doc_id``, ``n_shingles`` (size of the set of distinct five-word shingles of the whole
    text, A-Z in lower case; one for one to four words), ``component_id`` (least doc_id
    reachable over links of similarity 0.75 or more) and ``kept`` (doc_id is component_id).

    Null, empty and blank texts have no shingles and are linked with nothing. Repeated rows
    get the same answer each. A row without doc_id is linked with nothing, has no component
    and is kept. doc_id is the identity of a document: of two texts under one id, either may
    stand for it. No rows give no rows.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    signed = settle(
        source.mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, signature binary"), "signed"
    )
    classes = settle(
        signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
        .repartition(parts(signed.count(), _CLASSES_PER_PART)),
        "classes",
    )
    n_classes = classes.count()
    keys = settle(classes.mapInArrow(_keys, "key long, rep long"), "keys")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    met_keys = keys.join(buckets.filter("leader < last").drop("last"), "key")
    shared = settle(met_keys, "shared", parts(CHUNKS * len(_KEPT) * n_classes, _KEYS_PER_PART))

    members = settle(shared.select("rep").distinct(), "members", parts(n_classes, _REPS_PER_PART))
    n_members = members.count()
    chosen = classes.join(small(members), "rep")
    picked = source.withColumnRenamed("doc_id", "rep").join(small(members), "rep")
    texts = picked.groupBy("rep").agg(F.min("text").alias("text")) if _repeats(signed) else picked
    sets = settle(texts.join(chosen.select("rep", "signature"), "rep").mapInArrow(
        _sets, "rep long, signature binary, shingles binary"), "sets", parts(n_members, _SETS_PER_PART))

    met = shared.filter("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("n"))
    first = met.groupBy("rep").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("a"))
    stars = first.select("a", F.col("rep").alias("b"))
    links = settle(_confirmed(stars, sets), "links", parts(n_members, _SETS_PER_PART))

    labels = components(links)
    labelled = settle(
        _with_labels(shared.select("key", "rep"), labels), "labelled", parts(shared.count(), _KEYS_PER_PART)
    )
    spans = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_reps = settle(
        labelled.join(spans.filter("low < high").select("key"), "key").select("rep", "label").distinct(),
        "open",
        parts(n_members, _REPS_PER_PART),
    )
    remaining = sets.join(open_reps.select("rep"), "rep")
    more = settle(_confirmed(_prefix_pairs(remaining, open_reps), sets), "links")

    found = components(links.union(more))
    reps = classes.select("digest", F.col("rep"))
    grouped = _with_labels(reps, found).select("digest", F.col("label").alias("component"))
    return signed.join(grouped, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for those that ``near_duplicates`` does
    not keep: of each group the document of least doc_id stays.

    Of rows with one doc_id and one text, any one stays. Rows without doc_id have no group and are
    never compared with other documents, but of those with one text any one stays too; null is a
    text of its own.
    """
    lost = settle(near_duplicates(docs).filter("NOT kept").select("doc_id").distinct(), "lost")
    kept = docs.join(small(lost), "doc_id", "left_anti").select(*docs.columns)
    copied_id, copied_text = free_names(docs, "copied_id", "copied_text")
    named = kept.select(F.col("doc_id").alias(copied_id), F.xxhash64("text").alias(copied_text))
    counted = named.groupBy(copied_id, copied_text).agg(F.count("*").alias("n"))
    copied = settle(counted.filter("n > 1").drop("n"), "copied")
    if copied.isEmpty():
        return kept
    # Only rows that have copies are dealt out with their texts.
    same = F.col("doc_id").eqNullSafe(F.col(copied_id)) & (F.xxhash64("text") == F.col(copied_text))
    copies = kept.join(small(copied), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(small(copied), same, "left_anti").unionByName(copies)


def _repeats(signed: DataFrame) -> bool:
    """Whether any doc_id has several rows."""
    ids = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    return not ids.filter("n > 1").isEmpty()


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows by ``rep`` with their component; a rep without links is its own."""
    named = labels.select(F.col("node").alias("rep"), "label")
    return rows.join(named, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
