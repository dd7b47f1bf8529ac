"""Token ids of documents in files: encoded by a public tokenizer, packed with Simple-8b.

Files are Parquet tables of self-contained binary blocks, written by Spark's committer to any
store it can reach: a lost task leaves nothing behind. Shards are ranges of doc_id in ascending
order, blocks in a shard likewise, so a document's place in the whole is its shard's offset plus
its block's offset plus its place in the block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.llm import simple8b, words

END_ID = 0
BLOCK_IDS = 1 << 16
"""A block ends with the document that reaches this many ids."""
CACHE_UNITS = 1_500_000
"""Encoded units of text that a Python worker remembers, before it starts anew."""
_SLICE_BYTES = 1 << 23

_BLOCKS = "shard int, block int, first long, n_ids long, n_docs long, payload binary"
_workers: dict[str, _Encoder] = {}


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_LETTER = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_MARK = _flags(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
# First bytes of characters some of which are white space.
_DOUBTFUL_2, _DOUBTFUL_3 = _flags(b"\xc2"), _flags(b"\xe1\xe2\xe3")


def _unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut without changing their tokens, their own starts included.

    The byte-level pre-tokenizer begins a new word at a single blank between two characters
    that are no white space, and wherever an ASCII or Latin-1 letter meets an ASCII mark other
    than the apostrophe. Where a blank's neighbour might be white space, nothing is cut.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        solid = data > 0x20
        blank = (data[1:-1] == 0x20) & solid[:-2] & solid[2:]
        blank &= ~(_DOUBTFUL_2[data[2:]] | _DOUBTFUL_3[data[2:]])
        blank[1:] &= ~_DOUBTFUL_2[data[:-3]]
        blank[2:] &= ~_DOUBTFUL_3[data[:-4]] if len(data) > 4 else True
        cut[1 : len(data) - 1] |= blank
    begins, mark = _LETTER[data], _MARK[data]
    ends = begins.copy()
    # U+00C0 to U+00FF, two bytes each, are letters but for two signs.
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] != 0x97) & (data[second] != 0xB7)]
    begins[second - 1] = ends[second] = True
    cut[1 : len(data)] |= (ends[:-1] & mark[1:]) | (mark[:-1] & begins[1:])
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[: len(data)])


class _Encoder:
    """Ids of texts by a byte-level BPE tokenizer, remembering what units became."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # In a byte-level vocabulary every character of a token stands for one byte.
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.token_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Encode new units, many per call."""
        if not new:
            return
        units, sizes = [unit.decode() for unit in new], np.array([len(unit) for unit in new])
        calls = [units[at : at + 64] for at in range(0, len(units), 64)]
        found = self.tokenizer.encode_batch_fast(calls, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(one.ids, dtype=np.uint32) for one in found])
        # Tokens keep every byte, so a unit's tokens end where its bytes do.
        ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(sizes)) + 1
        known = len(self.offsets) - 1
        self.place.update(zip(new, range(known, known + len(new))))
        self.ids = np.concatenate([self.ids, ids])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends])

    def encode(self, part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice, how many each has)."""
        if not len(part.data):
            return np.zeros(0, np.uint32), np.zeros(len(part), np.int64)
        if len(self.place) > CACHE_UNITS:
            self._forget()
        starts = _unit_starts(part.data, part.offsets)
        ends = np.append(starts[1:], len(part.data))
        codes, first = words.distinct(part, starts, ends)
        raw = part.data.tobytes()
        listed = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        places = np.fromiter(map(self.place.get, listed, repeat(-1)), np.int64, len(listed))
        fresh, known = np.flatnonzero(places < 0), len(self.offsets) - 1
        self._learn([listed[at] for at in fresh.tolist()])
        places[fresh] = known + np.arange(len(fresh))
        places = places[codes]
        sizes = self.offsets[places + 1] - self.offsets[places]
        ends_out = np.cumsum(sizes)
        shift = np.repeat(self.offsets[places] - (ends_out - sizes), sizes)
        bounds = np.append(0, ends_out)[np.searchsorted(starts, part.offsets)]
        return self.ids[shift + np.arange(len(shift))], np.diff(bounds)


def _encoder(path: str) -> _Encoder:
    if path not in _workers:
        _workers[path] = _Encoder(path)
    return _workers[path]


def _write_blocks(tokenizer: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)
        block, first = 0, 0
        doc_ids, lengths, parts, held = [], [], [], 0

        def finished() -> pa.RecordBatch:
            payload = simple8b.pack_block(doc_ids, np.concatenate(lengths), np.concatenate(parts))
            row = [[shard], [block], [first], [held], [len(doc_ids)], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["shard", "block", "first", "n_ids", "n_docs", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            numbers = batch["doc_id"].to_pylist()
            for part in words.slices(batch["text"], None, words.SAME, _SLICE_BYTES):
                ids, counts = encoder.encode(part)
                ends = np.cumsum(counts)
                ids, counts = np.insert(ids, ends, END_ID), counts + 1
                ends = np.cumsum(counts)
                at = 0
                while at < len(part):
                    done = int(ends[at - 1]) if at else 0
                    # The block takes every document up to the one that fills it.
                    stop = min(int(np.searchsorted(ends, done + BLOCK_IDS - held)) + 1, len(part))
                    doc_ids += numbers[part.first + at : part.first + stop]
                    lengths.append(counts[at:stop])
                    parts.append(ids[done : ends[stop - 1]])
                    held += len(parts[-1])
                    at = stop
                    if held >= BLOCK_IDS:
                        yield finished()
                        block, first = block + 1, first + held
                        doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield finished()

    return pack


def write_token_files(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode every whole text and write the ids, ascending by doc_id, with an end id each.

    ``tokenizer`` names a byte-level BPE file of the tokenizers library that every executor
    has at that path; special tokens in texts are ordinary text. A null text is empty and has
    its end id alone. Rows without doc_id come first; rows of one doc_id go by their text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ranged.mapInArrow(_write_blocks(tokenizer), _BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)


def _read_blocks(with_ids: bool):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                doc_ids, lengths, ids = simple8b.unpack_block(batch["payload"][row].as_buffer())
                narrow = ids.astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                held = memoryview(narrow).cast("B")
                sums = [zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [
                    pa.array(np.full(len(lengths), batch["shard"][row].as_py(), np.int32)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + batch["first"][row].as_py()),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ]
                names = ["shard", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(starts, ends[-1:]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return unpack


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (unsigned crc32 of its ids as little-endian unsigned 32-bit integers) and,
    unless left out, the ids."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    layout = "shard int, doc_id long, place long, n_tokens long, ids_crc32 long"
    rows = blocks.mapInArrow(_read_blocks(with_ids), layout + (", ids array<long>" if with_ids else ""))
    # One row per shard, as many as there are files.
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(offsets), "shard").select(
        "doc_id",
        (F.col("offset") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def token_files(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write the token files of the documents to ``path`` and read them back without the ids.

    ``docs`` needs doc_id and text; other columns are ignored. One row per row of ``docs``:
    doc_id, start, n_tokens (with the end id), ids_crc32. Null and empty texts have one token.
    Rows of one doc_id are ordered by their text, so that equal rows follow each other. No
    documents give no rows.
    """
    write_token_files(docs, path, tokenizer)
    return read_token_files(docs.sparkSession, path, with_ids=False)
