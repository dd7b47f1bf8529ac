"""SentencePiece encoding and decoding through a relational lattice.

Texts are cut into units that no merge can cross, and every distinct unit is encoded once: its
substrings up to the longest piece are exploded and equi-joined with the piece table, the edges
are grouped by unit, and a Viterbi fold in Spark's ``aggregate`` walks them. The model is a BPE
model, whose tokens are not the path of the highest score; they are the one path on which
neighbouring pieces are compatible, that is, on which BPE would not rather merge across the
boundary. So an arc scores 0 if it joins compatible pieces and minus infinity if not, every
position keeps its one surviving edge, and the path read back from the end is what the
SentencePiece library gives.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm import pieces, words
from tickflow.llm.tables import settle
from tickflow.llm.workers import give_back, lean

BUCKET_BYTES = 1 << 25
"""Text that is put together in one task at the end, or the longest text if that is more."""
UNITS_PER_TASK = 50_000
_SLICE_BYTES = 1 << 20
_SPELLED_IDS = 1 << 16
_PARTITION_BITS = 24
_LISTED_PARTITIONS = 12
"""Of so many bits' worth of input partitions the buckets of a unit are listed together."""
_ANSWERS = 1 << 18
"""Answers that are put together by bucket before they are sent."""


def _normal(text: str) -> Column:
    """The text as the model sees it: a blank before it, word marks as blanks."""
    marked = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(pieces.WORD_MARK), F.lit(" "))
    return F.when(marked != "", F.concat(F.lit(" "), marked)).otherwise(marked)


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, words.Slice]]:
    """Slices of the texts with the bucket they belong to: neighbours of one input partition."""
    bucket, held = TaskContext.get().partitionId() << _PARTITION_BITS, 0
    for batch in batches:
        for part in words.slices(batch["text"], None, words.SAME, _SLICE_BYTES):
            if held and held + len(part.data) > BUCKET_BYTES:
                bucket, held = bucket + 1, 0
            held += len(part.data)
            yield bucket, batch, part


def _units(part: words.Slice, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, which of the slice's different units, where each of those comes first)."""
    cut = np.zeros(len(part.data) + 1, dtype=bool)
    cut[1 : len(part.data)] = cuts[part.data[:-1], part.data[1:]]
    cut[part.offsets[:-1]] = True
    starts = np.flatnonzero(cut[: len(part.data)])
    ends = np.append(starts[1:], len(part.data))[: len(starts)]
    return starts, ends, *words.distinct(part, starts, ends)


def _distinct_units(model: str):
    @lean
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, seen, current = pieces.load(model).cuts(), set(), None
        for bucket, _, part in _bucketed(batches):
            if bucket != current:
                seen, current = set(), bucket
            starts, ends, _, first = _units(part, cuts)
            raw = part.data.tobytes()
            listed = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            texts = [unit.decode() for unit in listed if unit not in seen]
            seen.update(listed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(np.full(len(texts), bucket))], ["unit", "bucket"]
            )

    return collect


@lean
def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each slice as one compressed value."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    for bucket, batch, part in _bucketed(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
            # A slice of a batch would be written with all of the batch's bytes.
            rows = pa.array(range(part.first, part.first + len(part)))
            writer.write_batch(batch.take(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "payload"]
        )


_LATTICE = (
    "unit string, buckets array<long>, size int, "
    "lattice array<struct<start:int,stop:int,number:int,before:array<int>,ids:array<int>>>"
)


def _whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Edges in batches that hold all edges of their units."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        heads = np.flatnonzero(batch["unit"].is_valid().to_numpy(zero_copy_only=False))
        last = int(heads[-1]) if len(heads) else 0
        if len(heads) and (held or last):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _link_edges(model: str):
    """Groups the edges by unit, and lists for each those it may follow, in order of their end.

    A unit's edges come one after the other, by start and length, as they were exploded, and its
    first one names it; a unit without an edge for each of its characters is an error.
    """

    @lean
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces.load(model)
        for edges in _whole_units(batches):
            column = edges["unit"].combine_chunks()
            heads = column.is_valid().to_numpy(zero_copy_only=False)
            units = column.drop_null()
            buckets = edges["buckets"].combine_chunks().filter(pa.array(heads))
            unit = np.cumsum(heads) - 1
            start, length, number = (edges[name].to_numpy().astype(np.int64) for name in ("start", "length", "id"))
            end = start + length
            single = length == 1
            sizes = pc.utf8_length(units).to_numpy().astype(np.int64)
            if (np.bincount(unit[single], minlength=len(units)) != sizes).any():
                raise ValueError("the edges of a unit did not come together")
            # Every place between characters of any unit has a number; edges are put in order of
            # the place they end at, so those that end at one place are neighbours.
            base = np.append(0, np.cumsum(sizes + 1))[:-1][unit]
            order = np.argsort(base + end, kind="stable")
            base, unit, start, end, number = base[order], unit[order], start[order], end[order], number[order]
            ending = np.append(0, np.cumsum(np.bincount(base + end, minlength=int(sizes.sum()) + len(sizes))))
            low = ending[base + start]
            count = ending[base + start + 1] - low
            shift = np.repeat(low - (np.cumsum(count) - count), count)
            before = shift + np.arange(len(shift))
            after = np.repeat(np.arange(len(unit)), count)
            left, right = number[before], number[after]
            # A character that is no piece merges with nothing.
            fits = (left < 0) | (right < 0)
            both = np.flatnonzero(~fits)
            fits[both] = known.beside(left[both], right[both])
            before, after = before[fits], after[fits]
            # Edges that no chain of compatible ones takes to the end of their unit are on no path.
            alive, found = np.zeros(len(unit), dtype=bool), end == sizes[unit]
            while found.any():
                alive |= found
                found = (np.bincount(before, found[after], len(unit)) > 0) & ~alive
            joined = alive[before] & alive[after]
            place = np.cumsum(alive) - 1
            before, after = place[before[joined]], place[after[joined]]
            unit, start, end, number = unit[alive], start[alive], end[alive], number[alive]
            firsts = np.searchsorted(unit, np.arange(len(units) + 1)).astype(np.int32)
            own = (np.arange(len(unit)) - firsts[unit]).astype(np.int32)
            before_offsets = np.append(0, np.cumsum(np.bincount(after, minlength=len(unit)))).astype(np.int32)
            ids, id_counts = number, np.ones(len(unit), dtype=np.int64)
            missing = np.flatnonzero(number < 0)
            if len(missing):
                spelled = {
                    at: [known.byte_ids[byte] for byte in units[int(unit[at])].as_py()[start[at]].encode()]
                    for at in missing.tolist()
                }
                id_counts[missing] = [len(spelled[at]) for at in missing.tolist()]
                ids = np.repeat(number, id_counts)
                ids[ids < 0] = [one for at in missing.tolist() for one in spelled[at]]
            id_offsets = np.append(0, np.cumsum(id_counts)).astype(np.int32)
            lattice = pa.StructArray.from_arrays(
                [
                    pa.array(start.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    pa.array(own),
                    pa.ListArray.from_arrays(pa.array(before_offsets), pa.array(own[before])),
                    pa.ListArray.from_arrays(pa.array(id_offsets), pa.array(ids.astype(np.int32))),
                ],
                ["start", "stop", "number", "before", "ids"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    units,
                    buckets,
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(firsts), lattice),
                ],
                ["unit", "buckets", "size", "lattice"],
            )

    return link


# Edges come by their end, so when an edge is seen, the survivor of the place it starts at is known:
# the best path to every place has one last edge. The path is read back from the end.
_VITERBI = """
    transform(
        array(aggregate(
            lattice, cast(array() AS array<int>),
            (last, e) -> CASE WHEN e.start = 0 OR arrays_overlap(e.before, last)
                THEN concat(last, array(e.number)) ELSE last END
        )),
        last -> aggregate(
            reverse(lattice), named_struct('at', size, 'ids', cast(array() AS array<int>)),
            (path, e) -> CASE WHEN e.stop = path.at AND array_contains(last, e.number)
                THEN named_struct('at', e.start, 'ids', concat(e.ids, path.ids)) ELSE path END
        ).ids
    )[0]
"""


def encode_units(units: DataFrame, model: str) -> DataFrame:
    """(unit, buckets, ids) of non-empty units of text and the buckets they are in."""
    spark, known = units.sparkSession, pieces.load(model)
    listed = pd.DataFrame([(text, known.ids[text]) for text in known.halves], columns=["piece", "id"])
    table = F.broadcast(spark.createDataFrame(listed, "piece string, id int"))
    sized = units.select("unit", "buckets", F.char_length("unit").alias("size"))
    # Of the lengths a substring may have, only those that pieces of such a beginning have.
    lengths = f"from_json('{json.dumps(known.lengths())}', 'array<array<int>>')"
    begun = f"cast(crc32(substring(unit, start + 1, {pieces.BEGINNING})) % {pieces.BEGINNINGS} AS int)"
    begins = sized.select("unit", "buckets", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("start"))
    ranges = begins.select("unit", "buckets", "size", "start", F.explode(F.expr(f"{lengths}[{begun}]")).alias("length"))
    substring = F.expr("substring(unit, start + 1, length)").alias("piece")
    exploded = ranges.filter("length <= size - start").select("unit", "buckets", "start", "length", substring)
    edges = exploded.join(table, "piece", "left").filter("id IS NOT NULL OR length = 1")
    # Named at its first edge only, so that name and buckets are not sent with each.
    named = [F.when((F.col("start") == 0) & (F.col("length") == 1), F.col(c)).alias(c) for c in ("unit", "buckets")]
    rows = edges.select(*named, "start", "length", F.coalesce("id", F.lit(-1)).alias("id"))
    lattices = rows.mapInArrow(_link_edges(model), _LATTICE)
    kind = "smallint" if len(known.texts) < 1 << 15 else "int"
    return lattices.select("unit", "buckets", F.expr(_VITERBI).cast(f"array<{kind}>").alias("ids"))


@lean
def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of units, those of many units of one bucket as one compressed value.

    Pieces spell the unit they make, so its text is not sent along.
    """
    codec, held, n_held = pa.Codec("zstd"), [], 0

    def packed() -> pa.RecordBatch:
        found = pa.Table.from_batches(held)
        buckets, ids = (found[name].combine_chunks() for name in ("buckets", "ids"))
        flat, firsts = ids.flatten().to_numpy().astype("<i4"), ids.offsets.to_numpy().astype(np.int64)
        firsts -= firsts[0]
        owner = np.repeat(np.arange(len(found)), np.diff(buckets.offsets.to_numpy()))
        bucket = buckets.flatten().to_numpy()
        order = np.argsort(bucket, kind="stable")
        bucket, owner = bucket[order], owner[order]
        sizes = np.diff(firsts)[owner]
        ends = np.cumsum(sizes)
        shift = np.repeat(firsts[owner] - (ends - sizes), sizes)
        flat, bounds = flat[shift + np.arange(len(shift))], np.append(0, ends)
        heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        stops = np.append(heads[1:], len(bucket))
        n_ids = bounds[stops] - bounds[heads]
        small = sizes.astype("<i4")
        payloads = [
            codec.compress(small[a:b].tobytes() + flat[bounds[a] : bounds[b]].tobytes(), asbytes=True)
            for a, b in zip(heads.tolist(), stops.tolist())
        ]
        columns = [pa.array(bucket[heads]), pa.array(stops - heads), pa.array(n_ids), pa.array(payloads, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "n_units", "n_ids", "payload"])

    for batch in batches:
        # Smaller parts of a batch whose units are in very many buckets.
        while len(batch):
            ends = np.cumsum(pc.list_value_length(batch["buckets"]).to_numpy())
            taken = max(1, int(np.searchsorted(ends, _ANSWERS - n_held, side="right")))
            held.append(batch.slice(0, taken))
            n_held += int(ends[min(taken, len(batch)) - 1])
            batch = batch.slice(taken)
            if n_held >= _ANSWERS or len(batch):
                yield packed()
                held, n_held = [], 0
    if held:
        yield packed()


def _answers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, where each unit's begin and end) of the rows of a bucket."""
    codec, sizes, ids = pa.Codec("zstd"), [], []
    for row in table.to_batches():
        for n_units, n_ids, payload in zip(row["n_units"].to_pylist(), row["n_ids"].to_pylist(), row["payload"]):
            raw = np.frombuffer(codec.decompress(payload.as_buffer(), 4 * (n_units + n_ids)), dtype="<i4")
            sizes.append(raw[:n_units])
            ids.append(raw[n_units:])
    flat = np.concatenate([np.zeros(0, np.int32), *ids])
    return flat, np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int32), *sizes]), dtype=np.int64))


class _Listed:
    """Different units, found by their keys; bytes are compared."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.part = None
        if len(offsets) > 1:
            none = np.zeros(0, dtype=np.int64)
            self.part = words.Slice(0, data, offsets, none, none, np.zeros_like(offsets))
            self.starts, self.ends = offsets[:-1], offsets[1:]
            keys = words.unit_keys(self.part, self.starts, self.ends)
            self.order = np.argsort(keys)
            self.keys = keys[self.order]

    def places(self, part: words.Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the byte ranges of a slice are listed."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        if self.part is not None:
            wanted = words.unit_keys(part, starts, ends)
            place = self.order[np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)]
            sizes = ends - starts
            if (sizes == self.ends[place] - self.starts[place]).all():
                shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                there = shift + np.repeat(self.starts[place] - starts, sizes)
                if (part.data[shift] == self.part.data[there]).all():
                    return place
            # Two units of one hash, or a missing one.
            exact = {self.part.text(at): at for at in range(len(self.part))}
            raw = part.data.tobytes()
            listed = [exact.get(raw[a:b], -1) for a, b in zip(starts.tolist(), ends.tolist())]
            if min(listed) >= 0:
                return np.array(listed)
        raise ValueError("documents were dealt differently when read again; settle them first")


def _put_together(model: str, decoded: bool):
    def join(texts: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()  # the bucket before
        cuts, texts_of = pieces.load(model).cuts(), _texts_of(model)
        flat, offsets = _answers(answers)
        spelled, ends = _spelled(_spelling(model), flat)
        found = _Listed(spelled, ends[offsets])
        doc_ids, results, read_back = [], [], []
        for payload in texts["payload"]:
            batch = pa.ipc.open_stream(payload.as_buffer()).read_all().combine_chunks().to_batches()
            for piece in batch:
                doc_ids.append(piece["doc_id"])
                for part in words.slices(piece["text"], None, words.SAME, _SLICE_BYTES):
                    starts, ends, codes, first = _units(part, cuts)
                    place = found.places(part, starts[first], ends[first])[codes]
                    sizes = offsets[place + 1] - offsets[place]
                    ends = np.cumsum(sizes, dtype=np.int64)
                    shift = np.repeat(offsets[place] - (ends - sizes), sizes)
                    bounds = np.append(0, ends)[np.searchsorted(starts, part.offsets)]
                    ids = flat[shift + np.arange(len(shift))]
                    results.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
                    if decoded:
                        read_back.append(pa.array(texts_of(ids, bounds), pa.string()))
        columns = {
            "doc_id": pa.chunked_array(doc_ids, pa.int64()),
            "ids": pa.chunked_array(results, pa.list_(pa.int32())),
        }
        if decoded:
            columns["decoded"] = pa.chunked_array(read_back, pa.string())
        return pa.table(columns)

    return join


def encode(docs: DataFrame, model: str, scanned: bool = False, decoded: bool = False) -> DataFrame:
    """The piece ids of every whole text: doc_id, ids, one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. ``model`` names a SentencePiece
    BPE model file with byte fallback, at that path on every executor; ids are those its library
    gives. ``docs`` is read twice and must be dealt alike both times; pass ``scanned`` if it is a
    plain table, else it is written out first. ``decoded`` adds a column of that name with what
    the ids decode to, as ``decode`` would. Null and empty texts have no ids, a word mark in
    a text is a blank, texts may be of any length. Repeated rows and rows without doc_id are
    encoded like others. No documents give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if not scanned:
        rows = settle(rows, "texts")
    texts = rows.select("doc_id", _normal("text").alias("text"))
    wanted = texts.mapInArrow(_distinct_units(model), "unit string, bucket long")
    # A unit that is everywhere is listed, and encoded, once for so many buckets.
    listed = wanted.groupBy("unit", F.shiftright("bucket", _PARTITION_BITS + _LISTED_PARTITIONS).alias("chunk"))
    units = settle(listed.agg(F.collect_list("bucket").alias("buckets")).drop("chunk"), "units")
    dealt = units.repartition(1 + units.count() // UNITS_PER_TASK)
    encoded = settle(encode_units(dealt, model).select("buckets", "ids"), "encoded")
    answers = encoded.mapInArrow(_by_bucket, "bucket long, n_units long, n_ids long, payload binary")
    packed = texts.mapInArrow(_pack_texts, "bucket long, payload binary")
    together = packed.groupBy("bucket").cogroup(answers.groupBy("bucket"))
    layout = "doc_id long, ids array<int>" + ", decoded string" * decoded
    return together.applyInArrow(_put_together(model, decoded), layout)


def _spelling(model: str):
    """A function from ids to the bytes they spell and where each id's bytes end, after a 0."""
    known = pieces.load(model)
    texts = [text.encode() if text in known.ids else b"" for text in known.texts]
    for byte, number in enumerate(known.byte_ids):
        texts[number] = bytes([byte])
    texts[known.unknown] = " \u2047 ".encode()
    sizes = np.array([len(text) for text in texts])
    begins = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def spell(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(texts):
            raise ValueError("an id is out of the model's range")
        own = sizes[ids]
        ends = np.append(0, np.cumsum(own))
        shift = np.repeat(begins[ids] - ends[:-1], own)
        return flat[shift + np.arange(len(shift))], ends

    return spell


def _spelled(spell, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``spell`` gives for many ids, some at a time to bound its working arrays."""
    found, ends, done = [np.zeros(0, dtype=np.uint8)], [np.zeros(1, dtype=np.int64)], 0
    for at in range(0, len(ids), _SPELLED_IDS):
        data, stops = spell(ids[at : at + _SPELLED_IDS])
        found.append(data)
        ends.append(stops[1:] + done)
        done += len(data)
    return np.concatenate(found), np.concatenate(ends)


def _texts_of(model: str):
    """A function from the ids of some texts and where each begins and ends to the texts."""
    spell = _spelling(model)

    def join(ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        spelled, ends = spell(ids)
        whole, cuts = spelled.tobytes(), ends[bounds].tolist()
        return [whole[a:b].decode(errors="replace").removeprefix(" ") for a, b in zip(cuts, cuts[1:])]

    return join


def _joined_pieces(model: str):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_of = _texts_of(model)
        for batch in batches:
            decoded = [
                texts_of(ids.values.to_numpy(), np.array([0, len(ids.values)]))[0] if ids.is_valid else None
                for ids in batch["ids"]
            ]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(decoded, pa.string())], ["row", "decoded"])

    return join


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids``; a column of that name is replaced.

    Exact for what ``encode`` made, but that word marks are blanks. The unknown id is U+2047
    between blanks, control ids are nothing, bytes that are no UTF-8 become U+FFFD; null ids
    give null, ids out of range or null an error.
    """
    kept = encoded.drop("decoded")
    rows = kept.select(F.struct("*").alias("row"), F.col("ids").cast("array<int>").alias("ids"))
    layout = T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_joined_pieces(model), layout).select("row.*", "decoded")
