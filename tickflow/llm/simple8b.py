"""Simple-8b coding of token ids: as many ids per 64-bit word as their width allows.

The top four bits of a word select how many ids its other 60 bits hold. Selector 0 is an escape:
the id is in the block's list of escapes, in order. A block holds whole documents and is decoded
without looking at any other; all words of one selector are unpacked at once.
"""

from __future__ import annotations

import struct

import numpy as np

# Ids in a word and bits of each, by selector; selector 0 is the escape, 1 a run of zeros.
PACKINGS = (
    (1, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
_COUNTS = np.array([count for count, _ in PACKINGS])
_HEADER = struct.Struct("<4sIQII")
_MAGIC = b"S8B1"


def _runs_of(flags: np.ndarray, count: int) -> np.ndarray:
    """Where ``count`` neighbouring flags are all set, by the place of the first."""
    width = 1
    while 2 * width <= count:
        flags, width = flags[:-width] & flags[width:], 2 * width
    return flags[: len(flags) - (count - width)] & flags[count - width :] if width < count else flags


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For every position the packing that takes most ids from there on."""
    size, top = len(ids), int(ids.max(initial=0))
    chosen = np.where(ids < np.uint64(1 << 60), 15, 0).astype(np.int8)
    # What fits more ids of fewer bits also fits fewer of more bits, so candidates only shrink.
    for selector in range(14, 0, -1):
        count, bits = PACKINGS[selector]
        if count > size:
            break
        if top >> bits == 0:
            chosen[: size - count + 1] = selector
            continue
        fits = _runs_of(ids < np.uint64(1 << bits), count)
        if not fits.any():
            break
        chosen[: len(fits)][fits] = selector
    return chosen


_DOUBLINGS = 6


def _heads(jump: np.ndarray) -> np.ndarray:
    """The places met when jumping from 0 on, ``jump`` being where each place leads.

    Jumps of 2, 4, 8 and more steps are taken for all places at once; only the longest are walked
    one by one, and what they pass over is filled in by the shorter ones.
    """
    size = len(jump)
    steps = [np.append(np.minimum(jump, size), size)]
    for _ in range(_DOUBLINGS):
        steps.append(steps[-1][steps[-1]])
    longest, walked, at = steps.pop(), [], 0
    while at < size:
        walked.append(at)
        at = int(longest[at])
    heads = np.array(walked, dtype=np.int64)
    for step in reversed(steps):
        heads = np.stack([heads, step[heads]], axis=1).ravel()
    return heads[heads < size]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit ids."""
    ids = ids.astype(np.uint64)
    chosen = _selectors(ids)
    heads = _heads(np.arange(len(ids)) + _COUNTS[chosen])
    selectors = chosen[heads].astype(np.uint64)
    words = selectors << np.uint64(60)
    for selector in np.unique(selectors).tolist():
        count, bits = PACKINGS[selector]
        if bits:
            own = np.flatnonzero(selectors == selector)
            firsts, packed = heads[own], words[own]
            for place in range(count):
                packed |= ids[firsts + place] << np.uint64(place * bits)
            words[own] = packed
    return words, ids[heads[selectors == 0]]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids, as unsigned 64-bit integers."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selectors]
    offsets = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), dtype=np.uint64)
    for selector in np.unique(selectors).tolist():
        count, bits = PACKINGS[selector]
        own = np.flatnonzero(selectors == selector)
        if selector == 0:
            ids[offsets[own]] = escapes
        elif bits:
            mask = np.uint64((1 << bits) - 1)
            for place in range(count):
                ids[offsets[own] + place] = (words[own] >> np.uint64(place * bits)) & mask
    return ids


def pack_block(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Documents and their ids, one after the other; a document's number may be None."""
    words, escapes = encode(ids)
    known = np.array([number is not None for number in doc_ids], dtype=np.uint8)
    numbers = np.array([number or 0 for number in doc_ids], dtype="<i8")
    header = _HEADER.pack(_MAGIC, len(doc_ids), len(ids), len(words), len(escapes))
    parts = (numbers, lengths.astype("<u8"), words.astype("<u8"), escapes.astype("<u8"), known)
    return header + b"".join(part.tobytes() for part in parts)


def unpack_block(block: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a block."""
    magic, n_docs, n_ids, n_words, n_escapes = _HEADER.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    place, parts = _HEADER.size, []
    for kind, count in (("<i8", n_docs), ("<u8", n_docs), ("<u8", n_words), ("<u8", n_escapes), ("u1", n_docs)):
        parts.append(np.frombuffer(block, dtype=kind, count=count, offset=place))
        place += parts[-1].nbytes
    numbers, lengths, words, escapes, known = parts
    ids = decode(words, escapes)
    if len(ids) != n_ids or lengths.sum() != n_ids:
        raise ValueError("a block of token ids is damaged")
    return [n if k else None for n, k in zip(numbers.tolist(), known.tolist())], lengths.astype(np.int64), ids
