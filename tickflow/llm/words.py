"""Words of whole Arrow text columns as numpy arrays of positions and 64-bit hashes.

Texts are handled as UTF-8 bytes, a few documents at a time, so memory is bounded by
``SLICE_BYTES`` or the longest single text, whichever is larger. Words are compared by hashes, a
pair of polynomials modulo two primes near 2**31: two different words meet with a chance of about
2**-62, longer byte ranges of n bytes with one of at most (n / 2**31)**2. Where a hash finds
something remembered under it, users compare the bytes too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

# Primes and the bases of their polynomials.
_FIELDS = ((2_147_483_647, 1_540_483_477), (2_147_483_629, 1_831_565_813))
_PLAIN_BYTES = 1 << 24
"""Up to so many bytes, 2**39 at most each, sum up within 64 bits as they are."""

# A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

# [^\x20\x09-\x0D]+
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower case
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_table(factor: int, prime: int, size: int) -> np.ndarray:
    """The first powers of a factor modulo a prime, doubling what is known."""
    table, known = np.ones(size, dtype=np.uint64), 1
    while known < size:
        step = np.uint64(pow(factor, known, prime))
        fresh = min(known, size - known)
        table[known : known + fresh] = table[:fresh] * step % np.uint64(prime)
        known += fresh
    return table


def _power_tables(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each field's base and of its inverse."""
    global _powers
    if not _powers or len(_powers[0][0]) < size:
        size = max(size + size // 8, SLICE_BYTES + 1)
        _powers = [
            (_power_table(base, prime, size), _power_table(pow(base, -1, prime), prime, size)) for prime, base in _FIELDS
        ]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Some neighbouring texts of a column.

    ``first`` is the row of the first text, ``offsets`` where each text begins and ends in
    ``data``, ``starts`` and ``ends`` where the words are, ``bounds`` where in those each
    text's words begin and end.
    """

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        """Words per text."""
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text each word is in, counted from the slice's first."""
        return np.repeat(np.arange(len(self)), self.counts())

    def running(self) -> list[np.ndarray]:
        """Running hash sums of the bytes; ``hashes`` cuts words out of them."""
        found, digits = [], self.data.astype(np.uint64) + np.uint64(1)
        for (prime, _), (up, _) in zip(_FIELDS, _power_tables(len(self.data) + 1)):
            terms = digits * up[: len(self.data)]
            if len(self.data) > _PLAIN_BYTES:
                terms %= np.uint64(prime)
            sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(terms, out=sums[1:])
            found.append(sums)
        return found

    def hashes(self, running: list[np.ndarray], starts=None, ends=None) -> np.ndarray:
        """A hash of each byte range, by default of each word."""
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        joined = np.zeros(len(starts), dtype=np.uint64)
        for (prime, _), (_, down), sums in zip(_FIELDS, _power_tables(len(self.data) + 1), running):
            own = (sums[ends] - sums[starts]) % np.uint64(prime) * down[starts] % np.uint64(prime)
            joined = (joined << np.uint64(32)) | own
        return mix(joined)

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def slices(
    column: pa.Array, is_word: np.ndarray | None = NOT_BLANK, fold: np.ndarray = LOWER, size: int = SLICE_BYTES
) -> Iterator[Slice]:
    """A text column in slices of about ``size`` bytes; a null is an empty text.

    ``fold`` maps bytes first; without ``is_word`` no words are looked for.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        part = offsets[row : end + 1] - offsets[row]
        folded = data[offsets[row] : offsets[end]]
        folded = folded if fold is SAME else fold[folded]
        if is_word is None:
            nothing = np.zeros(0, dtype=np.int64)
            yield Slice(row, folded, part, nothing, nothing, np.zeros(len(part), dtype=np.int64))
            row = end
            continue
        inside = is_word[folded]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        edges = part[1:-1]  # words do not reach over the end of a text
        begins[edges[edges < len(folded)]] |= inside[edges[edges < len(folded)]]
        before = edges[edges > 0] - 1
        stops[before] |= inside[before]
        starts = np.flatnonzero(begins)
        ends = np.flatnonzero(stops) + 1
        yield Slice(row, folded, part, starts, ends, np.searchsorted(starts, part))
        row = end


_FIRST_BYTES = np.array([(1 << 8 * size) - 1 for size in range(9)], dtype=np.uint64)
_HASHED = np.uint64(0xFF << 56)
_SHORT = 64


def unit_keys(part: Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each byte range: up to seven bytes are told by it, longer ones are hashed.

    Ranges of up to ``_SHORT`` bytes are taken eight bytes at a time.
    """
    sizes = ends - starts
    padded = np.concatenate([part.data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(part.data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    found = eight[starts] & _FIRST_BYTES[np.minimum(sizes, 8)]
    found |= sizes.astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(sizes > 7)
    if len(long):
        size, at = sizes[long], starts[long]
        hashed = size.astype(np.uint64)
        for done in range(0, min(int(size.max()), _SHORT), 8):
            left = np.clip(size - done, 0, 8)
            open_ones = np.flatnonzero(left)
            taken = eight[at[open_ones] + done] & _FIRST_BYTES[left[open_ones]]
            hashed[open_ones] = mix(hashed[open_ones] * np.uint64(0x9E3779B97F4A7C15) + taken)
        huge = np.flatnonzero(size > _SHORT)
        if len(huge):
            hashed[huge] = part.hashes(part.running(), at[huge], at[huge] + size[huge])
        found[long] = hashed | _HASHED
    return found


def distinct(part: Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the different byte ranges each one is, where each of those comes first).

    Ranges are told apart by ``unit_keys``; where those are hashes, bytes are compared.
    """
    codes, keys = pd.factorize(unit_keys(part, starts, ends))
    first = np.full(len(keys), len(codes))
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    if not len(codes):
        return codes, first
    lead = first[codes]
    hashed = np.flatnonzero((keys[codes] >= _HASHED) & (lead != np.arange(len(codes))))
    sizes = (ends - starts)[hashed]
    equal = (sizes == (ends - starts)[lead[hashed]]).all()
    if equal:
        own = np.repeat(starts[hashed] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        equal = (part.data[own] == part.data[own + np.repeat(starts[lead[hashed]] - starts[hashed], sizes)]).all()
    if equal:
        return codes, first
    places: dict[bytes, int] = {}
    raw = part.data.tobytes()
    ranges = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    codes = np.array([places.setdefault(one, len(places)) for one in ranges])
    first = np.full(len(places), len(codes))
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, first


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` neighbouring words, in order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        total += mix(hashes[k : k + count] + factor) * factor
    return mix(total)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct runs of ``size`` words, sorted; of fewer words, the whole sequence as one."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(runs(hashes, min(size, len(hashes))))
