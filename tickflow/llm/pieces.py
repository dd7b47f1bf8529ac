"""The pieces of a SentencePiece BPE model and how its merges relate neighbouring pieces.

In texts as well as pieces, a blank stands where the model writes its word mark U+2581.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd

WORD_MARK = "▁"
BEGINNING, BEGINNINGS = 3, 1 << 16
"""Characters of a text, and buckets of their hash, by which ``lengths`` tells beginnings apart."""
REMEMBERED_BITS = 20
"""Of so many bits' worth of pairs of pieces a worker remembers whether they are compatible."""
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces by id, their merge ranks and the merges that make them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(size)]
        self.texts = [model.id_to_piece(i).replace(WORD_MARK, " ") for i in range(size)]
        self.byte_ids = [model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        if any(not model.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model needs byte fallback")
        self.ids = {self.texts[i]: i for i in range(size) if plain[i]}
        self.ranks = {text: -model.get_score(i) for text, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.unknown = model.unk_id()
        # The last merge that makes a piece; None for characters. A piece that merges never make
        # is no token.
        self.halves: dict[str, tuple[str, str] | None] = {}
        for text in self.ids:
            parts, last = self._merged(text)
            if len(parts) == 1:
                self.halves[text] = last
        self._number_merges()

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """A short text's tokens and the last merge, by the definition of BPE."""
        parts, last = list(text), None
        while True:
            options = [(self.ranks.get(a + b), at) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, at = min(((r, at) for r, at in options if r is not None), default=(None, 0))
            if rank is None:
                return parts, last
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def lengths(self) -> list[list[int]]:
        """The lengths that pieces have, by the bucket of their beginning, ascending.

        Shorter ones than a beginning are in every bucket.
        """
        found = [set(range(1, BEGINNING)) for _ in range(BEGINNINGS)]
        for text in self.halves:
            if len(text) >= BEGINNING:
                found[zlib.crc32(text[:BEGINNING].encode()) % BEGINNINGS].add(len(text))
        return [sorted(lengths) for lengths in found]

    def cuts(self) -> np.ndarray:
        """For every two bytes, whether a text may always be cut between them.

        It may where no piece holds the two characters side by side, since then no merge joins
        them. Only ASCII characters are told apart; after others, a text is cut before blanks.
        """
        beside = np.zeros((256, 256), dtype=bool)
        for text in self.ids:
            for left, right in zip(text, text[1:]):
                a, b = left.encode()[-1], right.encode()[0]
                beside[a, b] = True
        beside[128:, 128:] = True
        beside[:128, 128:] = True
        lasting = beside[128:].any(axis=0)
        beside[128:, :] |= lasting
        beside[128:, :128] |= np.arange(128) != 0x20
        return ~beside

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side rather than merge across them.

        Undoing the later merge of either side again and again visits every two parts that meet
        at the boundary; a merge of those happens if it ranks before the merges that took them.
        """
        x, y = self.texts[left], self.texts[right]
        took_x = took_y = float("inf")
        while True:
            rank = self.ranks.get(x + y)
            if rank is not None and rank < took_x and rank <= took_y:
                return False
            rank_x = self.ranks[x] if self.halves[x] else -1.0
            rank_y = self.ranks[y] if self.halves[y] else -1.0
            if rank_x < 0 and rank_y < 0:
                return True
            if rank_x > rank_y:
                took_x, x = rank_x, self.halves[x][1]
            else:
                took_y, y = rank_y, self.halves[y][0]

    def _number_merges(self) -> None:
        """Tables of the merges by number, which ``all_compatible`` walks along.

        The pieces come first, then characters that are halves of pieces and none themselves.
        """
        numbers = dict(zip(reversed(self.texts), reversed(range(len(self.texts))))) | self.ids
        for half in (half for pair in self.halves.values() if pair for half in pair):
            numbers.setdefault(half, len(numbers) + len(self.texts))
        self._size = max(len(self.texts), 1 + max(numbers.values()))
        self._left, self._right = np.zeros((2, self._size), dtype=np.int64)
        self._rank = np.full(self._size, -1.0)
        for text, pair in self.halves.items():
            if pair:
                number = numbers[text]
                self._left[number], self._right[number] = numbers[pair[0]], numbers[pair[1]]
                self._rank[number] = self.ranks[text]
        merges = {}
        for text, rank in self.ranks.items():
            for at in range(1, len(text)):
                if text[:at] in numbers and text[at:] in numbers:
                    merges[numbers[text[:at]] * self._size + numbers[text[at:]]] = rank
        self._merge_keys = np.array(sorted(merges), dtype=np.int64)
        self._merge_ranks = np.array([merges[key] for key in self._merge_keys.tolist()])
        # A pair and its answer share one number, at the place of the pair's hash.
        self._answered = np.full(1 << REMEMBERED_BITS, -1, dtype=np.int64)

    def all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` of pairs of pieces, step by step for all that are still undecided."""
        good, open_ones = np.ones(len(left), dtype=bool), np.arange(len(left))
        took_left, took_right = np.full((2, len(left)), np.inf)
        while len(open_ones) and len(self._merge_keys):
            keys = left * self._size + right
            place = np.minimum(np.searchsorted(self._merge_keys, keys), len(self._merge_keys) - 1)
            rank = np.where(self._merge_keys[place] == keys, self._merge_ranks[place], np.inf)
            merged = (rank < took_left) & (rank <= took_right)
            good[open_ones[merged]] = False
            rank_left, rank_right = self._rank[left], self._rank[right]
            go_left = rank_left > rank_right
            took_left = np.where(go_left, rank_left, took_left)
            took_right = np.where(go_left, took_right, rank_right)
            left = np.where(go_left, self._right[left], left)
            right = np.where(go_left, right, self._left[right])
            going = ~merged & ((rank_left >= 0) | (rank_right >= 0))
            open_ones, left, right = open_ones[going], left[going], right[going]
            took_left, took_right = took_left[going], took_right[going]
        return good

    def beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``all_compatible``, worked out only for pairs that are not remembered."""
        keys = left * self._size + right
        held = self._answered[_places(keys)]
        good, new = (held & 1).astype(bool), np.flatnonzero(held >> 1 != keys)
        if len(new):
            codes, asked = pd.factorize(keys[new])
            answers = self.all_compatible(*np.divmod(asked, self._size))
            good[new] = answers[codes]
            self._answered[_places(asked)] = asked * 2 + answers
        return good


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - REMEMBERED_BITS)).astype(np.int64)


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)
