"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Each block is described by the tags around it, the words of their class, id and role names, and
by what its text is like; the chain's two states are main text and the rest. Weights are trained
in numpy on labelled pages by the gradient of the conditional likelihood, and pages are decoded by
Viterbi, so that a doubtful block follows its neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.html_blocks import Around, Block, blocks
from tickflow.llm.page_samples import labelled_pages

FEATURES = 1 << 13
STEPS, RATE, DECAY = 150, 0.1, 2e-3
_END_MARKS = tuple('.!?:;"”»…')


@lru_cache(maxsize=1 << 16)
def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


def _own(block: Block) -> list[int]:
    """The numbers of the features of a block's text and innermost tag."""
    words = block.text.count(" ") + 1
    names = ["any", f"tag {block.around.tag}", f"words {min(words.bit_length(), 7)}"]
    names.append(f"linked {round(block.linked * 4)}")
    names.append(f"ends {block.text.endswith(_END_MARKS)}")
    names += ["copyright"] * ("©" in block.text)
    return [_number(name) for name in names]


def _added(element: Around) -> list[int]:
    """The numbers of the features that an element adds to those of the elements around it."""
    names = [f"in {element.tag}"] * element.new_tag + [f"named {name}" for name in element.names]
    return [_number(name) for name in names]


def features(found: Sequence[Block]) -> list[list[int]]:
    """The numbers of each block's features."""
    described = []
    for block in found:
        numbers, element = _own(block), block.around
        while element.parent is not None:
            numbers += _added(element)
            element = element.parent
        described.append(numbers)
    return described


@dataclass(frozen=True)
class Chain:
    """Weights of main text against the rest by feature, and of neighbouring states."""

    weights: np.ndarray
    moves: np.ndarray

    def scores(self, found: Sequence[Block]) -> list[float]:
        """What speaks for main text in each block; every element around blocks is weighed once."""
        weighed: dict[int, float] = {}

        def weight(numbers: list[int]) -> float:
            return float(self.weights[numbers].sum()) if numbers else 0.0

        def around(element: Around) -> float:
            path = []
            while element.parent is not None and id(element) not in weighed:
                path.append(element)
                element = element.parent
            total = weighed.get(id(element), 0.0)
            for inner in reversed(path):
                total = weighed[id(inner)] = total + weight(_added(inner))
            return total

        return [weight(_own(block)) + around(block.around) for block in found]

    def decode(self, found: Sequence[Block]) -> list[bool]:
        """The likeliest states of a page's blocks, all at once."""
        if not found:
            return []
        scores = self.scores(found)
        (rest_rest, rest_main), (main_rest, main_main) = self.moves.tolist()
        rest, main, back = 0.0, scores[0], []
        for score in scores[1:]:
            to_rest = (main + main_rest, True) if main + main_rest > rest + rest_rest else (rest + rest_rest, False)
            to_main = (main + main_main, True) if main + main_main > rest + rest_main else (rest + rest_main, False)
            back.append((to_rest[1], to_main[1]))
            rest, main = to_rest[0], to_main[0] + score
        state = main > rest
        states = [state]
        for choice in reversed(back):
            state = choice[state]
            states.append(state)
        return states[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks(page or "")
        return "\n".join(block.text for block, chosen in zip(found, self.decode(found)) if chosen)


def train(pages: Sequence[str]) -> Chain:
    """Fit a chain to pages whose main text is marked; see ``html_blocks.blocks``.

    All pages are run side by side, step by step through their blocks.
    """
    parsed = [found for found in map(blocks, pages) if found]
    if not parsed:
        raise ValueError("no labelled page has any text")
    length = max(map(len, parsed))
    real = np.array([[k < len(found) for k in range(length)] for found in parsed])
    truth = np.array([[k < len(f) and f[k].marked for k in range(length)] for f in parsed]).astype(int)
    page_of, step_of, number = [], [], []
    for page, found in enumerate(parsed):
        for step, numbers in enumerate(features(found)):
            page_of += [page] * len(numbers)
            step_of += [step] * len(numbers)
            number += numbers
    cell = np.array(page_of) * length + np.array(step_of)
    number = np.array(number)
    both = real[:, 1:] & real[:, :-1]

    theta = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, STEPS + 1):
        moves = theta[FEATURES:].reshape(2, 2)
        main = np.bincount(cell, theta[number], real.size).reshape(real.shape)
        scores = np.stack([np.zeros_like(main), main], axis=2)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for k in range(1, length):
            step = np.logaddexp.reduce(ahead[:, k - 1, :, None] + moves, axis=1) + scores[:, k]
            ahead[:, k] = np.where(real[:, k, None], step, ahead[:, k - 1])
        for k in range(length - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (scores[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
            behind[:, k] = np.where(real[:, k + 1, None], step, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        chance = np.exp(ahead + behind - total[:, None, None])
        pair = ahead[:, :-1, :, None] + moves + (scores + behind)[:, 1:, None, :] - total[:, None, None, None]
        pair = np.exp(np.where(both[:, :, None, None], pair, -np.inf))
        slope = DECAY * theta
        wrong = np.where(real, chance[:, :, 1] - truth, 0.0) / len(parsed)
        slope[:FEATURES] += np.bincount(number, wrong.ravel()[cell], FEATURES)
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[:, :-1][both], truth[:, 1:][both]), 1)
        slope[FEATURES:] += ((pair.sum((0, 1)) - seen) / len(parsed)).ravel()
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= RATE * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return Chain(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def _extractor(chain: Chain):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [chain.main_text(page.as_py()) for page in batch["html"]]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    return extract


def extract_main_text(pages: DataFrame, labelled: Sequence[str] | None = None) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (its code points).

    Takes page_id, url and html; other columns are ignored. ``labelled`` pages train the chain,
    by default the composed ones of ``page_samples``; their number is bounded by the caller.
    Text has one line per block, white space collapsed and character references decoded; it is
    empty for null, empty and textless pages. Nothing is cut, however long a page is, and
    repeated rows, null ids and null urls pass through. No rows give no rows.
    """
    chain = train(labelled_pages() if labelled is None else labelled)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    found = rows.mapInArrow(_extractor(chain), "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
