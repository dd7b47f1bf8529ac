"""Quality rules: a decision list learned from labelled text statistics.

Statistics of whole texts are counted in one pass. Rules are learned by sequential covering on a
bounded sample of labelled rows: each rule is a conjunction of thresholds, grown on two thirds of
the sample by information gain, pruned from its end on the other third, and kept only if it is
precise there; what it covers is taken away before the next one. The list becomes one ordered
Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm import words
from tickflow.llm.tables import free_names, least_hashed, parts, settle, small
from tickflow.llm.workers import lean

SAMPLE_ROWS = 20_000
"""Labelled rows that rules are learned from at most; the rows of least hash are taken."""
MIN_WORDS, REPEAT_PERCENT, REPEAT_WORDS = 10, 20, 5
MIN_PRECISION, MIN_COVERED, MAX_RULES, MAX_CONDITIONS = 0.9, 8, 16, 4
MIN_RATIO = 1e-9
_ROWS_BACK = 1_000
_LABELS_PER_PART = 250_000

_COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_marks",
    "n_lines",
    "n_distinct_words",
    "n_echoes",
)
FEATURES = {
    "n_words": "cast(n_words AS double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "echo_share": "n_echoes / greatest(n_words, 1)",
}


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_SYMBOLS, _MARKS = _flags(b"#*$%&|<>"), _flags(b"!?")
_UPPER = _flags(bytes(range(65, 91)))


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(keys: np.ndarray, owners: np.ndarray, size: int) -> np.ndarray:
    """Distinct keys per text."""
    _, first = np.unique(words.mix(owners.astype(np.uint64)) ^ keys, return_index=True)
    return np.bincount(owners[first], minlength=size)


def _statistics(part: words.Slice) -> np.ndarray:
    """The counts of every text of a slice, one column per name in ``_COUNTS``."""
    size, data, running, owners = len(part), part.data, part.running(), part.owners()
    inside = words.NOT_BLANK[data]
    hashes = part.hashes(running)

    repeated = np.zeros(len(hashes) + 1, dtype=np.int64)
    runs = words.runs(hashes, REPEAT_WORDS)
    at = np.flatnonzero(owners[: len(runs)] == owners[REPEAT_WORDS - 1 :]) if len(runs) else np.zeros(0, np.int64)
    if len(at):
        keys = words.mix(owners[at].astype(np.uint64)) ^ runs[at]
        _, which, found = np.unique(keys, return_inverse=True, return_counts=True)
        again = at[found[which] > 1]
        repeated[again] += 1
        np.subtract.at(repeated, again + REPEAT_WORDS, 1)
    in_repeat = np.cumsum(repeated)[:-1] > 0

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([part.offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([breaks, part.offsets[1:]]))
    # A word starts in every line that counts, so its position tells the line.
    word_before = np.searchsorted(part.starts, line_starts)
    filled = word_before < np.searchsorted(part.starts, line_ends)
    line_owner = owners[word_before[filled]]
    line_hash = part.hashes(running, line_starts[filled], line_ends[filled])
    lines = np.bincount(line_owner, minlength=size)

    echoes = np.zeros(len(hashes), dtype=bool)
    echoes[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    letters = inside & ((data & 0xC0) != 0x80)
    return np.stack(
        [
            part.counts(),
            _per_text(letters, part.offsets),
            _per_text(_SYMBOLS[data], part.offsets),
            lines - _distinct(line_hash, line_owner, size),
            _per_text(in_repeat, part.bounds),
            _per_text(_UPPER[data], part.offsets),
            _per_text(_MARKS[data], part.offsets),
            lines,
            _distinct(hashes, owners, size),
            _per_text(echoes, part.bounds),
        ],
        axis=1,
    ).astype(np.int64)


@lean
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column, and the counts of the text in the second or, without one, in the first."""
    for whole in batches:
        # Some rows at a time, so that what goes back is not held twice as a whole.
        for first in range(0, len(whole), _ROWS_BACK):
            batch = whole.slice(first, _ROWS_BACK)
            text = batch[1] if batch.num_columns > 1 else pc.struct_field(batch[0], "text")
            table = np.concatenate([_statistics(part) for part in words.slices(text, fold=words.SAME)])
            yield pa.RecordBatch.from_arrays(
                [batch[0], *(pa.array(column) for column in table.T)], [batch.schema.names[0], *_COUNTS]
            )


def statistics(docs: DataFrame, carried: Column, whole_rows: bool = False) -> DataFrame:
    """A carried column and the counts of every whole text; a null text has no words.

    With ``whole_rows`` the carried column is a structure that holds the text itself.
    """
    rows = docs.select(carried, *([] if whole_rows else [F.col("text").alias("counted")]))
    counts = [T.StructField(name, T.LongType()) for name in _COUNTS]
    return rows.mapInArrow(_measure, T.StructType([rows.schema[0], *counts]))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated five-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        value = table[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    covered = np.ones(len(next(iter(table.values()))), dtype=bool)
    for condition in rule:
        covered &= condition.holds(table)
    return covered


def _best_condition(table: dict, bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of most gain: bad rows it keeps times the bits it adds to their purity."""
    p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
    if not p0 or not n0:
        return 0.0, None
    before, best = np.log2(p0 / (p0 + n0)), (0.0, None)
    for feature, values in table.items():
        order = np.argsort(values[inside], kind="stable")
        value, label = values[inside][order], bad[inside][order]
        cuts = np.flatnonzero(np.diff(value) > 0)
        if not len(cuts):
            continue
        p_low, n_low = np.cumsum(label)[cuts], np.cumsum(~label)[cuts]
        for above in (False, True):
            p, n = (p0 - p_low, n0 - n_low) if above else (p_low, n_low)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            top = int(np.argmax(gain))
            if gain[top] > best[0] + MIN_RATIO:
                middle = float((value[cuts[top]] + value[cuts[top] + 1]) / 2)
                best = float(gain[top]), Condition(feature, above, middle)
    return best


def _worth(rule: Rule, table: dict, bad: np.ndarray) -> tuple[float, int]:
    """Precision on some rows, counting one more row on either side, and how many it covers."""
    covered = _covers(rule, table)
    p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
    return (p + 1) / (p + n + 2), p + n


def learn(table: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """An ordered list of rules that cover bad rows; empty if there are none to learn from."""
    rules: list[Rule] = []
    third = np.random.default_rng(seed).integers(0, 3, len(bad)) == 0
    grow = {name: values[~third] for name, values in table.items()}
    prune = {name: values[third] for name, values in table.items()}
    grow_bad, prune_bad = bad[~third], bad[third]
    while len(rules) < MAX_RULES and grow_bad.any():
        rule: Rule = ()
        inside = np.ones(len(grow_bad), dtype=bool)
        while len(rule) < MAX_CONDITIONS:
            _, condition = _best_condition(grow, grow_bad, inside)
            if condition is None:
                break
            rule += (condition,)
            inside = _covers(rule, grow)
        if not rule:
            break
        shorter = [rule[:length] for length in range(1, len(rule) + 1)]
        rule = max(shorter, key=lambda r: (round(_worth(r, prune, prune_bad)[0], 3), -len(r)))
        precision, covered = _worth(rule, prune, prune_bad)
        if precision < MIN_PRECISION or covered < MIN_COVERED:
            break
        rules.append(rule)
        for part in (grow, prune):
            left = ~_covers(rule, part)
            if part is grow:
                grow_bad = grow_bad[left]
            else:
                prune_bad = prune_bad[left]
            for name in part:
                part[name] = part[name][left]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False where the first rule that holds rejects, true where none does."""
    if not rules:
        return F.lit(True)
    chain = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column()
        chain = F.when(holds, False) if chain is None else chain.when(holds, False)
    return chain.otherwise(True)


def learned_rules(measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from the labelled rows (``quality`` 0 is bad) that the base does not reject anyway.

    At most ``sample_rows`` of them are used, those whose hashed doc_id is least.
    """
    known = labels.filter("quality IS NOT NULL").select(F.col("doc_id").cast("long"), "quality")
    rows = measured.filter(~base_failed()).join(known, "doc_id")
    rows = rows.select("doc_id", "quality", *(F.expr(sql).alias(name) for name, sql in FEATURES.items()))
    sample = least_hashed(rows, sample_rows).toPandas().sort_values(["doc_id", "quality", *FEATURES])
    table = {name: sample[name].to_numpy(dtype=float) for name in FEATURES}
    return learn(table, sample["quality"].to_numpy() == 0)


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A verdict on every document.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns are ignored.
    Returns one row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the further counts that rules may use.

    Null and empty texts have no words and fail the base, as all texts under ten words do. Repeated
    rows are judged alike, whatever their doc_id, null included. Rows without a label teach
    nothing; of conflicting labels each counts as a row. Without labels of both kinds there are no
    rules and the base decides alone. No documents give no rows.
    """
    measured = settle(statistics(docs, F.col("doc_id").cast("long")), "statistics")
    rules = learned_rules(measured, labels, sample_rows)
    return measured.withColumns(
        {"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)}
    ).select(*("doc_id", *_COUNTS[:5], "base_failed", "kept", *_COUNTS[5:]))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``quality_rules`` keeps.

    Judged row by row, without a join; only labelled documents are counted twice, all of them, as
    the sample is drawn after the base's rejects are known.
    """
    (name,) = free_names(docs, "known")
    known = labels.filter("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias(name))
    known = small(settle(known.distinct(), "known", parts(labels.count(), _LABELS_PER_PART)))
    taught = docs.join(known, F.col("doc_id").cast("long") == F.col(name), "left_semi")
    measured = settle(statistics(taught, F.col("doc_id").cast("long")), "statistics")
    rules = learned_rules(measured, labels, sample_rows)
    judged = statistics(docs, F.struct(*(F.col(name) for name in docs.columns)).alias("row"), whole_rows=True)
    return judged.filter(~base_failed() & verdict(rules)).select("row.*")
