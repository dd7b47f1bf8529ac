"""Licence scans: TF-IDF cosine of headers and licence files to templates, and inheritance.

Every line of every file, and every file as a whole, is a sparse vector of its words' counts times
their inverse line frequency over the whole corpus, and is compared with the templates' vectors.
Templates are notices of a sentence and full licence texts. A header that is wrapped over lines, or
stands in a longer one, is met by windows: as many neighbouring words as a template has, wherever
lines break and whatever marks comments, compared with that template. A file whose line or window
is near a template states that licence itself. A file that is near one as a whole
is a licence file, and its licence holds for the directory it is in: files that state none take it
from the nearest ancestor directory that has one, found by joining paths.

Only units that can reach the threshold are compared in full: what a unit's words outside all
templates weigh at least must leave enough for those inside. The most frequent words' weights are
known for that everywhere, and all others weigh no less than the last of those. Of a text's windows
for one template only those that may be its nearest are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm import words
from tickflow.llm.tables import settle

THRESHOLD, FILE_THRESHOLD = 0.75, 0.6
HOLDER_WORDS, HOLDER_REST = 1.25, 8
"""A licence file has at most so many times the words of the notice it is, and a few more."""
COMMON_WORDS = 20_000
"""Most frequent words whose weights every task knows."""
WHOLE = -1
"""The number of the unit that is the whole file; lines count from 0, windows are below."""

# Common notices by SPDX identifier.
TEMPLATES: Mapping[str, Sequence[str]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction.',
    ),
    "GPL-2.0-only": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version.",
    ),
    "GPL-3.0-only": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, version 3.",
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    "LGPL-2.1-only": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",),
    "LGPL-2.1-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 "
        "of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0-or-later": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0-only": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0-only": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC0-1.0": ("Released under CC0 1.0 Universal.",),
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License v1.0 which accompanies this distribution.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "ISC": ("Licensed under the ISC License.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

# Full licence texts by SPDX identifier, without the copyright lines that differ between files.
FULL_TEXTS: Mapping[str, Sequence[str]] = {
    path.stem: (path.read_text(encoding="utf-8"),)
    for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
}


def _hashes(text: str) -> np.ndarray:
    part = next(words.slices(pa.array([text]), words.ALPHANUMERIC))
    return part.hashes(part.running())


def _lines(part: words.Slice) -> np.ndarray:
    """The line of the slice that each word is in, numbered on over its texts."""
    breaks = np.sort(np.concatenate([np.flatnonzero(part.data == 10), part.offsets[1:-1]]))
    return np.searchsorted(breaks, part.starts, side="right")


def _counted(unit: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, word, count) for every word of every unit."""
    codes, keys = pd.factorize(words.mix(unit.astype(np.uint64)) + hashes)
    first = np.zeros(len(keys), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return unit[first], hashes[first], np.bincount(codes, minlength=len(keys))


def _line_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many lines have each word; under word 0, how many lines have any."""
    for batch in batches:
        for part in words.slices(batch["text"], words.ALPHANUMERIC):
            line, hashes = _lines(part), part.hashes(part.running())
            _, word, _ = _counted(line, hashes)
            codes, keys = pd.factorize(word)
            keys = np.append(keys, np.uint64(0)).view(np.int64)
            counts = np.append(np.bincount(codes, minlength=len(keys) - 1), len(np.unique(line)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["word", "n"])


_UNITS = "row_id long, path string, unit long, word long, n long, weight double"


class _Templates:
    """The templates' vectors, a row each over all their words; of ``sizes`` words in text."""

    def __init__(self, rows: pd.DataFrame, full: Sequence[bool]):
        self.full = np.array(full)
        self.words = np.unique(rows["word"].to_numpy().view(np.uint64))
        self.vectors = np.zeros((len(full), len(self.words)))
        at = np.searchsorted(self.words, rows["word"].to_numpy().view(np.uint64))
        self.vectors[rows["number"], at] = rows["weight"]
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.sizes = np.bincount(rows["number"], rows["n"], len(full)).astype(np.int64)


def _window_squares(codes: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """The squared norm of every window of ``size`` words, as counts times weights."""
    total = len(codes)
    at = np.arange(total)
    keys = codes * (total + 1) + at
    order = np.sort(keys)
    place = np.searchsorted(order, keys)
    earlier = place - np.searchsorted(order, codes * (total + 1) + np.maximum(at - size + 1, 0))
    later = np.searchsorted(order, codes * (total + 1) + np.minimum(at + size, total)) - place - 1
    come = np.concatenate([[0.0], np.cumsum(weight**2 * (2 * earlier + 1))])
    gone = np.concatenate([[0.0], np.cumsum(weight**2 * (2 * later + 1))])
    return come[size:] - gone[: total - size + 1]


def _near_windows(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray, norm: float, size: int) -> list[int]:
    """Where a text's windows that may be nearest to a template begin, equal ones once.

    A word weighs from ``low`` to ``high``; ``own`` is the template's weight of it.
    """
    gain = np.concatenate([[0.0], np.cumsum(own * low)])
    dot = gain[size:] - gain[:-size]
    plain = np.concatenate([[0.0], np.cumsum(low**2)])
    if not (dot**2 >= (THRESHOLD * norm) ** 2 * (plain[size:] - plain[:-size]) * (1 - 1e-9)).any():
        return []
    codes, _ = pd.factorize(hashes)
    most = dot / (norm * np.sqrt(_window_squares(codes, low, size)))
    least = dot / (norm * np.sqrt(_window_squares(codes, high, size)))
    at = np.flatnonzero(most >= max(THRESHOLD, least.max()) * (1 - 1e-9))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(hashes))])
    _, first = np.unique(sums[at + size] - sums[at], return_index=True)
    return at[first].tolist()


def _near_units(weights: dict[int, float], in_notices: set[int], least: float, most: float, templates: _Templates):
    """The words of every unit that may be near a template, and of every file one row without.

    ``weights`` are of one occurrence of words in templates and of common ones; any other word
    weighs from ``least`` to ``most``.
    """
    known = np.array(sorted(weights), dtype=np.uint64)
    weight = np.array([weights[word] for word in known.tolist()])
    listed = np.array([word in in_notices for word in known.tolist()], dtype=bool)
    column = np.searchsorted(templates.words, known)
    column[~np.isin(known, templates.words)] = -1

    def look(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(known, word), len(known) - 1)
        return place, known[place] == word

    def near(counted, threshold: float, also: np.ndarray | None = None):
        unit, word, count = counted
        place, met = look(word)
        inside = met & listed[place]
        size = int(unit.max()) + 1 if len(unit) else 0
        squares = (count * np.where(met, weight[place], least)) ** 2
        own = np.bincount(unit, np.where(inside, squares, 0.0), size)
        other = np.bincount(unit, np.where(inside, 0.0, squares), size)
        likely = (own >= threshold**2 * (own + other) * (1 - 1e-9)) & (own > 0)
        if also is not None:
            likely |= also[:size]
        kept = likely[unit]
        return unit[kept], word[kept], count[kept]

    def against_templates(counted, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts that as a whole may be near a full text; texts and templates that windows may be near)."""
        text, word, count = counted
        place, met = look(word)
        squares = np.bincount(text, (count * np.where(met, weight[place], least)) ** 2, size)
        inside = met & (column[place] >= 0)
        text, at, value = text[inside], column[place][inside], (count * weight[place])[inside]
        whole, texts, numbers = np.zeros(size, dtype=bool), [], []
        for number, (vector, norm) in enumerate(zip(templates.vectors, templates.norms)):
            share = vector[at]
            # What a window can reach if it has all of the template's words that the text has.
            found = np.flatnonzero(np.bincount(text, share**2, size) >= (THRESHOLD * norm) ** 2 * (1 - 1e-9))
            texts.append(found)
            numbers.append(np.full(len(found), number))
            if templates.full[number]:
                dot = np.bincount(text, share * value, size)
                whole |= (dot > 0) & (dot**2 >= (FILE_THRESHOLD * norm) ** 2 * squares * (1 - 1e-9))
        return whole, np.concatenate(texts), np.concatenate(numbers)

    def windows(part: words.Slice, hashes: np.ndarray, texts: np.ndarray, numbers: np.ndarray):
        """(text, unit, word, count) of the windows that may be near a template."""
        order = np.argsort(texts, kind="stable")
        before = -1
        for text, number in zip(texts[order].tolist(), numbers[order].tolist()):
            begin, end = part.bounds[text : text + 2]
            size = int(templates.sizes[number])
            if end - begin <= size:
                continue
            own_hashes = hashes[begin:end]
            if text != before:
                place, met = look(own_hashes)
                low, high = np.where(met, weight[place], least), np.where(met, weight[place], most)
                at, before = np.where(met, column[place], -1), text
            own = np.where(at >= 0, templates.vectors[number][at], 0.0)
            for start in _near_windows(own_hashes, low, high, own, float(templates.norms[number]), size):
                word, count = np.unique(own_hashes[start : start + size], return_counts=True)
                unit = WHOLE - 1 - (start * len(templates.full) + number)
                yield np.full(len(word), text), np.full(len(word), unit), word, count

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in words.slices(batch["text"], words.ALPHANUMERIC):
                paths = batch["path"].slice(part.first, len(part))
                rows = next_row + np.arange(len(part))
                next_row += len(part)
                empty = pa.nulls(len(part), pa.int64())
                unknown = pa.nulls(len(part), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(rows), paths, empty, empty, empty, unknown], _names)

                def found(text, number, word, count):
                    place, met = look(word)
                    columns = (number.astype(np.int64), word.view(np.int64), count.astype(np.int64))
                    value = pa.array(count * weight[place], mask=~met)
                    return pa.RecordBatch.from_arrays(
                        [pa.array(rows[text]), paths.take(pa.array(text)), *map(pa.array, columns), value], _names
                    )

                owners, hashes, line = part.owners(), part.hashes(part.running()), _lines(part)
                if not len(hashes):
                    continue
                # Lines of a text are numbered from its first.
                before = np.searchsorted(np.flatnonzero(part.data == 10), part.offsets[:-1]) + np.arange(len(part))
                text_of_line = np.zeros(int(line.max()) + 1, dtype=np.int64)
                text_of_line[line] = owners
                unit, word, count = near(_counted(line, hashes), THRESHOLD)
                text = text_of_line[unit]
                yield found(text, unit - before[text], word, count)
                counted = _counted(owners, hashes)
                whole, texts, numbers = against_templates(counted, len(part))
                text, word, count = near(counted, FILE_THRESHOLD, whole)
                yield found(text, np.full(len(text), WHOLE), word, count)
                for window in windows(part, hashes, texts, numbers):
                    yield found(*window)

    return search


_names = ["row_id", "path", "unit", "word", "n", "weight"]


def licensed_units(
    files: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    full_texts: Mapping[str, Sequence[str]] = FULL_TEXTS,
) -> tuple[DataFrame, DataFrame]:
    """(files, matches) of settled tables: row_id and path of every row, and for every unit near
    a template row_id, path, unit, level (0: near a full text), licence (of the nearest of that
    level, the first by name among equals), score, and whether the unit is hardly more than that."""
    spark = files.sparkSession
    source = files.select("path", "text")
    counts = source.mapInArrow(_line_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = settle(counts, "frequency")
    lines = frequency.filter("word = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]

    listed, full = [], []
    for kind, group in ((False, templates), (True, full_texts)):
        for name, texts in group.items():
            for text in texts:
                word, count = np.unique(_hashes(text), return_counts=True)
                listed += [(len(full), kind, name, int(w), int(n)) for w, n in zip(word.view(np.int64), count)]
                full.append(kind)
    template_words = spark.createDataFrame(
        pd.DataFrame(listed, columns=["number", "full", "licence", "word", "n"]),
        "number int, full boolean, licence string, word long, n long",
    )

    def weighed(rows: DataFrame) -> DataFrame:
        idf = 1 + F.log((1.0 + F.lit(lines)) / (1.0 + F.coalesce(F.col("df"), F.lit(0))))
        known = frequency.select("word", F.col("n").alias("df"))
        return rows.join(known, "word", "left").withColumn("weight", F.col("n") * idf).drop("df")

    # As many rows as the templates have words.
    vectors = settle(weighed(template_words), "templates", 1)
    collected = vectors.select("number", "full", "word", "n", "weight").toPandas()
    weights = {w % 2**64: x / n for w, x, n in zip(collected["word"], collected["weight"], collected["n"])}
    in_notices = {w % 2**64 for w in collected["word"][~collected["full"]]}
    ordered = frequency.filter("word <> 0").orderBy(F.desc("n"), "word").limit(COMMON_WORDS).collect()
    idf = {row["word"] % 2**64: 1 + math.log((1 + lines) / (1 + row["n"])) for row in ordered}
    least = max(idf.values()) if len(idf) == COMMON_WORDS else 1.0
    most = 1 + math.log((1 + lines) / 2) if lines else 1.0
    search = _near_units(idf | weights, in_notices, least, max(least, most), _Templates(collected, full))
    found = settle(source.mapInArrow(search, _UNITS), "near")
    # Common words and those of templates were weighed where they were found; no word is hot among the rest.
    counted = found.filter("unit IS NOT NULL")
    rare = weighed(counted.filter("weight IS NULL").drop("weight")).select(*_names)
    units = settle(counted.filter("weight IS NOT NULL").unionByName(rare), "weighed")
    norms = units.groupBy("row_id", "path", "unit").agg(
        F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"), F.sum("n").alias("n_words")
    )
    sizes = vectors.groupBy("number").agg(
        F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"), F.sum("n").alias("template_words")
    )
    sides = vectors.join(sizes, "number").select(
        "number", "full", "licence", "template_words", F.col("word").alias("w"),
        (F.col("weight") / F.col("size")).alias("share"),
    )
    # A line is compared with notices, a whole file with all, a window with the template it is cut for.
    window_of = (F.lit(WHOLE - 1) - F.col("unit")) % len(full)
    meant = F.when(F.col("unit") < WHOLE, F.col("number") == window_of).otherwise((F.col("unit") == WHOLE) | ~F.col("full"))
    dots = units.join(F.broadcast(sides), (F.col("word") == F.col("w")) & meant).groupBy(
        "row_id", "unit", "number", "full", "licence", "template_words"
    ).agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    cosine = F.least(F.lit(1.0), F.round(F.col("dot") / F.col("norm"), 9))
    scored = dots.join(norms, ["row_id", "unit"]).withColumn("score", cosine)
    reached = F.when(F.col("unit") == WHOLE, FILE_THRESHOLD).otherwise(THRESHOLD)
    level = F.when(F.col("full"), 0).otherwise(1).alias("level")
    # A header above code is near its notice as a whole file, but is not most of the file.
    whole = F.col("full") | (F.col("n_words") <= HOLDER_WORDS * F.col("template_words") + HOLDER_REST)
    near = scored.filter(F.col("score") >= reached).groupBy("row_id", "path", "unit").agg(
        F.min(F.struct(level, (-F.col("score")).alias("minus"), "licence", (~whole).alias("header"))).alias("best")
    )
    matches = near.select(
        "row_id", "path", "unit", F.col("best.level").alias("level"), F.col("best.licence").alias("licence"),
        (-F.col("best.minus")).alias("score"), (~F.col("best.header")).alias("whole"),
    )
    return found.filter("unit IS NULL").select("row_id", "path"), settle(matches, "matches")


def _directory(path: str) -> str:
    return f"CASE WHEN {path} IS NULL THEN NULL WHEN {path} LIKE '%/%' THEN regexp_replace({path}, '/[^/]*$', '') ELSE '' END"


def license_scan(
    files: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    full_texts: Mapping[str, Sequence[str]] = FULL_TEXTS,
) -> DataFrame:
    """The licence of every file.

    ``files`` needs path (parts separated by ``/``) and text; other columns are ignored. Returns
    one row per row: path, licence (an SPDX identifier, or null), score, origin (``own``, ``inherited`` or
    ``none``) and licence_path (the file that states it). A file's own licence is that of its
    nearest line, window or of the whole file; of a directory's licence files the nearest to a
    template counts, and among equals the first by licence and path. Where a full text is met, it
    goes before all notices, as licence texts name other licences and share sentences.

    Null and empty texts state nothing but can inherit; a null path has no directory, so it neither
    gives nor takes. Repeated rows are answered each. Empty tables give no rows; without templates
    nothing has a licence.
    """
    if not any(templates.values()) and not any(full_texts.values()):
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("licence", "string"), ("score", "double"))]
        return files.select("path", *nothing, F.lit("none").alias("origin"), F.lit(None).cast("string").alias("licence_path"))
    rows, matches = licensed_units(files, templates, full_texts)
    order = F.struct("level", (-F.col("score")).alias("minus"), "licence", "unit")
    own = matches.groupBy("row_id").agg(F.min(order).alias("own"))
    holders = matches.filter((F.col("unit") == WHOLE) & F.col("whole") & F.col("path").isNotNull())
    nearest = F.min(F.struct("level", (-F.col("score")).alias("minus"), "licence", F.col("path").alias("licence_path")))
    held = settle(holders.groupBy(F.expr(_directory("path")).alias("directory")).agg(nearest.alias("held")), "held")

    stated = settle(rows.join(own, "row_id", "left"), "stated")
    lacking = stated.filter("own IS NULL AND path IS NOT NULL").select(F.expr(_directory("path")).alias("directory"))
    # Each directory once, however many files it has, with all its ancestors and itself.
    parts = F.expr("IF(directory = '', array(), split(directory, '/'))")
    above = F.transform(F.expr("sequence(0, size(parts))"), lambda depth: F.struct(
        depth.alias("depth"), F.array_join(F.slice("parts", 1, depth), "/").alias("ancestor")))
    climbed = lacking.distinct().withColumn("parts", parts).select("directory", F.inline(above))
    inherited = climbed.join(held.withColumnRenamed("directory", "ancestor"), "ancestor").groupBy("directory").agg(
        F.max_by("held", "depth").alias("inherited")
    )
    joined = stated.withColumn("directory", F.expr(f"CASE WHEN own IS NULL THEN {_directory('path')} END")).join(
        inherited, "directory", "left"
    )
    return joined.select(
        "path",
        F.coalesce("own.licence", "inherited.licence").alias("licence"),
        F.coalesce(-F.col("own.minus"), -F.col("inherited.minus")).alias("score"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("inherited.licence_path")).alias("licence_path"),
    )
