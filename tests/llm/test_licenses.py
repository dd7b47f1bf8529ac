import math
import re
import textwrap
from collections import Counter

import numpy as np

from tickflow.llm.licenses import FILE_THRESHOLD, FULL_TEXTS, TEMPLATES, THRESHOLD, _window_squares, license_scan

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(files):
    """Every unit against every template, then every directory from the file upwards."""
    lines = [Counter(words_of(line)) for _, text in files for line in (text or "").split("\n")]
    lines = [line for line in lines if line]
    frequency = Counter(word for line in lines for word in line)

    def vector(counts):
        return {w: n * (1 + math.log((1 + len(lines)) / (1 + frequency[w]))) for w, n in counts.items()}

    def cosine(a, b):
        dot = sum(v * b.get(w, 0) for w, v in a.items())
        return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())) if dot else 0.0

    listed = [(name, vector(Counter(words_of(text)))) for name, texts in TEMPLATES.items() for text in texts]

    def best(text, threshold):
        own = vector(Counter(words_of(text)))
        score, name = min((-round(cosine(own, other), 9), name) for name, other in listed)
        return (score, name) if -score >= threshold else None

    stated, held = [], {}
    for path, text in files:
        whole = best(text, FILE_THRESHOLD) if text else None
        found = [x for x in [whole, *(best(line, THRESHOLD) for line in (text or "").split("\n"))] if x]
        stated.append(min(found) if found else None)
        if whole and path is not None:
            directory = path.rpartition("/")[0]
            held[directory] = min(held.get(directory, (0, "", "")), (*whole, path))
    answers = []
    for (path, _), own in zip(files, stated):
        if own:
            answers.append((path, own[1], -own[0], "own", path))
            continue
        directory = path.rpartition("/")[0] if path is not None else None
        while directory is not None and directory not in held:
            directory = directory.rpartition("/")[0] if directory else None
        if directory is None:
            answers.append((path, None, None, "none", None))
        else:
            score, name, where = held[directory]
            answers.append((path, name, -score, "inherited", where))
    return answers


FILES = [
    ("LICENSE", "Released under the MIT License."), ("main.c", "int main"), ("a/x.c", "code of x"), ("a/b/c/y.c", None),
    ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3.\nthanks"),
    ("a/b/z.c", "# Licensed under CC BY-NC 4.0.\nint z\nint zz int zzz int q"), ("a/b/c/w.c", ""),
    ("d/LICENSE", "Licensed under the Apache License, Version 2.0."), ("d/COPYING", "Licensed under the apache license version 2"),
    ("d/e/f/g", "the work is of the public domain and the version is general"), ("d/e/f/g", "the work is of the public domain and the version is general"),
    (None, "some text"), (None, "Licensed under CC BY 4.0."), ("", "text"), ("/root.c", "text"), ("dd/e", "text " * 30_000),
]


def shown(rows):
    return sorted(((*r[:2], None if r[2] is None else round(r[2], 6), *r[3:]) for r in rows), key=repr)


def test_equals_brute_force(spark):
    frame = spark.createDataFrame([(*row, 1, "x") for row in FILES], "path string, text string, unit int, licence string")
    got = shown(tuple(r) for r in license_scan(frame.repartition(4)).collect())
    assert got == shown(brute(FILES))
    assert {r[3] for r in got} == {"own", "inherited", "none"}


def test_empty_tables(spark):
    frame = spark.createDataFrame(FILES, "path string, text string")
    assert license_scan(frame.limit(0)).count() == 0
    assert {r.origin for r in license_scan(frame, {}).collect()} == {"none"}
    assert {r.origin for r in license_scan(frame.filter("text IS NULL OR text = ''")).collect()} == {"none"}


CODE = "\n".join(f"int value_{k} = other_{k % 7} + {k};" for k in range(60))
APACHE = """# Copyright 2020 The Authors. All Rights Reserved.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
LATER = """/*
 * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 */
"""
MOZILLA = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
"""
ECLIPSE = """// This program and the accompanying materials are made
// available under the terms of the Eclipse Public License 2.0
// which is available at https://www.eclipse.org/legal/epl-2.0/
"""


def commented(name):
    lines = textwrap.wrap(" ".join(FULL_TEXTS[name][0].split()), 66)
    return "/*-\n * Copyright (c) 1998 Some Body\n" + "".join(f" * {line}\n" for line in lines) + " */\n"


def test_wrapped_headers(spark):
    headers = {
        "Apache-2.0": APACHE, "GPL-2.0-or-later": LATER, "MPL-2.0": MOZILLA, "EPL-2.0": ECLIPSE,
        **{name: commented(name) for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense")},
    }
    files = [(f"src/{name}.c", header + CODE) for name, header in headers.items()]
    files += [("plain.c", CODE), ("src/far.c", CODE + "\n" + APACHE + CODE)]
    found = {r.path: (r.licence, r.origin) for r in license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    expected = {f"src/{name}.c": (name, "own") for name in headers}
    assert found == {**expected, "plain.c": (None, "none"), "src/far.c": ("Apache-2.0", "own")}


def test_licence_files(spark):
    """Full texts under a copyright line, wrapped anew, hold for their directories."""
    files = []
    for name, (text,) in FULL_TEXTS.items():
        text = "Copyright (c) 2019-2024 Jane Doe and others\n\n" + textwrap.fill(" ".join(text.split()), 100)
        files += [(f"{name}/LICENSE", text), (f"{name}/src/main.c", CODE)]
    regents = FULL_TEXTS["BSD-3-Clause"][0].replace("copyright holder", "University").replace("COPYRIGHT HOLDERS", "REGENTS")
    files += [("r/COPYING", "Copyright (c) The Regents of the University of California.\n" + regents), ("r/x.c", CODE)]
    found = {r.path: (r.licence, r.origin) for r in license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    expected = {f"{name}/LICENSE": (name, "own") for name in FULL_TEXTS}
    expected |= {f"{name}/src/main.c": (name, "inherited") for name in FULL_TEXTS}
    assert found == {**expected, "r/COPYING": ("BSD-3-Clause", "own"), "r/x.c": ("BSD-3-Clause", "inherited")}


def test_window_norms():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 5, 40)
    weight = rng.random(5)[codes]
    for size in (1, 3, 17, 39):
        exact = [sum((n * weight[codes == c][0]) ** 2 for c, n in Counter(codes[k : k + size].tolist()).items()) for k in range(41 - size)]
        assert np.allclose(_window_squares(codes, weight, size), exact)


def test_a_header_above_code_makes_no_licence_file(spark):
    header = "\n".join(f"# {line}" for line in (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file',
        "except in compliance with the License.",
    ))
    code = "\n".join(f"value_{k} = compute_{k}(first, second)" for k in range(6))
    rows = [
        ("a/main.py", f"{header}\n{code}"), ("a/other.py", "print(1)"),
        ("b/NOTICE", "Copyright 2020 Someone\nReleased under the MIT License."), ("b/x.py", "print(2)"),
    ]
    found = {r.path: (r.licence, r.origin) for r in license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["a/main.py"] == ("Apache-2.0", "own") and found["a/other.py"] == (None, "none")
    assert found["b/NOTICE"] == ("MIT", "own") and found["b/x.py"] == ("MIT", "inherited")
