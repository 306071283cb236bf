"""The licence scan against brute force: every window of every text, every ancestor of every path."""

import math
import re
from collections import Counter

import pytest

from tidemark.llm import license_scan


def words_of(text):
    return [w for w in (x.strip(".-") for x in re.split(r"[^a-z0-9.\-]+", (text or "").lower())) if w]


TEMPLATES = [(name, words_of(line)) for name, line in license_scan.TEMPLATES]
DOCUMENT_COUNT = Counter(w for _, words in TEMPLATES for w in set(words))
RARITY = {w: math.log((1 + len(TEMPLATES)) / (1 + n)) + 1 for w, n in DOCUMENT_COUNT.items()}


def weights(words):
    return {w: n * RARITY[w] for w, n in Counter(words).items() if w in RARITY}


def own_licence(text):
    """(licence, cosine) of the best window around any anchor, or None."""
    words, found = words_of(text), []
    reach = max(len(t) for _, t in TEMPLATES) - 1
    for i, word in enumerate(words):
        if not re.search(license_scan.ANCHOR_TERM, word):
            continue
        near = words[max(0, i - reach) : i + reach + 1]
        for name, template in TEMPLATES:
            goal, size = weights(template), len(template)
            for at in range(max(1, len(near) - size + 1)):
                own = weights(near[at : at + size])
                met = own.keys() & goal.keys()
                if len(met) * 2 <= len(set(template)) or sum(w in RARITY for w in near[at : at + size]) < 2:
                    continue
                dot = sum(own[w] * goal[w] for w in met)
                found.append((dot / math.hypot(*own.values()) / math.hypot(*goal.values()), name))
    found = [(-round(cosine, 9), name) for cosine, name in found if round(cosine, 9) >= license_scan.MIN_COSINE]
    return (min(found)[1], -min(found)[0]) if found else None


def scanned(files):
    """path -> (own licence, its cosine, licence, directory it is inherited from), for unique paths."""
    own = {path: own_licence(text) for path, text in files.items()}
    folders = {}
    for path, found in own.items():
        if found and re.search(license_scan.LICENCE_FILE, path):
            folder = "/".join(path.split("/")[:-1])
            folders[folder] = min(folders.get(folder, (0, "")), (-found[1], found[0]))
    results = {}
    for path, found in own.items():
        if found:
            results[path] = (*found, found[0], None)
            continue
        folder = path.split("/")[:-1]
        above = ["/".join(folder[:k]) for k in range(len(folder), -1, -1)]
        nearest = next((f for f in above if f in folders), None)
        results[path] = (None, None, folders[nearest][1] if nearest is not None else None, nearest)
    return results


def compared(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        licence, cosine, inherited, folder = expected[r.path]
        assert (r.own_licence, r.licence, r.licence_dir) == (licence, inherited, folder), r.path
        assert r.own_cosine == (None if cosine is None else pytest.approx(cosine, abs=1e-8)), r.path


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = license_scan.op3_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    expected = scanned({r.path: texts[r.doc_id] for r in rows})
    assert sum(1 for licence, *_ in expected.values() if licence) > 5
    compared(rows, expected)


FILES = {
    "LICENSE": "Released under the MIT License",
    "a/x.py": "no statement here",
    "a/b/LICENSE.txt": "SPDX-License-Identifier: Apache-2.0",
    "a/b/NOTICE": "All rights reserved",
    "a/b/c/d/y.py": "import os",
    "a/b/c/z.c": "/* Copyright 2020 Acme Inc.\n * Licensed under the Apache License,\n * Version 2.0 (the License) */ int x;",
    "e/driving.txt": "The driving license of a person is not under the copyright of the state.",
    "e/f/COPYING": "GNU General Public License, version 3. This work is licensed under the GNU General Public License, version 2",
    "e/f/g.h": "licensed",
    "e/f/h.h": "",
    "e/f/i.h": None,
    "top.md": "word " * 30_000 + "This file is subject to the terms of the Mozilla Public License, version 2.0 " + "word " * 30_000,
}


def test_files_by_hand(spark):
    files = spark.createDataFrame(list(FILES.items()), "path string, text string")
    expected = scanned(FILES)
    assert expected["a/x.py"] == (None, None, "MIT", "") and expected["top.md"][0] == "MPL-2.0"
    compared(license_scan.license_scan(files).collect(), expected)


def test_recall_and_precision_of_headers(spark):
    """Every template in its usual surroundings is found and named; prose about licences is left alone."""
    frames = (
        "{}",
        "# Copyright 2021 The Authors.\n# {}.\nimport os\n",
        "/*\n * {}\n * You may obtain a copy at the address below.\n */",
        "Readme of a project. {}; see the file LICENSE for details.",
    )
    made = {f"{n}/{k}": (name, frame.format(line)) for n, (name, line) in enumerate(license_scan.TEMPLATES) for k, frame in enumerate(frames)}
    prose = (
        "She renewed her fishing license in the spring and paid the clerk.",
        "Copyright law protects authors in many countries of the world.",
        "Without permission nobody entered the old mill by the river.",
        "The redistribution of land was the great question of the century.",
    )
    rows = [(path, text) for path, (_, text) in made.items()] + [(f"prose/{n}", text) for n, text in enumerate(prose)]
    found = {r.path: r.own_licence for r in license_scan.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    right = sum(found[path] == name for path, (name, _) in made.items())
    assert right >= 0.95 * len(made)
    assert all(found[f"prose/{n}"] is None for n in range(len(prose)))
