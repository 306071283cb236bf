"""License scan: TF-IDF cosine of licence statements to templates, then inheritance by directory.

Statements may stand anywhere in a file's text: around each anchor term, which every template has one of, windows as
long as a template slide over the terms, across line ends. Terms are weighted by their frequency in the window and
their rarity among the templates; a term that no template has weighs nothing, but a window must hold more than half
of a template's terms. The templates are the sentences that grant a licence; whole licence texts are found by these.

A file's own licence is the template with the highest cosine over its windows, from
``MIN_COSINE`` up. A file without one inherits from the licence file in its own or the nearest
ancestor directory: directories are expanded to their ancestors once each, not once a file, and
joined with the directories that hold a licence file.

Terms outside the templates are one mark, and equal surroundings are scored once, whatever their count. Hot directories are joined after all licences of
a directory have become one row.

Defined cases: NULL and empty texts have no licence of their own. A NULL path has no directory and
inherits nothing. Ties go to the smaller licence name. Several licence files in a directory: the
highest cosine, then the smaller name. Rows that share path and text share their result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as t

MIN_COSINE = 0.6
ANCHOR = r"(?i)licen[cs]|copyright|spdx|rights reserved|permission is hereby|redistribution"
ANCHOR_TERM = r"licen[cs]|copyright|spdx|reserved|permission|redistribution"
OTHER = "_"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
# Statements by which the licences are granted.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Licensed under CC0 1.0, no rights reserved"),
    ("Proprietary", "All rights reserved"),
)


def _terms(line: Column) -> Column:
    folded = F.array_remove(F.split(F.lower(line), r"[^a-z0-9.\-]+"), "")
    return F.array_remove(F.transform(folded, lambda w: F.regexp_replace(w, r"^[.\-]+|[.\-]+$", "")), "")


def _frequencies(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.select(*keys, F.explode(_terms(F.col("line"))).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def template_vectors(spark, templates=TEMPLATES) -> tuple[DataFrame, DataFrame, float]:
    """Term weights of unit length for each template, the rarity of each term, and that of an unknown one.

    As many rows as the templates have words: a constant of the program.
    """
    rows = [(n, name, line) for n, (name, line) in enumerate(templates)]
    terms = _frequencies(spark.createDataFrame(rows, "no int, licence string, line string"), "no", "licence")
    total = len(templates)
    rarity = terms.groupBy("term").agg((F.log((1 + total) / (1 + F.count("*"))) + 1).alias("rarity"))
    weighed = terms.join(rarity, "term").withColumn("weight", F.col("tf") * F.col("rarity"))
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("no")))
    unit = weighed.select("no", "licence", "term", (F.col("weight") / length).alias("unit"))
    from math import log

    return unit, rarity, log(1 + total) + 1


def _lengths(templates) -> list[int]:
    return sorted({len(_plain_terms(line)) for _, line in templates})


def _plain_terms(line: str) -> list[str]:
    return [w for w in (x.strip(".-") for x in re.split(r"[^a-z0-9.\-]+", line.lower())) if w]


def surroundings(text: Column, templates=TEMPLATES) -> Column:
    """What stands around each anchor term, as far as a window reaches: terms of the templates, others as one mark."""
    reach = _lengths(templates)[-1] - 1
    known = sorted({w for _, line in templates for w in _plain_terms(line)})

    def around(terms: Column) -> Column:
        anchors = F.filter(F.transform(terms, lambda w, i: F.when(w.rlike(ANCHOR_TERM), i)), lambda i: i.isNotNull())

        def context(i: Column) -> Column:
            first = F.greatest(i - reach, F.lit(0))
            near = F.slice(terms, first + 1, i - first + 1 + reach)
            return F.array_join(F.transform(near, lambda w: F.when(w.isin(known), w).otherwise(OTHER)), " ")

        return F.array_distinct(F.transform(anchors, context))

    return t.let(_terms(text), around)


def score_surroundings(found: DataFrame, templates=TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(context, licence, cosine) of the distinct ``context`` values with a window that is a licence statement."""
    unit, rarity, _ = template_vectors(found.sparkSession, templates)
    longest = F.expr("int(sum(tf) OVER (PARTITION BY no))")
    sizes = _frequencies(found.sparkSession.createDataFrame([(n, line) for n, (_, line) in enumerate(templates)], "no int, line string"), "no")
    sizes = sizes.select("no", longest.alias("length"), F.count("*").over(Window.partitionBy("no")).alias("n_terms")).distinct()
    unit = unit.join(F.broadcast(sizes), "no")
    contexts = found.select("context").distinct().withColumn("terms", F.split("context", " "))
    each = contexts.withColumn("length", F.explode(F.array(*[F.lit(n) for n in _lengths(templates)])))
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - F.col("length") + 1, F.lit(1)))
    each = each.withColumn("at", F.explode(starts))
    window = F.array_sort(F.filter(F.slice("terms", F.col("at"), F.col("length")), lambda w: w != OTHER))
    windows = t.materialise(each.select("context", "length", F.array_join(window, " ").alias("window")).filter("window LIKE '% %'").distinct())
    own = ["window", "length"]
    terms = windows.select(*own).distinct().withColumn("term", F.explode(F.split("window", " "))).groupBy(*own, "term").agg(F.count("*").alias("tf"))
    weighed = terms.join(F.broadcast(rarity), "term").withColumn("weight", F.col("tf") * F.col("rarity"))
    norms = weighed.groupBy(*own).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = (
        weighed.join(F.broadcast(unit), ["term", "length"])
        .groupBy(*own, "no", "licence", "n_terms")
        .agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"), F.count("*").alias("met"))
        .filter(F.col("met") * 2 > F.col("n_terms"))
    )
    scored = dots.join(norms, own).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
    best = F.min(F.struct((-F.col("cosine")).alias("less"), "licence"))
    stated = scored.filter(F.col("cosine") >= min_cosine).groupBy(*own).agg(best.alias("stated"))
    met = windows.join(stated, own).groupBy("context").agg(F.min("stated").alias("best"))
    return met.select("context", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("cosine"))


def own_licences(files: DataFrame, text: str = "text", path: str = "path", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(_td_id, _td_hash, licence, cosine) of the files with a licence statement; the id is the path."""
    anchored = files.filter(F.col(text).rlike(f"(?i){ANCHOR_TERM}"))
    stated = t.materialise(anchored.select(*t.row_key(text, path), F.explode(surroundings(F.col(text))).alias("context")))
    scored = score_surroundings(stated, min_cosine=min_cosine)
    best = F.min(F.struct((-F.col("cosine")).alias("less"), "licence"))
    return (
        stated.join(scored, "context")
        .groupBy("_td_id", "_td_hash")
        .agg(best.alias("best"))
        .select("_td_id", "_td_hash", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("cosine"))
    )


def directory(path: Column) -> Column:
    """Without the last component; empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, from_dir, licence): the nearest of ``licensed`` (dir, licence) at or above each of ``directories`` (dir)."""
    parts = F.split("dir", "/")
    up = F.sequence(F.lit(0), F.size(parts))
    above = F.transform(up, lambda k: F.struct(k.alias("steps"), F.array_join(F.slice(parts, 1, F.size(parts) - k), "/").alias("from_dir")))
    every = directories.select("dir", F.inline(above))
    met = every.join(licensed.withColumnRenamed("dir", "from_dir"), "from_dir")
    nearest = F.min(F.struct("steps", "from_dir", "licence"))
    return met.groupBy("dir").agg(nearest.alias("n")).select("dir", "n.from_dir", "n.licence")


def license_scan(files: DataFrame, text: str = "text", path: str = "path", min_cosine: float = MIN_COSINE) -> DataFrame:
    """``files`` with own_licence, own_cosine, licence (own, or inherited) and licence_dir (where it is inherited from)."""
    names = ("own_licence", "own_cosine", "licence", "licence_dir")
    keyed = files.select(*[c for c in files.columns if c not in names]).withColumns(
        dict(zip(("_td_id", "_td_hash"), t.row_key(text, path))) | {"_td_dir": directory(F.col(path))}
    )
    own = t.materialise(own_licences(files, text, path, min_cosine))
    best = F.min(F.struct((-F.col("cosine")).alias("less"), "licence"))
    licensed = (
        own.filter(F.col("_td_id").rlike(LICENCE_FILE))
        .groupBy(directory(F.col("_td_id")).alias("dir"))
        .agg(best.alias("best"))
        .select("dir", F.col("best.licence").alias("licence"))
    )
    dirs = keyed.select(F.col("_td_dir").alias("dir")).filter("dir IS NOT NULL").distinct()
    near = inherited(dirs, licensed).select(F.col("dir").alias("_td_dir"), F.col("from_dir").alias("_td_from"), F.col("licence").alias("_td_near"))
    mine = own.withColumnsRenamed({"licence": "own_licence", "cosine": "own_cosine"})
    joined = keyed.join(mine, t.same_key(keyed, mine), "left").drop(mine["_td_id"]).drop(mine["_td_hash"]).join(near, "_td_dir", "left")
    return joined.withColumns(
        {
            "licence": F.coalesce("own_licence", "_td_near"),
            "licence_dir": F.when(F.col("own_licence").isNull(), F.col("_td_from")),
        }
    ).select(*[c for c in files.columns if c not in names], *names)


def document_paths(docs: DataFrame) -> DataFrame:
    """The query's file tree: source, language, thousands, hundreds. A document that begins or ends with a statement is a licence file.

    An id that is no whole number counts as one that its hash gives, below 10^6; a NULL id has no folder of its own.
    """
    edge = [F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(n)) for n in (1, -1)]
    name = F.concat(F.when(edge[0].rlike(ANCHOR) | edge[1].rlike(ANCHOR), "LICENSE.").otherwise(""), F.col("doc_id").cast("string"))
    hashed = F.when(F.col("doc_id").isNotNull(), F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)))
    number = F.coalesce(t.whole_number(F.col("doc_id")), hashed)
    folder = [F.floor(number / n).cast("string") for n in (1000, 100)]
    return docs.withColumn("path", F.concat_ws("/", "source", "lang", *folder, name))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return license_scan(document_paths(docs)).select("doc_id", "path", "own_licence", "own_cosine", "licence", "licence_dir")
