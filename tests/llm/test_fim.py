"""Fill-in-middle against a plain version that cuts Python strings, over texts of several blocks, and its round trip."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim

UNITS = {"char": r"(?s).", "word": r"(?:(?<![^\x20\x09-\x0D])|^)[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "line": r"[^\n]*\n|[^\n]+"}
TEXTS = [
    None,
    "",
    "a",
    "  lead and trail \n\n",
    "two\nlines",
    "é👍🏽" * 5000,
    ("wörd " * 37 + "\n") * 400,
    "x" * 20_000,
    "has <S> in it",
    "<",
    "ends in <P",
    "\n" * 9000,
]


def plain_version(key, text, plan):
    text = text or ""
    units = re.findall(UNITS[plan.unit], text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{plan.seed}:{key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in (plan.prefix, plan.suffix, plan.middle)) or h[2] % 100 >= plan.percent:
        return text, "plain", len(units), None, None
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < plan.spm_percent:
        return f"{plan.suffix}{s}{plan.prefix}{p}{plan.middle}{m}", "spm", len(units), len(p), len(m)
    return f"{plan.prefix}{p}{plan.suffix}{s}{plan.middle}{m}", "psm", len(units), len(p), len(m)


@pytest.mark.parametrize("plan", [fim.FimPlan(), fim.FimPlan("word", 7, 100, 50), fim.FimPlan("line", 2, 100, 50, "<pre>", "<suf>", "<mid>")])
def test_as_plain_version(plan, spark):
    rows = [(k * len(TEXTS) + i, x) for k in range(6) for i, x in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"form": F.lit(1), "n_units": F.lit("x"), "_td_text": F.lit(0)})
    made = fim.fill_in_middle(docs.repartition(3), plan).withColumn("back", fim.restored(F.col("output"), F.col("form"), plan))
    found = {r.doc_id: r for r in made.collect()}
    for key, text in rows:
        r = found[key]
        assert (r.output, r.form, r.n_units, r.prefix_chars, r.middle_chars) == plain_version(key, text, plan), key
        assert r.back == (text or "")
    assert {"plain", "psm", "spm"} <= {r.form for r in found.values()}


def test_descent_finds_every_boundary():
    text = "aé👍 \n" * 3000
    data = np.frombuffer(text.encode(), np.uint8)
    tree = fim._tree(data, "char")
    assert tree.total() == (len(text), len(text)) and tree.blocks > 4
    for cut in [*range(0, len(text), 997), 1, len(text) - 1, len(text)]:
        at, points = fim._boundary(data, tree, cut, "char")
        assert (at, points) == (len(text[:cut].encode()), cut)


def test_awkward_rows(tables, spark):
    nulls = tables.withColumn("output", F.lit(1))
    out = fim.fill_in_middle(nulls)
    assert out.count() == tables.count() and out.columns.count("output") == 1
    same = fim.transformed(nulls)
    assert same.columns == nulls.columns and same.count() == tables.count()
    assert fim.fill_in_middle(tables.limit(0)).count() == 0
    texts = spark.createDataFrame([("x" * 3, "é" * 3_000_000)], "doc_id string, text string")
    r = fim.fill_in_middle(texts, fim.FimPlan(percent=100)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).first()
    assert r.back == "é" * 3_000_000 and r.n_units == 3_000_000
