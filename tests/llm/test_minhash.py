"""MinHash near-duplicates against brute force, and the signature against the similarity it estimates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components

from tidemark.llm import minhash
from tidemark.llm import text as t
from tidemark.llm.links import JoinPlan


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_as_brute_force(folder, spark):
    place = f"/root/testdata/{folder}"
    docs = t.read(spark, place, "documents").select("doc_id", "text")
    want = brute_components([tuple(r) for r in docs.collect()], 3, 85)
    found = minhash.op13_minhash_dedup(spark, place).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(want)


def chains(n_groups, members, seed):
    """Groups in which each text differs from the one before in a word or two, so that only neighbours link."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randint(20, 90))]
        for _ in range(members):
            rows.append((len(rows) * 3 % 1009, " ".join(words)))
            words[draw.randrange(len(words))] = f"v{draw.randrange(400)}"
    return rows


@pytest.mark.parametrize("plan", [JoinPlan(3, 85), JoinPlan(2, 60), JoinPlan(1, 100)])
def test_links_near_the_threshold(plan, spark):
    rows = chains(20, 12, plan.percent)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["_td_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.document_components(docs, plan).collect()}
    assert found == brute_components(rows, plan.words, plan.percent)


def test_coordinates_agree_as_often_as_sets(spark):
    draw = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        off = []
        for _ in range(20):
            common, own = round(300 * share), (300 - round(300 * share)) // 2
            every = draw.integers(0, 1 << 63, common + 2 * own).astype(np.uint64)
            a, b = every[: common + own], np.r_[every[:common], every[common + own :]]
            minima = minhash.signatures(np.array([0, len(a)]), np.r_[a, b], 512)
            off.append((minima[0] == minima[1]).mean() - common / len(every))
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.04


def test_bands():
    assert minhash.bands_for(100) == 1
    assert all((1 - (p / 100) ** 5) ** minhash.bands_for(p) <= minhash.MISSED for p in (50, 80, 85, 99))


def test_awkward_rows(tables, spark):
    docs = tables.withColumns({"sig": F.lit(1), "sid": F.lit("x"), "low": F.lit(0)})
    found = minhash.document_components(docs).collect()
    assert len(found) == tables.count()
    by = {(r["_td_id"], r["n_shingles"]): r["component_id"] for r in found}
    assert by[(2, by_size(found, 1))] == 1 and by[(4, 0)] == 4 and by[(5, 0)] == 5 and by[(6, 0)] == 6 and by[(None, 1)] is None
    assert minhash.document_components(tables.limit(0)).count() == 0
    copies = spark.createDataFrame([(i, "a b c d e f") for i in range(500)] + [(900, "A B\tC d e f "), (901, "x" * 3_000_000)], "doc_id long, text string")
    kept = minhash.remove_near_duplicates(copies.repartition(7), JoinPlan(3, 85)).collect()
    assert sorted(r.doc_id for r in kept) == [0, 901]


def by_size(found, key):
    return next(r["n_shingles"] for r in found if r["_td_id"] == key)
