"""Centroid clustering against Lloyd's rounds in Python's integers."""

import hashlib
import math
import random

import pytest

from tidemark.llm import clustering
from tidemark.llm import text as t


def brute_force(rows, plan):
    limit = plan.limit()
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != plan.dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [plan.scale * x for x in vector]
        kept.append((key, [limit if x >= limit else -limit if x < -limit else math.floor(x) for x in whole]))
    kept.sort(key=lambda r: hashlib.sha256(f"{plan.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centres = [list(v) for _, v in kept[: plan.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(plan.rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for k, own in members.items():
            centres[k] = [sum(column) // len(own) for column in zip(*own)]
    return sorted((str(key), nearest(v)[1], nearest(v)[0]) for key, v in kept), centres


def check(spark, rows, plan, schema="vec_id long, embedding array<double>"):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    found, centroids = clustering.centroid_clusters(frame, plan)
    want, centres = brute_force(rows, plan)
    assert sorted((str(r[0]), r[1], r[2]) for r in found.collect()) == want
    assert {(r.cluster, r.dim): r.value for r in centroids.collect()} == {(k, d): x for k, c in enumerate(centres) for d, x in enumerate(c)}


@pytest.mark.parametrize("dims, clusters, shards, size", [(64, 7, 4, 1.0), (5, 3, 2, 1.0), (3, 4, 3, 1e300), (7, 3, 1, 40_000.0), (6, 5, 3, 2.0**20)])
def test_as_brute_force(dims, clusters, shards, size, spark):
    draw = random.Random(dims)
    rows = [(i, [draw.gauss(0, size) for _ in range(dims)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # a vector that holds a third of all rows
    check(spark, rows, clustering.ClusterPlan(dims, clusters, 3, 256, shards))


def test_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(clustering, "CHUNK", 16)
    draw = random.Random(1)
    check(spark, [(i, [float(draw.randint(-3, 3)) for _ in range(4)]) for i in range(500)], clustering.ClusterPlan(4, 6, 4, 256, 2))


def test_awkward_rows(spark):
    plan = clustering.ClusterPlan(2, 4, 2, 256, 2)
    rows = [(1, [0.5, 0.25]), (2, None), (3, [1.0]), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0])]
    check(spark, rows, plan)
    check(spark, rows + [(None, [3.0, -1.0]), (9, [0.5, 0.25]), (10, [-0.001, -0.0])], plan)
    check(spark, [("a", [1.0, 2.0]), ("b", [1.0, 2.0]), (None, [0.0, 1e9])], plan, "vec_id string, embedding array<float>")
    check(spark, [], plan)
    twice = spark.createDataFrame([(1, [0.0, 0.0]), (1, [9.0, 9.0]), (1, [0.0, 0.0])], "vec_id long, embedding array<double>")
    results = [sorted(map(tuple, clustering.centroid_clusters(f, clustering.ClusterPlan(2, 2, 1, 256, 1))[0].collect())) for f in (twice, twice.repartition(3))]
    assert results[0] == results[1] and len(results[0]) == 3


def test_only_what_the_result_reads_stays(spark, sf_dir):
    with t.Tables() as owner:
        clustering.centroid_clusters(t.read(spark, sf_dir, "embeddings"))
        assert len(owner.held) == 2
