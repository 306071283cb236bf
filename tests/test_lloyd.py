"""K-Means with shared passes against single fits in numpy, on any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import lloyd, segments
from tidemark.plans import registry

STARTS = [(3, 1), (3, 2), (5, 3), (5, 4), (8, 5)]


def blobs(spark, rows=900):
    """Six clouds; a third of all points are one and the same."""
    noise = "((id * 7919 + {0} * 104729) % 1000) / 2500D"
    where = ["(id % 6) % 3 - 1", "floor((id % 6) / 3) - 0.5", "0.2 * (id % 2)"]
    place = ", ".join(f"IF(id % 3 = 0, 0.25D, CAST({w} AS DOUBLE) + {noise.format(j)})" for j, w in enumerate(where))
    return spark.range(rows).selectExpr("id", f"array({place}) AS x")


def single_fit(points, k, seed, iterations=100):
    """Plain Lloyd from the same start, one point at a time."""
    centres = lloyd.plus_plus(points, k, seed)
    for _ in range(iterations):
        near = np.array([((centres - x) ** 2).sum(axis=1).argmin() for x in points])
        moved = np.array([points[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(k)])
        done = np.sqrt(((moved - centres) ** 2).sum(axis=1)).max() <= lloyd.TOLERANCE
        centres = moved
        if done:
            break
    return sum(((centres - x) ** 2).sum(axis=1).min() for x in points)


def test_same_costs_as_single_fits(spark):
    points = blobs(spark).cache()
    sample = lloyd._seed_sample(points, "id", "x")
    assert len(sample) == 900
    for (k, seed), found in zip(STARTS, lloyd.fit(points, "id", "x", STARTS, 100)):
        assert found.cost == pytest.approx(single_fit(sample, k, seed), rel=1e-4)
        assert found.centres.shape == (k, 3)


def test_partitions_do_not_matter(spark):
    few = lloyd.fit(blobs(spark).coalesce(1), "id", "x", STARTS, 100)
    many = lloyd.fit(blobs(spark).repartition(13), "id", "x", STARTS, 100)
    for a, b in zip(few, many):
        assert (a.centres == b.centres).all() and a.cost == b.cost


def test_more_centres_than_points_and_no_points(spark):
    two = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])], "id bigint, x array<double>")
    (found,) = lloyd.fit(two, "id", "x", [(4, 0)], 5)
    assert found.cost == 0 and found.centres.shape == (4, 2)
    numbers = {tuple(r.x): r.c for r in two.withColumn("c", lloyd.nearest("x", found.centres)).collect()}
    assert len(set(numbers.values())) == 2
    none = two.limit(0)
    (empty,) = lloyd.fit(none, "id", "x", [(4, 0)], 5)
    assert empty.cost == 0 and none.withColumn("c", lloyd.nearest("x", empty.centres)).collect() == []


def test_sweep(spark, work):
    group = "kmeans-sweep"
    features = work.feature_table
    spark.sparkContext.setJobGroup(group, group)
    points = segments._points(features).select("customer_id", "_point").cache()
    one = lloyd.fit(points, "customer_id", "_point", [(5, 42)], 100)[0]
    jobs_of_one = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    fits = lloyd.fit(points, "customer_id", "_point", [(5, 42 + n) for n in range(10)], 100)
    jobs_of_ten = len(spark.sparkContext.statusTracker().getJobIdsForGroup("other"))
    assert fits[0].cost == one.cost
    assert jobs_of_ten < 4 * jobs_of_one  # as many passes as the slowest start takes, not ten times as many
    rows = segments.kmeans_k_sweep(features, registry.QUICK_PARAMS, restarts=3).collect()
    assert [r.k for r in rows] == list(segments.SWEEP)
    assert all(r.inertia > 0 and r.silhouette > 0 for r in rows)
    assert rows[-1].inertia < rows[0].inertia


def test_cluster_is_the_nearest(spark):
    points = blobs(spark, 60)
    (found,) = lloyd.fit(points, "id", "x", [(4, 7)], 20)
    for row in points.withColumn("c", lloyd.nearest("x", found.centres)).collect():
        assert row.c == ((found.centres - np.array(row.x)) ** 2).sum(axis=1).argmin()
    assert points.select(F.count("x")).first()[0] == 60


def test_members_by_product_are_those_by_distance():
    draw = np.random.default_rng(3)
    points = draw.normal(size=(500, 7)) * [1, 1, 300, 1, 1e-3, 1, 1]
    points[:50] = points[0]
    stacked = np.concatenate([points[:5], points[60:68], points[60:63], points[[70, 70, 71]]])  # equal centres tie
    stacked[9] = stacked[8] + 1e-14
    edges = np.array([0, 5, 13, 16, 19])
    member = lloyd.members(points, stacked, edges)
    for low, high in zip(edges, edges[1:]):
        exact = lloyd.distances(points[:, None, :], stacked[None, low:high]).argmin(axis=1)
        assert (member[low:high].sum(axis=0) == 1).all() and (member[low:high].argmax(axis=0) == exact).all()
