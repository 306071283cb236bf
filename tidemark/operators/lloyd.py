"""K-Means with many starts: one pass over the points serves every start of every ``k``.

A pass is one job. Each task adds up its points by (start, nearest centre) with numpy and hands on one row for each of them,
which a grouped aggregate combines; the driver sees starts x centres rows, whatever the number of points. Coordinates are
summed as whole multiples of 2**-20, so the sums, and with them the centres, do not depend on how the points are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED_ROWS = 4096  # the starts are drawn from so many points; everything else uses all of them
TOLERANCE = 1e-4  # a start rests when no centre moves further
_UNIT = 1 << 20
_CHUNK = 1024  # points whose distances are in memory at a time
_ROUNDING = 1e-12  # of the squared lengths: a bound, thousands of times wider than it need be, for a distance's rounding


class Fit(NamedTuple):
    """The centres of one start and the summed squared distance of all points to the nearest."""

    centres: np.ndarray
    cost: float


def fit(points: DataFrame, id_column: str, point: str, starts: list[tuple[int, int]], iterations: int) -> list[Fit]:
    """Lloyd's algorithm from every ``(k, seed)`` of ``starts``.

    ``point`` is an array of standardised coordinates (then no sum can exceed a long: the absolute values add up to the
    number of points at most). ``points`` is read once for the seeds, once an iteration and once for the costs: pass a cached frame.
    Ties go to the smaller centre; a centre without points stays. Without points, centres have no coordinates and costs are 0.
    """
    sample = _seed_sample(points, id_column, point)
    if not len(sample):
        return [Fit(np.zeros((k, 0)), 0.0) for k, _ in starts]
    centres = [plus_plus(sample, k, seed) for k, seed in starts]
    moving = list(range(len(starts)))
    for _ in range(max(1, iterations)):
        sums = _pass(points, point, [centres[s] for s in moving])
        still = []
        for place, start in enumerate(moving):
            counts, totals, _ = sums[place]
            filled = counts > 0
            updated = centres[start].copy()
            updated[filled] = totals[filled] / counts[filled, None] / _UNIT
            if np.sqrt(((updated - centres[start]) ** 2).sum(axis=1)).max() > TOLERANCE:
                still.append(start)
            centres[start] = updated
        moving = still
        if not moving:
            break
    return [Fit(c, cost / _UNIT) for c, (_, _, cost) in zip(centres, _pass(points, point, centres, costs=True))]


def nearest(point: str, centres: np.ndarray) -> Column:
    """Number of the nearest centre; ties go to the smaller number."""
    coordinates = [F.get(F.col(point), F.lit(j)) for j in range(centres.shape[1])]

    def distance(centre: np.ndarray) -> Column:
        total = F.lit(0.0)
        for x, c in zip(coordinates, centre):
            total = total + (x - F.lit(float(c))) * (x - F.lit(float(c)))
        return total

    distances = F.array(*[distance(c) for c in centres])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def plus_plus(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` points of ``sample``, each drawn with the squared distance to those before it as its weight."""
    draw = np.random.default_rng(seed)
    chosen = [sample[draw.integers(len(sample))]]
    far = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        reach = np.cumsum(far)
        place = np.searchsorted(reach, draw.random() * reach[-1], side="right") if reach[-1] > 0 else 0
        chosen.append(sample[min(place, len(sample) - 1)])
        far = np.minimum(far, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _seed_sample(points: DataFrame, id_column: str, point: str) -> np.ndarray:
    """The points whose ids hash lowest: the same ones however the rows lie."""
    drawn = points.orderBy(F.xxhash64(id_column), id_column, point).limit(SEED_ROWS)
    return np.array([row[0] for row in drawn.select(point).collect()], dtype=float)


def _pass(points: DataFrame, point: str, centres: list[np.ndarray], costs: bool = False) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For every start: points and summed coordinates by centre, and (with ``costs``) its summed squared distances; both sums in 2**-20."""
    width = centres[0].shape[1]
    edges = np.concatenate([[0], np.cumsum([len(c) for c in centres])])
    stacked = np.concatenate(centres)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(stacked), width + 2), dtype=np.int64)  # coordinates, points, distances
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for first in range(0, len(flat), _CHUNK):
                add_points(found, flat[first : first + _CHUNK], stacked, edges, costs)
        slots = np.flatnonzero(found.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int32()), pa.array(list(found[slots]), pa.list_(pa.int64()))], names=["slot", "sums"]
        )

    partial = points.select(point).mapInArrow(add_up, "slot int, sums array<bigint>")
    sums = [F.sum(F.get("sums", F.lit(j))) for j in range(width + 2)]
    table = np.zeros((len(stacked), width + 2), dtype=np.int64)
    for row in partial.groupBy("slot").agg(F.array(*sums).alias("sums")).collect():  # starts x centres rows
        table[row.slot] = row.sums
    parts = [table[low:high] for low, high in zip(edges, edges[1:])]
    return [(part[:, width], part[:, :width], int(part[0, width + 1])) for part in parts]


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, added coordinate by coordinate: the same bits whatever the shapes. The arrays broadcast."""
    total = np.zeros(np.broadcast_shapes(points.shape, centres.shape)[:-1])
    for j in range(points.shape[-1]):
        gap = points[..., j] - centres[..., j]
        total += gap * gap
    return total


def members(points: np.ndarray, stacked: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(centres, points): 1 where the centre is the nearest of its start, by :func:`distances`; ties go to the smaller centre.

    A matrix product, whose rounding depends on its shape, rules out all centres that are further by more than it can be wrong.
    Where more than one is left, :func:`distances` decides.
    """
    squares = (stacked * stacked).sum(axis=1)
    near = np.column_stack([-2 * stacked, squares]) @ np.column_stack([points, np.ones(len(points))]).T
    margin = _ROUNDING * ((points * points).sum(axis=1) + squares.max() + 1)
    bound = np.minimum.reduceat(near, edges[:-1], axis=0) + margin
    member = (near <= np.repeat(bound, np.diff(edges), axis=0)).astype(float)
    open_starts, open_points = np.nonzero(np.add.reduceat(member, edges[:-1], axis=0) > 1)
    for start in np.unique(open_starts):
        low, high, own = edges[start], edges[start + 1], open_points[open_starts == start]
        choice = distances(points[own, None, :], stacked[None, low:high]).argmin(axis=1)
        member[low:high, own] = choice == np.arange(high - low)[:, None]
    return member


def add_points(found: np.ndarray, points: np.ndarray, stacked: np.ndarray, edges: np.ndarray, costs: bool = True) -> None:
    """Add ``points`` to the rows of ``found`` that belong to their nearest centres, one for every start.

    The sums may be a matrix product: below 2**53 they are whole numbers exactly, and a standardised coordinate is at most the
    root of the number of points.
    """
    width = points.shape[1]
    member = members(points, stacked, edges)
    whole = np.column_stack([np.rint(points * _UNIT), np.ones(len(points))])
    found[:, : width + 1] += (member @ whole).astype(np.int64)
    if costs:
        for low, high in zip(edges, edges[1:]):
            own = stacked[low + member[low:high].argmax(axis=0)]
            found[low, width + 1] += np.rint(distances(points, own) * _UNIT).astype(np.int64).sum()
