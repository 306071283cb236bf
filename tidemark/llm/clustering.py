"""Centroid clustering: Lloyd's rounds with vectors and centroids sharded by dimension.

The vectors become integers once and are written as blocks: a row holds the columns of one shard for up to
``CHUNK`` vectors, so no task ever needs a whole vector or a whole centroid. A round has three steps:

* each block meets the centroids' slice of its shard and gives exact partial distances to all centroids;
* the partial distances of a chunk, one row a shard, are added, and each vector takes its nearest centroid;
* the blocks meet the assignment of their chunk; sums and counts by shard, centroid and dimension are aggregated map
  side first, and each shard updates its own slice from them.

Nothing but blocks, slices and assignments moves, and a group is never larger than a chunk's shards, or a slice:
a vector or a cluster that holds a third of all rows is spread over its chunks. Centroids stay in tables; only the sum
of all distances goes through the driver.

Arithmetic is exact. Distances are computed in doubles while all partial sums stay below 2^53, else in 64-bit
integers. Components are clipped to the largest power of two with which no squared distance can
exceed a BIGINT (2^27 at 64 dimensions).

Defined cases: a vector that is NULL, has another number of components, or a NULL or non-finite one, is left out. Ids may
be NULL (hashed as empty) or repeat: each row is a vector of its own, and equal hashes are ordered by the vectors'
contents. With fewer vectors than centroids each vector is one. Without vectors the result is empty. Other columns
are not read. An empty cluster keeps its centroid. Partial sums of a cluster must fit a BIGINT (2^36 vectors at the limit of components).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t

t.ship(__name__)

CHUNK = 1024
EXACT = float(1 << 53)


@dataclass(frozen=True)
class ClusterPlan:
    dims: int = 64
    clusters: int = 40
    rounds: int = 5
    scale: int = 256
    shards: int = 4
    seed: int = 2

    def edges(self) -> list[int]:
        """First dimension of each shard, and the end."""
        return [self.dims * s // self.shards for s in range(self.shards + 1)]

    def limit(self) -> int:
        """Largest component: dims * (2 * limit)^2 fits a BIGINT."""
        return 1 << ((62 - (self.dims - 1).bit_length()) // 2 - 1)


def _packed(values: np.ndarray) -> bytes:
    """The integers in the narrowest type that holds them; the number of bytes tells which."""
    most = int(np.abs(values).max()) if values.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return np.ascontiguousarray(values, kind).tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * width)]
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.int64)


def _blocks(plan: ClusterPlan):
    edges, limit = plan.edges(), float(plan.limit())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column("vector")
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            usable = np.flatnonzero(sizes == plan.dims)
            if not len(usable):
                continue
            flat = lists.take(pa.array(usable)).flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, plan.dims)  # NULL is NaN here
            fine = np.isfinite(values).all(axis=1)
            usable, values = usable[fine], values[fine]
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(plan.scale * values), -limit, limit).astype(np.int64)
            ids = batch.column("_td_id").take(pa.array(usable))
            mix = np.cumprod(np.full(plan.dims, 0x9E3779B97F4A7C15, np.uint64))
            content = (whole.view(np.uint64) * mix).sum(axis=1, dtype=np.uint64).view(np.int64)
            for low in range(0, len(whole), CHUNK):
                part = whole[low : low + CHUNK]
                n, count = len(part), plan.shards
                none = [pa.nulls(1, pa.list_(kind)) for kind in (ids.type, pa.int64())]
                own = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x[low : low + n]) for x in (ids, pa.array(content))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(count), pa.int32()),
                        pa.array([chunk] * count, pa.int64()),
                        pa.array([n] * count, pa.int32()),
                        pa.array([_packed(part[:, a:b]) for a, b in zip(edges, edges[1:])], pa.binary()),
                        *(pa.concat_arrays([x, *[y] * (count - 1)]) for x, y in zip(own, none)),
                    ],
                    names=["shard", "chunk", "n", "data", "ids", "contents"],
                )
                chunk += 1

    return run


def column_blocks(vectors: DataFrame, plan: ClusterPlan, vector: str, key: str) -> DataFrame:
    """(shard, chunk, n, data, ids, contents): integers of up to ``CHUNK`` vectors in the dimensions of a shard; ids with the first shard."""
    rows = vectors.select(F.col(key).alias("_td_id"), F.col(vector).alias("vector"))
    kind = rows.schema["_td_id"].dataType.simpleString()
    return rows.mapInArrow(_blocks(plan), f"shard int, chunk long, n int, data binary, ids array<{kind}>, contents array<long>")


def _widths(plan: ClusterPlan) -> list[int]:
    return [b - a for a, b in zip(plan.edges(), plan.edges()[1:])]


def _seeds(plan: ClusterPlan):
    widths = _widths(plan)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """The slice of one shard: a row for each first centroid, in order."""
        rows, shard = rows.sort_by("rank"), int(rows.column("shard")[0].as_py())
        found = [
            _unpacked(d, n, widths[shard])[place]
            for d, n, place in zip(*(rows.column(c).to_pylist() for c in ("data", "n", "place")))
        ]
        return pa.table({"shard": pa.array([shard], pa.int32()), "k": pa.array([len(found)], pa.int32()), "centres": [_packed(np.array(found))]})

    return run


def first_slices(blocks: DataFrame, plan: ClusterPlan) -> DataFrame:
    """(shard, k, centres): the vectors with the smallest hashes."""
    named = blocks.filter("shard = 0").select("chunk", F.explode(F.arrays_zip("ids", "contents", F.expr("sequence(0, n - 1)").alias("place"))).alias("v"))
    text = F.coalesce(F.col("v.ids").cast("string"), F.lit(""))
    hashed = named.select("chunk", F.col("v.place").alias("place"), F.sha2(F.concat(F.lit(f"{plan.seed}:"), text), 256).alias("h"), "v.contents", text.alias("id"))
    first = hashed.orderBy("h", "id", "contents").limit(plan.clusters)  # a parameter bounds these rows
    ranked = first.agg(F.sort_array(F.collect_list(F.struct("h", "id", "contents", "chunk", "place"))).alias("all")).select(F.posexplode("all").alias("rank", "v"))
    ranked = ranked.select("rank", F.col("v.chunk").alias("chunk"), F.col("v.place").alias("place"))
    met = blocks.select("shard", "chunk", "n", "data").join(F.broadcast(ranked), "chunk")
    return met.groupBy("shard").applyInArrow(_seeds(plan), "shard int, k int, centres binary")


def _partial(plan: ClusterPlan):
    widths = _widths(plan)

    def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        reach = float(np.abs(x).max()) + float(np.abs(c).max())
        if x.shape[1] * reach * reach < EXACT:
            x, c = x.astype(np.float64), c.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("shard", "chunk", "n", "data", "k", "centres")}
                width = widths[row["shard"]]
                x, c = _unpacked(row["data"], row["n"], width), _unpacked(row["centres"], row["k"], width)
                part = _packed(distances(x, c).astype(np.int64))
                columns = [pa.array([row["chunk"]], pa.int64()), pa.array([row["n"]], pa.int32()), pa.array([row["k"]], pa.int32()), pa.array([part], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "n", "k", "part"])

    return run


def _nearest(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    n, k = (int(rows.column(c)[0].as_py()) for c in ("n", "k"))
    total = np.zeros((n, k), np.int64)
    for part in rows.column("part"):
        total += _unpacked(part.as_py(), n, k)
    nearest = total.argmin(axis=1)  # the first of equal ones
    found = total[np.arange(n), nearest]
    return pa.table({"chunk": [int(key[0].as_py())], "clusters": pa.array([nearest.astype(np.int32)]), "distances": pa.array([found])})


def assigned(blocks: DataFrame, slices: DataFrame, plan: ClusterPlan) -> DataFrame:
    """(chunk, clusters, distances): nearest centroid of each vector of a chunk and the squared distance."""
    # A slice has clusters * dims / shards numbers: parameters bound what is broadcast.
    met = blocks.select("shard", "chunk", "n", "data").join(F.broadcast(slices), "shard")
    partial = met.mapInArrow(_partial(plan), "chunk long, n int, k int, part binary")
    return partial.groupBy("chunk").applyInArrow(_nearest, "chunk long, clusters array<int>, distances array<long>")


def _sums(plan: ClusterPlan):
    widths = _widths(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, n, data = (batch.column(c)[i].as_py() for c in ("shard", "n", "data"))
                width = widths[shard]
                own = batch.column("clusters")[i].values.to_numpy()
                order = np.argsort(own, kind="stable")
                number, begin, count = np.unique(own[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(_unpacked(data, n, width)[order], begin, axis=0)
                columns = [
                    np.full(sums.size, shard, np.int32),
                    np.repeat(number, width).astype(np.int32),
                    np.tile(np.arange(width, dtype=np.int32), len(number)),
                    sums.ravel(),
                    np.repeat(count, width).astype(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "cluster", "dim", "total", "members"])

    return run


def _updated(plan: ClusterPlan):
    widths = _widths(plan)

    def run(key: tuple[pa.Scalar, ...], old: pa.Table, new: pa.Table) -> pa.Table:
        shard, k = (int(old.column(c)[0].as_py()) for c in ("shard", "k"))
        centres = _unpacked(old.column("centres")[0].as_py(), k, widths[shard])
        cluster, dim, value = (new.column(c).to_numpy() for c in ("cluster", "dim", "value"))
        centres[cluster, dim] = value
        return pa.table({"shard": pa.array([shard], pa.int32()), "k": pa.array([k], pa.int32()), "centres": [_packed(centres)]})

    return run


def moved_slices(blocks: DataFrame, slices: DataFrame, nearest: DataFrame, plan: ClusterPlan) -> DataFrame:
    """The slices after a round: floors of the members' means, dimension by dimension."""
    met = blocks.select("shard", "chunk", "n", "data").join(nearest.select("chunk", "clusters"), "chunk")
    sums = met.mapInArrow(_sums(plan), "shard int, cluster int, dim int, total long, members long")
    summed = sums.groupBy("shard", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    means = summed.select("shard", "cluster", "dim", F.expr("(total - pmod(total, members)) div members").alias("value"))
    return slices.groupBy("shard").cogroup(means.groupBy("shard")).applyInArrow(_updated(plan), "shard int, k int, centres binary")


def _numbers(plan: ClusterPlan):
    edges, widths = plan.edges(), _widths(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, k = (int(batch.column(c)[i].as_py()) for c in ("shard", "k"))
                values = _unpacked(batch.column("centres")[i].as_py(), k, widths[shard])
                cluster = np.repeat(np.arange(k, dtype=np.int32), widths[shard])
                dim = np.tile(np.arange(edges[shard], edges[shard + 1], dtype=np.int32), k)
                yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(dim), pa.array(values.ravel())], names=["cluster", "dim", "value"])

    return run


def centroid_clusters(vectors: DataFrame, plan: ClusterPlan = ClusterPlan(), vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """(_td_id, cluster, distance) of each vector kept, and the centroids (cluster, dim, value)."""
    with t.Tables() as tables:
        blocks = t.materialise(column_blocks(vectors, plan, vector, key))
        slices = t.materialise(first_slices(blocks, plan))
        for _ in range(plan.rounds):
            nearest = t.materialise(assigned(blocks, slices, plan))
            moved = t.materialise(moved_slices(blocks, slices, nearest, plan))
            t.drop(slices, nearest)
            slices = moved
        nearest = t.materialise(assigned(blocks, slices, plan))
        ids = blocks.filter("shard = 0").select("chunk", "ids")
        rows = ids.join(nearest, "chunk").select(F.inline(F.arrays_zip("ids", "clusters", "distances")))
        rows = t.materialise(rows.toDF("_td_id", "cluster", "distance"))
        tables.keep(rows, slices)
    return rows, slices.mapInArrow(_numbers(plan), "cluster int, dim int, value long")


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    rows, centroids = centroid_clusters(t.read(spark, sf_dir, "embeddings"))
    inertia = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = inertia.agg(F.sum("cluster_inertia")).first()[0]
    parts = centroids.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("parts"))
    digest = F.sha2(F.array_join(F.transform("parts", lambda p: p["value"].cast("string")), ","), 256)
    # One row a centroid: the plan's number of clusters bounds them.
    of_cluster = inertia.join(parts.select("cluster", digest.alias("centroid_sha256")), "cluster")
    return rows.join(F.broadcast(of_cluster), "cluster").select(
        F.col("_td_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256"
    )


def _sql(plan: ClusterPlan = ClusterPlan()) -> str:
    """Lloyd's rounds as one common table expression a step."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({plan.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {plan.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{plan.seed}:' || vec_id)) - 1 AS INT) AS cluster, x AS c FROM v
  QUALIFY cluster < {plan.clusters}
)""",
    ]
    for r in range(plan.rounds + 1):
        parts.append(
            f"""d{r} AS MATERIALIZED (
  SELECT vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance FROM v, c{r}
), a{r} AS MATERIALIZED (
  SELECT vec_id, x, cluster, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)"""
        )
        if r < plan.rounds:
            parts.append(
                f"""m{r} AS MATERIALIZED (
  SELECT cluster, list(mean ORDER BY dim) AS c FROM (
    SELECT cluster, dim, CAST((total - ((total % n) + n) % n) // n AS BIGINT) AS mean FROM (
      SELECT cluster, dim, CAST(sum(value) AS BIGINT) AS total, count(*) AS n
      FROM (SELECT cluster, unnest(x) AS value, generate_subscripts(x, 1) AS dim FROM a{r}) GROUP BY ALL))
  GROUP BY cluster
), c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"""
            )
    last = plan.rounds
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (cluster)
"""


SQL = _sql()
