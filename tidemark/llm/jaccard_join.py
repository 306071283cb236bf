"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

Sizes of the shingle sets fall into bands so wide that two sets
that link lie in one band or in neighbours; a set takes part in the instance of its own band and in
the next one's. In an instance two linked sets differ in at most ``k`` features. The feature domain
is partitioned into ``k + 1 + t`` parts, so at least ``t + 1`` parts agree, and the hash of the
features in a part is a signature. Three rules keep buckets small without losing a pair:

* a part without features is no signature, unless a set has more than ``t`` such parts;
* a set leaves out its ``t`` largest buckets (less one for each empty part): of the ``t + 1`` shared
  ones the smallest remains on both sides, as all sets order buckets alike;
* equal sets are one set.

What shares a bucket is checked and joined by :mod:`tidemark.llm.links`, whose defined cases hold here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import links
from tidemark.llm import text as t
from tidemark.llm.links import JoinPlan, grouped_texts, mix, set_ids, unseen

t.ship(__name__)

MAX_SIZE = 1 << 40


def bands(plan: JoinPlan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest size of each band; k and t of each instance."""
    tops, low = [], 1
    while low < MAX_SIZE:
        tops.append(low * 100 // plan.percent)
        low = tops[-1] + 1
    top = np.array(tops, np.int64)
    k = 2 * top * (100 - plan.percent) // (100 + plan.percent)
    return top, k, 2 + k // 3


def _signatures(plan: JoinPlan):
    top, ks, ts = bands(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, rows, doc, feature in grouped_texts(batches, plan.words):
            n, sid = set_ids(len(rows), doc, feature)
            fresh = unseen(n, sid, seen)
            band = np.searchsorted(top, n)
            for step in (0, 1):
                instance = np.minimum(band + step, len(top) - 1)
                used = fresh & (ks[instance] > 0)  # at k = 0 only equal sets link
                parts = np.where(used, ks[instance] + 1 + ts[instance], 0)
                begin = np.cumsum(parts) - parts
                mine = used[doc]
                d, f = doc[mine], feature[mine]
                if not len(d):
                    continue
                seed = mix(instance.astype(np.uint64) + np.uint64(1))
                part = (mix(f ^ seed[d]) % parts[d].astype(np.uint64)).astype(np.int64)
                at = begin[d] + part
                total = int(parts.sum())
                held = np.bincount(at, minlength=total)
                sums = np.zeros(total, np.uint64)
                np.add.at(sums, at, mix(f + np.uint64(0x5851F42D4C957F2D)))
                owner = np.repeat(np.arange(len(rows)), parts)
                empty = np.bincount(owner[held == 0], minlength=len(rows))
                spare = np.maximum(ts[instance] - empty, 0)
                out = (held > 0) | (empty > ts[instance])[owner]
                owner, number = owner[out], (np.arange(total) - np.repeat(begin, parts))[out]
                sign = mix(mix(sums[out]) ^ mix(seed[owner] + number.astype(np.uint64)))
                meta = instance[owner] * 1_000_000 + np.minimum(spare[owner], 999_999)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sign.view(np.int64)), pa.array(sid[owner].view(np.int64)), pa.array(meta.astype(np.int32))],
                    names=["sig", "sid", "meta"],
                )

    return run


def buckets(docs: DataFrame, plan: JoinPlan, text: str = "text") -> DataFrame:
    """(sig, sid): signatures that two sets or more share, without each set's largest ones."""
    signed = docs.select(F.col(text).alias("text")).mapInArrow(_signatures(plan), "sig long, sid long, meta int")
    by_sig = Window.partitionBy("sig")
    shared = (
        signed.withColumns({"low": F.min("sid").over(by_sig), "high": F.max("sid").over(by_sig), "size": F.count("*").over(by_sig)})
        .filter("low <> high")
        .select("sig", "sid", "meta", "size")
        .distinct()
    )
    shared = t.materialise(shared)
    largest = Window.partitionBy("sid", F.floor(F.col("meta") / 1_000_000)).orderBy(F.col("size").desc(), "sig")
    kept = shared.withColumn("rank", F.row_number().over(largest)).filter(F.col("rank") > F.col("meta") % 1_000_000)
    again = kept.select("sig", "sid", F.min("sid").over(by_sig).alias("low"), F.max("sid").over(by_sig).alias("high"))
    return again.filter("low <> high").select("sig", "sid", "low")


def document_components(docs: DataFrame, plan: JoinPlan = JoinPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, n_shingles, component_id), a row for each of ``docs``."""
    return links.document_components(docs, plan, buckets, text, key)


def remove_near_duplicates(docs: DataFrame, plan: JoinPlan = JoinPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component; all columns kept."""
    return links.remove_near_duplicates(docs, plan, buckets, text, key)


CONTRACT = JoinPlan(words=4, percent=85)


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = document_components(docs, CONTRACT)
    return found.select(F.col("_td_id").alias("doc_id"), "n_shingles", "component_id")
