"""MinHash near-duplicates: circulant permutations, banding, exact verification.

All coordinates of a signature come from two permutations of the 32-bit numbers. The first, sigma, scatters a set's features
once; the second, pi, is applied to them shifted circularly by the coordinate's number: coordinate k is the smallest
``pi(sigma(f) - k)``. So a signature needs no table of hash functions, and any number of coordinates costs the same two seeds.

``rows`` coordinates are hashed into the signature of a band, and sets that share one are a bucket. Sets with similarity s
meet with probability ``1 - (1 - s ** rows) ** bands``. At the plan's threshold of 85 % that leaves out one link in
100 million, and a document is lost only if all of its links are: within a group of copies there are many.
What meets is checked and joined by :mod:`tidemark.llm.links`, on the full sets, whose defined cases hold here; equal sets
are one set and always found. A lower ``percent`` needs more bands: :func:`bands_for` gives their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import links
from tidemark.llm import text as t
from tidemark.llm.bloom import possible
from tidemark.llm.links import JoinPlan, grouped_texts, mix, set_ids, unseen

t.ship(__name__)

ROWS = 5
MISSED = 1e-8  # probability that two sets at the threshold share no band
CONTRACT = JoinPlan(words=3, percent=85)


def bands_for(percent: int, rows: int = ROWS) -> int:
    """So many bands that sets of ``percent`` similarity share one but for ``MISSED``."""
    return 1 if percent >= 100 else math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** rows)))


def _scattered(feature: np.ndarray) -> np.ndarray:
    """sigma of the features' 32-bit hashes."""
    x = (mix(feature) >> np.uint64(32)).astype(np.uint32)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    x *= np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def _permuted(x: np.ndarray, out: np.ndarray, spare: np.ndarray) -> None:
    """pi of ``x``, written to ``out``."""
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=out)
    for factor, shift in ((0x7FEB352D, 15), (0x846CA68B, 16)):
        np.multiply(out, np.uint32(factor), out=out)
        np.right_shift(out, np.uint32(shift), out=spare)
        np.bitwise_xor(out, spare, out=out)


def signatures(begin: np.ndarray, feature: np.ndarray, coordinates: int) -> np.ndarray:
    """A row of ``coordinates`` minima for each set; ``begin`` is where the features of each, at least one, begin."""
    scattered = _scattered(feature)
    shifted, out, spare = (np.empty_like(scattered) for _ in range(3))
    found = np.empty((len(begin), coordinates), np.uint32)
    for k in range(coordinates):
        np.subtract(scattered, np.uint32(k), out=shifted)
        _permuted(shifted, out, spare)
        found[:, k] = np.minimum.reduceat(out, begin)
    return found


def _bands(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, row, doc, feature in grouped_texts(batches, words):
            n, sid = set_ids(len(row), doc, feature)
            fresh = unseen(n, sid, seen)
            mine = fresh[doc]
            if not mine.any():
                continue
            own = feature[mine]
            count = n[fresh]
            minima = signatures(np.cumsum(count) - count, own, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
            sign = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), minima.shape[:2]).copy()
            for r in range(rows):
                sign = mix(sign * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, r])
            columns = [sign.ravel().view(np.int64), np.repeat(sid[fresh], bands).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sig", "sid"])

    return run


def buckets(docs: DataFrame, plan: JoinPlan, text: str = "text", rows: int = ROWS) -> DataFrame:
    """(sig, sid, low): sets that share the signature of a band with another one, and the smallest of them."""
    signer = _bands(plan.words, bands_for(plan.percent, rows), rows)
    signed = t.materialise(docs.select(F.col(text).alias("text")).mapInArrow(signer, "sig long, sid long"))
    extremes = signed.groupBy("sig").agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
    shared = t.materialise(extremes.filter("low <> high").select("sig", "low"))
    # A band's signature may be shared by many sets: the join is one AQE can split.
    return possible(signed, shared, ["sig"]).join(shared, "sig").select("sig", "sid", "low").distinct()


def document_components(docs: DataFrame, plan: JoinPlan = CONTRACT, text: str = "text", key: str = "doc_id", rows: int = ROWS) -> DataFrame:
    """(_td_id, _td_hash, n_shingles, component_id), a row for each of ``docs``."""
    return links.document_components(docs, plan, partial(buckets, rows=rows), text, key)


def remove_near_duplicates(docs: DataFrame, plan: JoinPlan = JoinPlan(), text: str = "text", key: str = "doc_id", rows: int = ROWS) -> DataFrame:
    """``docs`` with one row of each component; all columns kept."""
    return links.remove_near_duplicates(docs, plan, partial(buckets, rows=rows), text, key)


def op13_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept); a row without an id is kept if its component has none."""
    found = document_components(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.col("_td_id").eqNullSafe(F.col("component_id"))
    return found.select(F.col("_td_id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))
