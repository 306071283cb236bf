"""Sets of word shingles, the links between similar ones, and the components of the links.

A document's set holds the hashes of its word shingles. An operator proposes buckets of sets that may link (by signatures of
its own); what follows is shared: checking what meets in a bucket, exactly, and joining what links.

Within a bucket every set is first checked against the smallest, then, in two rounds, against the one
with most links so far if their components differ. That joins groups of near copies in linear time; last,
sets of different components that share a bucket are checked with each other, once a pair.
A sketch of parities bounds from below in how many features two sets differ, which rules most pairs out inside the join;
the others are checked exactly, on the sets. Components come from minimum labels with pointer jumping.

Defined cases: a NULL, empty or blank text has an empty set, links with nothing and is its own
component. Rows that share id and text are one document; a NULL id is never the smallest of a group
with another id. Features are equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as t
from tidemark.llm.bloom import possible
from tidemark.llm.repeats import _powers, MULTIPLIERS

t.ship(__name__)

BUFFER = 1 << 21
# Rounds in which each bucket is checked against one of its sets, before pairs.
ROUNDS = 3
# So many signatures of a set tell whether a pair has met before.
FIRST = 16
# Equal sets that a task has signed are remembered, up to so many.
SEEN = 1_000_000


@dataclass(frozen=True)
class JoinPlan:
    """Sets of ``words``-word shingles link if 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80


# Proposes (sig, sid, low): sets that share a signature, and the smallest of them.
Buckets = Callable[[DataFrame, JoinPlan, str], DataFrame]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of one stretch of bytes; A-Z count as a-z."""
    space = SPACES[data]
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(MULTIPLIERS[0], 1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text, cut at white space into stretches of bounded length."""
    found, at = [], 0
    while at < len(data):
        end = min(at + BUFFER, len(data))
        while end < len(data) and not SPACES[data[end]]:
            end += 1
        found.append(word_hashes(data[at:end])[2])
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _shingles(owner: np.ndarray, word: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature), sorted and distinct; a document with fewer words has one feature, all of them."""

    def runs(first: np.ndarray, length: int) -> np.ndarray:
        h = np.full(len(first), length, np.uint64)
        for j in range(length):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word[first + j])
        return h

    count = np.bincount(owner, minlength=n_docs)
    begin = np.cumsum(count) - count
    inner = np.arange(max(0, len(word) - size + 1))
    inner = inner[owner[inner] == owner[inner + size - 1]]
    docs, features = [owner[inner]], [runs(inner, size)]
    for length in range(1, size):
        short = np.flatnonzero(count == length)
        docs.append(short)
        features.append(runs(begin[short], length))
    doc, feature = np.concatenate(docs), np.concatenate(features)
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])][: len(doc)]
    return doc[new], feature[new]


def grouped_texts(batches: Iterator[pa.RecordBatch], size: int):
    """(rows, document, feature) for stretches of rows; ``rows`` are (batch, row numbers)."""
    for batch in batches:
        texts = batch.column("text")
        rows, parts, held = [], [], 0

        def flush():
            lengths = [len(p) + 1 for p in parts]
            begin = np.cumsum(lengths) - lengths
            blank = np.full(1, 32, np.uint8)
            start, _, word = word_hashes(np.concatenate([x for p in parts for x in (p, blank)]))
            owner = np.searchsorted(begin, start, side="right") - 1
            return (batch, np.array(rows), *_shingles(owner, word, len(rows), size))

        for i in range(batch.num_rows):
            buffer = texts[i].as_buffer()
            data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
            if len(data) > BUFFER:
                word = _long_text(data)
                yield batch, np.array([i]), *_shingles(np.zeros(len(word), np.int64), word, 1, size)
                continue
            rows.append(i)
            parts.append(data)
            held += len(data)
            if held >= BUFFER:
                yield flush()
                rows, parts, held = [], [], 0
        if rows:
            yield flush()


def set_ids(n_docs: int, doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and identity of each document's set."""
    size = np.bincount(doc, minlength=n_docs)
    total = np.zeros(n_docs, np.uint64)
    if len(doc):
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total[doc[begin]] = np.add.reduceat(mix(feature ^ np.uint64(0xA5A5A5A55A5A5A5A)), begin)
    return size, mix(total + size.astype(np.uint64))


SKETCH = [f"s{i}" for i in range(8)]
SETS = "_td_id {id}, _td_hash long, n long, sid long, " + ", ".join(f"{s} long" for s in SKETCH)


def _sketches(n_docs: int, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """512 parities of each set. Two sets differ in at least as many features as their sketches in bits."""
    place = (mix(feature + np.uint64(0x2545F4914F6CDD1D)) & np.uint64(511)).astype(np.int64)
    odd = (np.bincount(doc * 512 + place, minlength=n_docs * 512) & 1).astype(bool)
    return np.packbits(odd).view(np.int64).reshape(n_docs, 8)


def _sizes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, doc, feature in grouped_texts(batches, size):
            n, sid = set_ids(len(rows), doc, feature)
            own = batch.select(["_td_id", "_td_hash"]).take(pa.array(rows))
            sketch = [pa.array(np.ascontiguousarray(column)) for column in _sketches(len(rows), doc, feature).T]
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(n.astype(np.int64)), pa.array(sid.view(np.int64)), *sketch],
                names=["_td_id", "_td_hash", "n", "sid", *SKETCH],
            )

    return run


def unseen(n: np.ndarray, sid: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which sets are neither empty nor in ``seen``, the sets this task has met; an equal set adds nothing."""
    fresh = np.zeros(len(n), bool)
    for i in np.flatnonzero(n):
        if int(sid[i]) not in seen:
            fresh[i] = True
            if len(seen) < SEEN:
                seen.add(int(sid[i]))
    return fresh


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, doc, feature in grouped_texts(batches, size):
            n, sid = set_ids(len(rows), doc, feature)
            offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(feature.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(sid.view(np.int64)), lists], names=["sid", "features"])

    return run


def document_sets(docs: DataFrame, plan: JoinPlan, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, n, sid): size and identity of each document's set."""
    keyed = docs.select(*t.row_key(text, key), F.col(text).alias("text"))
    return keyed.mapInArrow(_sizes(plan.words), SETS.format(id=dict(keyed.dtypes)["_td_id"]))


def _near(a: str, b: str, plan: JoinPlan):
    """False only if sketches and sizes show that two sets can't link."""
    bits = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH[1:]), F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))
    return bits * (100 + plan.percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - plan.percent)


def _linked(pairs: DataFrame, sets: DataFrame, plan: JoinPlan) -> DataFrame:
    """The pairs (a, b) that link, checked on the sets."""
    left, right = (sets.select(F.col("sid").alias(x), F.col("features").alias(f"f_{x}")) for x in ("a", "b"))
    met = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("f_a", "f_b"))
    union = F.size("f_a") + F.size("f_b") - common
    return met.filter(common * 100 >= union * plan.percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(sid, root): the smallest sid that links reach, for each sid with a link."""
    both = t.materialise(links.union(links.select("b", "a")).toDF("sid", "other").distinct())
    least = both.groupBy("sid").agg(F.least(F.col("sid"), F.min("other")).alias("root"))
    table = t.materialise(least.withColumn("moved", F.lit(True)))
    while not table.filter("moved").isEmpty():
        roots = table.select("sid", "root")
        of_other = roots.select(F.col("sid").alias("other"), F.col("root").alias("met"))
        least = both.join(of_other, "other").groupBy("sid").agg(F.min("met").alias("met"))
        nearer = roots.join(least, "sid").select("sid", F.least("root", "met").alias("near"), "root")
        jump = roots.select(F.col("sid").alias("near"), F.col("root").alias("far"))
        moved = nearer.join(jump, "near").select("sid", F.least("near", "far").alias("root"), (F.least("near", "far") < F.col("root")).alias("moved"))
        before, table = table, t.materialise(moved)
        t.drop(before)
    t.drop(both)
    return table.select("sid", "root")


def linked_components(docs: DataFrame, own: DataFrame, plan: JoinPlan, buckets: Buckets, text: str = "text") -> DataFrame:
    """(sid, root) for the sets that link with another; ``own`` is what :func:`document_sets` gives."""
    with t.Tables() as tables:
        roots = t.materialise(_linked_components(docs, own, plan, buckets, text))
        tables.keep(roots)
    return roots


def _linked_components(docs: DataFrame, own: DataFrame, plan: JoinPlan, buckets: Buckets, text: str) -> DataFrame:
    shared = t.materialise(buckets(docs, plan, text))
    wanted = shared.select("sid").distinct()
    # The sets themselves, only for documents that share a bucket; one for equal sets.
    holders = t.materialise(own.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min("_td_hash").alias("_td_hash")))
    texts = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias("_td_hash"))
    texts = possible(texts, holders, ["_td_hash"]).join(holders.select("_td_hash").distinct(), "_td_hash")
    sets = t.materialise(
        texts.dropDuplicates(["_td_hash"]).select("text").mapInArrow(_features(plan.words), "sid long, features array<long>").dropDuplicates(["sid"])
    )
    sketch = own.filter("n > 0").join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("n").alias("n"), *[F.first(s).alias(s) for s in SKETCH])
    sketch = t.materialise(sketch.select("sid", F.struct("n", *SKETCH).alias("known")))
    known = {x: sketch.select(F.col("sid").alias(x), F.col("known").alias(f"k_{x}")) for x in ("a", "b")}

    def checked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that sketches do not rule out."""
        return pairs.join(known["a"], "a").join(known["b"], "b").filter(_near("k_a", "k_b", plan)).select("a", "b")

    def mixed_buckets(roots: DataFrame) -> DataFrame:
        """(sig, sid, root): the buckets with sets of several components."""
        named = shared.join(roots, "sid", "left").select("sig", "sid", F.coalesce("root", "sid").alias("root"))
        return named.select("*", F.min("root").over(by_sig).alias("r1"), F.max("root").over(by_sig).alias("r2")).filter("r1 <> r2").drop("r1", "r2")

    by_sig = Window.partitionBy("sig")
    tried = t.materialise(checked(shared.filter("sid <> low").select(F.col("low").alias("a"), F.col("sid").alias("b")).distinct()))
    links = t.materialise(_linked(tried, sets, plan))
    roots = components(links)
    for step in range(1, ROUNDS):
        # Sets with many links stand in the middle of their group: whatever links at all is likely to link with them.
        degree = links.select(F.col("a").alias("sid")).union(links.select("b")).groupBy("sid").agg((-F.count("*")).alias("degree"))
        ranked = mixed_buckets(roots).join(degree, "sid", "left").withColumn(
            "rank", F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), F.xxhash64("sid", F.lit(step)).alias("order"), "sid", "root")
        )
        pivot = ranked.select("sid", "root", F.min("rank").over(by_sig).alias("pivot")).filter("root <> pivot.root")
        pairs = pivot.select(F.least("sid", "pivot.sid").alias("a"), F.greatest("sid", "pivot.sid").alias("b")).distinct()
        pairs = t.materialise(checked(pairs.join(tried, ["a", "b"], "left_anti")))
        more = t.materialise(_linked(pairs, sets, plan))
        tried, links = tried.unionByName(pairs), links.unionByName(more)
        roots = components(links)
    mixed = t.materialise(mixed_buckets(roots))
    # A pair meets in each bucket it shares; it counts only in the first, as far as the first signatures of both show.
    first = mixed.groupBy("sid").agg(F.slice(F.sort_array(F.collect_list("sig")), 1, FIRST).alias("first"))
    rows = mixed.join(sketch.join(first, "sid"), "sid")
    left, right = (rows.select("sig", *[F.col(c).alias(f"{c}_{x}") for c in ("sid", "root", "known", "first")]) for x in ("a", "b"))
    earliest = F.array_min(F.array_intersect("first_a", "first_b"))
    apart = (F.col("sid_a") < F.col("sid_b")) & (F.col("root_a") != F.col("root_b")) & _near("known_a", "known_b", plan)
    once = F.coalesce(earliest >= left["sig"], F.lit(True))
    rest = left.join(right, (left["sig"] == right["sig"]) & apart & once).select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()
    more = t.materialise(_linked(rest.join(tried, ["a", "b"], "left_anti"), sets, plan))
    if more.isEmpty():
        return roots
    return components(links.unionByName(more))


def _grouped(docs: DataFrame, plan: JoinPlan, buckets: Buckets, text: str, key: str) -> DataFrame:
    """What :func:`document_sets` gives, with ``group``: the same for all documents of a component."""
    own = t.materialise(document_sets(docs, plan, text, key))
    roots = linked_components(docs, own, plan, buckets, text)
    return own.join(roots, "sid", "left").withColumn("group", F.coalesce("root", "sid"))


def document_components(docs: DataFrame, plan: JoinPlan, buckets: Buckets, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, n_shingles, component_id), a row for each of ``docs``."""
    with t.Tables() as tables:
        found = t.materialise(_document_components(docs, plan, buckets, text, key))
        tables.keep(found)
    return found


def _document_components(docs: DataFrame, plan: JoinPlan, buckets: Buckets, text: str, key: str) -> DataFrame:
    placed = _grouped(docs, plan, buckets, text, key)
    # One row an equal set and id before the groups meet.
    least = placed.filter("n > 0").groupBy("group").agg(F.min("_td_id").alias("least"))
    return placed.join(least, "group", "left").select(
        "_td_id",
        "_td_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("_td_id")).alias("component_id"),
    )


def remove_near_duplicates(docs: DataFrame, plan: JoinPlan, buckets: Buckets, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component; all columns kept.

    It is the first by id, NULL last, then by the text's hash, then by that of the whole row. Rows without a word stay.
    """
    with t.Tables() as tables:
        placed = t.materialise(_grouped(docs, plan, buckets, text, key).filter("n > 0").select("group", "_td_id", "_td_hash"))
        order = F.struct(F.col("_td_id").isNull().alias("last"), "_td_id", "_td_hash")
        first = placed.groupBy("group").agg(F.min(order).alias("first"))
        stays = (F.col("_td_id").eqNullSafe(F.col("first._td_id"))) & (F.col("_td_hash") == F.col("first._td_hash"))
        gone = t.materialise(placed.join(first, "group").filter(~stays).select("_td_id", "_td_hash").distinct())
        again = t.materialise(placed.groupBy("_td_id", "_td_hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
        tables.keep(gone, again)
    keyed = docs.withColumns(dict(zip(("_td_id", "_td_hash"), t.row_key(text, key))))
    rest = keyed.join(gone, t.same_key(keyed, gone), "left_anti")
    once = rest.join(again, t.same_key(rest, again), "left_anti").select(*docs.columns)
    equal = Window.partitionBy("_td_id", "_td_hash").orderBy(F.xxhash64(*docs.columns))
    repeated = rest.join(again, t.same_key(rest, again), "left_semi").withColumn("_td_number", F.row_number().over(equal))
    return once.unionByName(repeated.filter("_td_number = 1").select(*docs.columns))
