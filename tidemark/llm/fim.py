"""Fill-in-middle transformation: cut each text at two units and move its middle to the end.

A text is split into blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks holds two counts for each, its
units and its code points. A cut is a number of units: a binary-lifting descent through the tree finds the
block in which that unit begins and the code points before it, and only that block is searched for the byte.
So a text is read once to count, whatever the number of cuts, and a cut costs a logarithm and one block.

Where a text is cut, and whether and in which order it is rearranged, follow from the hash of its id alone:
reruns, retries and other partitionings agree. Rows are independent, so nothing is shuffled.

Units are code points, words (each with the white space after it; white space at the start is a unit of its own)
or lines (each with its line break).

Defined cases: a NULL text counts as empty, and an empty one stays plain, like a text that contains a mark. A NULL id is
hashed as an empty one. Rows that share an id are cut by the same numbers, each text on its own. Input
columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t

t.ship(__name__)

BLOCK = 4096
FLUSH = 4 << 20  # bytes of text that are put out at a time
FIELDS = {"form": "string", "n_units": "long", "prefix_chars": "long", "middle_chars": "long"}


@dataclass(frozen=True)
class FimPlan:
    """``percent`` of the texts are rearranged, ``spm_percent`` of those suffix first."""

    unit: str = "char"  # or word, line
    seed: int = 1
    percent: int = 90
    spm_percent: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def _points(data: np.ndarray) -> np.ndarray:
    """Whether a code point begins at each byte."""
    return (data & 0xC0) != 0x80


def _units(data: np.ndarray, low: int, high: int, unit: str) -> np.ndarray:
    """Whether a unit begins at each byte from ``low`` to ``high``."""
    part = data[low:high]
    if unit == "char":
        return _points(part)
    before = data[max(low - 1, 0) : high - 1]
    begins = (before == 10) if unit == "line" else _SPACES[before] & ~_SPACES[part[len(part) - len(before) :]]
    return begins if low else np.r_[True, begins]


class Fenwick:
    """Sums of two counts a block, by prefixes of blocks."""

    def __init__(self, counts: np.ndarray) -> None:
        self.blocks = len(counts)
        sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)])
        at = np.arange(self.blocks + 1)
        self.tree = sums - sums[at - (at & -at)]

    def total(self) -> tuple[int, int]:
        at, units, points = self.blocks, 0, 0
        while at:
            units, points = units + int(self.tree[at, 0]), points + int(self.tree[at, 1])
            at -= at & -at
        return units, points

    def descend(self, unit: int) -> tuple[int, int, int]:
        """The block in which ``unit`` begins, and the units and code points before that block; past the last unit, all of them."""
        at, units, points = 0, 0, 0
        step = 1 << max(self.blocks.bit_length() - 1, 0)
        while step:
            ahead = at + step
            if ahead <= self.blocks and units + self.tree[ahead, 0] <= unit:
                at, units, points = ahead, units + int(self.tree[ahead, 0]), points + int(self.tree[ahead, 1])
            step >>= 1
        return at, units, points


def _tree(data: np.ndarray, unit: str) -> Fenwick:
    if not len(data):
        return Fenwick(np.zeros((0, 2), np.int64))
    counts = []
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        points = int(np.count_nonzero(_points(data[low:high])))
        counts.append((points if unit == "char" else int(np.count_nonzero(_units(data, low, high, unit))), points))
    return Fenwick(np.array(counts, np.int64))


def _boundary(data: np.ndarray, tree: Fenwick, cut: int, unit: str) -> tuple[int, int]:
    """(byte, code points before it) of the place after ``cut`` units."""
    block, units, points = tree.descend(cut)
    if block == tree.blocks:
        return len(data), points
    low, high = block * BLOCK, min((block + 1) * BLOCK, len(data))
    at = int(np.flatnonzero(_units(data, low, high, unit))[cut - units])
    return low + at, points + int(np.count_nonzero(_points(data[low : low + at])))


def _rearranged(plan: FimPlan):
    marks = [m.encode() for m in (plan.prefix, plan.suffix, plan.middle)]

    def one(whole: bytes, h: list[int]):
        data = np.frombuffer(whole, np.uint8)
        tree = _tree(data, plan.unit)
        n, _ = tree.total()
        if not whole or h[2] % 100 >= plan.percent or any(m in whole for m in marks):
            return whole, "plain", n, None, None
        first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        (a, before), (b, upto) = (_boundary(data, tree, cut, plan.unit) for cut in (first, second))
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        spm = h[3] % 100 < plan.spm_percent
        parts = (marks[1], suffix, marks[0], prefix) if spm else (marks[0], prefix, marks[1], suffix)
        return b"".join((*parts, marks[2], middle)), "spm" if spm else "psm", n, before, upto - before

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_td_text")
            hashes = np.stack([batch.column(f"_td_h{i}").to_numpy() for i in range(4)], axis=1).tolist()
            low, held, made = 0, 0, []
            for i in range(batch.num_rows):
                buffer = texts[i].as_buffer()
                made.append(one(buffer.to_pybytes() if buffer is not None else b"", hashes[i]))
                held += len(made[-1][0])
                if held >= FLUSH or i + 1 == batch.num_rows:
                    kept = batch.slice(low, len(made))
                    columns = [kept.column(c) for c in kept.schema.names if not c.startswith("_td_")]
                    names = [c for c in kept.schema.names if not c.startswith("_td_")]
                    output, *fields = zip(*made)
                    types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
                    columns += [pa.array(output, pa.binary()).view(pa.string()), *(pa.array(f, k) for f, k in zip(fields, types))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "output", *FIELDS])
                    low, held, made = i + 1, 0, []

    return run


def fill_in_middle(docs: DataFrame, plan: FimPlan = FimPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``output``, the rearranged text, its ``form`` (plain, psm or spm), ``n_units``, ``prefix_chars`` and ``middle_chars``."""
    kept = [c for c in docs.columns if c not in ("output", *FIELDS) and not c.startswith("_td_")]
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    hashes = {f"_td_h{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    whole = docs.withColumns({"_td_text": F.col(text), **hashes}).select(*kept, "_td_text", *hashes)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    added = ", ".join(f"{name} {kind}" for name, kind in {"output": "string", **FIELDS}.items())
    return whole.mapInArrow(_rearranged(plan), f"{schema}, {added}" if kept else added)


def restored(output: Column, form: Column, plan: FimPlan = FimPlan()) -> Column:
    """The text a rearranged ``output`` was made from."""
    first = F.when(form == "psm", F.lit(plan.suffix)).otherwise(F.lit(plan.prefix))
    body = F.substring(output, F.when(form == "psm", len(plan.prefix)).otherwise(len(plan.suffix)) + 1, F.length(output))

    def parts(whole: Column) -> Column:
        one = F.call_function("substring_index", whole, first, F.lit(1))
        rest = F.substring(whole, F.length(one) + F.length(first) + 1, F.length(whole))

        def joined(rest: Column) -> Column:
            two = F.call_function("substring_index", rest, F.lit(plan.middle), F.lit(1))
            middle = F.substring(rest, F.length(two) + len(plan.middle) + 1, F.length(rest))
            return F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))

        return t.let(rest, joined)

    return F.when(form == "plain", output).otherwise(t.let(body, parts))


def transformed(docs: DataFrame, plan: FimPlan = FimPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the rearranged text in place of the text; the same columns."""
    made = fill_in_middle(docs.select(F.col(text).alias("text"), F.col(key).alias("key"), F.struct(*docs.columns).alias("row")), plan, "text", "key")
    return made.select(*[F.col("output").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(docs).drop("text")
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
e AS (
  SELECT doc_id, text, length(text) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM e
), g AS (
  SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1, n - b) AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM g
"""
