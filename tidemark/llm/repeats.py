"""Removal of repeated strings: every byte covered by a ``length``-byte string that starts elsewhere too.

The steps are those of a sampled suffix sort, stopped at depth ``length``: sample positions, name
them by what they begin with, bring equal names together, and compare what surrounds them.

* A text is known by its digest, so copies of a text are one text; a text with several rows is a
  repeat as a whole.
* Of every ``length``-byte window the smallest ``GRAM``-byte string, by hash, is its sampled
  position. Equal windows sample the same place, and a run of windows shares one: about three
  positions in 200 bytes.
* Names that occur at two places or more are candidates. Only those get their context: the bytes
  of all windows that chose them.
* Windows of equal name are compared by a 128-bit hash of their bytes, in Arrow batches that hold
  whole names. A name with more than ``BIG_NAME`` places is not gathered: its windows become rows,
  counted by a partial aggregation and joined back.
* The windows found cut the text; the rest is hashed.

A difference cover modulo 3 would sort two suffixes of three, over 500 million for half a gigabyte;
README has the figures that led to this sample instead. Results are the same: each equal pair of
windows meets at its common sampled place.

Defined cases: a NULL text counts as empty and an empty or short text loses nothing. Repeated rows
are separate documents, so each loses all its bytes if there are ``length`` or more. Matches never
cross documents. Strings are equal if two 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t
from tidemark.llm.bloom import possible

LENGTH = 200
GRAM = 64
BIG_NAME = 20_000
WINDOWS = 200_000
PIECE = 1 << 20
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

DIGEST = ("d1", "d2")
_KNOWN: dict = {}

t.ship(__name__)


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the digest of the whole text; a NULL text is an empty one."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"d1": F.xxhash64(whole), "d2": F.xxhash64(F.lit(1), whole)})


def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64; kept by the worker."""
    if (multiplier, n) in _KNOWN:
        return _KNOWN[multiplier, n]
    inverse = pow(multiplier, -1, 1 << 64)
    up, down = np.full(n, multiplier, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    _KNOWN[multiplier, n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _KNOWN[multiplier, n]


def window_hashes(data: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` bytes; the same bytes hash alike wherever they stand."""
    room = 1 << max(16, len(data).bit_length())
    up, down = _powers(MULTIPLIERS[which], room)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    found = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(32)
    return found


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _sampled(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(name, place, first, last) of each sampled place of some texts laid end to end.

    ``first`` to ``last`` are the windows that chose it. ``ends`` are the ends of the texts: a
    window that crosses one is none.
    """
    names = window_hashes(data, gram)
    place_bits = np.uint64(PIECE * 2 - 1)
    keys = (names & ~place_bits) | np.arange(len(names), dtype=np.uint64)
    chosen = (_sliding_min(keys, length - gram + 1) & place_bits).astype(np.int64)
    starts = np.arange(len(chosen))
    inside = starts + length <= ends[np.searchsorted(ends, starts, side="right")]
    starts, chosen = starts[inside], chosen[inside]
    if not len(starts):
        return None
    turn = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(starts) != 1)) + 1
    first, last = np.r_[0, turn], np.r_[turn, len(starts)] - 1
    return names[chosen[first]].view(np.int64), chosen[first], starts[first], starts[last]


PLACES = pa.schema(
    [("name", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())] + [(c, pa.int32()) for c in ("place", "first", "last")]
)


def _places(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # texts of this task: a copy adds nothing
        parts: list[tuple[np.ndarray, int, int, int]] = []
        held = 0

        def flush():
            data = np.concatenate([p[0] for p in parts])
            ends = np.cumsum([len(p[0]) for p in parts])
            found = _sampled(data, ends, length, gram) if len(data) >= length else None
            if found is not None:
                name, place, first, last = found
                which = np.searchsorted(ends, first, side="right")
                base = np.r_[0, ends[:-1]][which] - np.array([p[3] for p in parts])[which]
                owner = np.array([p[1:3] for p in parts], np.int64)[which]
                columns = [name, owner[:, 0], owner[:, 1], *[(x - base).astype(np.int32) for x in (place, first, last)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=PLACES)

        for batch in batches:
            texts, one, two = (batch.column(i) for i in range(3))
            one, two = one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                value = texts[i].as_buffer()
                key = hash((int(one[i]), int(two[i])))
                if value is None or value.size < length or key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                data = np.frombuffer(value, np.uint8)
                for at in range(0, len(data) - length + 1, PIECE - length + 1):
                    parts.append((data[at : at + PIECE], int(one[i]), int(two[i]), at))
                    held += len(parts[-1][0])
                    if held >= PIECE:
                        yield from flush()
                        parts.clear()
                        held = 0
        if parts:
            yield from flush()

    return run


CONTEXTS = pa.schema(
    [("name", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int32()), ("context", pa.binary())]
)


def _contexts(length: int):
    def run(key, texts: pa.Table, places: pa.Table) -> pa.Table:
        if not texts.num_rows or not places.num_rows:
            return CONTEXTS.empty_table()
        whole = texts.column("text")[0].as_buffer().to_pybytes()
        first, last = places.column("first").to_pylist(), places.column("last").to_pylist()
        cut = [whole[a : b + length] for a, b in zip(first, last)]
        return pa.table(
            [*(places.column(c).combine_chunks() for c in ("name", "n", "d1", "d2", "first")), pa.array(cut, pa.binary())],
            schema=CONTEXTS,
        )

    return run


def _windows(batch: pa.RecordBatch | pa.Table, length: int):
    """Both hashes of every window of the contexts, the row each belongs to, and its start in the text."""
    contexts = batch.column("context")
    contexts = contexts.combine_chunks() if isinstance(contexts, pa.ChunkedArray) else contexts
    sizes = np.array([len(x.as_buffer()) for x in contexts])
    data = np.frombuffer(b"".join(x.as_py() for x in contexts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = begins[row] + offset
    start = batch.column("first").to_numpy()[row] + offset
    return window_hashes(data, length)[at], window_hashes(data, length, 1)[at], row, start


RUNS = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
FLAT = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int32())])


def _repeated_runs(length: int):
    """Runs of windows that occur twice or more; the input has the rows of a name side by side."""

    def compared(rows: pa.Table) -> pa.RecordBatch | None:
        contexts = rows.column("context").to_pylist()
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(c, len(number)) for c in contexts), np.int64, len(contexts))
        # A context that occurs twice is repeated as a whole; windows are compared between different ones.
        unique, example, copies = np.unique(which, return_index=True, return_counts=True)
        one, two, row, offset = _windows(rows.take(pa.array(example)), length)
        offset = offset - rows.column("first").to_numpy()[example][row]
        order = np.lexsort((two, one))
        same = np.r_[False, (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
        repeated = np.zeros(len(one), bool)
        repeated[order] = same | np.r_[same[1:], False]
        repeated |= copies[row] > 1
        if not repeated.any():
            return None
        row, offset = row[repeated], offset[repeated]
        turn = np.flatnonzero((np.diff(row) != 0) | (np.diff(offset) != 1)) + 1
        begin = np.r_[0, turn]
        run_of, a, b = row[begin], offset[begin], offset[np.r_[turn, len(row)] - 1]
        # Every row has the runs of its context.
        low, count = np.searchsorted(run_of, which), np.bincount(run_of, minlength=len(unique))[which]
        owner = np.repeat(np.arange(len(which)), count)
        run = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(owner))
        first = rows.column("first").to_numpy()[owner]
        owners = [rows.column(c).to_numpy()[owner] for c in DIGEST]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*owners, (first + a[run]).astype(np.int32), (first + b[run]).astype(np.int32))], schema=RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            names = table.column("name").to_numpy()
            cut = int(np.searchsorted(names, names[-1]))  # the last name may go on in the next batch
            rest = table.slice(cut)
            # Whole names, some ``WINDOWS`` windows at a time.
            windows = np.cumsum(pc.binary_length(table.column("context")).to_numpy() - length + 1)
            low = 0
            while low < cut:
                done = windows[low - 1] if low else 0
                high = int(np.searchsorted(windows, done + WINDOWS))
                high = min(max(int(np.searchsorted(names, names[min(high, cut)])), int(np.searchsorted(names, names[low], side="right"))), cut)
                if (found := compared(table.slice(low, high - low))) is not None:
                    yield found
                low = high
        if rest is not None and rest.num_rows and (found := compared(rest)) is not None:
            yield found

    return run


def _flat_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                one, two, row, start = _windows(part, length)
                owners = [part.column(c).to_numpy()[row] for c in DIGEST]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (one.view(np.int64), two.view(np.int64), *owners, start.astype(np.int32))], schema=FLAT
                )

    return run


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, big: int = BIG_NAME, text: str = "text") -> DataFrame:
    """(d1, d2, first, last): runs of starts of strings that occur twice or more among the distinct texts."""
    known = digests(docs.select(F.col(text).alias("text")).filter(F.octet_length("text") >= length))
    places = t.materialise(known.mapInArrow(_places(length, gram), "name long, d1 long, d2 long, place int, first int, last int"))
    at = F.xxhash64("d1", "d2", "place")
    names = (
        places.groupBy("name")
        .agg(F.min(at).alias("low"), F.max(at).alias("high"), F.count("*").alias("n"))
        .filter("low <> high")
        .select("name", "n")
    )
    candidates = t.materialise(places.join(names, "name").select("name", "n", "d1", "d2", "first", "last").distinct())
    t.drop(places)
    wanted = t.materialise(candidates.select(*DIGEST).distinct())
    texts = possible(known, wanted, list(DIGEST)).join(wanted, list(DIGEST)).select(*DIGEST, F.encode("text", "UTF-8").alias("text"))
    texts = texts.dropDuplicates(list(DIGEST))

    def contexts(places: DataFrame) -> DataFrame:
        met = texts.groupBy(*DIGEST).cogroup(places.groupBy(*DIGEST))
        return met.applyInArrow(_contexts(length), "name long, n long, d1 long, d2 long, first int, context binary")

    few = contexts(candidates.filter(F.col("n") <= big))
    runs = few.repartition("name").sortWithinPartitions("name").mapInArrow(_repeated_runs(length), "d1 long, d2 long, first int, last int")
    big_names = candidates.filter(F.col("n") > big)
    if big_names.isEmpty():
        return runs
    flat = contexts(big_names).mapInArrow(_flat_windows(length), "w1 long, w2 long, d1 long, d2 long, first int")
    start = F.xxhash64("d1", "d2", "first")
    twice = flat.groupBy("w1", "w2").agg(F.min(start).alias("low"), F.max(start).alias("high")).filter("low <> high").select("w1", "w2")
    hot = flat.join(twice, ["w1", "w2"]).select(*DIGEST, "first", F.col("first").alias("last"))
    return runs.unionByName(hot)


CUTS = pa.schema(
    [("d1", pa.int64()), ("d2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _cut(length: int):
    def run(key, texts: pa.Table, runs: pa.Table) -> pa.Table:
        if not texts.num_rows or not runs.num_rows:
            return CUTS.empty_table()
        whole = np.frombuffer(texts.column("text")[0].as_buffer(), np.uint8)
        order = np.argsort(first := runs.column("first").to_numpy(), kind="stable")
        first, end = first[order], np.maximum.accumulate(runs.column("last").to_numpy()[order] + length)
        new = np.r_[True, first[1:] > end[:-1]]
        starts, ends = first[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]
        edge = np.zeros(len(whole) + 1, np.int64)
        edge[starts] += 1
        edge[ends] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        d1, d2 = (int(x.as_py()) for x in key)
        return pa.table([[d1], [d2], [int(gone.sum())], [len(starts)], [whole[~gone].tobytes()]], schema=CUTS)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, big: int = BIG_NAME, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and ``kept``, the bytes that stay; columns of those names are replaced."""
    names = ("n_bytes", "n_removed", "n_spans", "kept")
    columns = [c for c in docs.columns if c not in names]
    keyed = digests(docs.select(*columns), text).withColumn("n_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
    whole = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    with t.Tables() as tables:
        runs = t.materialise(repeated_windows(docs, length, gram, big, text))
        tables.keep(runs)
    copies = keyed.filter(F.col("n_bytes") >= length).groupBy(*DIGEST).agg(F.count("*").alias("rows"))
    copied = copies.filter("rows > 1").select(*DIGEST, F.lit(True).alias("copied"))
    hit = t.materialise(runs.select(*DIGEST).distinct())
    texts = possible(keyed, hit, list(DIGEST)).join(hit, list(DIGEST)).select(*DIGEST, whole.alias("text")).dropDuplicates(list(DIGEST))
    cuts = texts.groupBy(*DIGEST).cogroup(runs.groupBy(*DIGEST)).applyInArrow(
        _cut(length), "d1 long, d2 long, n_removed long, n_spans long, kept binary"
    )
    decided = cuts.join(copied, list(DIGEST), "full_outer")
    joined = keyed.join(decided, list(DIGEST), "left")
    gone = F.coalesce("copied", F.lit(False))
    return joined.withColumns(
        {
            "kept": F.when(gone, F.lit(b"")).when(F.col("kept").isNotNull(), F.col("kept")).otherwise(whole),
            "n_removed": F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long"),
            "n_spans": F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long"),
        }
    ).select(*columns, *names)


def op10_repeated_strings(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
