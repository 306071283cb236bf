"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of words (A-Z as a-z): pairs of words, under them single words by how many others they follow, and under
those the spelling, for words the trusted texts do not have. Pairs are counted in all trusted documents, and counts,
continuation counts, discounts, context totals and back-off weights are joins and aggregations of tables sharded by
a word's hash, so the model grows with the corpus and stays in the executors. Pairs of every count are kept, those
seen once too, each with the discount estimated for its count. Trusted texts are counted, and documents
scored, in ``SLICES`` passes over the words of one part and the pairs that end in them, so that only one part is shuffled at a
time. What a pair needs of its two words is joined to it, and its weights are worked out, just before its pass. A scoring pass takes the documents in ``SHARES``
turns, by a hash, so that only one share of their n-grams is shuffled at a time; each document is in one of them.

What an n-gram adds to the log probability over its suffix, and what it weighs as a context, is one number, so a document's
log probability is its spelling plus that of its words and pairs. Each document's distinct ones are joined to the
shards once and summed. The most frequent ones, at most ``HEAVY`` whatever the corpus, are broadcast and summed where the
document is read: that takes the hot keys out of the join, exactly. So is the spelling, a model of n-grams of ``ORDER``
classes of bytes within a word: at most 64^3.

A trusted document is scored without itself: its own occurrences are taken off the count of each pair, and one off the
continuation count of each word (of a text beyond ``links.BUFFER`` bytes, those of the stretch at hand). So its score is like that of any other document, and being labelled earns nothing.
A pair seen once adds exactly nothing to it, so a trusted document is not joined to those.

The scores of all trusted documents give a threshold for each language: its own median, and above it a reach in log perplexity.
The reach is the ``quantile`` of the language's scores, less the part of them that one or two documents make up. The fewer they are
(beside ``1 / (1 - quantile)``, the number that the quantile needs), the more it is widened to the reach of all languages around
their medians, never narrowed. A document is kept if its perplexity is not above the threshold.

Defined cases: a NULL text or one without a word has no perplexity and is not kept. A NULL language is a language
of its own; one without a trusted document takes the loosest threshold of all. Without trusted documents every document with
a word is kept. Documents that share an id share its labels; repeated rows are scored one by one. Words are equal if
their 64-bit hashes are. Discounts are 0.5 where a count of counts is 0. Weights are
summed in units of 2^-32, so no sum depends on an order.
"""

from __future__ import annotations

import math
from collections import namedtuple
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t
from tidemark.llm.bloom import BITS_PER_KEY, bloom_filter, blocks_for, broadcastable, holds, possible, slice_of
from tidemark.llm.links import BUFFER, SPACES, word_hashes

t.ship(__name__)

ORDER, BITS = 3, 6
SYMBOLS = 1 << BITS
UNIT = 1 << 32
QUANTILE = 0.995
SLICES = 4  # a power of two
SHARES = 2
GATHERED = 1 << 19  # bytes of short texts that are worked on at once
ARROW_ROWS = 1_000  # texts that are handed to Python at once
HEAVY = 1 << 16
KEYS_PER_BLOCK = 4  # of 64 bits, in a filter that is sent to tasks
PREFIX = 18  # leading bits of a key that index a broadcast table
LEVELS = (0.5, 0.75, 0.9, 0.95, 0.97, 0.98, 0.985, 0.99, 0.9925, 0.995, 0.9975, 0.999)

# Bytes with a class of their own. Digits, capitals, other ASCII, and the first bytes of longer characters share one each.
OWN_CLASS = " abcdefghijklmnopqrstuvwxyz.,!?|*#%$&'\"-:;()/_="
DIGIT, CAPITAL, OTHER, FIRST_BYTE = 48, 49, 50, 51
BLANK = OWN_CLASS.index(" ")


def _classes() -> np.ndarray:
    byte = np.arange(256)
    table = np.where(byte < 128, OTHER, np.where(byte >= 192, FIRST_BYTE, 52 + byte % 12)).astype(np.int32)
    table[48:58], table[65:91] = DIGIT, CAPITAL
    for number, letter in enumerate(OWN_CLASS):
        table[ord(letter)] = number
    table[SPACES] = BLANK
    return table


_TABLE = _classes()
_START, _END = (np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_P = [np.uint64(n) for n in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _xxhash64(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit numbers, as Spark's xxhash64 applies it to each column in turn."""

    def turned(x, bits):
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    h = seed + _P[4] + np.uint64(8)
    h = h ^ (turned(value * _P[1], 31) * _P[0])
    h = turned(h, 27) * _P[0] + _P[3]
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def pair_hash(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """``xxhash64(one, two)``."""
    return _xxhash64(two, _xxhash64(one, np.full(len(one), 42, np.uint64)))


# Texts end to end. Item i is row rows[i] of the batch, or a stretch of it: begin[i] is its first byte, before[i] the
# hash of the word before it, opens[i] and last[i] tell whether the text begins and ends with it. Words have start, end, hash, item.
Stretch = namedtuple("Stretch", "batch rows begin before opens last data start end word item")


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    """The texts of column ``text`` in stretches of bounded length; a longer text is cut at white space."""
    blank = np.full(1, 32, np.uint8)

    def flush(batch, items):
        parts = [x for item in items for x in (item[1], blank)]
        sizes = np.array([len(item[1]) + 1 for item in items])
        begin, data = np.cumsum(sizes) - sizes, np.concatenate(parts)
        start, end, word = word_hashes(data)
        item = np.searchsorted(begin, start, side="right") - 1
        rows, before, opens, last = (np.array([x[i] for x in items], kind) for i, kind in ((0, np.int64), (2, np.uint64), (3, bool), (4, bool)))
        return Stretch(batch, rows, begin, before, opens, last, data, start, end, word, item)

    for batch in batches:
        texts, items, held = batch.column("text"), [], 0
        for i in range(batch.num_rows):
            buffer = texts[i].as_buffer()
            data = np.frombuffer(buffer, np.uint8) if buffer is not None else blank[:0]
            at, before = 0, _START
            while len(data) - at > BUFFER:
                end = at + BUFFER
                while end < len(data) and not SPACES[data[end]]:
                    end += 1
                if end == len(data):
                    break
                made = flush(batch, [(i, data[at:end], before, at == 0, False)])
                yield made
                at, before = end, made.word[-1] if len(made.word) else before
            items.append((i, data[at:], before, at == 0, True))
            held += len(data) - at
            if held >= min(GATHERED, BUFFER):
                yield flush(batch, items)
                items, held = [], 0
        if items:
            yield flush(batch, items)


def _symbols(s: Stretch) -> tuple[np.ndarray, np.ndarray]:
    """N-gram of classes at each byte, with what stands before it in its word, and whether it counts: bytes of words and the blank after each."""
    one = _TABLE[s.data]
    two, three = np.r_[np.int32(BLANK), one[:-1]], np.r_[np.int32(BLANK), np.int32(BLANK), one[:-2]][: len(one)]
    three = np.where(two == BLANK, BLANK, three)
    return one | two << BITS | three << 2 * BITS, (one != BLANK) | (two != BLANK)


def _pairs(s: Stretch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, item, number of the second word) of all pairs, with the marks before and after each text; the end mark has number -1."""
    follows = np.r_[False, s.item[1:] == s.item[:-1]][: len(s.item)]
    first = np.where(follows, np.r_[s.word[:1], s.word[:-1]], s.before[s.item])
    final = s.before.copy()
    final[s.item] = s.word  # the last of each item stays
    ends = np.flatnonzero(s.last & (final != _START))
    number = np.r_[np.arange(len(s.word)), np.full(len(ends), -1)]
    return np.r_[first, final[ends]], np.r_[s.word, np.full(len(ends), _END)], np.r_[s.item, ends], number


def _words(s: Stretch, second: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, item): every word, and the marks of each text that has one; ``second`` and ``item`` are those of :func:`_pairs`."""
    starts = np.unique(s.item)
    starts = starts[s.before[starts] == _START]
    return np.r_[second, np.full(len(starts), _START)], np.r_[item, starts]


def _grouped(item: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (item, gram) and how often each occurs."""
    order = np.argsort(gram)
    order = order[np.argsort(item[order].astype(np.int16 if len(item) == 0 or item.max() < 1 << 15 else np.int64), kind="stable")]
    item, gram = item[order], gram[order]
    new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (gram[1:] != gram[:-1])][: len(item)])
    return item[new], gram[new], np.diff(np.r_[new, len(item)])


def _longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in stretches(batches):
        gram, counts = _symbols(s)
        times = np.bincount(gram[counts], minlength=SYMBOLS**ORDER)
        found = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), *_longs(times[found])], names=["gram", "c"])


def gram_counts(trusted: DataFrame, text: str = "text") -> DataFrame:
    """(gram, c) of symbols over all of ``trusted``."""
    counted = trusted.select(F.col(text).alias("text")).mapInArrow(_counts, "gram int, c long")
    return counted.groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(row, one: float | None = None) -> list[float]:
    """Discounts of counts 1, 2, and 3 or more, from the counts of counts n1 to n4; ``one`` sets the first."""
    n1, n2, n3, n4 = ((row[f"n{k}"] or 0) for k in (1, 2, 3, 4))
    found = [0.5, 0.5, 0.5]
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    # A context always leaves some probability to what it was not seen with.
    found = [min(max(d, 0.01), k) for d, k in zip(found, (1, 2, 3))]
    return found if one is None else [one, *found[1:]]


def _counts_of_counts(count: str) -> list[Column]:
    return [F.sum((F.col(count) == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]


def _cut(c: Column, discounts: list[float]) -> Column:
    one, two, more = discounts
    return F.when(c <= 0, 0.0).when(c == 1, one).when(c == 2, two).otherwise(more)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(n, gram, p, backoff): interpolated probabilities of the n-grams seen, and what each weighs as a context.

    ``backoff`` belongs to the context ``gram`` of n - 1 symbols and stands in rows of its own (p NULL).
    """
    by_order = {ORDER: counts.select("gram", "c")}
    for n in range(ORDER - 1, 0, -1):  # how many symbols stand before it
        shorter = (F.col("gram") % (1 << BITS * n)).alias("gram")
        by_order[n] = t.materialise(by_order[n + 1].groupBy(shorter).agg(F.count("*").alias("c")))
    rows, below = None, None
    for n in range(1, ORDER + 1):
        discounts = _discounts(by_order[n].agg(*_counts_of_counts("c")).first())
        discount = _cut(F.col("c"), discounts)
        split = by_order[n].withColumns(
            {"context": F.floor(F.col("gram") / SYMBOLS).cast("int"), "suffix": (F.col("gram") % (1 << BITS * (n - 1))).cast("int"), "cut": discount}
        )
        totals = split.groupBy("context").agg((F.sum("cut") / F.sum("c")).alias("backoff"), F.sum("c").alias("total"))
        joined = split.join(totals, "context")
        if below is None:
            lower = F.lit(1.0 / SYMBOLS)
        else:
            joined = joined.join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
            lower = F.col("lower")
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("backoff") * lower
        seen = t.materialise(joined.select(F.lit(n).alias("n"), F.col("gram").cast("int").alias("gram"), p.alias("p")))
        below = seen
        part = seen.select("n", "gram", "p", F.lit(None).cast("double").alias("backoff")).unionByName(
            totals.select(F.lit(n).alias("n"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("p"), "backoff")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _dense(model: dict) -> np.ndarray:
    """Log probability of every possible n-gram, from what was seen and the back-off weights."""
    p = np.full(1, 1.0 / SYMBOLS)
    for n in range(1, ORDER + 1):
        gram, seen, context, weight = model[n]
        size = 1 << BITS * n
        backoff = np.ones(size >> BITS)
        backoff[context] = weight
        full = np.repeat(backoff, SYMBOLS) * np.resize(p if n > 1 else np.full(SYMBOLS, p[0]), size)
        full[gram] = seen
        p = full
    return np.log(p).astype(np.float32)


def _broadcast(spark, model: DataFrame):
    """The spelling of n-grams of symbols, a table of 64^3 numbers in units of 1 / UNIT."""
    parts = {}
    found = model.toArrow().to_pandas()
    for n in range(1, ORDER + 1):
        own = found[found["n"] == n]
        seen, contexts = own[own["p"].notna()], own[own["p"].isna()]
        parts[n] = (seen["gram"].to_numpy(), seen["p"].to_numpy(), contexts["gram"].to_numpy(), contexts["backoff"].to_numpy())
    return spark.sparkContext.broadcast(np.rint(_dense(parts).astype(np.float64) * UNIT).astype(np.int64))


def _spelled(s: Stretch, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums up to each byte of the spelling and of the symbols."""
    gram, counts = _symbols(s)
    return np.r_[0, np.cumsum(np.where(counts, table[gram], 0))], np.r_[0, np.cumsum(counts)]


def _trusted_pairs(number: int, spelling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in stretches(batches):
            sums, _ = _spelled(s, spelling.value)
            first, second, _, word = _pairs(s)
            mine = second & np.uint64(SLICES - 1) == number
            first, second, word = first[mine], second[mine], word[mine]
            _, at, times = np.unique(pair_hash(first, second), return_index=True, return_counts=True)
            at_word = word[at]
            spelt = np.full(len(at), round(-math.log(SYMBOLS) * UNIT))
            own = at_word >= 0
            spelt[own] = sums[s.end[at_word[own]] + 1] - sums[s.start[at_word[own]]]
            yield pa.RecordBatch.from_arrays(_longs(first[at], second[at], spelt, times), names=["w1", "w2", "spelling", "c"])

    return run


# ``parts`` are the counts (w1, w2, c) of ``pairs`` by slice, and ``known`` makes rows of ``pairs`` of them.
Model = namedtuple("Model", "words pairs spelt discounts parts known")


def pair_counts(trusted: DataFrame, spelling, number: int) -> DataFrame:
    """(w1, w2, spelling, c): the pairs whose second word is in slice ``number``, and the spelling of that word."""
    counted = trusted.select("text").mapInArrow(_trusted_pairs(number, spelling), "w1 long, w2 long, spelling long, c long")
    return counted.groupBy("w1", "w2").agg(F.max("spelling").alias("spelling"), F.sum("c").alias("c"))


def _stacked(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def word_model(slices: Iterator[DataFrame], one: float | None = None) -> Model:
    """What :func:`pair_counts` gives, slice by slice, as ``words``, a table, and ``pairs``, which join what is known of their words.

    ``words`` (word, times, whole, less): what a word adds to its spelling and weighs as a context; less is without one occurrence.
    ``pairs`` (pair, c, total, given): count, that of the context, and the probability of the second word without the pair.
    ``spelt`` is the log weight of the spelling, ``discounts`` those of pairs; ``one`` sets that of pairs seen once, and at 1, which
    leaves them nothing, they are not stored.
    """
    pairs, ones, contexts, counts = [], [], [], []
    for part in slices:
        part = t.materialise(part)
        pairs.append(t.materialise(part.filter(F.col("c") > (1 if one == 1 else 0)).select("w1", "w2", "c")))
        ones.append(t.materialise(part.groupBy("w2").agg(F.count("*").alias("n"), F.max("spelling").alias("spelling"))))
        by_count = [F.sum(F.expr(f"CAST({rule} AS BIGINT)")).alias(name) for name, rule in (("s1", "c = 1"), ("s2", "c = 2"), ("s3", "c > 2"))]
        contexts.append(t.materialise(part.groupBy("w1").agg(F.sum("c").alias("total"), *by_count)))
        counts.append(part.agg(*_counts_of_counts("c")).first())
        t.drop(part)
        t.let_go(part.sparkSession)
    d = _discounts({f"n{k}": sum(row[f"n{k}"] or 0 for row in counts) for k in (1, 2, 3, 4)}, one)
    summed = _stacked(contexts).groupBy("w1").agg(*[F.sum(c).alias(c) for c in ("total", "s1", "s2", "s3")])
    backoff = (F.col("s1") * d[0] + F.col("s2") * d[1] + F.col("s3") * d[2]) / F.col("total")
    context = t.materialise(summed.select(F.col("w1").alias("word"), "total", backoff.alias("backoff")))
    one = _stacked(ones).withColumnRenamed("w2", "word")  # every slice has words of its own
    row = one.agg(*_counts_of_counts("n"), F.sum("n").alias("whole")).first()
    d1, whole = _discounts(row), row["whole"]
    spelt = math.log(one.agg(F.sum(_cut(F.col("n"), d1))).first()[0] / whole)
    other = F.col("spelling") / UNIT + spelt

    def p(n: Column) -> Column:
        return (n - _cut(n, d1)) / whole + F.exp(other)

    def units(weight: Column) -> Column:
        return F.rint(F.coalesce(weight, F.lit(0.0)) * UNIT).cast("long")

    both = one.join(context, "word", "full_outer")
    words = both.select(
        "word",
        F.coalesce("total", "n").alias("times"),
        units(F.log(p(F.col("n"))) - other) + units(F.log("backoff")),
        units(F.log(p(F.col("n") - 1)) - other) + units(F.when(F.col("total") > 1, F.log("backoff"))),
    )
    words = t.materialise(words.toDF("word", "times", "whole", "less"))
    of_second = t.materialise(one.select(F.col("word").alias("w2"), p(F.col("n")).alias("p")))
    t.drop(*ones, *contexts)

    def known(part: DataFrame) -> DataFrame:
        met = part.join(context.withColumnRenamed("word", "w1"), "w1").join(of_second, "w2")
        return met.select(F.xxhash64("w1", "w2").alias("pair"), "c", "total", (F.col("backoff") * F.col("p")).alias("given"))

    return Model(words, known(_stacked(pairs)), spelt, d, pairs, known)


def _most_frequent(table: DataFrame, count: str) -> DataFrame:
    """At most ``HEAVY`` rows: those whose count reaches the least power of two that so many reach."""
    size = F.floor(F.log2(F.col(count).cast("double"))).cast("int")
    held, least = 0, 64
    for row in sorted(table.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):  # 64 rows at most
        held += row["count"]
        if held > HEAVY:
            break
        least = row["size"]
    return table.filter(size >= least)


def _sorted_columns(table: DataFrame, key: str) -> list[np.ndarray]:
    """Sorted keys, where those with each prefix begin, and the other columns."""
    columns = [c.to_numpy() for c in t.collected(table).combine_chunks().columns]
    at = table.columns.index(key)
    order = np.argsort(columns[at].view(np.uint64))
    keys = columns[at][order].view(np.uint64)
    first = np.searchsorted(keys, np.arange(1 << PREFIX, dtype=np.uint64) << np.uint64(64 - PREFIX)).astype(np.int32)
    return [keys, first, *(c[order] for i, c in enumerate(columns) if i != at)]


def _found(keys: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key, and whether it is there. Keys are hashes, so few share a prefix."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    last = len(keys) - 1
    at = np.minimum(first[wanted >> np.uint64(64 - PREFIX)], last)
    moving = np.flatnonzero((keys[at] < wanted) & (at < last))
    while len(moving):
        at[moving] += 1
        moving = moving[(keys[at[moving]] < wanted[moving]) & (at[moving] < last)]
    return at, keys[at] == wanted


def _broadcast_filter(table: DataFrame, key: str):
    """A blocked Bloom filter of the hashes ``key``, whose own bits place them, for tasks to apply before they hand rows on; None above the byte limit.

    Executors keep a file of each, so there are as many blocks as the keys need and not the next power of two.
    """
    blocks = max(1, math.ceil(table.count() / KEYS_PER_BLOCK))
    if not broadcastable(blocks):
        return None
    hashed = F.col(key)
    block = F.pmod(F.shiftrightunsigned(hashed, SLICES.bit_length()), F.lit(blocks).cast("long"))
    bits = F.lit(0).cast("long")
    for k in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(hashed, 40 + 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    used = t.collected(table.groupBy(block.alias("block")).agg(F.bit_or(bits).alias("bits")))
    words = np.zeros(blocks, np.uint64)
    words[used.column("block").to_numpy()] = used.column("bits").to_numpy().view(np.uint64)
    return table.sparkSession.sparkContext.broadcast(words)


def _may_hold(words: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Which grams may be in the filter: all that went in, and few others."""
    word = words[(gram >> np.uint64(SLICES.bit_length())) % np.uint64(len(words))]
    there = np.ones(len(gram), bool)
    for k in range(BITS_PER_KEY):
        there &= ((word >> ((gram >> np.uint64(40 + 6 * k)) & np.uint64(63))) & np.uint64(1)).astype(bool)
    return there


def _pair_weight(c, total, given, discounts):
    """What a pair adds over its second word, in units; for arrays."""
    cut = np.where(c <= 0, 0.0, np.where(c == 1, discounts[0], np.where(c == 2, discounts[1], discounts[2])))
    return np.rint(np.log1p(np.maximum(c - cut, 0.0) / total / given) * UNIT).astype(np.int64)


def _documents(spelling, heavy, discounts):
    """Words, symbols and what needs no join, a row for each document, or stretch of a long one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, first_word, _, whole, less), (pairs, first_pair, c, total, given) = heavy.value
        for s in stretches(batches):
            n = len(s.rows)
            ends = np.r_[s.begin[1:], len(s.data)]
            sums, symbols = (x[ends] - x[s.begin] for x in _spelled(s, spelling.value))
            first, second, pair_item, number = _pairs(s)
            n_words = np.bincount(pair_item, minlength=n)
            sums = sums + np.bincount(pair_item[number < 0], minlength=n) * round(-math.log(SYMBOLS) * UNIT)
            full, short = sums.copy(), sums.copy()
            word, item = _words(s, second, pair_item)
            at, there = _found(words, first_word, word)
            np.add.at(full, item[there], whole[at[there]])
            np.add.at(short, item[there], less[at[there]])
            pair = pair_hash(first, second)
            _, there = _found(pairs, first_pair, pair)
            item, pair, times = _grouped(pair_item[there], pair[there])
            at, _ = _found(pairs, first_pair, pair)
            np.add.at(full, item, times * _pair_weight(c[at], total[at], given[at], discounts))
            np.add.at(short, item, times * _pair_weight(c[at] - times, total[at], given[at], discounts))
            own = [s.batch.column(name).take(pa.array(s.rows)) for name in ("_td_id", "_td_hash", "_td_lang")]
            out = [*own, pa.array(s.opens), *_longs(symbols, n_words, full, short)]
            yield pa.RecordBatch.from_arrays(out, names=["_td_id", "_td_hash", "_td_lang", "opens", "n_symbols", "n_words", "whole", "less"])

    return run


def _document_grams(heavy, number: int, known_grams, repeated_grams):
    """Those of slice ``number``; of a trusted document only what ``repeated_grams`` may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [table[:2] for table in heavy.value]
        for s in stretches(batches):
            first, second, item, _ = _pairs(s)
            trusted = s.batch.column("trusted").to_numpy(zero_copy_only=False)[s.rows].astype(bool)
            word, word_item = _words(s, second, item)
            mine, of_word = np.flatnonzero(second & np.uint64(SLICES - 1) == number), np.flatnonzero(word & np.uint64(SLICES - 1) == number)
            grams, items = [], []
            for gram, own, table in zip((word[of_word], pair_hash(first[mine], second[mine])), (word_item[of_word], item[mine]), known):
                for which, wanted in ((~trusted[own], known_grams), (trusted[own], repeated_grams)):
                    at = np.flatnonzero(which)
                    if wanted is not None:
                        at = at[_may_hold(wanted.value, gram[at])]
                    at = at[~_found(*table, gram[at])[1]]
                    grams.append(gram[at])
                    items.append(own[at])
            item, gram, times = _grouped(np.concatenate(items), np.concatenate(grams))
            doc = s.batch.column("doc").take(pa.array(s.rows[item]))
            yield pa.RecordBatch.from_arrays([doc, *_longs(gram, times)], names=["doc", "gram", "times"])

    return run


def log_probabilities(docs: DataFrame, model: Model, spelling) -> DataFrame:
    """(_td_id, _td_hash, _td_lang, n_symbols, n_words, whole, less): log probabilities in units, with and without the document's own counts.

    ``docs`` has _td_id, _td_hash, _td_lang and text, and may have trusted (boolean): of those documents only ``less`` is meant.
    The counts of ``model.parts`` are deleted as they are used, if the :class:`Tables` entered last hold them.
    """
    kinds = dict(docs.dtypes)
    trusted = F.col("trusted") if "trusted" in kinds else F.lit(False)
    words, pairs = _most_frequent(model.words, "times"), model.known(_most_frequent(_stacked(model.parts), "c"))
    heavy = docs.sparkSession.sparkContext.broadcast((_sorted_columns(words, "word"), _sorted_columns(pairs, "pair")))
    schema = f"_td_id {kinds['_td_id']}, _td_hash long, _td_lang {kinds['_td_lang']}, opens boolean, n_symbols long, n_words long, whole long, less long"
    rows = docs.mapInArrow(_documents(spelling, heavy, model.discounts), schema)
    doc = F.xxhash64("_td_id", "_td_hash", "_td_lang").alias("doc")
    sums = ("n_symbols", "n_words", "whole", "less")
    # The stretches of long texts, and repeated rows, are one row; ``copies`` tells how many rows a document is.
    own = rows.groupBy("_td_id", "_td_hash", "_td_lang").agg(F.sum(F.col("opens").cast("long")).alias("copies"), *[F.sum(c).alias(c) for c in sums])
    parts = [t.materialise(own.select("*", doc))]
    texts = docs.select(doc, "text", trusted.alias("trusted"))
    entry = "doc long, gram long, times long"

    times = F.col("times")

    def weight(c: Column) -> Column:
        share = F.greatest(c - _cut(c, model.discounts), F.lit(0.0)) / F.col("base")
        # As _pair_weight has it; round() goes through decimals.
        return F.rint(F.log1p(share) * UNIT).cast("long")

    entries = model.words.withColumnRenamed("word", "gram").drop("times")
    # A pair's weights are worked out once, with all of its count and with one less; only a document that repeats it needs others.
    whole = times * F.col("whole")
    less = times * F.when(F.col("c").isNull() | (times == 1), F.col("less")).otherwise(weight(F.col("c") - times))
    for number, counted in enumerate(model.parts):
        based = model.known(counted).select(F.col("pair").alias("gram"), "c", (F.col("total") * F.col("given")).alias("base"))
        own_pairs = t.materialise(based.select("*", weight(F.col("c")).alias("whole"), weight(F.col("c") - 1).alias("less")))
        t.drop(counted)
        table = entries.filter(F.col("gram").bitwiseAND(SLICES - 1) == number).unionByName(own_pairs, allowMissingColumns=True)
        # As many rows as the corpus has words, and a model of their order: only its filters are broadcast, by size.
        filters = [_broadcast_filter(rows, "gram") for rows in (table, table.filter("c IS NULL OR c > 1"))]
        shares = []
        for share in range(SHARES):
            grams = texts.filter(F.pmod(F.col("doc"), F.lit(SHARES)) == share).mapInArrow(_document_grams(heavy, number, *filters), entry)
            met = grams.join(table.hint("shuffle_hash"), "gram")
            shares.append(t.materialise(met.groupBy("doc").agg(F.sum(whole).alias("whole"), F.sum(less).alias("less"))))
        parts.append(_stacked(shares))
        t.drop(own_pairs)
        for sent in filters:
            if sent is not None:
                sent.destroy()  # a file on every executor
        t.let_go(docs.sparkSession)
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part.select("doc", F.col("whole").alias("more"), F.col("less").alias("more_less")), "doc", "left")
        joined = joined.withColumns({"whole": F.col("whole") + F.coalesce("more", F.lit(0)), "less": F.col("less") + F.coalesce("more_less", F.lit(0))}).drop("more", "more_less")
    spelt = F.round(F.col("n_words") * model.spelt * UNIT).cast("long")
    one = [F.expr(f"{c} div greatest(copies, 1)").alias(c) for c in ("n_symbols", "n_words")]
    found = joined.withColumns({c: F.col(c) + spelt for c in ("whole", "less")})
    found = found.select("_td_id", "_td_hash", "_td_lang", "copies", *one, *[(F.col(c) / F.greatest("copies", F.lit(1))).alias(c) for c in ("whole", "less")])
    found = t.materialise(found)
    heavy.destroy()
    return found


def fitted(texts: DataFrame, one: float | None = 1.0) -> tuple[Model, object]:
    """The model of the ``texts`` (text), and the broadcast spelling. ``one`` as in :func:`word_model`; None estimates it."""
    spelling = _broadcast(texts.sparkSession, kneser_ney(t.materialise(gram_counts(texts))))
    return word_model((pair_counts(texts, spelling, number) for number in range(SLICES)), one), spelling


def thresholds(checked: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, float | None]:
    """(_td_of, own), the threshold of each language in ``checked`` (_td_lang, perplexity), and that of a language without a row there."""
    at_levels = f"percentile_approx({{}}, array({', '.join(f'{x}D' for x in LEVELS)}), 10000)"

    def level(n: Column) -> Column:
        # One or two documents alone never reach above it, and it grows into the quantile.
        return F.greatest(F.lit(LEVELS[0]), F.lit(quantile) - F.lit(1.5) / (n + 1))

    def at(values: Column, where: Column) -> Column:
        found = F.get(values, F.lit(len(LEVELS) - 1))
        for i in reversed(range(len(LEVELS) - 1)):
            low, high = LEVELS[i], LEVELS[i + 1]
            between = F.get(values, F.lit(i)) + (F.get(values, F.lit(i + 1)) - F.get(values, F.lit(i))) * (where - low) / (high - low)
            found = F.when(where <= high, between).otherwise(found)
        return found

    logs = checked.select(F.col("_td_lang").alias("_td_of"), F.log("perplexity").alias("x"))
    own = logs.groupBy("_td_of").agg(F.expr(at_levels.format("x")).alias("values"), F.count("*").alias("n"))
    own = own.select("_td_of", "n", F.get("values", F.lit(0)).alias("center"), at(F.col("values"), level(F.col("n"))).alias("upper"))
    own = t.materialise(own)
    centers = own.select(F.col("_td_of").alias("_td_like"), "center")
    off = logs.join(centers, logs["_td_of"].eqNullSafe(centers["_td_like"])).select((F.col("x") - F.col("center")).alias("off"))
    pooled = off.agg(F.expr(at_levels.format("off")).alias("values"), F.expr("percentile_approx(abs(off), 0.5D, 10000)").alias("mad"), F.count("*").alias("n"))
    row = pooled.select(at(F.col("values"), level(F.col("n"))).alias("upper"), "mad").first()
    if row["mad"] is None:
        return own.select("_td_of", F.lit(None).cast("double").alias("own")), None
    # Nor narrower than a normal distribution with this median deviation, its upper quartile, would have it.
    widest = max(row["upper"], row["mad"] * NormalDist().inv_cdf(quantile) / NormalDist().inv_cdf(0.75))
    reach, needed = F.col("upper") - F.col("center"), 1 / (1 - quantile)
    mixed = (F.col("n") * reach + needed * widest) / (F.col("n") + needed)
    found = own.select("_td_of", F.exp(F.col("center") + F.greatest(reach, mixed)).alias("own"))
    return found, found.agg(F.max("own")).first()[0]


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with trusted: whether _td_id is one of ``ids`` (_td_key_id), without shuffling the texts.

    A Bloom filter finds all of them; the few others that pass it are found by an exact join of ids and broadcast. Too many
    ids for a filter leave every document unmarked.
    """
    blocks = blocks_for(ids.count())
    if not broadcastable(blocks):
        return docs.withColumn("trusted", F.lit(False))
    rows = docs.select(F.col("_td_id").alias("_td_key_id")).filter("_td_key_id IS NOT NULL")
    wrong = t.materialise(possible(rows, ids, ["_td_key_id"]).join(ids, "_td_key_id", "left_anti").distinct())
    bits = F.broadcast(bloom_filter(ids.select(F.xxhash64("_td_key_id").alias("_td_key")), "_td_key", blocks).toDF("_td_slice", "_td_words"))
    keyed = docs.withColumn("_td_key", F.xxhash64("_td_id"))
    met = keyed.withColumn("_td_slice", slice_of(F.col("_td_key"), blocks)).join(bits, "_td_slice")
    passed = F.col("_td_id").isNotNull() & holds(F.col("_td_words"), F.col("_td_key"), blocks)
    others = F.broadcast(wrong.select("_td_key_id", F.lit(True).alias("_td_wrong")))  # 0.15 % of the ids
    met = met.withColumn("_td_passed", passed).join(others, F.col("_td_id") == F.col("_td_key_id"), "left")
    return met.select(*docs.columns, (F.col("_td_passed") & F.col("_td_wrong").isNull()).alias("trusted"))


def quality_scores(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(_td_id, _td_hash, lang, n_symbols, perplexity, threshold, kept), a row for each of ``docs``; ``trusted`` holds the ids of trusted documents."""
    keyed = docs.select(*t.row_key(text, key), F.col(lang).alias("_td_lang"), F.col(text).alias("text"))
    with t.Tables() as tables, t.small_batches(docs.sparkSession, ARROW_ROWS):
        ids = t.materialise(trusted.select(F.col(key).alias("_td_key_id")).filter("_td_key_id IS NOT NULL").distinct())
        named = docs.select(F.col(key).alias("_td_key_id"), F.col(text).alias("text"))
        texts = possible(named, ids, ["_td_key_id"]).join(ids, "_td_key_id").select("text").filter(F.col("text").rlike(t.WORD))
        texts = t.materialise(texts)
        learnt = not texts.isEmpty()
        if learnt:
            model, spelling = fitted(texts, one=None)
            t.drop(texts)
        else:
            model, spelling = _blank_model(docs.sparkSession)
        scored = log_probabilities(_marked(keyed, ids), model, spelling)
        marked = scored.join(ids, F.col("_td_id") == F.col("_td_key_id"), "left").withColumn("known", F.col("_td_key_id").isNotNull())
        total = F.when(F.col("known"), F.col("less")).otherwise(F.col("whole"))
        perplexity = F.when(F.col("n_symbols") > 0, F.exp(-total / UNIT / F.col("n_symbols"))) if learnt else F.lit(None).cast("double")
        judged = t.materialise(marked.select("_td_id", "_td_hash", "_td_lang", "copies", "n_symbols", "known", perplexity.alias("perplexity")))
        own, other = thresholds(judged.filter("known AND n_symbols > 0"), quantile)
        joined = judged.join(own, judged["_td_lang"].eqNullSafe(own["_td_of"]), "left")
        threshold = F.coalesce("own", F.lit(other).cast("double"))
        below = F.coalesce(F.col("perplexity") <= threshold, F.lit(not learnt)) & (F.col("n_symbols") > 0)
        result = t.materialise(joined.select("_td_id", "_td_hash", "_td_lang", "copies", "n_symbols", "perplexity", threshold.alias("threshold"), below.alias("kept")))
        tables.keep(result)
    columns = [F.col("_td_lang").alias("lang"), "n_symbols", "perplexity", "threshold", "kept"]
    once = result.filter("copies = 1").select("_td_id", "_td_hash", *columns)
    again = result.filter("copies > 1")
    rows = keyed.drop("text").withColumnRenamed("_td_lang", "_td_of")
    met = rows.join(again, t.same_key(rows, again) & rows["_td_of"].eqNullSafe(again["_td_lang"]))
    return once.unionByName(met.select(rows["_td_id"], rows["_td_hash"], *columns))


def _blank_model(spark) -> tuple[Model, object]:
    """Nothing is known: only words and symbols are counted."""
    words = spark.createDataFrame([], "word long, times long, whole long, less long")
    pairs = spark.createDataFrame([], "pair long, c long, total long, given double")
    return Model(words, pairs, 0.0, [0.5, 0.5, 0.5], [pairs] * SLICES, lambda part: part), spark.sparkContext.broadcast(np.zeros(SYMBOLS**ORDER, np.int64))


def remove_low_quality(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The ``docs`` that are kept; all columns."""
    gone = quality_scores(docs, trusted, quantile, text, key, lang).filter("NOT kept").select("_td_id", "_td_hash", F.col("lang").alias("_td_lang")).distinct()
    keyed = docs.withColumns(dict(zip(("_td_id", "_td_hash"), t.row_key(text, key))))
    same = t.same_key(keyed, gone) & keyed[lang].eqNullSafe(gone["_td_lang"])
    return keyed.join(gone, same, "left_anti").select(*docs.columns)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic."""
    return labels.filter("quality = 1 AND toxic = 0").select("doc_id").distinct()


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = quality_scores(docs, trusted_ids(t.read(spark, sf_dir, "labels")))
    return found.select(
        F.col("_td_id").alias("doc_id"), "lang", "n_symbols", F.round("perplexity", 4).alias("perplexity"), F.round("threshold", 4).alias("threshold"), "kept"
    )
