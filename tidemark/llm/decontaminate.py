"""Benchmark decontamination: a broadcast hash set of test n-grams against every training window.

A document is normalised, cut into words and hashed in blocks of half a window, one after another, inside one
projection. Wherever a window starts, one whole block lies in its first words, so the blocks stream through a
broadcast semi join with the benchmark's runs of as many words, and windows are made, each once, only around the
blocks that pass. These stream through a broadcast hash join with the benchmark's, and the words
are compared there, so a hash collision is no hit. Only hits are shuffled. The set is broadcast
when a count of it stays within ``BROADCAST_WINDOWS``; a larger set is joined by shuffle with the
same result, every window's words travelling along.

Defined cases: a NULL or empty text has no words and no hits. An item without words has no window.
Repeated rows each get their own result; rows with the same id and text share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000
# Fixed value: what separates the words of the contract after folding A-Z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(text: Column) -> Column:
    """A-Z as a-z. A text of ASCII alone, with as many bytes as characters, is faster with ``lower``, which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(t.ascii_lower(text))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(_folded(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def _hash(w: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, start + k) for k in range(size)])


def _hashes(word_list: Column, size: int, step: int = 1) -> Column:
    """The hash of the run of ``size`` words at every ``step``-th word; empty where there are fewer."""

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size, F.lit(step))
        return F.transform(starts, lambda i: _hash(w, i, size))

    return F.when(F.size(word_list) < size, F.array().cast("array<bigint>")).otherwise(t.let(word_list, windows))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """(size, words, items): each distinct window once, with the items that hold it."""
    cut = benchmark.select(F.col(item).cast("string").alias("item"), tokens(F.col(text)).alias("w"))
    size = F.least(F.size("w"), F.lit(window))
    runs = cut.filter(F.size("w") > 0).select(
        "item",
        size.alias("size"),
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " "))
        ).alias("words"),
    )
    return runs.groupBy("size", "words").agg(F.collect_set("item").alias("items"))


def _near_blocks(cut: DataFrame, tested: DataFrame, size: int) -> DataFrame:
    """(_td_id, _td_hash, w, start): each start of ``size`` words of ``cut`` once, where the first whole block may be one of ``tested``.

    Blocks of half the size, rounded up, lie end to end, so the first that begins in a window ends in it. Its offset there is less than its own size.
    """
    block = (size + 1) // 2
    runs = F.transform(F.sequence(F.lit(0), F.lit(block - 1)), lambda i: _hash(F.col("w"), i, block))
    known = tested.select(F.explode(runs).alias("part")).distinct()
    blocks = cut.select("_td_id", "_td_hash", "w", F.posexplode(_hashes(F.col("w"), block, block)).alias("number", "part"))
    met = blocks.join(F.broadcast(known), "part", "left_semi")
    first = F.greatest(F.col("number") * block - (block - 1), F.lit(0))
    last = F.least(F.col("number") * block, F.size("w") - size)
    return met.select("_td_id", "_td_hash", "w", F.explode(F.when(first <= last, F.sequence(first, last))).alias("start"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, start, size, items): every occurrence of a test window in a document."""
    tests = t.materialise(benchmark_windows(benchmark, window, text))
    # At most ``window`` different sizes, and one number.
    sizes = [row["size"] for row in tests.select("size").distinct().collect()]
    small = tests.count() <= BROADCAST_WINDOWS
    cut = docs.select(*t.row_key(text, key), tokens(F.col(text)).alias("w"))
    found = None
    for size in sorted(sizes):
        split = F.split("words", " ")
        tested = tests.filter(F.col("size") == size)
        own = tested.select(_hash(split, F.lit(0), size).alias("h"), F.col("words").alias("test"), "items")
        here = F.array_join(F.slice("w", F.col("start") + 1, size), " ")
        if small:
            every = _near_blocks(cut, tested.select(split.alias("w")), size).withColumn("h", _hash(F.col("w"), F.col("start"), size))
            met = every.join(F.broadcast(own), (every["h"] == own["h"]) & (here == own["test"]))
        else:
            every = cut.select("_td_id", "_td_hash", "w", F.posexplode(_hashes(F.col("w"), size)).alias("start", "h"))
            every = every.select("_td_id", "_td_hash", "start", "h", here.alias("here"))
            met = every.join(own, (every["h"] == own["h"]) & (every["here"] == own["test"]))
        met = met.select("_td_id", "_td_hash", "start", F.lit(size).alias("size"), "items")
        found = met if found is None else found.unionByName(met)
    if found is None:
        nothing = "CAST(NULL AS INT) AS start, CAST(NULL AS INT) AS size, CAST(NULL AS ARRAY<STRING>) AS items"
        return cut.filter(F.lit(False)).selectExpr("_td_id", "_td_hash", nothing.split(", ")[0], *nothing.split(", ")[1:])
    return found


def hit_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, positions, items) of the documents with hits: positions of hit words, items as sorted strings.

    One row gathers what one document holds of the benchmark, which its own length bounds.
    """
    one = hits(docs, benchmark, window, text, key).dropDuplicates(["_td_id", "_td_hash", "start", "size"])
    # A position once for each window that covers it; the set keeps each once.
    grouped = one.groupBy("_td_id", "_td_hash").agg(
        F.collect_list(F.struct("start", "size")).alias("runs"), F.collect_set("items").alias("sets")
    )
    covered = F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1)))
    return grouped.select(
        "_td_id",
        "_td_hash",
        F.array_sort(F.array_distinct(covered)).alias("positions"),
        F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), a row for each of ``docs``."""
    own = docs.select(*t.row_key(text, key), F.size(tokens(F.col(text))).cast("long").alias("n_words"))
    found = hit_words(docs, benchmark, window, text, key)
    joined = own.join(found, t.same_key(own, found), "left")
    n_hit = F.coalesce(F.size("positions"), F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        own["_td_id"].alias(key),
        "n_words",
        F.when(F.col("positions").isNull(), F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.col("positions").isNotNull().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without those that hold a test window; all columns kept."""
    keyed = docs.withColumns(dict(zip(("_td_id", "_td_hash"), t.row_key(text, key))))
    bad = hits(docs, benchmark, window, text, key).select("_td_id", "_td_hash").distinct()
    return keyed.join(bad, t.same_key(keyed, bad), "left_anti").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the hit words cut out of the text; a changed text is its other words, joined by blanks."""
    keyed = docs.withColumns(dict(zip(("_td_id", "_td_hash"), t.row_key(text, key))))
    found = hit_words(docs, benchmark, window, text, key).withColumnRenamed("positions", "_td_positions")
    joined = keyed.join(found, t.same_key(keyed, found), "left")
    # Both ends of a maximal run of clean words, between sorted hit positions.
    w, p = tokens(keyed[text]), F.concat(F.array(F.lit(-1)), F.col("_td_positions"), F.array(F.size(tokens(keyed[text]))))

    def clean(word_list: Column) -> Column:
        return t.let(
            p,
            lambda q: F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.size(q) - 1),
                    lambda k: F.slice(word_list, F.get(q, k - 1) + 2, F.get(q, k) - F.get(q, k - 1) - 1),
                )
            ),
        )

    cut = F.when(F.col("_td_positions").isNull(), keyed[text]).otherwise(F.array_join(t.let(w, clean), " "))
    return joined.select(*[cut.alias(text) if c == text else keyed[c] for c in docs.columns])


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, t.read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


SQL = r"""
WITH fold AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), tests AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), tw AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT item, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM tests WHERE len(w) > 0)
), dw AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM fold, (SELECT DISTINCT m FROM tw) WHERE len(w) >= m)
), hit AS (SELECT dw.r, dw.i, dw.m, tw.item FROM dw JOIN tw ON dw.m = tw.m AND dw.k = tw.k),
n AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       n.n IS NOT NULL AS contaminated
FROM fold LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""
