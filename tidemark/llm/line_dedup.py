"""Line dedup: a segment-partition edit join over all lines.

How many edits two lines may differ by follows from the length of the shorter one (``EDITS``). A line whose
length allows ``edits`` is cut into ``edits + 1`` segments. A line as long or longer within ``edits`` edits of it
holds one segment unchanged, at a place that the multi-match-aware bounds narrow to a few substrings. So
each line probes, for every length it may match, the substrings that could be a segment of a line of
that length; a segment of its own is a probe as well, of its own length. Equal keys (segment
number, length, substring) make a bucket. The first pass aggregates keys, map side first, to find
buckets with two lines or more; the second pass keeps only lines in those, by number, and a third
brings their texts. There a line is checked with Spark's banded edit distance, first against the earliest line of its bucket,
and where that fails against every earlier one. The join emits only true matches.

A line is a duplicate if an equal line, or one within that many edits of it, stands earlier: in a
document with a smaller id, or above it. Lines are judged on the input, not on what is left.
Spark's edit distance is banded by rows of characters rather than by machine words; results are
those of a bit-parallel check.

Defined cases: a line without a word is never a duplicate and stays. A line
shorter than every length in ``edits`` allows none: it matches only when equal. NULL and empty texts have no lines with words. Ids are integers; a NULL id
comes last. Rows that share an id are one document: a line of theirs at the same place is not its
own duplicate. Equality of lines is that of two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as t
from tidemark.llm.bloom import possible

Edits = tuple[tuple[int, int], ...]
# (characters, edits): a pair whose shorter line has so many characters, or more, may differ by so many edits.
EDITS: Edits = ((12, 1), (24, 2))


def occurrences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, line_no, place, h1, h2, line): the lines that have a word."""
    each = docs.select(*t.row_key(text, key), F.posexplode(t.lines(F.col(text))).alias("line_no", "line"))
    last = F.lit((1 << 63) - 1).cast("decimal(20,0)")
    place = F.coalesce(F.col("_td_id").cast("decimal(20,0)"), last) * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no")
    return each.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        "_td_id",
        "_td_hash",
        "line_no",
        place.cast("decimal(32,0)").alias("place"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
        "line",
    )


def _allowed(edits: Edits, length: Column) -> Column:
    """The edits that a shorter line of ``length`` characters allows."""
    allowed = F.lit(0)
    for least, many in sorted(edits):
        allowed = F.when(length >= least, many).otherwise(allowed)
    return allowed


def _probes(edits: Edits) -> Column:
    """Every (low, high, parts, shorter, part, shift): the line looks for a match ``shorter`` characters shorter, of
    low <= length < high, whose segment ``part`` of ``parts`` stands at ``shift``."""
    ranges = sorted(edits)
    ends = [low for low, _ in ranges[1:]] + [1 << 31]
    names = ("low", "high", "parts", "shorter", "part", "shift")
    return F.array(
        *[
            F.struct(*[F.lit(v).cast("long").alias(name) for name, v in zip(names, (low, high, many + 1, shorter, part, shift))])
            for (low, many), high in zip(ranges, ends)
            for shorter in range(many + 1)
            for part in range(many + 1)
            for shift in range(max(-part, shorter - many + part), min(part, shorter + many - part) + 1)
        ]
    )


def _keyed(lines: DataFrame, edits: Edits) -> DataFrame:
    """Every key of a line: ``own`` for its segments, the others for what it may match.

    The probes are rows and the key one small expression over them, which the JVM compiles; an array of all keys
    is too large a method for that. Lines in ASCII are cut as bytes, which needs no count of characters.
    """
    counted = lines.withColumn("n", F.length("line")).filter(F.col("n") >= min(least for least, _ in edits))
    raw = F.expr("IF(octet_length(line) = n, CAST(line AS BINARY), NULL)")
    each = counted.withColumn("raw", raw).select("*", F.inline(_probes(edits)))
    each = each.withColumn("length", F.expr("n - shorter")).filter("length >= low AND length < high")
    each = each.withColumns({"base": F.expr("length div parts"), "over": F.expr("part - parts + length % parts")})
    each = each.withColumns(
        {"size": F.expr("CAST(base + IF(over >= 0, 1, 0) AS INT)"), "at": F.expr("CAST(part * base + greatest(0, over) + shift AS INT)")}
    )
    piece = "IF(raw IS NULL, CAST(substring(line, at + 1, size) AS BINARY), substring(raw, at + 1, size))"
    return each.filter("at >= 0 AND at + size <= n").select(
        F.expr(f"xxhash64(part, length, {piece})").alias("key"),
        F.expr("shorter = 0 AND shift = 0").alias("own"),
        "h1",
        "h2",
    )


def near_duplicates(lines: DataFrame, edits: Edits = EDITS) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within the edits that the shorter of the two allows.

    A line has a dozen keys, so its text is not shuffled with them: it joins the members of a bucket by its hashes.
    """
    keyed = _keyed(lines, edits)
    shared = (
        keyed.groupBy("key")
        .agg(F.max("own").alias("own"), F.min("h1").alias("low"), F.max("h1").alias("high"))
        .filter("own AND low <> high")
        .select("key")
    )
    shared = t.materialise(shared)
    members = possible(keyed, shared, ["key"]).groupBy("key", "h1", "h2").agg(F.max("own").alias("own"))
    members = t.materialise(members.join(shared, "key"))
    ids = t.materialise(members.select("h1", "h2").distinct())
    texts = possible(lines, ids, ["h1", "h2"]).groupBy("h1", "h2", "line").agg(F.min("place").alias("place"))
    members = t.materialise(members.join(texts, ["h1", "h2"]))
    in_bucket = Window.partitionBy("key").orderBy("place", "h1", "h2")
    distance = F.levenshtein("line", "other", max(many for _, many in edits))
    close = (distance >= 0) & (distance <= _allowed(edits, F.least(F.length("line"), F.length("other"))))
    begun = members.withColumn("other", F.first("line").over(in_bucket)).withColumn("before", F.first("place").over(in_bucket))
    matched = begun.filter(F.col("before") < F.col("place")).filter(close).select("h1", "h2").distinct()
    matched = t.materialise(matched)
    others = members.select(
        "key", F.col("own").alias("other_own"), F.col("place").alias("before"), F.col("line").alias("other")
    )
    open_ones = members.join(matched, ["h1", "h2"], "left_anti")
    rest = open_ones.join(
        others,
        (open_ones["key"] == others["key"]) & (F.col("before") < F.col("place")) & (F.col("own") | F.col("other_own")) & close,
    )
    return matched.union(rest.select("h1", "h2")).distinct()


def removed_lines(docs: DataFrame, edits: Edits = EDITS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_td_id, _td_hash, n_lines, gone): lines with words in each document, and the numbers of the duplicates."""
    found = occurrences(docs, text, key)
    first = t.materialise(found.groupBy("h1", "h2").agg(F.min("place").alias("place")))
    near = near_duplicates(found, edits).withColumn("near", F.lit(True))
    verdicts = first.join(near, ["h1", "h2"], "left").withColumnRenamed("place", "first")
    again = (F.col("place") > F.col("first")) | F.coalesce("near", F.lit(False))
    return (
        found.drop("line")
        .join(verdicts, ["h1", "h2"])
        .groupBy("_td_id", "_td_hash")
        .agg(
            F.count_distinct("line_no").alias("n_lines"),
            F.collect_set(F.when(again, F.col("line_no"))).alias("gone"),
        )
    )


def line_dedup(docs: DataFrame, edits: Edits = EDITS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without duplicate lines; a document that loses every line with a word goes.

    The lines to cut are a table of their own, so no shuffle files of the search are left when whole texts are shuffled.
    """
    keyed = docs.withColumns(dict(zip(("_td_id", "_td_hash"), t.row_key(text, key))))
    gone = removed_lines(docs, edits, text, key).filter(F.size("gone") > 0)
    gone = t.materialise(gone.withColumnsRenamed({"gone": "_td_gone", "n_lines": "_td_lines"}))
    joined = keyed.join(gone, t.same_key(keyed, gone), "left").filter("_td_gone IS NULL OR size(_td_gone) < _td_lines")

    def rest(line_list: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(line_list) - 1), F.col("_td_gone"))
        return F.array_join(F.transform(left, lambda i: F.get(line_list, i)), "\n")

    cut = F.when(F.col("_td_gone").isNull(), keyed[text]).otherwise(t.let(t.lines(keyed[text]), rest))
    return joined.select(*[cut.alias(text) if c == text else keyed[c] for c in docs.columns])


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed), a row for each document."""
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    own = docs.select(*t.row_key())
    found = removed_lines(docs)
    return own.join(found, t.same_key(own, found), "left").select(
        own["_td_id"].alias("doc_id"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )
