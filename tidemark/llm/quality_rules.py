"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression over the whole text, so the scan, the measures and the
verdict are one stage without a shuffle. Ratios are compared as integers in thousandths, so no
verdict depends on floating point.

Defined cases: a NULL or empty text has no words and fails the base rules. Repeated rows are
judged one by one. Columns of the input are kept; a measure replaces a column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as t

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for it was on as with be by this are from or at "
    "le la les de des et en un une du que qui dans est pour par sur "
    "der die das und ist den dem mit von zu ein eine nicht auf für im "
    "el los las del y se por con su al lo una"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * measure / per <= high``; an open bound is None."""

    measure: str
    per: str
    low: int | None
    high: int | None


# Production thresholds, in thousandths.
RULES = (
    Rule("word_chars", "n_words", 2_000, 15_000),
    Rule("n_symbols", "n_words", None, 200),
    Rule("n_stop_words", "n_words", 20, None),
    Rule("n_dup_lines", "n_text_lines", None, 500),
)
MIN_WORDS = 50
REPEAT_PERCENT = 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(word_list: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more, counted once each.

    Windows are sorted by a 64-bit hash with their position, so equal ones are neighbours:
    n log n for a text of any length.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        keyed = F.transform(
            starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
        )
        return t.let(F.sort_array(keyed), repeated)

    def repeated(s: Column) -> Column:
        def again(x: Column, j: Column) -> Column:
            return (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])

        starts = F.transform(F.filter(s, lambda x, j: F.coalesce(again(x, j), F.lit(False))), lambda x: x["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    return F.when(F.size(word_list) < 3, F.lit(0)).otherwise(t.let(word_list, windows))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures the rules use."""
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns(
        {
            "_td_words": t.words(F.col(text)),
            "_td_lines": F.filter(t.lines(whole), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    word_list, line_list = F.col("_td_words"), F.col("_td_lines")
    return split.withColumns(
        {
            "n_words": F.size(word_list).cast("long"),
            "word_chars": F.length(F.array_join(word_list, "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_stop_words": F.size(F.filter(word_list, lambda w: w.isin(STOP_WORDS))).cast("long"),
            "n_text_lines": F.size(line_list).cast("long"),
            "n_dup_lines": (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long"),
            "n_repeat_words": _repeated_words(word_list).cast("long"),
        }
    ).drop("_td_words", "_td_lines")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one Boolean expression."""
    holds = F.lit(True)
    for rule in rules:
        value, per = F.col(rule.measure) * 1000, F.col(rule.per)
        if rule.low is not None:
            holds = holds & (value >= per * rule.low)
        if rule.high is not None:
            holds = holds & (value <= per * rule.high)
    return holds


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with measures, ``base_failed`` and ``kept``."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    return (
        measures(docs, text)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged = quality_rules(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *MEASURES, "base_failed", "kept")


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM win) WHERE n >= 2
), rep AS (
  SELECT r, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(w, lambda x: x IN (STOPS))) AS BIGINT) AS n_stop,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 5 * n_symbols <= n_words
       AND 50 * n_stop >= n_words AND 2 * n_dup_lines <= n_lines AS kept
FROM b
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS))
