"""URL filter: rules on host and path, then a list of canonical URLs behind a Bloom filter.

The listed URLs are folded into a blocked Bloom filter: one 64-bit word a block, four bits a URL.
A page looks up one block; only possible hits go on to the exact hash join, which removes the
false positives. The filter's size follows from a count of the list; up to ``bloom.BROADCAST_BYTES`` it is
broadcast, above it is joined by slice. The join's hot URLs are split by AQE.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path, fits no rule and is
not listed: it is allowed. An empty list blocks nothing. Repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm import text as t

# Fixed value: first host labels of the listed spam sites.
LISTED_LABELS = ("spam-farm", "cheap-pills")


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def _rest(url: Column) -> Column:
    """What stands after the first ``://``; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host(url: Column) -> Column:
    return t.ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a last slash, query without tracking; NULL without a host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.rlike(r"^(utm_[A-Za-z]+|ref)="))
    query = F.array_join(parts, "&")
    plain = F.regexp_replace(host(url), r"^(www|m)\.", "")
    whole = F.concat(plain, F.regexp_replace(path(url), r"/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host(url) != "", whole)


def _fits(rule: UrlRule, at_host: Column, at_path: Column) -> Column:
    return ((at_host == rule.host) | at_host.endswith("." + rule.host)) & at_path.startswith(rule.path)


def _by_rule(rules: tuple[UrlRule, ...], value) -> Column:
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        chosen = F.when(_fits(rule, F.col("host"), F.col("path")), F.lit(value(rule))).otherwise(chosen)
    return chosen


def url_filter(pages: DataFrame, listed: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, ``listed`` and verdict; ``listed`` has a column ``canonical``."""
    names = ("host", "path", "rule", "listed", "verdict")
    kept = [c for c in pages.columns if c not in names]
    unique = listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct()
    judged = (
        pages.select(*kept)
        .withColumns({"host": host(F.col(url)), "path": path(F.col(url)), "_td_url": canonical(F.col(url))})
        .withColumns({"rule": _by_rule(rules, lambda r: r.name), "_td_rule": _by_rule(rules, lambda r: r.verdict)})
    )
    blocks = bloom.blocks_for(unique.count())
    sliced = judged.withColumn("_td_slice", F.when(F.col("_td_url").isNotNull(), bloom.slice_of(F.col("_td_url"), blocks)))
    bits = bloom.bloom_filter(unique, "canonical", blocks).toDF("_td_slice", "_td_words")
    probed = sliced.join(F.broadcast(bits) if bloom.broadcastable(blocks) else bits, "_td_slice", "left").withColumn(
        "_td_maybe", F.coalesce(bloom.holds(F.col("_td_words"), F.col("_td_url"), blocks), F.lit(False))
    )
    exact = unique.select(F.col("canonical").alias("_td_url"), F.lit(True).alias("_td_hit"))
    maybe = probed.filter("_td_maybe").join(exact, "_td_url", "left")
    clear = probed.filter("NOT _td_maybe").withColumn("_td_hit", F.lit(None).cast("boolean"))
    return (
        maybe.unionByName(clear)
        .withColumn("listed", F.coalesce("_td_hit", F.lit(False)))
        .withColumn("verdict", F.coalesce("_td_rule", F.when(F.col("listed"), "block").otherwise("allow")))
        .select(*kept, *names)
    )


def listed_urls(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS, url: str = "url") -> DataFrame:
    """The list of the query: canonical URLs seen on the listed sites."""
    site = F.regexp_extract(canonical(F.col(url)), r"^[^./?]*", 0)
    return pages.filter(site.isin(*labels)).select(canonical(F.col(url)).alias("canonical")).distinct()


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = t.read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH p AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest FROM pages),
h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1),
                        '(utm_[A-Za-z]+|ref)=[^&]*&?', '', 'g'), '&$', '') AS q
  FROM p
), c AS (
  SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
            || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canon FROM h
), l AS (SELECT DISTINCT canon FROM c WHERE regexp_extract(canon, '^[^./?]*') IN ('spam-farm', 'cheap-pills')),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canon IN (SELECT canon FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
