"""Mixing sources to target weights.

Each source's documents are laid end to end and cut into blocks of ``block_words`` words. Offsets
come from two-level running sums, within a pack group and over the group totals, so no source is
ordered in one task. The output has shards of ``slots_per_shard`` slots. A source owns as many
slots as its target asks for. All slots are drawn into a random order, by a seeded hash of source and
number, and that order is cut into shards: the source counts of a shard are a multinomial draw under the
condition that all shards together meet the targets. The j-th slot of a source is the block that the
source's permutation of the epoch gives, and blocks are joined by index. The order comes from three-level
ranks, within a hash range, over the ranges of a span and over the spans; nothing is collected, and a rerun gives the same mix.

Defined cases: a NULL text has size 0 and a document of size 0 takes nothing; a NULL source is a
source of its own, the last. Repeated rows are packed one by one. Ids may be of any type:
whole numbers are packed by their number, all others, NULL included, by a hash of id and text. A target stops at ``max_epochs`` times its source's size, so no document is taken more
often. An empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as t

# Primes below 10^7: a multiplier permutes 0..n-1 unless it divides n.
PRIMES = (9_999_991, 9_999_973, 9_999_971, 9_999_943, 9_999_937, 9_999_931)
CHUNK = 65_536
# Ranges of the slots' hash in a span, over which one task sums.
SPAN = 65_536


@dataclass(frozen=True)
class MixPlan:
    weights: tuple[int, ...] = (1, 2, 3)
    max_epochs: int = 3
    block_words: int = 32
    pack_groups: int = 4096
    slots_per_shard: int = 4096
    seed: int = 17


def _permuted(index: Column, n: Column, turn: Column) -> Column:
    """A permutation of 0..n-1 for each ``turn``."""
    pick = F.pmod(turn, F.lit(len(PRIMES) // 2)).cast("int")
    first = F.get(F.array(*[F.lit(p) for p in PRIMES[::2]]), pick)
    second = F.get(F.array(*[F.lit(p) for p in PRIMES[1::2]]), pick)
    factor = F.when(n % first != 0, first).otherwise(second)
    return F.pmod(index * factor + turn * 104_729, n)


def sized(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(t.WORD)).cast("long").alias("size"),
        t.row_key(text, key)[1],
    )


def source_targets(sizes: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """(source, source_no, source_size, target, n_blocks, first_slot, n_slots, all_slots), a row a source.

    Targets share all words by weight; where one passes its cap the excess goes to the others. That
    is the level L with ``sum(min(cap, L * weight)) = all words``: sources are taken by cap per
    weight, and L is the largest level that the sources not yet capped give.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    cycle = F.array(*[F.lit(w) for w in plan.weights])
    level = F.max(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.col("level"))).over(everything)
    block = F.lit(plan.block_words)
    return (
        per.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(cycle, F.col("source_no") % len(plan.weights)))
        .withColumn("cap", F.col("source_size") * plan.max_epochs)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("level", level)
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
        )
        .withColumn("n_blocks", F.floor((F.col("source_size") + block - 1) / block))
        .withColumn(
            "n_slots",
            F.coalesce(
                F.least(
                    F.col("n_blocks") * plan.max_epochs,
                    F.floor(F.col("target") * F.col("n_blocks") / F.nullif("source_size", F.lit(0)) + 0.5),
                ),
                F.lit(0),
            ),
        )
        .withColumn("first_slot", F.coalesce(F.sum("n_slots").over(before_of("source_no")), F.lit(0)))
        .withColumn("all_slots", F.sum("n_slots").over(everything))
        .drop("weight", "cap", "total", "level")
    )


def before_of(order: str):
    return Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def packed(sizes: DataFrame, sources: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """``sizes`` with source_no and ``start``, the document's first word in its source's sequence."""
    known = sources.select(F.col("source").alias("_td_source"), "source_no", "source_size", "target")
    numbered = (
        sizes.join(known, sizes["source"].eqNullSafe(known["_td_source"]))
        .drop("_td_source")
        .withColumn("_td_order", F.coalesce(t.whole_number(F.col("doc_id")), F.xxhash64(F.col("doc_id").cast("string"), "_td_hash")))
        .withColumn("_td_group", F.pmod(F.col("_td_order"), F.lit(plan.pack_groups)))
    )
    groups = numbered.groupBy("source_no", "_td_group").agg(F.sum("size").alias("_td_sum"))
    in_source = Window.partitionBy("source_no").orderBy("_td_group").rowsBetween(Window.unboundedPreceding, -1)
    in_group = (
        Window.partitionBy("source_no", "_td_group")
        .orderBy("_td_order", "size", "_td_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = groups.select("source_no", "_td_group", F.coalesce(F.sum("_td_sum").over(in_source), F.lit(0)).alias("_td_base"))
    return (
        numbered.withColumn("_td_start", F.coalesce(F.sum("size").over(in_group), F.lit(0)))
        .join(starts, ["source_no", "_td_group"])
        .withColumn("start", F.col("_td_base") + F.col("_td_start"))
        .drop("_td_base", "_td_start", "_td_order", "_td_group")
    )


def _running(sums: DataFrame) -> DataFrame:
    """(range, base): the slots before each range, added within spans of ranges and over the spans' totals."""
    spans = sums.withColumn("span", F.floor(F.col("range") / SPAN))
    totals = spans.groupBy("span").agg(F.sum("n").alias("n"))
    ahead = totals.select("span", F.coalesce(F.sum("n").over(before_of("span")), F.lit(0)).alias("ahead"))
    in_span = Window.partitionBy("span").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    within = spans.select("span", "range", F.coalesce(F.sum("n").over(in_span), F.lit(0)).alias("within"))
    # One row for 2^28 slots.
    return within.join(F.broadcast(ahead), "span").select("range", (F.col("ahead") + F.col("within")).alias("base"))


def slots(sources: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """(source_no, block, shard, slot): every slot of the output, made in chunks that spread over tasks."""
    chunks = sources.filter("n_slots > 0").select(
        "source_no",
        "n_blocks",
        "n_slots",
        "first_slot",
        "all_slots",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n_slots") - 1) / CHUNK))).alias("chunk"),
    )
    low = F.col("chunk") * CHUNK
    each = chunks.repartition("source_no", "chunk").withColumn(
        "j", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("n_slots")) - 1))
    )
    epoch = F.floor(F.col("j") / F.col("n_blocks"))
    turn = F.col("source_no") * 31 + epoch
    # Ranges of the hash, a shard's slots in each.
    ranges = F.floor((F.col("all_slots") - 1) / plan.slots_per_shard) + 1
    drawn = F.xxhash64("source_no", "j", F.lit(plan.seed))
    high = F.shiftrightunsigned(drawn, 32)
    mapped = each.select(
        "source_no",
        "j",
        _permuted(F.pmod(F.col("j"), F.col("n_blocks")), F.col("n_blocks"), turn).alias("block"),
        drawn.alias("drawn"),
        F.floor(high.cast("decimal(20,0)") * ranges.cast("decimal(17,0)") / F.lit(1 << 32).cast("decimal(10,0)")).cast("long").alias("range"),
        # The unsigned order of the hash, which that of ranges follows.
        drawn.bitwiseXOR(F.lit(-(1 << 63))).alias("order"),
    )
    starts = _running(t.materialise(mapped.groupBy("range").agg(F.count("*").alias("n"))))
    rank = F.row_number().over(Window.partitionBy("range").orderBy("order", "source_no", "j")) - 1
    place = F.col("base") + F.col("rank")
    return (
        mapped.withColumn("rank", rank)
        # The planner doesn't see that slots multiply: it would broadcast them. They are dealt by range already.
        .join(starts.hint("merge"), "range")
        .select(
            "source_no",
            "block",
            F.floor(place / plan.slots_per_shard).alias("shard"),
            F.pmod(place, F.lit(plan.slots_per_shard).cast("long")).alias("slot"),
        )
    )


def shard_counts(drawn: DataFrame) -> DataFrame:
    """(shard, source_no, n_slots) of what :func:`slots` gives."""
    return drawn.groupBy("shard", "source_no").agg(F.count("*").alias("n_slots"))


def pieces(placed: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """(doc_id, source_no, start, size, block, first_word, n_words): what each document gives to each block."""
    block = plan.block_words
    end = F.col("start") + F.col("size")
    cut = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    )
    first = F.greatest(F.col("start"), F.col("block") * block)
    return cut.withColumn("first_word", first - F.col("start")).withColumn(
        "n_words", F.least(end, (F.col("block") + 1) * block) - first
    )


@dataclass(frozen=True)
class Drawn:
    """The written tables of one mix: the documents with their places, and the slots."""

    placed: DataFrame
    slots: DataFrame


def draw(docs: DataFrame, plan: MixPlan = MixPlan(), **names: str) -> Drawn:
    sizes = t.materialise(sized(docs, **names))
    sources = t.materialise(source_targets(sizes, plan))
    return Drawn(packed(sizes, sources, plan), t.materialise(slots(sources, plan)))


def _taken(drawn: Drawn, plan: MixPlan) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, source_no, start, _td_hash, places): the words of each document's rows in the slots.

    ``places`` tells the rows without their text: (shard, slot, first_word, n_words), in order.
    """
    own = ["doc_id", "source", "size", "source_size", "target", "source_no", "start", "_td_hash"]
    place = F.when(F.col("slot").isNotNull(), F.struct("shard", "slot", "first_word", "n_words"))
    taken = (
        pieces(drawn.placed, plan)
        # As many blocks as words / block_words: never a broadcast.
        .join(drawn.slots.hint("merge"), ["source_no", "block"], "left")
        .groupBy(*own)
        .agg(
            F.sum(F.when(F.col("slot").isNotNull(), F.col("n_words")).otherwise(0)).alias("taken"),
            F.sort_array(F.collect_list(place)).alias("places"),
        )
    )
    none = drawn.placed.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "places": F.array().cast(taken.schema["places"].dataType)})
    return taken.select(*own, "taken", "places").unionByName(none.select(*own, "taken", "places"))


def mix(docs: DataFrame, plan: MixPlan = MixPlan(), **names: str) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken), a row for each of ``docs``."""
    return _taken(draw(docs, plan, **names), plan).select("doc_id", "source", "size", "source_size", "target", "taken")


def _named(key: str, source: str) -> dict[str, Column]:
    """Columns without NULL, alike for the same id and source: a plain join by them finds rows as they were dealt for deduplication."""
    columns = {}
    for name, value in (("id", F.col(key)), ("source", F.col(source))):
        columns |= {f"_td_{name}_text": F.coalesce(value.cast("string"), F.lit("")), f"_td_{name}_null": value.isNull()}
    return columns


def shard_rows(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """(shard, slot, source, doc_id, first_word, text): the mix itself; a slot's rows in order of first_word form its block."""
    rows = mixed(docs, plan, text, key, source).select("source", "doc_id", F.inline("rows"))
    return rows.select("shard", "slot", "source", "doc_id", "first_word", "text")


def mixed(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """What :func:`mix` gives, and ``rows``: the document's rows of :func:`shard_rows`, (shard, slot, first_word, text), in order.

    Blocks meet slots as numbers alone. Each text is shuffled once, to the places of its document, and cut there.
    """
    with t.Tables() as tables:
        counted = t.materialise(_taken(draw(docs, plan, text=text, key=key, source=source), plan))
        tables.keep(counted)
    same = [*_named(key, source), "_td_hash"]
    texts = docs.select(*[c.alias(name) for name, c in _named(key, source).items()], t.row_key(text, key)[1], F.col(text).alias("_td_text"))

    def cut(words: Column) -> Column:
        def row(place: Column) -> Column:
            piece = F.slice(words, (place["first_word"] + 1).cast("int"), place["n_words"].cast("int"))
            return F.struct(place["shard"].alias("shard"), place["slot"].alias("slot"), place["first_word"].alias("first_word"), F.array_join(piece, " ").alias("text"))

        return F.transform("places", row)

    met = counted.withColumns(_named("doc_id", "source")).join(texts.dropDuplicates(same), same)
    return met.select("doc_id", "source", "size", "source_size", "target", "taken", t.let(t.words(F.col("_td_text")), cut).alias("rows"))


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, source_no, [1, 2, 3][source_no % 3 + 1] AS weight, source_size, 3 * source_size AS cap,
         sum(source_size) OVER () AS total
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM d GROUP BY source)
), lev AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
         (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM per
), tgt AS (
  SELECT *, least(cap::DOUBLE, coalesce((SELECT max(level) FROM lev WHERE ratio > level) * weight, 0)) AS target,
         (source_size + 31) // 32 AS n_blocks
  FROM lev
), src AS (
  SELECT *, coalesce(least(3 * n_blocks, CAST(floor(target * n_blocks / nullif(source_size, 0) + 0.5) AS BIGINT)), 0) AS n_slots
  FROM tgt
), slot AS (
  SELECT source_no, e, CASE WHEN n_blocks % p <> 0 THEN p ELSE q END AS f, n_blocks,
         unnest(range(CAST(least(n_blocks, n_slots - e * n_blocks) AS BIGINT))) AS j
  FROM (SELECT source_no, n_blocks, n_slots, e, CAST([9999991, 9999971, 9999937][(source_no * 31 + e) % 3 + 1] AS BIGINT) AS p,
               CAST([9999973, 9999943, 9999931][(source_no * 31 + e) % 3 + 1] AS BIGINT) AS q
        FROM src, (VALUES (0), (1), (2)) v(e) WHERE n_slots > e * n_blocks)
), cnt AS (
  SELECT source_no, (j * f + (source_no * 31 + e) * 104729) % n_blocks AS block, count(*) AS times FROM slot GROUP BY 1, 2
), pos AS (
  SELECT d.doc_id, d.size, s.source_no, s.source_size, s.target, row_number() OVER () AS r,
         coalesce(sum(d.size) OVER (PARTITION BY s.source_no ORDER BY coalesce(d.doc_id, 0) % 4096, coalesce(d.doc_id, 0), d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN src s ON d.source IS NOT DISTINCT FROM s.source
), cut AS (
  SELECT r, source_no, start, size, unnest(range(CAST(start // 32 AS BIGINT), CAST((start + size - 1) // 32 + 1 AS BIGINT))) AS block
  FROM pos WHERE size > 0
), took AS (
  SELECT r, sum((least(start + size, (cut.block + 1) * 32) - greatest(start, cut.block * 32)) * coalesce(times, 0)) AS taken
  FROM cut LEFT JOIN cnt ON cut.source_no = cnt.source_no AND cut.block = cnt.block GROUP BY r
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM pos LEFT JOIN took USING (r)
"""
