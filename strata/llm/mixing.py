"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Each source has a weight; weights share a token budget.  A target stops at ``cap`` times its
   source's size and the excess goes to the others by weight until none is above (water-filling,
   in closed form over the sources sorted by the level at which they fill up).
2. The budget is cut into blocks of ``block`` words.  Sainte-Lague gives every source an integer
   number of blocks: the highest quotients ``target / (2k + 1)`` win.  No seat is enumerated: the
   seats follow from rounding at the standard divisor, and only the few seats by which that misses
   the total are dealt by quotient.
3. A source's blocks are apportioned in the same way to its shards (hash shards of about
   ``shard_words`` words, so a hot source is many shards).
4. Inside a shard documents lie end to end in a seeded order.  Whole passes over the tape plus one
   run of blocks from a seeded start, wrapping around, make up the quota; a document takes what
   the selected blocks cover of it, at most ``cap`` times its size.

Everything is DataFrame work: one scan of the texts (word counts), then narrow rows only.

Defined results: NULL and empty texts have size 0 and take 0; a NULL source is a source of its own,
last in order; a source of size 0 has target 0; rows that repeat an id count each on their own; an
empty table gives an empty result; extra columns are ignored.  The draw depends on id, text and seed
only, so reruns and other partitionings agree, and rows without an id or with one id are dealt to shards by their texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, bounded_broadcast, cut

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 64
SHARD_WORDS = 1_000_000
SEED = 11


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """Seeded draw: the first 60 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])), 1, 15),
                  16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: int = CAP) -> DataFrame:
    """Add ``rank``, ``weight`` and ``target`` to ``source, source_size`` (one row per source)."""
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").asc_nulls_last())
    by_level = everything.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    w = (sources.withColumn("rank", F.row_number().over(in_order))
         .withColumn("weight", F.get(cycle, ((F.col("rank") - 1) % len(weights)).cast("int")))
         .withColumn("limit", (F.col("source_size") * cap).cast("double"))
         .withColumn("level", F.col("limit") / F.col("weight"))
         .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
         .withColumn("filled", F.coalesce(F.sum("limit").over(by_level), F.lit(0.0)))
         .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)))
         .withColumn("try", (F.col("budget") - F.col("filled")) / F.col("left"))
         # the first level at or above the water decides; sources under it are full
         .withColumn("water", F.min(F.when(F.col("level") >= F.col("try"), F.struct("level", "rank", "try"))).over(everything)))
    target = F.when(F.col("water").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("weight") * F.col("water.try")))
    return w.select("source", "source_size", "rank", "weight", target.alias("target"))


def apportion(rows: DataFrame, group: list[str], weight: str, total: str, order: list[str], seats: str = "seats") -> DataFrame:
    """Sainte-Lague seats inside each group: ``weight`` >= 0, ``total`` seats of the group on every row.

    ``group`` and ``order`` together name a row.  Ties go to the first row by ``order``.
    """
    all_of = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    base = (rows.withColumn("_sum", F.sum(F.col(weight).cast("double")).over(all_of)).withColumn("_members", F.count(F.lit(1)).over(all_of))
            .withColumn("_quota", F.when(F.col("_sum") > 0, F.col(weight) * F.col(total) / F.col("_sum")).otherwise(F.lit(0.0)))
            .withColumn("_seats", F.floor(F.col("_quota") + 0.5).cast("long"))
            .withColumn("_missing", F.when(F.col("_sum") > 0, F.col(total) - F.sum("_seats").over(all_of)).otherwise(F.lit(0)).cast("long"))
            # rounding misses the total by at most half the members, shared in proportion: no row can
            # gain or lose more than its part of that, and one
            .withColumn("_reach", (F.floor(F.when(F.col("_sum") > 0, F.col(weight) / F.col("_sum")).otherwise(0.0)
                                           * F.col("_members") / 2) + 2).cast("int")))
    step = F.explode(F.sequence(F.lit(0), F.col("_reach") - 1))
    k = F.when(F.col("_missing") > 0, F.col("_seats") + F.col("_j")).otherwise(F.col("_seats") - 1 - F.col("_j"))
    offers = (base.where((F.col("_missing") != 0) & (F.col(weight) > 0)).select(*group, *order, weight, "_missing", "_seats", step.alias("_j"))
              .withColumn("_k", k).where(F.col("_k") >= 0)
              .withColumn("_quotient", F.col(weight) / (2 * F.col("_k") + 1)))
    sign = F.when(F.col("_missing") > 0, F.lit(1)).otherwise(F.lit(-1))
    best = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(
        F.desc(F.col("_quotient") * sign), *[F.when(F.col("_missing") > 0, F.col(o)) for o in order],
        *[F.desc(F.when(F.col("_missing") < 0, F.col(o))) for o in order], "_j")
    dealt = (offers.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.abs("_missing"))
             .groupBy(*group, *order).agg(F.sum(sign).alias("_more")))
    return (base.join(dealt, [*group, *order], "left")
            .withColumn(seats, F.col("_seats") + F.coalesce(F.col("_more"), F.lit(0)))
            .drop("_sum", "_members", "_quota", "_seats", "_missing", "_reach", "_more"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: int = CAP, block: int = BLOCK,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, shard, taken``."""
    sized = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words("text").alias("size"),
                            draw(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))).alias("draw")), "mix-sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    blocks = F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) / block + 0.5).cast("long")
    sources = apportion(sources.withColumn("blocks", blocks), [], "target", "blocks", ["rank"], "quota")
    sources = cut(sources.select("source", "source_size", "rank", "target", "quota", F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("shards")), "mix-sources")
    small = bounded_broadcast(sources.withColumnRenamed("source", "_source"), sources.count())
    placed = sized.join(small, F.col("source").eqNullSafe(F.col("_source"))).withColumn("shard", F.pmod("draw", "shards"))
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
    shards = apportion(shards, ["rank"], "words", "quota", ["shard"], "blocks")
    take = F.least(F.col("blocks") * block, F.col("words") * cap)
    shards = (shards.where(F.col("words") > 0).withColumn("take", take)
              .withColumn("passes", F.floor(F.col("take") / F.col("words")).cast("long"))
              .withColumn("rest", F.col("take") - F.col("passes") * F.col("words"))
              .withColumn("start", block * F.pmod(draw(F.lit(seed), F.col("rank"), F.col("shard")),
                                                  F.ceil(F.col("words") / block).cast("long"))))
    shards = cut(shards.select("rank", "shard", "words", "passes", "rest", "start"), "mix-shards")
    tape = (Window.partitionBy("rank", "shard").orderBy("draw", "doc_id", "size")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = (placed.withColumn("to", F.sum("size").over(tape)).withColumn("from", F.col("to") - F.col("size"))
            .join(bounded_broadcast(shards, shards.count()), ["rank", "shard"], "left"))
    end = F.col("start") + F.col("rest")
    run = F.greatest(F.lit(0), F.least(F.col("to"), end) - F.greatest(F.col("from"), F.col("start")))
    wrapped = F.greatest(F.lit(0), F.least(F.col("to"), end - F.col("words")) - F.col("from"))
    taken = F.coalesce(F.col("passes") * F.col("size") + run + wrapped, F.lit(0)).cast("long")
    return laid.select("doc_id", "source", "size", "source_size", "target", "shard", taken.alias("taken"))


def oracle(docs: str = "documents", block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED, cap: int = CAP) -> str:
    """DuckDB restatement: the water level by trying every source, seats by enumerating them one by one."""
    lay = "PARTITION BY rank, shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING"
    bits = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         {bits.format(f"'{seed}|' || coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))")} AS draw
  FROM {docs}),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((rank - 1) % 3 + 1)::INT]::DOUBLE AS weight, ({cap} * source_size)::DOUBLE AS cap FROM s),
-- the water level at which source x is the first that is not full
levels AS (
  SELECT x.rank, x.cap / x.weight AS level,
         ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce((SELECT sum(y.cap) FROM w y WHERE (y.cap / y.weight, y.rank) < (x.cap / x.weight, x.rank)), 0.0))
         / (SELECT sum(y.weight) FROM w y WHERE (y.cap / y.weight, y.rank) >= (x.cap / x.weight, x.rank)) AS water
  FROM w x),
t AS (
  SELECT w.*, least(cap, weight * (SELECT water FROM levels WHERE level >= water ORDER BY level, rank LIMIT 1)) AS target FROM w),
n AS (SELECT floor(sum(target) / {block} + 0.5)::BIGINT AS seats FROM t),
seat AS (
  SELECT rank FROM (SELECT rank, target / (2 * unnest(range(0, (source_size * {cap} / {block} + 3)::BIGINT)) + 1) AS quotient FROM t WHERE target > 0)
  QUALIFY row_number() OVER (ORDER BY quotient DESC, rank) <= (SELECT seats FROM n)),
q AS (SELECT t.*, coalesce(c.n, 0) AS quota, greatest(1, ceil(source_size / {shard_words}))::BIGINT AS shards
      FROM t LEFT JOIN (SELECT rank, count(*) AS n FROM seat GROUP BY rank) c USING (rank)),
p AS (SELECT d.*, q.rank, q.source_size, q.target, q.quota, d.draw % q.shards AS shard
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
h AS (SELECT rank, shard, sum(size)::BIGINT AS words, any_value(quota) AS quota FROM p GROUP BY rank, shard),
hseat AS (
  SELECT rank, shard FROM (SELECT rank, shard, quota, words / (2 * unnest(range(0, quota + 1)) + 1) AS quotient FROM h WHERE words > 0)
  QUALIFY row_number() OVER (PARTITION BY rank ORDER BY quotient DESC, shard) <= quota),
k AS (
  SELECT h.*, least(coalesce(c.n, 0) * {block}, words * {cap}) AS take,
         {block} * ({bits.format(f"'{seed}|' || rank || '|' || shard")} % ceil(words / {block})::BIGINT) AS start
  FROM h LEFT JOIN (SELECT rank, shard, count(*) AS n FROM hseat GROUP BY rank, shard) c USING (rank, shard) WHERE words > 0),
l AS (SELECT p.*, sum(size) OVER ({lay}) AS upto FROM p)
SELECT doc_id, l.source, size, source_size, target, l.shard,
       coalesce((take // words) * size
         + greatest(0, least(upto, start + take % words) - greatest(upto - size, start))
         + greatest(0, least(upto, start + take % words - words) - (upto - size)), 0)::BIGINT AS taken
FROM l LEFT JOIN k ON l.rank = k.rank AND l.shard = k.shard
"""
