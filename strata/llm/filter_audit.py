"""Filter interaction audit: what every filter removes in every order of the filters, from one pass over the texts.

1. *Masks.*  Each document becomes one bit mask of the filters that it fails.  The filters on the text are
   column expressions; ``E`` (a copy of a smaller id's text) needs the smallest id of every text.
2. *Histogram.*  Counts per (part, mask), with the labels' counts beside them: all that the orders depend on.
3. *Lehmer-rank difference arrays.*  Orders are numbered by Lehmer code, which is their lexicographic rank.  All
   orders that begin with the same letters hold one interval of ranks, so a mask is removed at step ``s`` on a
   union of intervals: one for each beginning of ``s - 1`` letters outside the mask and one letter inside it.  A
   mask's count is added at the interval's start and taken off at its end, and a prefix sum over the ranks gives
   the documents removed for every order and step.  No document is replayed through any order.

How the work is spread: texts are read once and reduced to (id, part, 32-byte digest, mask), which is written to
the shared folder.  Rows that do not fail ``E`` are found by an equi-join on (digest, smallest id) - the id is
part of the key, so a text with any number of copies is spread like any other rows - and labels by an
equi-join on the id, in which rows without an id are spread by digest.  Everything after the histogram has at
most ``2^filters`` rows a part.

Defined results: a NULL text is an empty text; a NULL ``lang`` is the part ``''``; a NULL id is a copy of nothing,
nothing is a copy of it, and it has no label; rows that repeat an id and text count each, and none of them is a copy of
the other; rows that share an id but not a text each follow their own text; an id with several label rows has
a label if one of them has it; texts of any length are measured whole; equal ids are ties that nothing depends
on; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut

BLANKS = r"[\x20\x09-\x0D]+"
#: Letter of the filter that compares texts with each other.
COPY = "E"


def text_filters() -> dict[str, Column]:
    """Failure conditions over the columns that ``measured`` adds, by letter."""
    return {
        "A": F.col("n_words") < 100,
        "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 10 * F.col("n_points"),
        "D": F.col("marked"),
    }


def letters() -> list[str]:
    return sorted([*text_filters(), COPY])


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest`` and the measurements of every text."""
    text = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", BLANKS), lambda w: w != "")
    return text.withColumn("words", words).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_capitals"), F.length("text").alias("n_points"),
        F.col("text").rlike("[#$%&*|]").alias("marked"))


def _bit(letter: str) -> int:
    return 1 << letters().index(letter)


def histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters that they fail."""
    mask = sum((F.when(broken, F.lit(_bit(x))).otherwise(F.lit(0)) for x, broken in text_filters().items()), F.lit(0))
    rows = cut(measured(docs).groupBy("doc_id", "part", "digest", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")), "audit-masks")
    first = rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    found = rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "n", (F.col("mask") + F.when(copy, F.lit(_bit(COPY))).otherwise(F.lit(0))).alias("mask"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).alias("spread"))
    good, toxic = (F.coalesce(F.col(c) == 1, F.lit(False)) for c in ("quality", "toxic"))
    marks = (labels.where(F.col("doc_id").isNotNull() & (good | toxic))
             .groupBy("doc_id").agg(F.max(good).alias("good"), F.max(toxic).alias("toxic")).withColumn("spread", F.lit(0).cast("long")))
    counted = found.join(marks, ["doc_id", "spread"], "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"))
    return cut(counted, "audit-histogram")


def lehmer_rank(beginning: str, alphabet: list[str]) -> int:
    """Rank of the first order that begins so: per place, the unused smaller letters times the orders behind them."""
    left, rank = list(alphabet), 0
    for x in beginning:
        place = left.index(x)
        left.pop(place)
        rank += place * factorial(len(left))
    return rank


def intervals(alphabet: list[str]) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last): the orders in which a mask is removed at a step."""
    out, bits = [], {x: 1 << i for i, x in enumerate(alphabet)}
    for step in range(1, len(alphabet) + 1):
        for beginning in map("".join, permutations(alphabet, step)):
            start = lehmer_rank(beginning, alphabet)
            rest = [bits[x] for x in alphabet if x not in beginning]
            for k in range(1 << len(rest)):  # letters behind the step are in the mask or not
                mask = bits[beginning[-1]] + sum(b for i, b in enumerate(rest) if k >> i & 1)
                out.append((mask, step, start, start + factorial(len(alphabet) - step)))
    return out


def order_totals(hist: DataFrame, alphabet: list[str]) -> DataFrame:
    """One row per part, order and step from ``part, mask, n, good, toxic``."""
    spark, n_orders, measures = hist.sparkSession, factorial(len(alphabet)), ("n", "good", "toxic")
    bits = [1 << i for i in range(len(alphabet))]

    def count(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    parts = hist.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[count(F.col("mask").bitwiseAND(b) > 0) for b in bits]).alias("fails"),
        F.array(*[count(F.col("mask") == b) for b in bits]).alias("only"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(alphabet)])
    grid = (parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(n_orders - 1))))
            .withColumn("filter_order", F.get(orders, F.col("rank")))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(alphabet)))))
            .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
            .withColumn("place", F.instr(F.lit("".join(alphabet)), F.col("filter"))))
    table = F.broadcast(spark.createDataFrame(intervals(alphabet), "mask int, step int, start int, stop int"))  # a constant of the letters
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), *measures),
                             F.struct(F.col("stop").alias("rank"), *[(-F.col(m)).alias(m) for m in measures])))
    steps = (hist.join(table, "mask").select("part", "step", ends.alias("end")).select("part", "step", "end.*")
             .groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in measures]))
    by_rank = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_step = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    removed = grid.join(steps, ["part", "step", "rank"], "left").withColumns(
        {f"removed_{m}": F.sum(F.coalesce(F.col(m), F.lit(0))).over(by_rank) for m in measures})
    return removed.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed_n").over(by_step)).alias("kept"),
        F.col("removed_n").alias("removed"), (F.element_at("fails", F.col("place")) - F.col("removed_n")).alias("redundant"),
        F.element_at("only", F.col("place")).alias("unique_fails"), F.col("removed_good").alias("good_lost"),
        F.col("removed_toxic").alias("toxic_lost"), F.sum("removed_n").over(Window.partitionBy("part", "filter")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    return order_totals(histogram(docs, labels), letters())


def oracle(docs: str = "documents", labels: str = "labels") -> str:
    """DuckDB restatement: every order applied to every document, filter by filter."""
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM {docs}),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM t),
f AS (
  SELECT doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) AS c,
         len(regexp_replace(text, '[^#$%&*|]', '', 'g')) > 0 AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM {labels} GROUP BY doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS bad, count(*) AS n,
             sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, bad),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
      FROM x p, x q, x r, x s, x u WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
r AS (SELECT *, filter_order[step:step] AS filter, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
      FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
h AS (SELECT *, bad & bit > 0 AS fails, bad & earlier > 0 AS gone FROM m, r),
s AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN bad = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM h GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
FROM s
"""
