"""Benchmark decontamination by template canonicalisation.

1. *Template.*  Numbers, units behind numbers and names (capitalised words inside a sentence) become
   typed placeholders; the rest is lower-cased words without punctuation.  ``Tom Smith ran 12 km``
   and ``Tom Jones ran 3 miles`` are one template.
2. *Windows.*  Every ``WINDOW`` consecutive template tokens are hashed (by doubling: pairs, pairs of
   pairs, ...) and hash-joined with the windows of the benchmark.  Benchmark windows that are mostly
   placeholders are no evidence and are left out.
3. *Coverage.*  A document matches an item if the shared windows cover enough of the item's template.
4. *Slots.*  Along the best alignment the item's slot values must map to the document's one to one
   (5 -> 7 everywhere); then the document is a copy, or a re-parameterised copy if values differ.

Only DataFrame functions; texts are never shuffled.  The window join reads each text once and keeps
only hits; slots are read back for matching documents alone.

Defined results: NULL and empty texts match nothing; items of fewer than ``WINDOW`` template tokens
are too short to be evidence and match nothing; repeated rows match alike (one row per document id,
text and item); rows with a NULL id are reported with a NULL id; an empty table on either side gives
an empty result; extra columns are ignored by ``matches`` and handed on by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, cut, fresh

WINDOW = 8           # a power of two
MIN_LITERALS = 5     # tokens of a benchmark window that are no placeholders
COVERAGE = 0.5       # of the item's template tokens
MIN_TOKENS = 13      # covered at least, or all but two of a shorter item
CONSISTENCY = 0.75

NUM, NAME, UNIT = "\ue000", "\ue001", "\ue002"  # private use characters
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
         "kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonnes ounce ounces "
         "pound pounds ml l liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h "
         "hr hrs hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents "
         "degree degrees celsius fahrenheit kelvin hz khz mhz ghz kb mb gb tb bytes bits v w kw mw kwh j kj cal kcal n pa "
         "kpa mph kph").split()

_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
_UNIT = rf"({NUM}{_NUMBER})[ -]?((?i:{'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))}))(?![\p{{L}}\p{{N}}])"
_NAME = r"(?<=[\p{L}\p{N},;)] )(\p{Lu}\p{Ll}+)"
_TOKEN = rf"{NUM}{_NUMBER}|[{NAME}{UNIT}]?[\p{{L}}\p{{M}}\p{{N}}]+"


def tagged(text: str | Column) -> Column:
    """The text with every slot marked by its type, values still there."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    c = F.regexp_replace(c, rf"(?<![\p{{L}}\p{{N}}])({_NUMBER})", NUM + "$1")
    c = F.regexp_replace(c, _UNIT, "$1 " + UNIT + "$2")
    return F.lower(F.regexp_replace(c, _NAME, NAME + "$1"))


def tokens(tagged_text: Column) -> Column:
    """Template tokens with slot values."""
    return F.regexp_extract_all(tagged_text, F.lit(_TOKEN), F.lit(0))


def canonical(tagged_text: Column) -> Column:
    """Template tokens: slots are their type alone."""
    return tokens_of_types(F.regexp_replace(tagged_text, rf"([{NUM}{NAME}{UNIT}])(?:{_NUMBER}|[\p{{L}}\p{{M}}\p{{N}}]+)", "$1"))


def tokens_of_types(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(rf"[{NUM}{NAME}{UNIT}]|[\p{{L}}\p{{M}}\p{{N}}]+"), F.lit(0))


def windows(df: DataFrame, template: str, out: str, width: int = WINDOW) -> DataFrame:
    """Add the hashes of all windows of ``width`` tokens, in order, as column ``out``.

    Each doubling is a projection of its own: inside one expression every level would be evaluated
    again for each of its uses.
    """
    df = df.withColumn(out, F.transform(template, lambda t: F.xxhash64(t)))
    step = 1
    while step < width:
        df = df.withColumn(out, F.zip_with(out, F.slice(out, step + 1, F.greatest(F.size(out), F.lit(1))), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    return df.withColumn(out, F.slice(out, 1, F.greatest(F.size(template) - (width - 1), F.lit(0))))


def items(benchmark: DataFrame) -> DataFrame:
    """Benchmark items with template size and slots ``(pos, type, value)``."""
    t = benchmark.select("item_id", tagged("text").alias("tagged")).select(
        "item_id", tokens(F.col("tagged")).alias("tokens"), canonical(F.col("tagged")).alias("template"))
    slot = F.filter(F.transform("tokens", lambda v, i: F.struct(i.alias("pos"), F.substring(v, 1, 1).alias("type"), v.alias("value"))),
                    lambda s: s["type"].isin(NUM, NAME, UNIT))
    return t.select("item_id", "template", F.size("template").alias("n_tokens"), slot.alias("slots"))


def covered(positions: Column, width: int = WINDOW) -> Column:
    """Tokens under windows that start at the (sorted, distinct) positions."""
    gaps = F.zip_with(positions, F.slice(positions, 2, F.greatest(F.size(positions), F.lit(1))),
                      lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """One row per contaminated document and item.

    Columns: ``doc_id, text_key`` (hash of the text, tells rows with one id apart), ``item_id,
    n_tokens, n_covered, coverage, n_slots, slot_consistency, reparameterised``.
    """
    bench = cut(items(benchmark), "decon-items")
    literals = F.size(F.filter(F.slice("template", F.col("pos") + 1, WINDOW), lambda t: ~t.isin(NUM, NAME, UNIT)))
    keys = (windows(bench.where(F.col("n_tokens") >= WINDOW), "template", "windows")
            .select("item_id", "template", F.posexplode("windows").alias("pos", "hash"))
            .where(literals >= MIN_LITERALS)
            # a window that an item repeats counts once, where it stands first
            .groupBy("item_id", "hash").agg(F.min("pos").alias("item_pos")))
    keys = cut(keys.select("hash", "item_id", "item_pos"), "decon-windows")
    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), canonical(tagged("text")).alias("template"))
    # the outer form: for the inner one the optimizer adds a size filter and inlines all doublings into it
    spread = windows(own, "template", "windows").select("doc_id", "text_key", F.posexplode_outer("windows").alias("pos", "hash"))
    hits = cut(spread.join(bounded_broadcast(keys, keys.count()), "hash")
               .groupBy("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
               .agg(F.array_sort(F.collect_set("item_pos")).alias("at")), "decon-hits")
    pair = ["doc_id", "text_key", "item_id"]
    each = hits.select(*pair, F.explode("at").alias("p")).groupBy(*pair).agg(F.array_sort(F.collect_set("p")).alias("at"))
    best = hits.groupBy(*pair).agg(F.max_by("shift", F.struct(F.size("at"), -F.col("shift"))).alias("shift"))
    small = F.broadcast if bench.count() <= 100_000 else (lambda x: x)
    found = (each.withColumn("n_covered", covered(F.col("at")))
             .join(small(bench.select("item_id", "n_tokens", "slots")), "item_id")
             .where((F.col("n_covered") >= coverage * F.col("n_tokens"))
                    & (F.col("n_covered") >= F.least(F.lit(MIN_TOKENS), F.col("n_tokens") - 2))))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in pair]
    found = cut(found.alias("a").join(best.alias("b"), on).select(
        *[f"a.{c}" for c in pair], "n_tokens", "n_covered", "slots", "shift"), "decon-found")
    return checked(docs, found).where(F.col("slot_consistency") >= consistency).select(
        *pair, "n_tokens", "n_covered", (F.col("n_covered") / F.col("n_tokens")).alias("coverage"), "n_slots",
        "slot_consistency", "reparameterised")


def checked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``n_slots, slot_consistency, reparameterised`` to the candidate pairs."""
    plain = found.where(F.size("slots") == 0).withColumn("pairs", F.expr(
        "cast(array() as array<struct<item:string,doc:string>>)"))
    slotted = found.where(F.size("slots") > 0)
    n = slotted.select("doc_id").distinct().count()
    if n:
        need = bounded_broadcast(slotted.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), n, 1_000_000)
        texts = (docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
                 .join(need, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
                 .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), tokens(tagged("text")).alias("tokens")))
        value = lambda s: F.get(F.col("tokens"), s["pos"] + F.col("shift"))
        both = F.filter(F.transform("slots", lambda s: F.struct(s["value"].alias("item"), F.when(
            F.substring(value(s), 1, 1) == s["type"], value(s)).alias("doc"))), lambda p: p["doc"].isNotNull())
        slotted = (slotted.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
                   .withColumn("pairs", F.array_distinct(both)).drop("_id", "_key", "tokens"))
        slotted = slotted.dropDuplicates(["doc_id", "text_key", "item_id"])
        plain = plain.unionByName(slotted)
    one_side = lambda f: F.size(F.array_distinct(F.transform("pairs", lambda p: p[f])))
    ratio = F.when(F.size("pairs") > 0, F.least(one_side("item"), one_side("doc")) / F.size("pairs")).otherwise(F.lit(1.0))
    return (plain.withColumn("n_slots", F.size("slots")).withColumn("slot_consistency", ratio)
            .withColumn("reparameterised", F.exists("pairs", lambda p: p["item"] != p["doc"])))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input's rows and columns without contaminated documents."""
    dirty = cut(matches(docs, benchmark, **options).select("doc_id", "text_key").distinct(), "decon-dirty")
    i, k = fresh(docs, "_decon_id"), fresh(docs, "_decon_key")
    dirty = dirty.toDF(i, k)
    return docs.join(bounded_broadcast(dirty, dirty.count()),
                     F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(k)), "left_anti")


def oracle() -> str:
    """DuckDB restatement of ``matches`` on documents and benchmark: windows compared as text, no hashes."""
    num, name, unit = (f"chr({ord(c)})" for c in (NUM, NAME, UNIT))
    number = r"[\p{N}]+(?:[.,:/][\p{N}]+)*"
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    slot = f"[{NUM}{NAME}{UNIT}]"
    # RE2 has no look-around: the character before stays in the match, so neighbours need a second pass
    once = lambda c: rf"regexp_replace({c}, '([\p{{L}}\p{{N}},;)] )(\p{{Lu}}\p{{Ll}}+)', '\1' || {name} || '\2', 'g')"
    tag = rf"regexp_replace(coalesce(text, ''), '(^|[^\p{{L}}\p{{N}}])({number})', '\1' || {num} || '\2', 'g')"
    tag = rf"regexp_replace({tag}, '({NUM}{number})[ -]?((?i:{units}))($|[^\p{{L}}\p{{N}}])', '\1 ' || {unit} || '\2\3', 'g')"
    tag = f"lower({once(once(tag))})"
    return rf"""
WITH src AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
tok AS (
  SELECT side, id, text, row_number() OVER () AS r,
         regexp_extract_all({tag}, '{NUM}{number}|[{NAME}{UNIT}]?[\p{{L}}\p{{M}}\p{{N}}]+') AS v
  FROM src),
tpl AS (SELECT *, list_transform(v, lambda t: CASE WHEN regexp_matches(t, '^{slot}') THEN t[1] ELSE t END) AS t FROM tok),
win AS (
  SELECT side, id, r, i - 1 AS pos, len(t) AS n, array_to_string(t[i:i + {WINDOW - 1}], ' ') AS w,
         len(list_filter(t[i:i + {WINDOW - 1}], lambda x: NOT regexp_matches(x, '^{slot}'))) AS literals
  FROM (SELECT *, unnest(range(1, len(t) - {WINDOW - 2})) AS i FROM tpl WHERE len(t) >= {WINDOW})),
key AS (SELECT id AS item_id, r AS item_r, w, n, min(pos) AS item_pos FROM win WHERE side = 'b' AND literals >= {MIN_LITERALS} GROUP BY ALL),
hit AS (SELECT DISTINCT d.id AS doc_id, d.r AS doc_r, k.item_id, k.item_r, k.n, d.pos - k.item_pos AS shift, k.item_pos
        FROM win d JOIN key k USING (w) WHERE d.side = 'd'),
cov AS (
  SELECT doc_r, item_r, any_value(doc_id) AS doc_id, any_value(item_id) AS item_id, any_value(n) AS n, sum(gain) AS n_covered
  FROM (SELECT *, least({WINDOW}, coalesce(lead(item_pos) OVER (PARTITION BY doc_r, item_r ORDER BY item_pos) - item_pos, {WINDOW})) AS gain
        FROM (SELECT DISTINCT doc_r, item_r, doc_id, item_id, n, item_pos FROM hit))
  GROUP BY doc_r, item_r),
best AS (
  SELECT doc_r, item_r, shift FROM (SELECT doc_r, item_r, shift, count(*) AS c FROM hit GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY doc_r, item_r ORDER BY c DESC, shift) = 1),
cand AS (
  SELECT cov.*, best.shift FROM cov JOIN best USING (doc_r, item_r)
  WHERE n_covered >= {COVERAGE} * n AND n_covered >= least({MIN_TOKENS}, n - 2)),
slots AS (
  SELECT r AS item_r, i - 1 AS pos, v[i] AS value FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM tpl WHERE side = 'b')
  WHERE regexp_matches(v[i], '^{slot}')),
pairs AS (
  SELECT c.doc_r, c.item_r, s.value AS item, d.v[s.pos + c.shift + 1] AS doc
  FROM cand c JOIN slots s USING (item_r) JOIN tpl d ON d.r = c.doc_r
  WHERE s.pos + c.shift >= 0 AND d.v[s.pos + c.shift + 1][1] = s.value[1]),
agree AS (
  SELECT doc_r, item_r, least(count(DISTINCT item), count(DISTINCT doc)) / count(DISTINCT (item, doc)) AS ratio, bool_or(item <> doc) AS differ
  FROM pairs GROUP BY doc_r, item_r)
SELECT DISTINCT c.doc_id, c.item_id, c.n::INT AS n_tokens, n_covered::INT AS n_covered, n_covered / c.n AS coverage,
       coalesce(k.n_slots, 0)::INT AS n_slots, coalesce(a.ratio, 1.0) AS slot_consistency, coalesce(a.differ, false) AS reparameterised
FROM cand c LEFT JOIN agree a USING (doc_r, item_r)
LEFT JOIN (SELECT item_r, count(*) AS n_slots FROM slots GROUP BY item_r) k USING (item_r)
WHERE coalesce(a.ratio, 1.0) >= {CONSISTENCY}
"""
