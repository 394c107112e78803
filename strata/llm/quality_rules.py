"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one long whose
bit *i* says that rule *i* failed.  A policy is a named, versioned set of rules; applying it is
``failure_bits & mask = 0``, so policies can be changed, compared and ablated from the ledger
without reading a text again.

Defined results: NULL and empty texts measure zero everywhere (and fail ``too_few_words``);
repeated rows are measured each on its own; an empty table gives an empty ledger.  Extra columns
of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import per_text, raw, small_batches

WINDOW = 5
_BLANKS = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_CONTINUATION = bytes(range(0x80, 0xC0))
_HIGH = bytes(range(0x80, 0x100))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower",
            "n_high", "n_unique_words"]


def repeated_words(words: list[bytes], width: int = WINDOW) -> tuple[int, int]:
    """(words that lie in a ``width``-word window found twice or more, distinct words)."""
    n = len(words)
    ids: dict[bytes, int] = {}
    seq = [ids.setdefault(w, len(ids)) for w in words]
    v = len(ids)
    if n <= width or v == n:
        return 0, v
    a = np.array(seq, dtype=np.int64)
    m = n - width + 1
    if v ** width < 2 ** 62:
        key = a[:m].copy()
        for j in range(1, width):
            key = key * v + a[j:j + m]
    else:
        # renumber prefixes of the window, one word longer each time: exact at any vocabulary
        key = a[:m]
        for j in range(1, width):
            key = np.unique(key * v + a[j:j + m], return_inverse=True)[1]
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0, v
    at = np.nonzero(np.isin(key, twice))[0]
    marked = np.zeros(n, dtype=bool)
    for j in range(width):
        marked[at + j] = True
    return int(marked.sum()), v


def measure(text: bytes) -> tuple:
    n = len(text)
    words = text.split()
    dense = text.translate(None, _BLANKS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated, unique = repeated_words(words)
    return (len(words), len(dense.translate(None, _CONTINUATION)), n - len(text.translate(None, _SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated, n - len(text.translate(None, _UPPER)),
            n - len(text.translate(None, _LOWER)), len(dense) - len(dense.translate(None, _HIGH)), unique)


def _measures(text_col: str) -> Column:
    udf = per_text(lambda: measure, ", ".join(f"{m} bigint" for m in MEASURES),
                   pa.struct([(m, pa.int64()) for m in MEASURES]))
    return udf(raw(text_col))


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurement columns, in integers so that no rounding decides."""

    name: str
    failed: str


#: The order fixes the bit numbers: append, never reorder.
RULES = [
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbol_heavy", "4 * n_symbols > n_words"),
    Rule("shouting", "n_upper > 2 * n_lower and n_upper > n_high and n_words >= 10"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("few_letters", "2 * (n_upper + n_lower + n_high) < word_chars"),
    Rule("low_variety", "n_words >= 100 and 20 * n_unique_words < n_words"),
]
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}

#: Versioned policies.  ``base`` is the fixed floor; a document is kept if none of a policy's rules failed.
POLICIES = {
    "base": ["too_few_words", "repeated_windows"],
    "v1": ["too_few_words", "repeated_windows", "repeated_lines", "low_variety"],
    "v2": ["too_few_words", "repeated_windows", "symbol_heavy", "shouting", "repeated_lines", "short_words",
           "long_words", "few_letters", "low_variety"],
}
PRODUCTION = "v2"


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements, ``failure_bits``."""
    small_batches(docs.sparkSession)
    m = docs.select(F.col(id_col), _measures(text_col).alias("m")).select(id_col, "m.*")
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(BIT[r.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return m.withColumn("failure_bits", bits)


def verdict(policy: str = PRODUCTION, bits: str = "failure_bits") -> Column:
    """True if the document passes the policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(book: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that only this rule rejects, and that pass without it.

    One aggregation over the distinct bit patterns (at most 2^rules, in practice dozens); an
    empty ledger gives one row of zeros per policy and rule.
    """
    policies = policies or list(POLICIES)
    patterns = book.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    aggs, names = [], []
    for p in policies:
        for r in POLICIES[p]:
            bit, hit = BIT[r], F.col("failure_bits").bitwiseAND(F.lit(mask(p)).cast("long"))
            i = len(names)
            names.append((p, r))
            total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
            aggs += [total(hit.bitwiseAND(F.lit(bit).cast("long")) != 0).alias(f"f{i}"),
                     total(hit == bit).alias(f"o{i}"),
                     total(hit.bitwiseAND(F.lit(~bit).cast("long")) == 0).alias(f"k{i}")]
    wide = patterns.agg(*aggs, F.coalesce(F.bit_or("failure_bits"), F.lit(0)).alias("seen_bits"))
    rows = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.col(f"f{i}").alias("n_failed"),
                              F.col(f"o{i}").alias("n_only"), F.col(f"k{i}").alias("n_kept_without"),
                              (F.col("seen_bits").bitwiseAND(F.lit(BIT[r]).cast("long")) != 0).alias("ever_failed"))
                     for i, (p, r) in enumerate(names)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def oracle() -> str:
    """DuckDB restatement of the measurements, rules and the production verdict over documents."""
    bits = " + ".join(f"CASE WHEN {r.failed} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
        FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
twice AS (SELECT r, w FROM win GROUP BY r, w HAVING count(*) > 1),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN twice USING (r, w)) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[a-z]')) AS n_lower,
         strlen(text) - len(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS n_high, len(list_distinct(words)) AS n_unique_words
  FROM w LEFT JOIN hit USING (r)),
b AS (SELECT *, ({bits})::BIGINT AS failure_bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, failure_bits,
       (failure_bits & {mask("base") | mask(PRODUCTION)}) = 0 AS kept
FROM b
"""
