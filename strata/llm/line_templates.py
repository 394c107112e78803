"""Line dedup by a log-template tree.

Every line walks a tree of fixed depth: token count, then the leading tokens, then its template.
Tokens that are variable by themselves (digits, addresses) are masked first, unless the line has more of
them than literal words: rows of figures hardly have a template, and only equal rows recur.  At the bottom a line
belongs to the literal template of its masked tokens and, if it is long enough, to ``FIELDS`` templates
in which one run of tokens behind the leading ones is a free field; two lines that differ only
inside such a run share a template.  A template recurs if lines of different documents
have it; recurring templates are dropped everywhere but in the first document (smallest id).

Literal templates are settled first; what remains of them, with all other lines, is settled by the
templates with a free field.  Both steps are keyed sums (smallest and largest document per template),
combined before the shuffle, so a line that a third of all documents share costs one row per task.

Lines of fewer than ``MIN_TOKENS`` tokens carry no template and always stay.

Defined results: NULL text stays NULL and has no lines; an empty text stays empty; rows that share an
id are one document (a line they share does not recur); NULL ids are one document, last in order; a
document's own repetitions stay in the first document; repeated rows are treated alike; an empty table
gives an empty result; extra columns are handed on by ``clean`` and ignored by ``dedup``.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, cut, fresh, per_batch, raw, small_batches

MIN_TOKENS = 6
LEADING = 3
FIELDS = 5
MIN_FIELD_TOKENS = 13  # from here on a field is at most a fifth of the tokens behind the leading ones, rounded up
_LAST = (1 << 63) - 1

_VARIABLE = re.compile(rb"[0-9@]|://|^www\.")
_ANY_VARIABLE = re.compile(rb"[0-9@]|://|www\.")
_LETTER = re.compile(rb"[a-z\x80-\xff]")


def _signed(b: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b) - (1 << 63)


def templates(line: bytes) -> tuple[int, list[int]] | None:
    """(literal template, templates with one free field) of a line; None if it is too short."""
    tokens = line.lower().split()
    n = len(tokens)
    if n < MIN_TOKENS:
        return None
    if _ANY_VARIABLE.search(line):
        masked = [b"<*>" if _VARIABLE.search(t) else t for t in tokens]
        # tokens without a letter (rules, column bars) count for neither side
        if sum(t == b"<*>" for t in masked) > sum(t != b"<*>" and _LETTER.search(t) is not None for t in masked):
            return _signed(b" ".join(tokens)), []
        tokens = masked
    fields = []
    if n >= MIN_FIELD_TOKENS:
        rest = n - LEADING
        for g in range(FIELDS):
            # the field: positions p with (p - LEADING) * FIELDS // rest == g
            a, b = LEADING + -(-g * rest // FIELDS), LEADING + -(-(g + 1) * rest // FIELDS)
            fields.append(_signed(b"%d %d " % (n, g) + b" ".join(tokens[:a]) + b" <*> " + b" ".join(tokens[b:])))
    return _signed(b" ".join(tokens)), fields


_ROW = pa.list_(pa.struct([("no", pa.int32()), ("literal", pa.int64()), ("fields", pa.list_(pa.int64()))]))


def _lines(text_col: str) -> Column:
    def make():
        def run(texts: list[bytes]) -> pa.Array:
            out = []
            for t in texts:
                rows = []
                for i, line in enumerate(t.split(b"\n")):
                    found = templates(line)
                    if found:
                        rows.append({"no": i, "literal": found[0], "fields": found[1]})
                out.append(rows)
            return pa.array(out, type=_ROW)
        return run
    return per_batch(make, "array<struct<no:int,literal:bigint,fields:array<bigint>>>")(raw(text_col))


def _recurring(keys: DataFrame) -> DataFrame:
    """(key, first document) of the keys that several documents have, from ``key, doc``."""
    return (keys.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("_last"))
            .where("first < _last").select("key", "first"))


def dropped_lines(docs: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc, text_key, numbers of the lines to drop) of the documents that lose lines."""
    small_batches(docs.sparkSession)
    lines = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("text_key"),
                        F.explode(_lines("text")).alias("l")).select("doc", "text_key", "l.*")
    lines = cut(lines, "line-templates")
    literal = cut(_recurring(lines.select(F.col("literal").alias("key"), "doc")), "line-recurring")
    joined = lines.join(bounded_broadcast(literal, literal.count(), broadcast_rows), lines["literal"] == literal["key"], "left")
    joined = cut(joined.select("doc", "text_key", "no", (F.col("first") < F.col("doc")).alias("late"),
                               F.when(F.coalesce(F.col("first") >= F.col("doc"), F.lit(True)), F.col("fields")).alias("fields")),
                 "line-literal")
    free = joined.where(F.size("fields") > 0).select("doc", "text_key", "no", F.explode("fields").alias("key"))
    field = cut(_recurring(free.select("key", "doc")), "line-recurring")
    again = (free.join(bounded_broadcast(field, field.count(), broadcast_rows), "key").where("first < doc")
             .select("doc", "text_key", "no"))
    return (joined.where("late").select("doc", "text_key", "no").union(again)
            .groupBy("doc", "text_key").agg(F.array_sort(F.collect_set("no")).alias("drop")))


def _with_drops(docs: DataFrame, broadcast_rows: int) -> tuple[DataFrame, str]:
    """The input with the numbers of the lines to drop (NULL: none) in a column of a new name."""
    drops = cut(dropped_lines(docs, broadcast_rows), "line-drops")
    d, k, x = fresh(docs, "_line_doc"), fresh(docs, "_line_key"), fresh(docs, "_line_drop")
    small = bounded_broadcast(drops.toDF(d, k, x), drops.count())
    on = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)) == F.col(d)) & (F.xxhash64("text") == F.col(k))
    return docs.join(small, on, "left").drop(d, k), x


def _rest(drop: str) -> Column:
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(F.col(drop), i))
    return F.when(F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def dedup(docs: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, text`` (what is left)."""
    both, drop = _with_drops(docs.select("doc_id", "text"), broadcast_rows)
    return both.select("doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"),
                       F.coalesce(F.size(drop), F.lit(0)).alias("n_dropped"), _rest(drop).alias("text"))


def clean(docs: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The input's rows and columns with shortened texts; documents that lose their last word go.

    A column ``n_chars`` of a shortened document is set to the length of what is left.
    """
    both, drop = _with_drops(docs, broadcast_rows)
    left = both.withColumn("text", _rest(drop)).where(F.col(drop).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(drop).isNull(), F.col("n_chars"))
                               .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return left.select(*docs.columns)


def oracle() -> str:
    """DuckDB restatement of ``dedup`` on documents, templates written out."""
    field = (f"[' ' || n, ' ' || g, array_to_string(t[1:a], ' '), array_to_string(t[b + 1:n], ' ')]")
    edge = "({LEADING} + ceil({g} * (n - {LEADING}) / {FIELDS}::DOUBLE))::INT"
    a = edge.format(g="g", LEADING=LEADING, FIELDS=FIELDS)
    b = edge.format(g="(g + 1)", LEADING=LEADING, FIELDS=FIELDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_LAST}) AS doc, text FROM documents),
l AS (SELECT r, doc, i - 1 AS no, string_split(text, chr(10))[i] AS line
      FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
t AS (SELECT *, len(t) AS n FROM (
        SELECT r, doc, no, list_transform(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'),
               lambda x: CASE WHEN regexp_matches(x, '[0-9@]|://|^www\.') THEN '<*>' ELSE x END) AS t FROM l)
      WHERE len(t) >= {MIN_TOKENS}),
lit AS (SELECT t, min(doc) AS first FROM t GROUP BY t HAVING min(doc) < max(doc)),
one AS (SELECT t.*, coalesce(lit.first < t.doc, false) AS late FROM t LEFT JOIN lit USING (t)),
seg AS (SELECT r, doc, no, {field} AS key FROM (
          SELECT *, {a} AS a, {b} AS b FROM (
            SELECT *, unnest(range({FIELDS})) AS g FROM one WHERE NOT late AND n >= {MIN_FIELD_TOKENS}))),
rec AS (SELECT key, min(doc) AS first FROM seg GROUP BY key HAVING min(doc) < max(doc)),
gone AS (SELECT r, no FROM one WHERE late UNION SELECT r, no FROM seg JOIN rec USING (key) WHERE first < doc),
left_over AS (
  SELECT r, string_agg(line, chr(10) ORDER BY no) AS text, count(*) FILTER (gone.no IS NOT NULL) AS n FROM (
    SELECT l.r, l.no, CASE WHEN g.no IS NULL THEN line END AS line, g.no AS gone_no FROM l LEFT JOIN gone g USING (r, no)) x
  LEFT JOIN gone USING (r, no) GROUP BY r)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::INT AS n_lines, coalesce(o.n, 0)::INT AS n_dropped,
       CASE WHEN coalesce(o.n, 0) = 0 THEN d.text ELSE coalesce(o.text, '') END AS text
FROM d LEFT JOIN left_over o USING (r)
"""
