"""Rules over several tables (Q6): references that lead nowhere and keys that are not unique.

Row rules (``operators/quality.py``) see one row.  These see a table against another or against itself, and give
rejected rows in the same form: the rows with ``rejection_reason`` and ``rejected_field``.

* ``orphans``: the distinct referenced keys, not the rows, are held against the parent's keys, so a key with a third of all
  rows crosses the join once; NULL keys refer to nothing and are left to a NOT NULL rule.
* ``repeated``: keys are counted with partial sums before they are shuffled; rows of counted keys are then found by a semi join.

Both find the offending *keys* first and then the rows that hold them.  ``violations`` evaluates its input once: the rows
are stored with a number each, rules see numbers and keys only, and the whole rows are joined once with what was found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import fresh_dir

MSG_ORPHAN = "{field}: no existe en {parent}"
ROW = "_violating_row"
MSG_REPEATED = "{field}: clave repetida"


@dataclass(frozen=True)
class Reference:
    """``fields`` of the child must be among ``parent_fields`` of the parent; ``only`` restricts the rows that refer at all."""
    fields: tuple[str, ...]
    parent: str
    parent_fields: tuple[str, ...]
    only: Column | None = None


@dataclass(frozen=True)
class Unique:
    fields: tuple[str, ...]


def _present(fields: Sequence[str]) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & F.col(f).isNotNull()
    return out


def _rows_of(df: DataFrame, keys: DataFrame, fields: Sequence[str], message: str) -> DataFrame:
    return df.join(keys, list(fields), "left_semi").select(
        *df.columns, F.lit(message).alias("rejection_reason"), F.lit(fields[0]).alias("rejected_field"))


def orphan_keys(child: DataFrame, parent: DataFrame, rule: Reference) -> DataFrame:
    """Distinct referenced keys that the parent lacks."""
    refers = _present(rule.fields) if rule.only is None else _present(rule.fields) & F.coalesce(rule.only, F.lit(False))
    asked = child.where(refers).select(*rule.fields).distinct()
    known = parent.where(_present(rule.parent_fields)).select(
        *[F.col(p).alias(c) for p, c in zip(rule.parent_fields, rule.fields)]).distinct()
    return asked.join(known, list(rule.fields), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, rule: Reference) -> DataFrame:
    """Rows whose reference leads nowhere, with a reason."""
    rows = child if rule.only is None else child.where(F.coalesce(rule.only, F.lit(False)))
    return _rows_of(rows, orphan_keys(child, parent, rule), rule.fields,
                    MSG_ORPHAN.format(field=rule.fields[0], parent=rule.parent))


def repeated(df: DataFrame, rule: Unique) -> DataFrame:
    """All rows of keys that several rows have, with a reason."""
    keys = df.where(_present(rule.fields)).groupBy(*rule.fields).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*rule.fields)
    return _rows_of(df, keys, rule.fields, MSG_REPEATED.format(field=rule.fields[0]))


def _numbered(df: DataFrame) -> DataFrame:
    """The rows, stored, each with a number that stays."""
    rows = df.withColumn(ROW, F.monotonically_increasing_id())
    path = fresh_dir(df.sparkSession, "violations")
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def violations(df: DataFrame, rules: Sequence[Reference | Unique], parents: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows of all rules; a row that breaks several appears once for each."""
    rows, found = _numbered(df), None
    for r in rules:
        if isinstance(r, Reference):
            parent = rows if parents[r.parent] is df else parents[r.parent]
            bad = orphans(rows, parent, r)
        else:
            bad = repeated(rows, r)
        bad = bad.select(ROW, "rejection_reason", "rejected_field")
        found = bad if found is None else found.unionByName(bad)
    return rows.join(found, ROW).select(*[F.col(f"`{c}`") for c in df.columns], "rejection_reason", "rejected_field")
