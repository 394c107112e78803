"""Deduplication operators.

``latest_by`` keeps one whole row per key with a window ``row_number() = 1``.
Catalyst plans that as a map-side ``WindowGroupLimit`` before the exchange,
so at most one row per key and map task is shuffled - a hot key holding a
third of the data is reduced locally before it reaches the reducer.

Rows whose key has a NULL component are not "duplicates of each other":
they bypass the window (no single-partition NULL hot spot) and are kept as
they are, so a later quality rule can quarantine them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_MARK = "\\N"          # stands for NULL inside the hashed text
HASH_SEP = "\u001f"         # unit separator between hashed fields


def _key_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def record_hash(columns: Sequence[str]) -> Column:
    """Stable SHA-256 of the business columns (NULL and '' kept distinct)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], null_keys: bool = True) -> DataFrame:
    """Newest row per key; ``order`` lists the recency columns, most significant first.

    The ordering must be total for a deterministic result - end it with a
    content hash (see :func:`record_hash`) when timestamps can tie.

    Rows with a NULL key component are passed through untouched (a second,
    filtered branch over the same input).  Callers whose input cannot hold any, or
    that do not want them, pass ``null_keys=False`` and read the input once.
    """
    if not keys:
        raise ValueError("latest_by needs at least one key column")
    present = _key_present(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    keyed = (
        df.filter(present)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )
    return keyed.unionByName(df.filter(~present)) if null_keys else keyed
