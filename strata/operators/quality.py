"""Declarative data-quality rules.

A rule set is an ordered list of :class:`Rule`.  From the one list we derive
the reject flag, the first-failing reason, the array of every failing
message and the offending field, so flag and reason can never disagree.

A rule's ``broken`` predicate may evaluate to NULL (e.g. ``channel IN (...)``
on a NULL channel).  SQL three-valued logic would make such a row neither
valid nor rejected; here NULL counts as broken, so ``valid + rejected``
always equals the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import constants as K
from strata.functions.clean import clean_string


@dataclass(frozen=True)
class Rule:
    field: str
    broken: Column      # TRUE (or NULL) when the row violates the rule
    message: Column     # text explaining the violation

    def fails(self) -> Column:
        return F.coalesce(self.broken, F.lit(True))


def _expected(values: list[str]) -> str:
    return "|".join(values)


def not_null(field: str) -> Rule:
    return Rule(field, F.col(field).isNull(), F.lit(K.MSG_NULL.format(field=field)))


def matches(field: str, pattern: str, shape: str) -> Rule:
    return Rule(field, ~F.col(field).rlike(pattern), F.lit(K.MSG_FORMAT.format(field=field, shape=shape)))


def _template(text: str, value: Column) -> Column:
    """A message template with one ``{value}`` slot filled from a column."""
    head, tail = text.split("{value}")
    return F.concat(F.lit(head), value, F.lit(tail))


def member_of(field: str, values: list[str], nullable: bool = False) -> Rule:
    c = F.col(field)
    broken = ~c.isin(*values)
    if nullable:
        broken = c.isNotNull() & broken
    text = K.MSG_VALUE.format(field=field, value="{value}", expected=_expected(values))
    return Rule(field, broken, _template(text, F.coalesce(c.cast("string"), F.lit("NULL"))))


# --- rule sets ------------------------------------------------------------------------------

def transaction_rules() -> list[Rule]:
    """Q1: silver transaction rules, in reporting priority order.

    Message texts are fixed values shared with the downstream reports.
    """
    amount = F.col("amount")
    reverse_without_ref = (F.col("transaction_type") == "reversa") & F.col("reference_id").isNull()
    return [
        not_null("transaction_id"),
        matches("transaction_id", K.TX_ID_PATTERN, K.TX_ID_SHAPE),
        not_null("user_id"),
        matches("user_id", K.USER_ID_PATTERN, K.USER_ID_SHAPE),
        not_null("merchant_id"),
        matches("merchant_id", K.MERCHANT_ID_PATTERN, K.MERCHANT_ID_SHAPE),
        not_null("channel"),
        member_of("channel", K.TX_RULE_CHANNELS),
        not_null("transaction_type"),
        member_of("transaction_type", K.TX_RULE_TYPES),
        not_null("amount"),
        Rule("amount", amount <= 0, _template(K.MSG_NOT_POSITIVE, amount.cast("string"))),
        Rule("transaction_date", F.col("transaction_date").isNull(), F.lit(K.MSG_TX_DATE)),
        not_null("status"),
        member_of("status", K.TX_RULE_STATUS),
        Rule("reference_id", F.coalesce(reverse_without_ref, F.lit(False)), F.lit(K.MSG_REVERSAL_REFERENCE)),
    ]


def _unparsed_date(field: str, raw_field: str) -> Rule:
    """The raw text held a value but no layout parsed it."""
    return Rule(field, clean_string(raw_field).isNotNull() & F.col(field).isNull(),
                F.lit(K.MSG_BAD_DATE.format(field=field)))


EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def merchant_rules() -> list[Rule]:
    """Merchants: key present and well formed; catalogue values when present; dates parse."""
    return [
        not_null("merchant_id"),
        matches("merchant_id", K.MERCHANT_ID_PATTERN, K.MERCHANT_ID_SHAPE),
        member_of("category", K.VALID_MERCHANT_CATEGORIES, nullable=True),
        member_of("country", K.VALID_COUNTRIES, nullable=True),
        _unparsed_date("affiliation_date", "_raw_affiliation_date"),
        member_of("status", K.VALID_MERCHANT_STATUS, nullable=True),
        member_of("risk_level", K.VALID_RISK_LEVELS, nullable=True),
    ]


def user_rules() -> list[Rule]:
    """Users: key present and well formed; e-mail shape; catalogue values; dates parse."""
    return [
        not_null("user_id"),
        matches("user_id", K.USER_ID_PATTERN, K.USER_ID_SHAPE),
        Rule("email", F.col("email").isNotNull() & ~F.col("email").rlike(EMAIL_PATTERN),
             F.lit(K.MSG_BAD_EMAIL)),
        member_of("country", K.VALID_COUNTRIES, nullable=True),
        member_of("segment", K.VALID_USER_SEGMENTS, nullable=True),
        _unparsed_date("registration_date", "_raw_registration_date"),
    ]


# --- evaluation ---------------------------------------------------------------------------------

_VERDICT = ("_rejected", "rejection_reason", "rejected_field", "quality_errors")


def once(df: DataFrame, *extra: Column) -> DataFrame:
    """The frame and ``extra`` columns as a generated row.

    A filter on plain projected columns is pushed below the projection, where every expression that it needs is
    evaluated a second time.  No filter passes a generator, so what lies below is evaluated once per row.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns], *extra))))


def with_verdict(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Flag, first reason, offending field and error array.

    All rules go into one bit mask, evaluated once per row together with the cleaners below it (``once``); the four outputs
    are read off the mask.
    """
    mask, cleaned = "_failed_rules", df.select(*[F.col(f"`{c}`") for c in df.columns if c not in _VERDICT])
    bits = sum((F.when(r.fails(), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)), F.lit(0))
    flagged = once(cleaned, bits.cast("long").alias(mask))
    failed = [F.getbit(mask, F.lit(i)) == 1 for i in range(len(rules))]
    return flagged.select(
        *[F.col(f"`{c}`") for c in cleaned.columns],
        (F.col(mask) != 0).alias("_rejected"),
        F.coalesce(*[F.when(f, r.message) for f, r in zip(failed, rules)]).alias("rejection_reason"),
        F.coalesce(*[F.when(f, F.lit(r.field)) for f, r in zip(failed, rules)]).alias("rejected_field"),
        F.array_compact(F.array(*[F.when(f, r.message) for f, r in zip(failed, rules)])).alias("quality_errors"),
    )
