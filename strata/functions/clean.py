"""Cleaning and normalisation: every function maps a column to a Column.

All of them are native Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen and are null-safe and ANSI-safe: parsing uses
``try_*`` variants, never a cast that can raise on dirty input.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions import constants as K

ColumnLike = str | Column

ISO_DATE, LATIN_DATE = K.DATE_LAYOUTS_TX
# Text shape each layout needs (zero-padded); checked before parsing so that
# rows that cannot match never reach the (exception-driven) parser.
DATE_SHAPES = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$", "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$", "dd-MM-yyyy": r"^\d{2}-\d{2}-\d{4}$",
}
# Order matters: the first format that parses wins.
TX_DATE_FORMATS = tuple(K.DATE_LAYOUTS_TX)
MULTI_DATE_FORMATS = tuple(K.DATE_LAYOUTS_MULTI)


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(mapping: dict[str, str]) -> Column:
    """A literal ``map<string,string>`` for alias lookups."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def _invert(groups: dict[str, list[str]]) -> dict[str, str]:
    return {alias: target for target, aliases in groups.items() for alias in aliases}


# --- C3: trims ---------------------------------------------------------------

def trim_col(c: ColumnLike) -> Column:
    """Spaces removed at both ends (tabs/newlines are kept, like SQL TRIM)."""
    return F.trim(_col(c))


def trim_lower_col(c: ColumnLike) -> Column:
    return F.lower(F.trim(_col(c)))


def blank_to_null(c: ColumnLike) -> Column:
    """Trimmed value, with the empty string turned into NULL."""
    v = F.trim(_col(c))
    return F.when(v != "", v)


# --- C1 / C7: dates -------------------------------------------------------------

def parse_date(c: ColumnLike, formats: tuple[str, ...] = TX_DATE_FORMATS) -> Column:
    """First format (strict, zero-padded) that parses the trimmed text; else NULL."""
    v = F.trim(_col(c))
    return F.coalesce(*[F.when(v.rlike(DATE_SHAPES[fmt]), F.try_to_date(v, fmt)) for fmt in formats])


def normalize_date(c: ColumnLike) -> Column:
    """ISO date, then dd/MM/yyyy."""
    return parse_date(c, TX_DATE_FORMATS)


def parse_date_multi(c: ColumnLike) -> Column:
    """Placeholder-aware parse over four day/month/year layouts."""
    return parse_date(clean_string(c), MULTI_DATE_FORMATS)


# --- C2 / C8: amounts -------------------------------------------------------------

def normalize_amount(c: ColumnLike) -> Column:
    """Free-text amount -> positive DOUBLE or NULL.

    Keeps digits and separators, reads every comma as a dot and keeps only
    the right-most dot as the decimal point (so both ``1,234.56`` and
    ``1.234,56`` give 1234.56).  Signs and currency symbols are dropped.
    """
    kept = F.regexp_replace(F.trim(_col(c)), K.AMOUNT_DROP_CHARS, "")
    dotted = F.translate(kept, ",", ".")
    one_point = F.regexp_replace(dotted, r"\.(?=[^.]*\.)", "")
    value = one_point.try_cast("double")
    return F.when(value > 0, value)


def parse_amount(c: ColumnLike) -> Column:
    """Signed DECIMAL(18,2); the first reading that holds decides.

    Thousands commas (``1,234.56``), a decimal comma (``12,5``), else the text as it is (``-50``).  Text that
    fits none, such as ``1.234,56``, is NULL.
    """
    text = F.regexp_replace(clean_string(c), K.SIGNED_AMOUNT_DROP_CHARS, "")
    readings = [F.when(text.rlike(shape), F.translate(text, ",", point)) for shape, point in K.AMOUNT_COMMA_SHAPES]
    return F.coalesce(*[r.try_cast("decimal(18,2)") for r in [*readings, text]])


# --- C5 / C6: placeholders ----------------------------------------------------------

def clean_string(c: ColumnLike) -> Column:
    """Trimmed text; empty or a known placeholder token (any case) becomes NULL."""
    v = F.trim(_col(c).cast("string"))
    is_placeholder = (v == "") | F.upper(v).isin(*K.PLACEHOLDER_TOKENS)
    return F.when(~is_placeholder, v)


def lower_clean(c: ColumnLike) -> Column:
    """C6."""
    return F.lower(clean_string(c))


def normalize_email(c: ColumnLike) -> Column:
    """E-mail addresses compare case-insensitively."""
    return lower_clean(c)


# --- C9 - C13: domain normalisers ------------------------------------------------------

def normalize_country(c: ColumnLike) -> Column:
    """Country aliases (any case, accents included) -> ISO code; unknown text is kept."""
    v = F.upper(clean_string(c))
    return F.coalesce(_lookup(_invert(K.COUNTRY_ALIASES))[v], v)


def normalize_status(c: ColumnLike) -> Column:
    """Merchant status in Spanish; other values pass through lower-cased."""
    v = lower_clean(c)
    return F.coalesce(_lookup(K.STATUS_ALIASES)[v], v)


def normalize_risk_level(c: ColumnLike) -> Column:
    """C11: 'unclassified' tokens -> NULL."""
    v = lower_clean(c)
    return F.when(~v.isin(*K.UNCLASSIFIED_RISK), v)


def normalize_segment(c: ColumnLike) -> Column:
    """Segment aliases -> premium / estandar / nuevo."""
    v = lower_clean(c)
    return F.coalesce(_lookup(_invert(K.SEGMENT_ALIASES))[v], v)


def normalize_phone(c: ColumnLike) -> Column:
    """Digits only, international form for the home country.

    An explicit ``+`` or a leading country prefix keeps the number as
    ``+<digits>``; a bare subscriber number gets the country prefix.
    """
    text = clean_string(c)
    digits = F.regexp_replace(text, "[^0-9]", "")
    international = text.startswith("+") | digits.startswith(K.PHONE_COUNTRY_PREFIX)
    local = F.length(digits) == K.PHONE_LOCAL_DIGITS
    return F.concat(F.when(international, "+").when(local, f"+{K.PHONE_COUNTRY_PREFIX}").otherwise(""), digits)


# --- C4 and per-source cleaning -------------------------------------------------------------

TX_BUSINESS_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "channel", "transaction_type",
    "amount", "currency", "transaction_date", "status", "reference_id",
]
MERCHANT_BUSINESS_COLUMNS = [
    "merchant_id", "merchant_name", "category", "country", "affiliation_date", "status", "risk_level",
]
USER_BUSINESS_COLUMNS = [
    "user_id", "full_name", "document_id", "email", "phone", "country", "segment", "registration_date",
]


def transaction_cleaners() -> dict[str, Column]:
    """C4: ten cleaned business columns, keyed by output name."""
    return {
        "transaction_id": trim_col("transaction_id"),
        "user_id": trim_col("user_id"),
        "merchant_id": trim_col("merchant_id"),
        "channel": trim_lower_col("channel"),
        "transaction_type": trim_lower_col("transaction_type"),
        "amount": normalize_amount("amount"),
        "currency": F.upper(F.trim(F.col("currency"))),
        "transaction_date": normalize_date("transaction_date"),
        "status": trim_lower_col("status"),
        "reference_id": blank_to_null("reference_id"),
    }


def merchant_cleaners() -> dict[str, Column]:
    return {
        "merchant_id": clean_string("merchant_id"),
        "merchant_name": clean_string("merchant_name"),
        "category": lower_clean("category"),
        "country": normalize_country("country"),
        "affiliation_date": parse_date_multi("affiliation_date"),
        "status": normalize_status("status"),
        "risk_level": normalize_risk_level("risk_level"),
    }


def user_cleaners() -> dict[str, Column]:
    return {
        "user_id": clean_string("user_id"),
        "full_name": clean_string("full_name"),
        "document_id": clean_string("document_id"),
        "email": normalize_email("email"),
        "phone": normalize_phone("phone"),
        "country": normalize_country("country"),
        "segment": normalize_segment("segment"),
        "registration_date": parse_date_multi("registration_date"),
    }


def apply_cleaners(df, cleaners: dict[str, Column]):
    """One projection: cleaned business columns, every other column kept as is.

    A single ``select`` keeps the plan flat (no chain of ``withColumn``).
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in cleaners]
    return df.select(*[expr.alias(name) for name, expr in cleaners.items()], *rest)


def clean_transactions(df):
    """C4."""
    return apply_cleaners(df, transaction_cleaners())


def clean_merchants(df):
    return apply_cleaners(df, merchant_cleaners())


def clean_users(df):
    return apply_cleaners(df, user_cleaners())
