"""Scalar building blocks over text columns."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

CENT = Decimal("0.01")


def is_blank(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit("")).isNull()


def any_blank(names: Iterable[str]) -> Column:
    return reduce(or_, [is_blank(F.col(name)) for name in names])


def code(text: Column) -> Column:
    """Case- and space-insensitive form of a catalogue value."""
    return F.upper(F.trim(text))


# How dates, times, amounts and flags may be written. "spark": as Spark's casts read them. "full": a date or time
# must name its day, slashes may stand for dashes and digits may be grouped by single underscores; a flag has no spaces around it.
FORMS = ("spark", "full")


def _known(forms: str) -> bool:
    if forms not in FORMS:
        raise ValueError(f"text forms are {FORMS}, not {forms!r}")
    return forms == "full"


def _dashed(text: Column) -> Column:
    """A text that begins with a whole date, with dashes; NULL for others."""
    one_kind = text.rlike(r"^\s*\d{4,}(-\d{1,2}-|/\d{1,2}/)\d{1,2}")
    return F.when(one_kind, F.regexp_replace(text, r"^(\s*\d{4,})/(\d{1,2})/", "$1-$2-"))


def amount(text: Column, forms: str = "spark") -> Column:
    if _known(forms):
        text = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return text.try_cast("decimal(18,2)")


def instant(text: Column, forms: str = "spark") -> Column:
    """Zone-less timestamp; feeds are UTC by contract."""
    return (_dashed(text) if _known(forms) else text).try_cast("timestamp_ntz")


def day(text: Column, forms: str = "spark") -> Column:
    return (_dashed(text) if _known(forms) else text).try_cast("date")


def flag(text: Column, forms: str = "spark") -> Column:
    if _known(forms):
        text = F.when(text == F.trim(text), text)
    return text.try_cast("boolean")


def stored_amount(value: Column, label: Column) -> Column:
    """Narrow a parsed amount to DECIMAL(12,2), failing the job when it does not fit."""
    narrow = value.try_cast("decimal(12,2)")
    message = F.concat(F.lit("amount does not fit DECIMAL(12,2): "), label)
    too_wide = value.isNotNull() & narrow.isNull()
    return F.when(too_wide, F.raise_error(message).cast("decimal(12,2)")).otherwise(narrow)


def record_id(value: Column, prefix: str, row_number: Column) -> Column:
    """The record's own id, or a name built from its row number when the id is empty."""
    fallback = F.concat(F.lit(prefix), row_number.cast("string"))
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def pseudonym(value: Column) -> Column:
    return F.sha2(value, 256)


def is_digest(value: Column) -> Column:
    return value.rlike("^[0-9a-f]{64}$")


def differs(left: Column, right: Column) -> Column:
    """Null-aware inequality: never NULL itself."""
    return ~left.eqNullSafe(right)


def beyond_cent(left: Column, right: Column) -> Column:
    return F.abs(left - right) > F.lit(CENT)


def money(value: Column) -> Column:
    """Published money width, the same for every engine that reads it."""
    return F.round(value, 2).cast("decimal(18,2)")


def total(value: Column) -> Column:
    """Sum that is zero on an empty table."""
    return F.coalesce(F.sum(value), F.lit(0))
