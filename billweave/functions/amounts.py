"""Amounts held as text: a printed Python dict such as ``{'value': 12.5, 'x': None}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def _document(text: Column) -> Column:
    as_json = F.replace(F.replace(text, F.lit("None"), F.lit("null")), F.lit("'"), F.lit('"'))
    return F.try_parse_json(as_json)


def _value_text(text: Column) -> Column:
    return F.try_variant_get(_document(text), "$.value", "string")


def to_amount(text: Column) -> Column:
    """Numeric text as a double; anything else is NULL instead of an error.

    The pattern gives the whole text or nothing, so ``text`` is evaluated once.
    """
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def extracted_amount(text: Column) -> Column:
    """The ``value`` entry as a double; NULL if it is missing, null or unreadable."""
    return to_amount(_value_text(text))


def amount_unreadable(text: Column) -> Column:
    """True where there is text but it is malformed or its value is no number."""
    value = _value_text(text)
    broken = _document(text).isNull() | (value.isNotNull() & to_amount(value).isNull())
    return text.isNotNull() & broken
