"""String normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keep(text: Column) -> Column:
    """The value as it is (ids and integration keys)."""
    return text


def trimmed(text: Column) -> Column:
    """Without surrounding spaces; tabs and line breaks stay."""
    return F.trim(text)


def proper_case(text: Column) -> Column:
    """Trimmed, each space-separated word capitalised."""
    return F.initcap(F.trim(text))


def lower_trimmed(text: Column) -> Column:
    return F.lower(F.trim(text))


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))


def normalize_email(text: Column) -> Column:
    return lower_trimmed(text)


def normalize_currency(text: Column) -> Column:
    return upper_trimmed(text)


def derive_full_name(full: Column, first: Column, last: Column) -> Column:
    """The full name, or first and last joined; an empty string when all three are NULL."""
    return F.coalesce(proper_case(full), F.concat_ws(" ", proper_case(first), proper_case(last)))
