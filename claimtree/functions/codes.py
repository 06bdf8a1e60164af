"""Column expressions for claim codes, dates and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_bucket(text: Column) -> Column:
    """``MM-dd-yyyy`` text to ``yyyy-MM``; unreadable text gives NULL instead of failing the job."""
    return F.date_format(F.try_to_timestamp(text, F.lit("MM-dd-yyyy")), "yyyy-MM")


def pad_code(code: Column, width: int = 11) -> Column:
    """Left-pad with zeros to ``width``; a longer code is cut to ``width``."""
    return F.lpad(code, width, "0")


def flag_340b(id_340b: Column) -> Column:
    return F.when(id_340b.isNull(), "No").otherwise("yes")


def contains_ci(text: Column, term: str) -> Column:
    return F.lower(text).contains(term.lower())


def null_token(text: Column) -> Column:
    """NULL for the id spellings ``null`` (any case) and ``-``."""
    value = text.cast("string")
    return F.when(~F.lower(value).isin("null", "-"), value)
