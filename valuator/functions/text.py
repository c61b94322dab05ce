"""Text cleaning column builders (P1–P3). Pure Column -> Column, JVM regex only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's title-cleaning rules:
# the COE-expiry pattern, the year / engine-capacity / mileage pattern, and
# the four transmission and fuel words removed from titles.
COE_PATTERN = r"\(COE till (\d{2}/\d{4})\)"
COE_REMOVE_PATTERN = r"\(COE till \d{2}/\d{4}\)"
YEAR_CAPACITY_MILEAGE_PATTERN = r"(?i)\b\d{4}\b|\d+(\.\d+)?(cc|l|litre|liter)|[0-9]+\s*(km|kms)"
COMMON_WORDS_PATTERN = r"(?i)\b(auto|manual|diesel|petrol)\b"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squash_spaces(c: str | Column) -> Column:
    """Python's ' '.join(s.split()): trim and collapse whitespace runs."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def clean_title(c: str | Column) -> Column:
    """Drop '(COE till MM/YYYY)', years, capacities, mileages and
    auto/manual/diesel/petrol words; collapse spaces."""
    t = F.regexp_replace(_col(c), COE_REMOVE_PATTERN, "")
    t = F.regexp_replace(t, YEAR_CAPACITY_MILEAGE_PATTERN, "")
    t = F.regexp_replace(t, COMMON_WORDS_PATTERN, "")
    return squash_spaces(t)


def extract_expiry(c: str | Column) -> Column:
    """P2: 'MM/YYYY' from '(COE till MM/YYYY)', null when absent."""
    return F.nullif(F.regexp_extract(_col(c), COE_PATTERN, 1), F.lit(""))


def clean_token(c: str | Column) -> Column:
    """Lowercase, '/'->'_', drop non-word characters, whitespace runs -> '_'.

    Word characters are letters and digits of any script, and '_'.
    Null input gives '' as in the later variant.
    """
    s = F.lower(_col(c))
    s = F.replace(s, F.lit("/"), F.lit("_"))
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_\s]", "")
    s = F.regexp_replace(s, r"\s+", "_")
    return F.coalesce(F.trim(s), F.lit(""))


def first_word(c: str | Column) -> Column:
    return F.split(F.trim(_col(c)), r"\s+", 2)[0]
