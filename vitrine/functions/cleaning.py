"""Cleaning expressions used by the staging models.

SAFE_CAST in the reference is stricter than Spark's try_cast (which accepts
'1' as a boolean, '2024' as a date and surrounding blanks for numbers), so
every safe cast first checks the text shape with a regular expression and only
then casts.  All are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import bq_trim

# Fixed shapes accepted by the safe casts.
INT_SHAPE = r"^[+-]?[0-9]+$"
FLOAT_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
BOOL_SHAPE = r"(?i)^(true|false)$"
YEAR_MONTH_SHAPE = r"^[0-9]{4}-[0-9]{2}$"
RE2_SPACE = "[ \\t\\n\\f\\r]"  # \s of the reference's regex dialect


def safe_long(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(INT_SHAPE), s.try_cast("long"))


def safe_double(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(FLOAT_SHAPE), s.try_cast("double"))


def safe_date(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(DATE_SHAPE), s.try_cast("date"))


def safe_bool(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(BOOL_SHAPE), F.lower(s) == "true")


def yes_no_to_boolean(c: Column) -> Column:
    """'oui' -> true, 'non' -> false (case and blanks ignored), anything else NULL."""
    v = F.lower(bq_trim(c))
    return F.when(v == "oui", F.lit(True)).when(v == "non", F.lit(False))


def is_year_month(c: Column) -> Column:
    return c.isNotNull() & bq_trim(c).rlike(YEAR_MONTH_SHAPE)


def year_month_split(c: Column) -> tuple[Column, Column]:
    """'YYYY-MM' -> (month, year) as longs (NULL when the pieces are not integers)."""
    t = bq_trim(c)
    return safe_long(F.substring(t, 6, 2)), safe_long(F.substring(t, 1, 4))


def filled(c: Column) -> Column:
    """Completeness term `x IS NOT NULL`."""
    return F.when(c.isNotNull(), 1).otherwise(0)


def filled_text(c: Column) -> Column:
    """Completeness term `TRIM(x) <> ''` (NULL counts 0)."""
    return F.when(bq_trim(c) != "", 1).otherwise(0)


def strip_variation_suffix(produit: Column, variation: Column) -> Column:
    """Remove a trailing '<blanks>-<blanks><variation>' from the product name.

    The reference builds a regular expression per row from the (escaped)
    variation text.  Here the same test is done without a per-row pattern: the
    trimmed name must end with the trimmed variation, and what precedes it must
    end with a dash surrounded by optional blanks; that tail is removed.  A
    NULL variation leaves the name unchanged.
    """
    p = bq_trim(produit)
    v = bq_trim(variation)
    rest = F.substr(p, F.lit(1), F.length(p) - F.length(v))
    tail = f"{RE2_SPACE}*-{RE2_SPACE}*$"
    hit = v.isNotNull() & p.endswith(v) & rest.rlike(tail)
    return F.when(hit, F.regexp_replace(rest, tail, "")).otherwise(p)
