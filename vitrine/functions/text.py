"""Text expressions: reference-compatible trimming and keyword hit counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BigQuery's TRIM removes surrounding whitespace; Spark's plain trim removes spaces only.
WHITESPACE = " \t\n\r"


def bq_trim(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def keyword_hit(text: Column, keyword: str) -> Column:
    """1 when LOWER(text) LIKE '%keyword%', else 0 (NULL text gives 0)."""
    return F.when(F.lower(text).contains(keyword), 1).otherwise(0)


def keyword_counts(text: Column, keywords: dict[str, str]) -> list[Column]:
    """SUM(CASE WHEN LOWER(text) LIKE '%kw%' THEN 1 ELSE 0 END) per keyword, aliased."""
    return [F.sum(keyword_hit(text, kw)).cast("long").alias(name) for name, kw in keywords.items()]
