"""Sums over date windows, and days inside date intervals, without range joins.

A range join of days and windows makes a row for every day in every window.
Here the days of a key are walked once:

* `window_totals`: running totals in date order; a window's sum is the total at
  its last day less the total before its first day, two lookups per distinct span;
* `days_inside`: a sweep over the starts (+1) and ends (-1) of the intervals; a
  day is inside where the running sum is positive.

Days are rows of a (key, day) rollup, and the looked-up dates and the steps are
reduced to one row per (key, day) before the walk.  So a key has at most some
rows per calendar day in its window, however many lines, windows or intervals it
holds; the windows themselves are only met by joins on (key, day), which AQE
splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _walk(key: str, day: str):
    return Window.partitionBy(key).orderBy(day).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def window_totals(days: DataFrame, windows: DataFrame, key: str, day: str, first: str, last: str, measures: tuple[str, ...]) -> DataFrame:
    """windows (key, first, last, more columns) with the sums of the measures over the key's days from first to last, and `n_days`, their number.

    A sum is NULL where no day has a value.  A window that ends before it starts,
    or has a NULL key or bound, holds no day.  Days without a date are in no window.
    """
    spans = windows.where(F.col(last) >= F.col(first)).where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(first).alias("_from"), F.col(last).alias("_to")).distinct()
    # both lookups of a span are rows of one join, so that the days are sorted and walked once
    ends = F.array(F.struct(F.date_sub("_from", 1).alias("_end"), F.lit(True).alias("_low")), F.struct(F.col("_to").alias("_end"), F.lit(False).alias("_low")))
    sides = spans.select("_key", "_from", "_to", F.explode(ends).alias("s")).select("_key", "_from", "_to", "s.*")
    points = sides.select(F.col("_key").alias(key), F.col("_end").alias(day)).distinct()
    dated = days.where(F.col(day).isNotNull()).select(key, day, *measures, F.lit(1).cast("long").alias("_n"), F.lit(False).alias("_asked"))
    asked = points.select(key, day, *[F.lit(None).cast(days.schema[m].dataType).alias(m) for m in measures], F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_asked"))
    walk = _walk(key, day)
    totals = (dated.unionByName(asked)
              .select(F.col(key).alias("_at_key"), F.col(day).alias("_at"), "_asked", F.sum("_n").over(walk).alias("_n"), *[F.count(m).over(walk).alias(f"_c_{m}") for m in measures],
                      *[F.coalesce(F.sum(m).over(walk), F.lit(0)).alias(f"_s_{m}") for m in measures])
              .where("_asked").drop("_asked"))
    names = [c for c in totals.columns if c not in ("_at_key", "_at")]
    found = (sides.join(totals, (F.col("_key") == F.col("_at_key")) & (F.col("_end") == F.col("_at"))).groupBy("_key", "_from", "_to")
             .agg(*[F.max(F.when(F.col("_low"), F.col(c))).alias(f"_low{c}") for c in names], *[F.max(F.when(~F.col("_low"), F.col(c))).alias(f"_high{c}") for c in names]))
    both = windows.join(found, (F.col(key) == F.col("_key")) & (F.col(first) == F.col("_from")) & (F.col(last) == F.col("_to")), "left")
    return both.select(*windows.columns,
                       *[F.when(F.col(f"_high_c_{m}") > F.col(f"_low_c_{m}"), F.col(f"_high_s_{m}") - F.col(f"_low_s_{m}")).alias(m) for m in measures],
                       F.coalesce(F.col("_high_n") - F.col("_low_n"), F.lit(0)).alias("n_days"))


def days_inside(days: DataFrame, intervals: DataFrame, key: str, day: str, first: str, last: str) -> DataFrame:
    """days with `inside`: whether an interval of the day's key holds it.  A day without a date is in none."""
    steps = (intervals.where(F.col(last) >= F.col(first)).where(F.col(key).isNotNull())
             .select(key, F.explode(F.array(F.struct(F.col(first).alias("d"), F.lit(1).alias("step")),
                                            F.struct(F.date_add(last, 1).alias("d"), F.lit(-1).alias("step")))).alias("s"))
             .groupBy(key, F.col("s.d").alias(day)).agg(F.sum("s.step").alias("_step")))
    more = [c for c in days.columns if c not in (key, day)]
    merged = days.select(key, day, *more, F.lit(0).cast("long").alias("_step"), F.lit(True).alias("_is_day")).unionByName(
        steps.select(key, day, *[F.lit(None).cast(days.schema[c].dataType).alias(c) for c in more], "_step", F.lit(False).alias("_is_day")))
    open_ = merged.withColumn("_open", F.sum("_step").over(_walk(key, day)))
    return open_.where("_is_day").select(*days.columns, (F.col("_open") > 0).alias("inside"))
