"""Surrogate keys.

The reference numbers rows with an unordered ``ROW_NUMBER() OVER ()`` (calendar,
channels, order lines).  A global window moves every row to one task, which
does not survive a fact-sized table.  Here ids are a deterministic function of
a natural key:

* `day_number_id`: calendar ids are ``datediff(date, start) + 1`` - no window.
* `ordered_sequence_id`: a dense 1..N numbering in key order, computed in a
  distributed way: range-partition and sort by the key, checkpoint the result
  (so every later pass sees the same partitions, also after an executor loss),
  count rows per partition, turn the counts into offsets (one row per
  partition, so the broadcast is bounded by the partition count), add the
  position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir


def day_number_id(date_col: Column, start: str) -> Column:
    return (F.datediff(date_col, F.lit(start).cast("date")) + 1).cast("int")


def ordered_sequence_id(df: DataFrame, order_cols: list[str], id_col: str = "id",
                        num_partitions: int | None = None) -> DataFrame:
    """Append a dense id 1..N following the ascending order of `order_cols`.

    `order_cols` must be unique over `df` for the numbering to be reproducible
    (it then equals ``ROW_NUMBER() OVER (ORDER BY order_cols)``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order_cols])
               .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_cols])
               .checkpoint(eager=True))
    pid = F.spark_partition_id()
    located = (ordered
               .withColumn("_pid", pid)
               .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)))
    counts = located.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running sum is over a bounded, tiny table.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (located.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_pid", "_pos", "_off"))
