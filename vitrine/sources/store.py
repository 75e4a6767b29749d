"""Tables that are replaced all at once.

Every write is a run of its own; a pointer names the run that readers see, and it
is switched after the run is complete.  A job that dies while it writes leaves
the pointer, and so the previous table, as they were.

* A folder target holds `runs/<run>` (Parquet) and `current`, a table of pointers
  (one small file per run, committed by Spark like any other write; the one with
  the highest number counts).  Only Spark's readers and writers touch it, so the
  target can be in any store that Spark knows.
* A catalog target is a view over a managed run table; `CREATE OR REPLACE VIEW`
  switches it, and the run tables keep their bucketing.

The newest `keep` runs stay, so that readers of the run before the last one can
finish; older ones are emptied (folder) or dropped (catalog).  A run whose job
died has no pointer: nothing reads it, and its files stay until the target's
folder is cleaned.  One writer per target at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = 2
POINTER = "seq long, run string"


class NoTable(Exception):
    """Nothing was ever completed under this target."""


def _pointers(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, run) of every completed run, newest first."""
    try:
        found = spark.read.schema(POINTER).parquet(f"{target.rstrip('/')}/current").collect()  # one row per run
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(((r.seq, r.run) for r in found), reverse=True)


def write_run(df: DataFrame, target: str) -> str:
    """Write df as a new run of the target; readers don't see it yet."""
    run = f"runs/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{target.rstrip('/')}/{run}")  # two runs of a table stay at rest
    return run


def switch(spark: SparkSession, target: str, run: str, keep: int = KEEP) -> None:
    """Make a completed run the target's table, and empty the runs that are no longer kept."""
    target, before = target.rstrip("/"), _pointers(spark, target)
    seq = before[0][0] + 1 if before else 1
    spark.createDataFrame([(seq, run)], POINTER).coalesce(1).write.mode("append").parquet(f"{target}/current")
    for old, name in before[max(0, keep - 1):]:
        if old == seq - keep:  # the one that has just fallen off
            spark.range(0).write.mode("overwrite").parquet(f"{target}/{name}")


def replace_table(df: DataFrame, target: str, keep: int = KEEP) -> DataFrame:
    """Write df as the target's table; returns it re-read."""
    run = write_run(df, target)
    switch(df.sparkSession, target, run, keep)
    return df.sparkSession.read.parquet(f"{target.rstrip('/')}/{run}")


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The target's current run."""
    found = _pointers(spark, target)
    if not found:
        raise NoTable(target)
    return spark.read.parquet(f"{target.rstrip('/')}/{found[0][1]}")


def has_table(spark: SparkSession, target: str) -> bool:
    return bool(_pointers(spark, target))


def replace_catalog_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0, keep: int = KEEP) -> None:
    """Replace a catalog table `[database.]table`; with bucket_by, the run is bucketed and sorted by that column, one file per bucket."""
    spark = df.sparkSession
    database, table = name.split(".") if "." in name else (spark.catalog.currentDatabase(), name)
    runs = sorted((t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{table}__run_")), reverse=True)
    seq = int(runs[0].split("_")[-2]) + 1 if runs else 1
    run = f"{table}__run_{seq:08d}_{uuid.uuid4().hex[:8]}"
    writer = (df.repartition(buckets, bucket_by) if bucket_by else df).write.format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(f"{database}.{run}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{run}")
    for old in runs[max(0, keep - 1):]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
