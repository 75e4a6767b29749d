"""The daily batch: exports -> raw tables -> staging tables -> star -> KPI tables + quality report.

The reference schedules this once a day (load every export, rebuild every
model, run the declared tests).  Here it is one function; a scheduler only
has to call it.

Physical layout of the materialised staging tables (the reference also
materialises staging as tables):

* the three tables keyed by order (orders, order lines, reviews) are bucketed
  by `id_commande` into the same number of buckets, so the order-line / order
  join of every KPI reads co-located buckets and needs no shuffle;
* a bucketed join has no shuffle stage, so AQE cannot split a skewed bucket:
  callers whose data may hold an order with a large share of all lines pass
  `bucketed=False`; then these tables are plain Parquet too, the KPI joins
  shuffle, and AQE's skew-join handling splits the hot order;
* the other staging tables are plain Parquet.

Every table is replaced all at once (sources/store.py): a run that dies leaves
the tables of the run before.

Everything is written under one folder; on a cluster it must be shared
storage (the session's checkpoint folder is used when no root is given).
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.quality import DECLARED_CHECKS, dq_build_report, dq_report
from vitrine.operators.staging import build_staging
from vitrine.registry import STAR_KEYS
from vitrine.sources.ingest import ingest_batch_log, scratch_dir
from vitrine.sources.catalogue import SOURCES, register_sources
from vitrine.sources.store import replace_catalog_table, replace_table
from vitrine.star import Star

ORDER_KEYED = {"stg_commandes": "id_commande", "stg_details_commandes": "id_commande",
               "stg_satisfaction": "id_commande"}
#: tables of the star that several KPIs read, stored or checkpointed when first used
SHARED_TABLES = ("product_days", "products_display", "product_ranks", "canal_lookup")



def database_of(location: str) -> str:
    """A database of its own for every folder."""
    return "vitrine_" + hashlib.md5(location.encode()).hexdigest()[:16]


def materialize_staging(spark: SparkSession, staging: dict[str, DataFrame], location: str,
                        buckets: int | None = None, bucketed: bool = True) -> dict[str, DataFrame]:
    """Write the staging tables as catalog tables under `location`; return them re-read."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    database = database_of(location)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, df in staging.items():
        # bucketed: one shuffle at build time, every bucket is written by one task as one file
        replace_catalog_table(df, f"{database}.{name}", ORDER_KEYED.get(name) if bucketed else None, n)
    return {name: spark.table(f"{database}.{name}") for name in staging}


def calendar_bounds(staging: dict[str, DataFrame]) -> tuple[str, str]:
    """First and last day of the orders, deliveries, campaigns and posts that are there (today where there are none)."""
    dated = {"stg_commandes": ("date_commande", "date_livraison_estimee"), "stg_campaigns": ("date", "date"), "stg_posts": ("date_post", "date_post")}
    low, high = [], []
    for name, (first, last) in dated.items():
        if name in staging:
            a, b, c = staging[name].agg(F.min(first), F.max(first), F.max(last)).first()
            low += [a] if a else []
            high += [x for x in (b, c) if x]
    today = date.today()
    return min(low, default=today).isoformat(), max(high, default=today).isoformat()


class MissingSource(Exception):
    """A model needs a staging table whose export failed."""


class _Available(dict):
    def __missing__(self, name):
        raise MissingSource(name)


def run_daily(spark: SparkSession, exports: dict[str, str], root: str | None = None,
              cal_start: str | None = None, cal_end: str | None = None, as_of: str | None = None,
              buckets: int | None = None, bucketed: bool = True, at_once: int = 4) -> dict[str, DataFrame]:
    """Load every export, rebuild staging and the star, write every KPI and the quality report.

    A failed export is logged; what depends on it is left out and named in `skipped`
    (result, missing table), the rest is built from this run's tables only.  The
    KPIs are built `at_once` at a time.  The calendar spans the loaded data unless its bounds are given
    (`marts.REFERENCE_CAL_START`, `REFERENCE_CAL_END` are the reference's).
    Returns the load log, the skipped results, the quality report and the KPI
    tables (re-read from storage).
    """
    from vitrine.registry import KPI_FUNCTIONS

    root = (root or scratch_dir(spark, "daily")).rstrip("/")
    log = ingest_batch_log(spark, exports, f"{root}/raw")
    loaded = [r.table_name for r in log.where("status = 'success'").collect()]
    raw = register_sources(spark, f"{root}/raw", [t for t in SOURCES if t in loaded])
    staging = _Available(materialize_staging(spark, build_staging(raw), f"{root}/staging", buckets, bucketed))
    low, high = calendar_bounds(staging)
    star = Star(spark, staging, cal_start or low, cal_end or high, root=f"{root}/star")
    out, skipped = {"load_log": log}, []
    for shared in SHARED_TABLES:  # once, before the KPIs that read them are built side by side
        try:
            getattr(star, shared)
        except MissingSource:
            pass

    def build(item):
        key, fn = item
        try:
            df = fn(star, as_of) if key == "sat_by_delivery_state" else fn(star)
        except MissingSource as missing:
            return key, None, str(missing)
        return key, replace_table(df, f"{root}/kpis/{key}"), None

    with ThreadPoolExecutor(at_once) as pool:
        for key, df, missing in pool.map(inheritable_thread_target(spark)(build), KPI_FUNCTIONS.items()):
            if df is None:
                skipped.append((key, missing))
            else:
                out[key] = df
    models = {}
    for key in STAR_KEYS:
        try:
            models[key] = star.dim_details_commandes() if key == "dim_details_commandes" else getattr(star, key)
        except MissingSource as missing:
            skipped.append((key, str(missing)))
    checks = [c for c in DECLARED_CHECKS if c.model in models and (c.to_model is None or c.to_model in models)]
    out["dq_report"] = replace_table(dq_report(models, checks), f"{root}/quality/dq_report")
    try:
        out["dq_build_report"], _ = dq_build_report(star, f"{root}/star")
    except MissingSource as missing:
        skipped.append(("dq_build_report", str(missing)))
    out["skipped"] = spark.createDataFrame(skipped, "result string, missing string")
    return out
