"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [--runs 3] [key ...]

Like the reference's daily run, staging tables are materialised once (timed as
`build_sec`; order-keyed tables bucketed by id_commande), then the tables that
KPIs share (`shared_sec`, each by name: the product x day rollup, names, ranks,
channels), and the KPIs run over them.  The headline `value` is the KPIs' time
and the shared tables' together, so that nothing they read is built outside it.
The same queries over the test tables (the `queries()` path, without staging
tables) are `from_raw`, their shared tables included in `from_raw_total`.  Every
run writes the full result to the `noop` sink; one warm-up, then the median of
`--runs` timed runs (shared tables: one warm-up, one timed build).  Prints one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("sales_daily_revenue", "sales_product_pairs", "sales_declining_products",
            "mkt_monthly_promo_vs_budget", "sales_promo_variation_30d")


def timed(make_df, runs: int) -> float:
    def once():
        t0 = time.perf_counter()
        make_df().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0
    once()  # warm-up
    return round(statistics.median(once() for _ in range(runs)), 3)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--all", action="store_true", help="every KPI, not only the headline queries")
    ap.add_argument("--runs", type=int, default=3)
    ap.add_argument("--skip-raw", action="store_true", help="do not time the from-raw path")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from vitrine.daily import SHARED_TABLES, materialize_staging
    from vitrine.registry import KPI_FUNCTIONS, QUERIES
    from vitrine.session import build_session
    from vitrine.sources import testdata
    from vitrine.star import Star, testdata_star

    def shared(star):
        """Seconds to build each shared table of a star."""
        out = {}
        for name in SHARED_TABLES:
            t0 = time.perf_counter()
            getattr(star, name)
            out[name] = round(time.perf_counter() - t0, 3)
        return out

    scratch = tempfile.mkdtemp(prefix="vitrine-bench-")
    extra = {"spark.sql.warehouse.dir": f"{scratch}/warehouse"}
    extra.update(json.loads(os.environ.get("BENCH_SPARK_CONF", "{}")))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus))),
                          app="vitrine-bench", extra=extra)
    keys = a.keys or (list(KPI_FUNCTIONS) if a.all else list(HEADLINE))

    t0 = time.perf_counter()
    staged = materialize_staging(spark, testdata.staging_from_testdata(spark, sf_dir), f"{scratch}/staging")
    build = round(time.perf_counter() - t0, 3)
    star = Star(spark, staged, *testdata.calendar_bounds(spark, sf_dir))

    def kpi(k):
        fn = KPI_FUNCTIONS[k]
        return (lambda: fn(star, "2000-01-01")) if k == "sat_by_delivery_state" else (lambda: fn(star))

    shared(Star(spark, staged, *testdata.calendar_bounds(spark, sf_dir)))  # warm-up
    tables = shared(star)
    times = {k: timed(kpi(k), a.runs) for k in keys}
    raw_tables = {} if a.skip_raw else shared(testdata_star(spark, sf_dir))
    raw = {} if a.skip_raw else {k: timed(lambda k=k: QUERIES[k](spark, sf_dir), a.runs) for k in keys}
    print(json.dumps({
        "metric": "headline_kpis_on_materialized_staging" if not (a.all or a.keys) else "kpis_on_materialized_staging",
        "value": round(sum(times.values()) + sum(tables.values()), 3), "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
        "build_sec": build, "kpis_sec": round(sum(times.values()), 3), "shared_sec": tables,
        "from_raw": raw, "from_raw_shared_sec": raw_tables,
        "from_raw_total": round(sum(raw.values()) + sum(raw_tables.values()), 3) if raw else None}))
    spark.stop()


if __name__ == "__main__":
    main()
