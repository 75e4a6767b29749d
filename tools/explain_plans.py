"""Write the physical plans of the headline KPIs as they run at scale.

    python tools/explain_plans.py [--sf-dir /root/testdata/sf0.01] [--out docs/plans]

Size-based broadcasts are switched off (as they would be for tables of
cluster size), so the plans show what remains: bucketed order-keyed scans
joined without an exchange, hinted broadcasts of the bounded calendar only,
partial aggregates before every shuffle, pushed filters and pruned schemas.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="docs/plans")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    from bench import HEADLINE
    from vitrine.daily import materialize_staging
    from vitrine.registry import KPI_FUNCTIONS
    from vitrine.session import build_session
    from vitrine.sources import testdata
    from vitrine.star import Star

    scratch = tempfile.mkdtemp(prefix="vitrine-plans-")
    spark = build_session("local[8]", 16, extra={
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    staged = materialize_staging(spark, testdata.staging_from_testdata(spark, a.sf_dir), f"{scratch}/staging")
    star = Star(spark, staged, *testdata.calendar_bounds(spark, sf_dir))
    os.makedirs(a.out, exist_ok=True)
    for k in a.keys or HEADLINE:
        df = KPI_FUNCTIONS[k](star)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        plan = buf.getvalue()
        with open(os.path.join(a.out, f"{k}.txt"), "w") as f:
            f.write(plan)
        tree = plan.split("\n\n")[0]
        print(k, "shuffles:", tree.count("+- Exchange ("), "broadcasts:", tree.count("BroadcastExchange ("),
              "bucketed scans:", plan.count("Bucketed: true"))
    spark.stop()


if __name__ == "__main__":
    main()
