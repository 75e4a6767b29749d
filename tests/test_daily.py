"""The daily run end to end: CSV exports -> raw -> staging -> star -> KPI tables + quality report."""

from vitrine.daily import database_of, run_daily
from vitrine.registry import KPI_FUNCTIONS, export_raw_csv
from vitrine.sources.ingest import scratch_dir
from vitrine.sources.raw_fixtures import RAW_SPECS


def test_run_daily(spark, sf_dir):
    folder = scratch_dir(spark, "test-daily-export")
    exports = {t.capitalize(): export_raw_csv(spark, sf_dir, t, folder) for t in RAW_SPECS}
    out = run_daily(spark, exports, root=scratch_dir(spark, "test-daily"),
                    as_of="2000-01-01", buckets=4)
    log = {r.table_name: (r.status, r.rows) for r in out["load_log"].collect()}
    assert set(log) == set(RAW_SPECS) and all(s == "success" and n > 0 for s, n in log.values())
    for key in KPI_FUNCTIONS:
        assert key in out
    assert out["sales_daily_revenue"].count() > 0
    assert out["sales_top_products"].count() > 0
    report = out["dq_report"].collect()
    assert len(report) == 41
    # dirty exports: blank order ids survive the order-line model (its filter only drops NULL ids),
    # so those lines have no parent order - the quality report must see them.
    orphans = {(r.model, r.column_name): r.violations for r in report if r.test == "relationships"}
    assert orphans[("dim_details_commandes", "id_commande")] > 0
    assert out["skipped"].count() == 0


def test_run_daily_survives_a_failed_export_and_keeps_roots_apart(spark, sf_dir):
    folder = scratch_dir(spark, "test-daily-partial")
    wanted = ["raw_clients", "raw_produits", "raw_entrepots", "raw_entrepots_machine", "raw_campaigns", "raw_posts"]
    exports = {t: export_raw_csv(spark, sf_dir, t, folder) for t in wanted}
    roots = [scratch_dir(spark, "test-daily-a"), scratch_dir(spark, "test-daily-b")]
    first = run_daily(spark, exports, root=roots[0], buckets=2, bucketed=False)
    second = run_daily(spark, exports | {"raw_entrepots": f"{folder}/missing.csv"}, root=roots[1], buckets=2)
    failed = [r.table_name for r in second["load_log"].where("status = 'failed'").collect()]
    assert failed == ["raw_entrepots"]
    skipped = {r.result: r.missing for r in second["skipped"].collect()}
    assert skipped["log_downtime_by_warehouse"] == "stg_entrepots" and "log_downtime_by_warehouse" not in second
    assert "log_downtime_by_warehouse" in first and "mkt_clicks_by_channel" in second
    assert database_of(f"{roots[0]}/staging") != database_of(f"{roots[1]}/staging")
    assert first["mkt_clicks_by_channel"].count() == second["mkt_clicks_by_channel"].count() > 0
