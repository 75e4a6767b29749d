"""Malformed records, packed exports, and tables that are replaced all at once."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vitrine.registry import export_raw_csv
from vitrine.sources import raw_fixtures, store
from vitrine.sources.ingest import ingest_batch_log, ingest_csv, ingest_overwrite_sink, quarantined, write_csv

EXPORT = '''id,Nom,note
1,"a, ""b""",x
2,Bob,31,EXTRA
3,short
4,"two
lines",y
5,z,,
6,"q,q",1,2,3
7,"l,1
l,2",1
8,5" disk
9,ok,NA
'''


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return f"file://{path}"


def _text(spark, path):
    return sorted(r.record for r in quarantined(spark, path).collect())


def test_records_with_too_many_fields_leave_the_table_for_quarantine(spark, tmp_path):
    path = _write(tmp_path / "a.csv", EXPORT)
    df = ingest_csv(spark, path)
    rows = sorted(tuple(r) for r in df.collect())
    assert df.columns == ["id", "nom", "note"]
    assert rows == [("1", 'a, "b"', "x"), ("3", "short", None), ("4", "two\nlines", "y"), ("7", "l,1\nl,2", "1"), ("9", "ok", None)]
    assert df.count() == 5 and ingest_csv(spark, path).select("note").where("note = 'y'").count() == 1  # pruned columns change nothing
    assert _text(spark, path) == ["2,Bob,31,EXTRA", "5,z,,", '6,"q,q",1,2,3', '8,5" disk']


def test_files_without_line_breaks_are_read_in_splits(spark, tmp_path):
    path = _write(tmp_path / "big.csv", "id,v\n" + "".join(f"{k},v{k}\n" if k % 100 else f"{k},v,w\n" for k in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = ingest_csv(spark, path, multi_line=False)
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 2
        assert df.count() == 19_800 and quarantined(spark, path, multi_line=False).count() == 200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_the_load_log_names_the_records(spark, tmp_path):
    files = {"Raw_A": _write(tmp_path / "a.csv", EXPORT), "Raw_B": _write(tmp_path / "b.csv", "id,v\n1,x\n"), "Raw_C": f"file://{tmp_path}/missing.csv",
             "Raw_D": _write(tmp_path / "d.csv", "id,v\n")}
    target = f"file://{tmp_path}/raw"
    log = {r.table_name: r for r in ingest_batch_log(spark, files, target).collect()}
    assert {k: (r.status, r.rows, r.quarantined) for k, r in log.items()} == {
        "raw_a": ("success", 5, 4), "raw_b": ("success", 1, 0), "raw_c": ("failed", 0, 0), "raw_d": ("success", 0, 0)}
    assert log["raw_a"].error.startswith("[MALFORMED_RECORDS] 4 records") and "PATH_NOT_FOUND" in log["raw_c"].error
    assert store.read_table(spark, f"{target}/raw_a").count() == 5 and store.read_table(spark, f"{target}/raw_d").columns == ["id", "v"]
    assert store.read_table(spark, f"{target}_quarantine/raw_a").count() == 4 and not store.has_table(spark, f"{target}_quarantine/raw_b")
    # the mended export empties the quarantine
    files["Raw_A"] = _write(tmp_path / "a.csv", "id,Nom,note\n1,a,b\n")
    assert [r.quarantined for r in ingest_batch_log(spark, {"Raw_A": files["Raw_A"]}, target).collect()] == [0]
    assert store.read_table(spark, f"{target}_quarantine/raw_a").count() == 0


def test_a_file_can_be_refused_like_the_reference_does(spark, tmp_path):
    target = f"file://{tmp_path}/raw"
    good = {"T": _write(tmp_path / "t.csv", "id,v\n1,x\n2,y\n")}
    assert [r.status for r in ingest_batch_log(spark, good, target, on_malformed="fail").collect()] == ["success"]
    bad = {"T": _write(tmp_path / "t.csv", "id,v\n1,x,z\n2,y\n")}
    (row,) = ingest_batch_log(spark, bad, target, on_malformed="fail").collect()
    assert row.status == "failed" and row.error.startswith("[MALFORMED_RECORDS] 1 records")
    assert store.read_table(spark, f"{target}/t").count() == 2  # the table before
    with pytest.raises(ValueError):
        ingest_batch_log(spark, good, target, on_malformed="ignore")


def test_an_export_is_packed_and_keeps_no_second_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_fixtures, "_RAW_CACHE", {})
    rows = [(k, f'part, "{k}"\nof {k}' if k % 3 else None, "brand", "type", k % 9, k / 4) for k in range(1, 300)] + [(12, "again", "b", "t", 1, 2.5), (12, None, None, None, None, None)]
    sf_dir = f"file://{tmp_path}"
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{sf_dir}/part.parquet")
    path = export_raw_csv(spark, sf_dir, "raw_produits", f"{sf_dir}/packed")
    assert not raw_fixtures._RAW_CACHE  # nothing was stored for the export
    files = [f for f in os.listdir(f"{tmp_path}/packed/raw_produits.csv") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    stored = raw_fixtures.raw_table(spark, sf_dir, "raw_produits")
    write_csv(stored, f"{sf_dir}/plain.csv")
    got, want = (sorted(map(repr, map(tuple, ingest_csv(spark, p).collect()))) for p in (path, f"{sf_dir}/plain.csv"))
    assert got == want and len(got) > 300
    again = export_raw_csv(spark, sf_dir, "raw_produits", f"{sf_dir}/again")  # from the stored rows
    assert sorted(map(repr, map(tuple, ingest_csv(spark, again).collect()))) == want
    (log,) = ingest_batch_log(spark, {"Raw_Produits": path}, f"{sf_dir}/raw").collect()
    assert (log.status, log.rows, log.quarantined) == ("success", len(got), 0)


def _dies(spark):
    """Rows whose job writes some partitions and then fails."""
    return spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_write_that_dies_leaves_the_previous_table(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    with pytest.raises(store.NoTable):
        store.read_table(spark, target)
    ingest_overwrite_sink(spark.range(3), target)
    with pytest.raises(Exception, match="killed"):
        ingest_overwrite_sink(_dies(spark), target)
    assert store.read_table(spark, target).count() == 3
    # killed after the run is written, before the pointer is switched
    store.write_run(spark.range(50), target)
    reader = store.read_table(spark, target)
    assert reader.count() == 3
    ingest_overwrite_sink(spark.range(7), target)
    assert store.read_table(spark, target).count() == 7 and reader.count() == 3  # a reader of the run before still finishes
    ingest_overwrite_sink(spark.range(8).selectExpr("id AS other"), target)  # another schema
    assert store.read_table(spark, target).columns == ["other"]
    sizes = {len([f for f in os.listdir(tmp_path / "t" / "runs" / r) if f.endswith(".parquet")]) for r in os.listdir(tmp_path / "t" / "runs")}
    assert 0 in sizes or min(sizes) <= 8  # the first run has been emptied
    assert spark.read.parquet(f"{target}/current").count() == 3


def test_runs_are_packed(spark, tmp_path):
    target, rows = f"file://{tmp_path}/t", [(f"P{k % 90:05d}", None if k % 7 else "non", str(k)) for k in range(3000)]
    ingest_overwrite_sink(spark.createDataFrame(rows, "id string, flag string, n string"), target)
    (run,) = os.listdir(tmp_path / "t" / "runs")
    files = [pq.ParquetFile(tmp_path / "t" / "runs" / run / f) for f in os.listdir(tmp_path / "t" / "runs" / run) if f.endswith(".parquet")]
    assert files and {f.metadata.row_group(g).column(c).compression for f in files for g in range(f.num_row_groups) for c in range(3)} == {"ZSTD"}
    assert sorted(map(repr, (tuple(r) for r in store.read_table(spark, target).collect()))) == sorted(map(repr, rows))


def test_old_runs_are_emptied(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    for n in range(1, 5):
        ingest_overwrite_sink(spark.range(n), target)
    runs = {r.seq: r.run for r in spark.read.parquet(f"{target}/current").collect()}
    assert [spark.read.schema("id long").parquet(f"{target}/{runs[k]}").count() for k in (1, 2, 3, 4)] == [0, 0, 3, 4]


def test_catalog_tables_are_views_over_runs_and_keep_their_buckets(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store_test")
    name = "store_test.orders"
    for n in (10, 20, 30):
        store.replace_catalog_table(spark.range(n).withColumnRenamed("id", "k"), name, "k", 4)
    with pytest.raises(Exception, match="killed"):
        store.replace_catalog_table(_dies(spark).withColumnRenamed("id", "k"), name, "k", 4)
    assert spark.table(name).count() == 30
    assert len([t for t in spark.catalog.listTables("store_test") if "__run_" in t.name]) in (2, 3)  # a dead run may leave its table
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = spark.table(name), spark.table(name).selectExpr("k", "k + 1 AS v")
        plan = a.join(b, "k")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE store_test CASCADE")
