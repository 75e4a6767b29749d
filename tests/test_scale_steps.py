"""Steps whose cost must not grow faster than their rows: copies made in one pass, ties of an order, one walk, sized shuffles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrine.operators.dedup import dedup_by_completeness
from vitrine.operators.windows import window_totals
from vitrine.plans import sales
from vitrine.plans.common import ranked
from vitrine.sources.raw_fixtures import RawSpec, dirty, raw_table
from vitrine.star import testdata_star as star_of

SPEC = RawSpec(("id", "name", "size"), ("id",), ("name",), "name")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _copies(row):
    """The rules of raw_fixtures in plain Python."""
    key, name, size = row
    digits = "".join(c for c in key or "" if c.isdigit())
    k = int(digits) if digits else 0

    def padded(x):
        if x is None:
            return None
        return f"  {x} " if k % 7 == 0 else f"{x}\t" if k % 11 == 0 else x

    yield padded(key), padded(name), size
    if k % 4 == 0:
        yield (key, None, None) if k % 8 == 0 else (key, "", "")
    if k % 9 == 0:
        yield key, None if name is None else name + "Z", size
    if k % 50 in (1, 2):
        yield None if k % 50 == 1 else "   ", name, size


@pytest.fixture(scope="module")
def base(spark):
    rows = [(f"K{k}", f"n{k}" if k % 5 else None, str(k) if k % 6 else "") for k in range(1, 460)]
    rows += [(None, "nameless", "1"), ("x", "no number", None), ("K36", "again", "2"), ("K36", "again", "2")]
    return rows, spark.createDataFrame(rows, "id string, name string, size string")


def test_dirty_makes_all_copies_in_one_pass(base):
    rows, df = base
    made = dirty(df, SPEC)
    assert sorted(map(repr, (tuple(r) for r in made.collect()))) == sorted(repr(c) for r in rows for c in _copies(r))
    assert "Union" not in _plan(made)


def test_raw_table_is_stored_by_columns(spark, sf_dir):
    assert "parquet" in _plan(raw_table(spark, sf_dir, "raw_entrepots"))


def test_dedup_sorts_by_a_hash_of_its_keys(base):
    rows, df = base
    kept = dedup_by_completeness(df, [F.col("id")], F.when(F.col("name").isNotNull(), 1).otherwise(0), [F.col("id").alias("id"), F.col("name").alias("name")])
    best = {}
    for key, name, _ in rows:
        rank = (0 if name is None else -1, name is None, name or "")
        best[key] = min(best.get(key, (rank, name)), (rank, name))
    assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == sorted(repr((k, v[1])) for k, v in best.items())
    assert "xxhash64" in _plan(kept)


def test_ties_of_an_order_are_dealt_out(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = spark.range(20_000).select(F.lit(1).alias("n"), "id")
        sizes = ranked(counts, F.desc("n")).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 10_000
        top = ranked(spark.createDataFrame([(2, "b"), (3, "c"), (2, "a")], "n int, w string"), F.desc("n")).collect()
        assert [tuple(r) for r in top] == [(3, "c"), (2, "a"), (2, "b")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_window_totals_walk_the_days_once(spark):
    d = [dt.date(2000, 1, 1) + dt.timedelta(i) for i in range(6)]
    days = spark.createDataFrame([("a", d[0], 1), ("a", d[2], 5), ("b", d[1], None), (None, d[1], 7)], "k string, day date, q long")
    asked = [("a", d[0], d[2], "w1"), ("a", d[0], d[2], "w1"), ("a", d[1], d[1], "w2"), ("b", d[0], d[5], "w3"), (None, d[0], d[5], "w4"), ("a", d[3], d[2], "w5"),
             ("a", None, d[2], "w6"), ("c", d[0], d[1], "w7")]
    got = window_totals(days, spark.createDataFrame(asked, "k string, s date, e date, w string"), "k", "day", "s", "e", ("q",))
    assert sorted((r.w, r.q, r.n_days) for r in got.collect()) == [
        ("w1", 6, 2), ("w1", 6, 2), ("w2", None, 0), ("w3", None, 1), ("w4", None, 0), ("w5", None, 0), ("w6", None, 0), ("w7", None, 0)]
    assert _plan(got).count("Window [") == 1


def test_tasks_of_declining_products_grow_with_the_rollup(spark, sf_dir, monkeypatch):
    star = star_of(spark, sf_dir)
    monkeypatch.setattr(sales, "ROWS_PER_TASK", 100, raising=False)
    wanted = -(-star.product_days.count() // 100)
    assert wanted > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f"RepartitionByExpression [id_produit" in _plan(sales.sales_declining_products(star))
    assert f"], {wanted}" in _plan(sales.sales_declining_products(star))
