"""Star builders, pricing and data-quality checks on small literal tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vitrine.functions.pricing import effective_price
from vitrine.operators import marts
from vitrine.operators.quality import Check, dq_report
from vitrine.operators.surrogate import ordered_sequence_id
from vitrine.sources.ingest import ingest_batch_log, scratch_dir, write_csv


def test_dim_date_bounds_and_ids(spark):
    d = marts.dim_date(spark, "2019-01-01", "2025-08-05").orderBy("date").collect()
    assert len(d) == 2409
    assert (d[0].id_date, d[0].date) == (1, dt.date(2019, 1, 1))
    assert (d[-1].id_date, d[-1].date) == (2409, dt.date(2025, 8, 5))


def test_dim_favoris_split(spark):
    df = spark.createDataFrame([("c1", None), ("c2", ""), ("c3", "P1,P2"), ("c4", "P1, P2")],
                               "id_client string, favoris string")
    got = sorted((r.id_client, r.favoris) for r in marts.dim_favoris(df).collect())
    assert got == [("c2", ""), ("c3", "P1"), ("c3", "P2"), ("c4", " P2"), ("c4", "P1")]


def test_ordered_sequence_id_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select(F.format_string("k%04d", (F.col("id") * 7919) % 1000).alias("k"))
    got = ordered_sequence_id(df.repartition(5), ["k"], "id", num_partitions=4).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 1001))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_effective_price_cases(spark):
    d = dt.date(2024, 1, 10)
    rows = [("20%", d), ("€10.00", d), ("€10,50", d), ("€500.00", d), (None, d), ("abc", d),
            ("20%", dt.date(2024, 1, 1)), ("20%", dt.date(2024, 1, 31)), ("20%", dt.date(2023, 12, 31))]
    df = spark.createDataFrame(rows, "v string, on date").withColumn("prix", F.lit(100.0))
    got = df.select(effective_price(F.col("prix"), F.col("v"), F.col("on"), F.lit(dt.date(2024, 1, 1)),
                                    F.lit(dt.date(2024, 1, 31))).alias("p")).collect()
    assert [r.p for r in got] == [Decimal("80"), Decimal("90"), Decimal("89.5"), Decimal("0"), None, None,
                                  Decimal("80"), Decimal("80"), Decimal("100")]


def test_quality_checks_find_seeded_violations(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    child = spark.createDataFrame([("x", "a"), ("x", "b"), (None, "z"), ("y", None)], "id string, ref string")
    models = {"child": child, "parent": parent}
    checks = [Check("child", "id", "unique"), Check("child", "id", "not_null"),
              Check("child", "ref", "relationships", "parent", "id"), Check("parent", "id", "unique")]
    got = {(r.model, r.test): r.violations for r in dq_report(models, checks).collect()}
    assert got == {("child", "unique"): 1, ("child", "not_null"): 1, ("child", "relationships"): 1, ("parent", "unique"): 0}
    assert [r.violations for r in dq_report({"child": child.limit(0), "parent": parent}, checks, test="not_null").collect()] == [0]


def test_batch_log_keeps_going_after_a_failure(spark):
    folder = scratch_dir(spark, "test-export")
    write_csv(spark.createDataFrame([("1", "x")], "ID string, Nom string"), f"{folder}/good.csv")
    log = ingest_batch_log(spark, {"Good": f"{folder}/good.csv", "Missing": f"{folder}/missing.csv"},
                           scratch_dir(spark, "test-raw"))
    got = {r.table_name: (r.status, r.rows) for r in log.collect()}
    assert got == {"good": ("success", 1), "missing": ("failed", 0)}


def test_prices_are_rounded_once(spark):
    """A thousand units at 1.005 and a thousand at 2.004 make 3009.00: prices are not rounded before the sum."""
    from vitrine.functions.pricing import money, price, round_money

    df = spark.createDataFrame([(1000, 1.005), (1000, 2.004)], "qty long, prix double")
    assert df.agg(round_money(F.sum(money(F.col("qty"), price(F.col("prix")))))).first()[0] == 3009.0


def test_layout_is_the_callers_choice(spark):
    from vitrine.daily import database_of, materialize_staging

    df = spark.createDataFrame([("C1", 1), ("C2", 2)], "id_commande string, quantite long")
    for bucketed in (True, False):
        root = scratch_dir(spark, "test-layout")
        out = materialize_staging(spark, {"stg_details_commandes": df}, root, buckets=2, bucketed=bucketed)
        assert sorted(tuple(r) for r in out["stg_details_commandes"].collect()) == [("C1", 1), ("C2", 2)]
        # the table is a view over its run
        (run,) = [t.name for t in spark.catalog.listTables(database_of(root)) if t.name.startswith("stg_details_commandes__run_")]
        described = spark.sql(f"DESCRIBE EXTENDED {database_of(root)}.{run}").collect()
        assert any(r.col_name == "Num Buckets" for r in described) == bucketed


def test_promo_match_in_window_keeps_units(spark):
    """Units with promo_match='in_window' equal raw units when promotions do not overlap;
    the reference's product-only match multiplies them by the number of promotions."""
    from vitrine.plans.sales import sales_top_products
    from vitrine.star import Star

    d = dt.date(2020, 5, 10)
    stg = {
        "stg_commandes": spark.createDataFrame(
            [("C1", "CL1", "E1", d, "Livrée", None, "Carte", "T", d), ("C2", "CL1", "E1", d.replace(day=20), "Livrée",
                                                                        None, "Carte", "T", d.replace(day=20))],
            "id_commande string, id_client string, id_entrepot_depart string, date_commande date, "
            "statut_commande string, id_promotion_appliquee string, mode_de_paiement string, "
            "numero_tracking string, date_livraison_estimee date"),
        "stg_details_commandes": spark.createDataFrame(
            [("C1", "P1", 3, True), ("C2", "P1", 4, True)],
            "id_commande string, id_produit string, quantite long, emballage_special boolean"),
        "stg_produits": spark.createDataFrame(
            [("P1", "cat", "m", "mug", 10.0, "s", None)],
            "id string, categorie string, marque string, produit string, prix double, sous_categorie string, "
            "variation string"),
        "stg_promotions": spark.createDataFrame(
            [("A", "P1", "Pourcentage", "50%", dt.date(2020, 5, 1), dt.date(2020, 5, 12), "r"),
             ("B", "P1", "Remise fixe", "€1.00", dt.date(2020, 6, 1), dt.date(2020, 6, 5), "r")],
            "id_promotion string, id_produit string, type_promotion string, valeur_promotion string, "
            "date_debut date, date_fin date, responsable_promotion string"),
    }
    star = Star(spark, stg, "2020-01-01", "2020-12-31")
    ref = sales_top_products(star).collect()[0]
    win = sales_top_products(star, promo_match="in_window").collect()[0]
    assert ref.total_vendus == 14 and ref.chiffre_affaires == 3 * 5.0 + 3 * 10.0 + 4 * 10.0 * 2
    assert win.total_vendus == 7 and win.chiffre_affaires == 3 * 5.0 + 4 * 10.0


def test_cluster_conf_sizes_partitions():
    from vitrine.session import cluster_conf

    big = cluster_conf(100 * 2**40, task_slots=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 40960        # 10 TB shuffled / 256 MB
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * 2**20
    small = cluster_conf(10 * 2**20, task_slots=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16          # two waves of the slots
