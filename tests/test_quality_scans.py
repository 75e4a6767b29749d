"""The quality reports against plain Python, with one scan of every model."""

import random
import re
from collections import Counter

from vitrine.operators.quality import Check, dq_build_report, dq_report
from vitrine.plans import marketing
from vitrine import star as stars

CHECKS = (Check("parent", "id", "unique"), Check("parent", "id", "not_null"), Check("child", "id", "unique"), Check("child", "p1", "not_null"),
          Check("child", "p1", "relationships", "parent", "id"), Check("child", "p2", "relationships", "parent", "id"),
          Check("child", "p2", "relationships", "other", "key"), Check("parent", "up", "relationships", "parent", "id"))


def _models(spark, folder):
    rng = random.Random(3)
    parent = [(rng.choice([None, *range(40)]), rng.choice([None, *range(60)])) for _ in range(60)]
    child = [(k // 2 if k < 20 else k, rng.choice([None, 7, *range(80)]), rng.randrange(50)) for k in range(400)] + [(None, 7, 99)] * 200
    other = [(k,) for k in range(0, 100, 2)]
    shapes = {"parent": (parent, "id long, up long"), "child": (child, "id long, p1 long, p2 int"), "other": (other, "key long")}
    for name, (rows, schema) in shapes.items():
        spark.createDataFrame(rows, schema).write.parquet(f"file://{folder}/{name}")
    return {n: [dict(zip(re.findall(r"(\w+) ", s), r)) for r in rows] for n, (rows, s) in shapes.items()}, {n: spark.read.parquet(f"file://{folder}/{n}") for n in shapes}


def _by_hand(models, c):
    values = [r[c.column] for r in models[c.model]]
    if c.test == "unique":
        return sum(n > 1 for v, n in Counter(values).items() if v is not None)
    if c.test == "not_null":
        return values.count(None)
    keys = {r[c.to_column] for r in models[c.to_model]}
    return sum(v is not None and v not in keys for v in values)


def test_every_check_and_one_scan_per_model(spark, tmp_path):
    rows, models = _models(spark, tmp_path)
    report = dq_report(models, CHECKS)
    assert [tuple(r) for r in report.collect()] == [(c.model, c.column, c.test, _by_hand(rows, c)) for c in CHECKS]
    assert len(re.findall(r"Relation \[", report._jdf.queryExecution().optimizedPlan().toString())) == 3
    only = dq_report(models, CHECKS, test="relationships")
    assert [r.violations for r in only.collect()] == [_by_hand(rows, c) for c in CHECKS if c.test == "relationships"]


def test_checks_over_empty_models(spark, tmp_path):
    _, models = _models(spark, tmp_path)
    empty = {n: df.limit(0) for n, df in models.items()}
    assert {r.violations for r in dq_report(empty, CHECKS).collect()} == {0}


def test_what_the_models_lose(spark, sf_dir, tmp_path):
    """Counts of the build, in a calendar of three days, against counts of the inputs."""
    full = stars.testdata_star(spark, sf_dir)
    staging = dict(full.stg)
    staging["stg_promotions"] = staging["stg_promotions"].selectExpr("* EXCEPT (valeur_promotion)", "CASE WHEN id_produit LIKE '%1' THEN 'offert' WHEN id_produit LIKE '%2' THEN 'x%' "
                                                                     "WHEN id_produit LIKE '%3' THEN NULL ELSE valeur_promotion END AS valeur_promotion")
    staging["stg_clients"] = staging["stg_clients"].selectExpr("* EXCEPT (favoris)", "CASE WHEN id_client LIKE '%5' THEN 'P99999, P1,' || favoris ELSE favoris END AS favoris")
    star = stars.Star(spark, staging, "1995-01-01", "1995-01-03")
    report, models = dq_build_report(star, f"file://{tmp_path}")
    got = {(r.model, r.column_name, r.test): r.violations for r in report.collect()}
    orders, inside = staging["stg_commandes"], "BETWEEN DATE'1995-01-01' AND DATE'1995-01-03'"
    wishes = star.dim_favoris.selectExpr("'P' || lpad(substr(favoris, 2), 5, '0') AS id").join(star.dim_produits.selectExpr("id_produit AS id"), "id", "left_anti").count()
    assert wishes > 0 and got == {
        ("dim_promotions", "valeur_promotion", "unreadable"): staging["stg_promotions"].where("valeur_promotion IN ('offert', 'x%')").count(),
        ("facts_commandes", "id_date_commande", "outside_calendar"): orders.where(f"NOT date_commande {inside}").count(),
        ("facts_commandes", "id_date_livraison", "outside_calendar"): orders.where(f"NOT date_livraison_estimee {inside}").count(),
        ("wishlist", "favoris", "unmatched"): wishes}
    assert models["facts_commandes"].count() == star.facts_commandes.count() < orders.count()
    assert models["facts_commandes"].columns == star.facts_commandes.columns


def test_facts_meet_the_channels_without_an_exchange_on_their_name(spark, sf_dir):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        star = stars.testdata_star(spark, sf_dir)
        for df in (star.facts_posts, star.facts_campaigns, marketing.mkt_sentiment_daily(star), marketing.mkt_clicks_by_channel(star)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\((nom_canal|canal|canal_social)#\d+, \d+\), ENSURE_REQUIREMENTS(?![^\n]*\n[^\n]*HashAggregate)", plan)
            assert "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in old.items():
            spark.conf.set(k, v)
