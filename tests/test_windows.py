"""Window sums, days inside intervals and the stored rollup against plain Python; the plans hold no range join."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine import star as stars
from vitrine.operators.windows import days_inside, window_totals
from vitrine.plans import marketing, sales
from vitrine.plans.common import order_lines

DAY0 = dt.date(2024, 1, 1)


def _day(n):
    return None if n is None else DAY0 + dt.timedelta(n)


@pytest.fixture(scope="module")
def days(spark):
    rng = random.Random(4)
    rows = [(k, d, rng.choice([None, *range(-3, 9)])) for k in ("a", "b", "c") for d in sorted(rng.sample(range(60), 25))]
    rows += [("hot", d, 1) for d in range(60)] + [("a", None, 100), (None, 5, 100), ("nulls", 3, None), ("nulls", 4, None)]
    return rows, spark.createDataFrame([(k, _day(d), q) for k, d, q in rows], "k string, date date, qty long")


@pytest.fixture(scope="module")
def windows(spark):
    rng = random.Random(6)
    rows = [(n, rng.choice(["a", "b", "c", "nulls", "unsold"]), s := rng.randrange(-5, 65), s + rng.randrange(-4, 30)) for n in range(200)]
    rows += [(n, "hot", 10, 20) for n in range(200, 260)] + [(260, None, 0, 50), (261, "a", None, 9), (262, "a", 3, None), (263, "a", 0, 59), (264, "a", 0, 59), (265, "hot", 21, 20), (266, "hot", 40, 5)]
    return rows, spark.createDataFrame([(n, k, _day(s), _day(e)) for n, k, s, e in rows], "w long, k string, first date, last date")


def _inside(d, s, e):
    return None not in (d, s, e) and s <= d <= e


def test_window_totals(days, windows):
    got = {r.w: (r.qty, r.n_days) for r in window_totals(days[1], windows[1], "k", "date", "first", "last", ("qty",)).collect()}
    assert len(got) == len(windows[0])
    for n, k, s, e in windows[0]:
        own = [q for key, d, q in days[0] if key == k and k is not None and _inside(d, s, e)]
        values = [q for q in own if q is not None]
        assert got[n] == (sum(values) if values else None, len(own)), (n, k, s, e)


def test_days_inside(days, windows):
    got = Counter((r.k, r.date, r.qty, r.inside) for r in days_inside(days[1], windows[1], "k", "date", "first", "last").collect())
    assert got == Counter((k, _day(d), q, k is not None and any(w[1] == k and _inside(d, w[2], w[3]) for w in windows[0])) for k, d, q in days[0])
    only = windows[1].where("w >= 265")  # intervals that end before they start hold nothing
    assert not any(r.inside for r in days_inside(days[1], only, "k", "date", "first", "last").collect())


def test_without_days_or_windows(days, windows):
    none = days[1].limit(0)
    assert {(r.qty, r.n_days) for r in window_totals(none, windows[1], "k", "date", "first", "last", ("qty",)).collect()} == {(None, 0)}
    assert window_totals(days[1], windows[1].limit(0), "k", "date", "first", "last", ("qty",)).count() == 0
    assert days_inside(none, windows[1], "k", "date", "first", "last").count() == 0
    assert days_inside(days[1], windows[1].limit(0), "k", "date", "first", "last").where("inside").count() == 0


def test_the_rollup_holds_what_the_lines_hold(spark, sf_dir):
    star = stars.testdata_star(spark, sf_dir)
    total = star.product_days.agg(F.sum("qty"), F.sum("n"), F.sum("live_qty"), F.sum("live_n")).first()
    lines, live = star.details.agg(F.sum("quantite"), F.count(F.lit(1))).first(), order_lines(star).agg(F.sum("quantite"), F.count(F.lit(1))).first()
    assert tuple(total) == (*lines, *live)
    assert star.product_days.count() == star.product_days.select("id_details_produits", "date").distinct().count()


def test_plans_read_the_rollup_and_hold_no_range_join(spark, sf_dir):
    """A join with a comparison of days also has an equality of days (the calendar's own), and no order line is scanned."""
    star = stars.testdata_star(spark, sf_dir)
    lines = {f.split("/")[-1] for f in star.stg["stg_details_commandes"].inputFiles()}
    for kpi in (sales.sales_promo_variation_30d, sales.sales_promo_sensitivity, marketing.mkt_promo_effectiveness, marketing.mkt_promo_days_vs_others):
        df = kpi(star)
        plan = df._jdf.queryExecution().optimizedPlan()
        text = plan.toString()
        joins = [line for line in text.splitlines() if "Join" in line]
        ranged = [line for line in joins if re.search(r" (>=|<=|>|<) ", line)]
        assert joins and all(re.search(r"date\w*#\d+ = |= date\w*#\d+", line) for line in ranged), (kpi.__name__, ranged)
        assert not lines & {f.split("/")[-1] for f in df.inputFiles()}, kpi.__name__
