"""Sales KPIs (the reference's Ventes_* models).

Every function takes a `Star` and returns a lazy DataFrame with the
reference's output columns.  Shared shapes:

* promotion-aware revenue = pre-aggregated (product, day) units priced
  against the product's promotions (plans/common.py);
* product display names = 'name - variation' for names with several prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.pricing import UNIT, discounted_price, money, price, promo_period_label, round_money, round_ratio, safe_ratio
from vitrine.operators.windows import window_totals
from vitrine.plans.common import (order_lines, orders_with_date, priced_with_promotions,
                                  promotions_with_dates, ranked, units_by_product_day)
from vitrine.fixed_values import (AGE_BAND_OTHER, AGE_BANDS, DECLINE_RUN, LEAST_SOLD_LABEL, MONTH_NORMAL,
                                  MONTH_STRONG, MONTH_STRONG_FACTOR, MONTH_WEAK, MONTH_WEAK_FACTOR,
                                  PERIOD_LABELS_7D, PERIOD_OTHER_7D, PROMO_WINDOW_7D, PROMO_WINDOW_30D,
                                  SENSITIVITY_HIGH, SENSITIVITY_HIGH_AT, SENSITIVITY_LOW, SENSITIVITY_LOW_AT,
                                  SENSITIVITY_MID, UNSOLD_LABEL, PERIOD_LABELS_30D)
from vitrine.session import ensure_checkpoint_dir
from vitrine.star import Star

BEFORE, DURING, AFTER = PERIOD_LABELS_30D


def sales_daily_revenue(star: Star, promo_match: str = "product") -> DataFrame:
    """Promotion-aware revenue per order day (with the reference's promotion fan-out by default)."""
    priced = priced_with_promotions(units_by_product_day(star), star, promo_match=promo_match)
    daily = priced.groupBy("date").agg(F.sum(money(F.col("qty"), F.col("unit_price"))).alias("_ca"))
    return daily.select(
        F.col("date").alias("periode"),
        F.year("date").cast("long").alias("annee"),
        F.month("date").cast("long").alias("mois"),
        F.dayofmonth("date").cast("long").alias("jour"),
        round_money(F.col("_ca")).alias("chiffre_affaires"),
    ).orderBy("periode")


def sales_top_products(star: Star, promo_match: str = "product") -> DataFrame:
    """Revenue and units per category, display name and catalogue price (no LIMIT)."""
    prods = star.products_display
    priced = priced_with_promotions(units_by_product_day(star), star, prods, promo_match=promo_match)
    return (priced.groupBy("categorie", F.col("nom_affiche").alias("produit"), "prix")
            .agg(F.sum("qty").alias("total_vendus"),
                 round_money(F.sum(money(F.col("qty"), F.col("unit_price")))).alias("chiffre_affaires"))
            .transform(ranked, F.desc("chiffre_affaires")))


def sales_unsold_products(star: Star) -> DataFrame:
    """Catalogue products without any order line."""
    sold = star.product_days.select(F.col("id_details_produits").alias("id_produit")).distinct()
    return (star.dim_produits.join(sold, "id_produit", "left_anti")
            .select("produit", F.lit(0).cast("long").alias("total_vendus"),
                    F.lit(UNSOLD_LABEL).alias("type_resultat")))


def sales_least_sold(star: Star) -> DataFrame:
    """Units per product name (cancelled orders included), > 0, ascending."""
    per_product = star.product_days.groupBy("id_details_produits").agg(F.sum("qty").alias("_q"))
    prods = star.dim_produits.select("id_produit", "produit")
    return (per_product.join(prods, per_product.id_details_produits == prods.id_produit)
            .groupBy("produit").agg(F.sum("_q").alias("total_vendus"))
            .where(F.col("total_vendus") > 0)
            .select("produit", "total_vendus", F.lit(LEAST_SOLD_LABEL).alias("type_resultat"))
            .transform(ranked, "total_vendus"))


def _month_index(star: Star) -> DataFrame:
    """Observed months (any non-cancelled order) with their rank.

    The table has at most one row per calendar month, a bound fixed by the
    calendar parameters, so the ordered window over it runs on one small task.
    """
    months = (orders_with_date(star).select(F.trunc("date", "month").alias("mois")).distinct())
    return months.select("mois", F.row_number().over(Window.orderBy("mois")).alias("k"))


#: rows of the product x day rollup that one task aggregates and sorts (some 1.3 KB each in its hash maps and sort)
ROWS_PER_TASK = 500_000


def _product_tasks(star: Star) -> int:
    """Partitions for a shuffle of the rollup's rows by product: they grow with its rows, a task's rows do not."""
    wanted = -(-star.product_days.count() // ROWS_PER_TASK)
    return max(wanted, int(star.spark.conf.get("spark.sql.shuffle.partitions")))


def sales_declining_products(star: Star, run: int = DECLINE_RUN, promo_match: str = "product") -> DataFrame:
    """Products whose monthly promotion-aware revenue fell `run` months in a row.

    The reference zero-fills product x observed-month with a cross join and
    takes LAG 1..5.  A qualifying row needs m1 > ... > m5 > ca >= 0, so the
    five previous observed months are months *with* sales; only the current
    month may be a zero-filled one.  The plan therefore works on the sparse
    (product, month) revenue rows only, with one window pass per product (at
    most one row per month, so a hot product stays small):
      * a sales month k qualifies when the `run` previous sales months are
        k-1 .. k-run (one check: lag(k, run) = k - run, since k increases) and
        the values strictly increase going back;
      * the observed month k+1 qualifies with revenue 0 when it has no sales
        and months k .. k-run+1 form such a run.
    Both candidates come out of the same pass (explode), and the month of a
    candidate index is looked up in the observed-month table, which also drops
    k+1 past the last observed month.  Revenue is compared as integer cents.
    No product x month grid is materialised.
    """
    units = units_by_product_day(star)
    priced = priced_with_promotions(units, star, promo_match=promo_match)
    # Partition by product once: the monthly aggregate and the window then need no further shuffle.
    monthly = (priced.repartition(_product_tasks(star), "id_produit")
               .groupBy("id_produit", "categorie", F.trunc("date", "month").alias("mois"))
               .agg(F.round(F.sum(money(F.col("qty"), F.col("unit_price"))), 2).alias("_ca")))
    midx = _month_index(star)
    sparse = (monthly.join(F.broadcast(midx), "mois")
              .select("id_produit", "categorie", "k",
                      (F.coalesce(F.col("_ca"), F.lit(0)) * 100).cast("long").alias("c")))
    w = Window.partitionBy("id_produit").orderBy("k")
    lv = [F.lag("c", i).over(w) for i in range(1, run + 1)]
    lagged = sparse.select("id_produit", "categorie", "k", "c",
                           F.lag("k", run).over(w).alias("k_run"), F.lag("k", run - 1).over(w).alias("k_run1"),
                           F.lead("k", 1).over(w).alias("next_k"),
                           *[x.alias(f"v{i}") for i, x in enumerate(lv, 1)])
    v = [F.col(f"v{i}") for i in range(1, run + 1)]

    def increasing(vals):
        cond = F.lit(True)
        for a, b in zip(vals, vals[1:]):
            cond = cond & (a < b)
        return cond

    k = F.col("k")
    cur_ok = (F.col("k_run") == k - run) & increasing([F.col("c")] + v)
    nxt_ok = ((F.col("next_k").isNull() | (F.col("next_k") != k + 1))
              & (F.col("k_run1") == k - (run - 1)) & increasing([F.lit(0).cast("long"), F.col("c")] + v[: run - 1]))
    fields = ["k_out", "cents"] + [f"m{i}" for i in range(1, run + 1)]
    cur = F.when(cur_ok, F.struct(*[x.alias(n) for x, n in zip([k, F.col("c")] + v, fields)]))
    nxt = F.when(nxt_ok, F.struct(*[x.alias(n) for x, n in
                                    zip([k + 1, F.lit(0).cast("long"), F.col("c")] + v[: run - 1], fields)]))
    cand = (lagged.where(cur_ok | nxt_ok)
            .select("id_produit", "categorie", F.explode(F.array(cur, nxt)).alias("o"))
            .where(F.col("o").isNotNull())
            .select("id_produit", "categorie", "o.*"))
    months = F.broadcast(midx).alias("months")  # same frame as above: one broadcast, reused
    return (cand.join(months, cand.k_out == F.col("months.k"))
            .select("id_produit", "categorie", F.col("months.mois").alias("mois"),
                    (F.col("cents") / 100.0).alias("ca_mensuel"),
                    *[(F.col(f"m{i}") / 100.0).alias(f"m{i}") for i in range(1, run + 1)])
            .orderBy("id_produit", "mois"))


def age_band(age: F.Column) -> F.Column:
    out = None
    for low, high, label in AGE_BANDS:
        out = (F.when if out is None else out.when)(age.between(low, high), label)
    return out.otherwise(AGE_BAND_OTHER)


def sales_by_age_band(star: Star, promo_match: str = "product") -> DataFrame:
    """Units and promotion-aware revenue per age band, display name and category."""
    clients = star.dim_clients.select(F.col("id_client").alias("_cl"), age_band(F.col("age")).alias("tranche_age"))
    orders = orders_with_date(star).select("id_commande", "date", "id_client")
    orders = orders.join(clients, orders.id_client == clients._cl).select("id_commande", "date", "tranche_age")
    lines = star.details.select("id_commande", "id_details_produits", "quantite").join(orders, "id_commande")
    units = lines.groupBy("id_details_produits", "date", "tranche_age").agg(F.sum("quantite").alias("qty"))
    prods = star.products_display
    priced = priced_with_promotions(units, star, prods, promo_match=promo_match)
    return (priced.groupBy("tranche_age", F.col("nom_affiche").alias("produit"), "categorie")
            .agg(F.sum("qty").alias("quantite_vendue"),
                 round_money(F.sum(money(F.col("qty"), F.col("unit_price")))).alias("chiffre_affaires"))
            .transform(ranked, "tranche_age", F.desc("quantite_vendue")))


def wishlist_product_id(fav: F.Column) -> F.Column:
    """'P12' -> 'P00012'; a longer id keeps all its digits."""
    digits = F.substr(fav, F.lit(2))
    return F.concat(F.lit("P"), F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def wishlist_matches(star: Star) -> DataFrame:
    """Wishlist additions per rebuilt product id, with its product (NULL where the catalogue has none): id_produit, produit, nb_fois_ajoute."""
    # Count per rebuilt id first (map-side combined), then join the catalogue.
    counts = (star.dim_favoris.where(F.col("id_client").isNotNull())
              .groupBy(wishlist_product_id(F.col("favoris")).alias("_pid"))
              .agg(F.count(F.lit(1)).alias("nb_fois_ajoute")))
    prods = star.dim_produits.select("id_produit", "produit")
    return counts.join(prods, prods.id_produit == counts._pid, "left").select("id_produit", "produit", "nb_fois_ajoute")


def sales_wishlist_counts(star: Star) -> DataFrame:
    """Wishlist additions per product."""
    return (wishlist_matches(star).where(F.col("id_produit").isNotNull())
            .groupBy("id_produit", "produit").agg(F.sum("nb_fois_ajoute").alias("nb_fois_ajoute"))
            .select("produit", "nb_fois_ajoute")
            .transform(ranked, F.desc("nb_fois_ajoute")))


def sales_product_pairs(star: Star) -> DataFrame:
    """Pairs of display names bought by one client on one day, seen more than once.

    The reference self-joins order lines on (client, day).  Here lines are
    first reduced to one row per (client, day, display name) holding the
    multiplicity and the smallest product id / category of that name; the
    self-join then emits one row per pair of *distinct names* in a basket,
    weighted by the product of multiplicities.  That is exactly the set of
    (pair, basket) contributions the result is made of; duplicate lines of a
    name are never paired.  A very large basket is a skewed join key, which
    AQE's skew-join handling splits across tasks.  The smallest id / category
    are carried as order-preserving ranks (longs), so both aggregates stay
    hash-based; the ranks are turned back into strings on the result rows.
    """
    prods = (star.products_display.select("id_produit", F.col("nom_affiche").alias("nom_produit"))
             .join(star.product_ranks.select("id_produit", "id_rank", "cat_rank"), "id_produit"))
    orders = star.facts_commandes.select("id_commande", "id_client", "id_date_commande")
    lines = star.details.select("id_commande", "id_details_produits").join(orders, "id_commande")
    lines = lines.join(prods, lines.id_details_produits == prods.id_produit)
    basket = (lines.groupBy("id_client", "id_date_commande", "nom_produit")
              .agg(F.count(F.lit(1)).alias("n"), F.min("id_rank").alias("pid"), F.min("cat_rank").alias("cat")))
    a = basket.select(F.col("id_client").alias("c"), F.col("id_date_commande").alias("d"),
                      F.col("nom_produit").alias("produit_A"), F.col("n").alias("nA"),
                      F.col("pid").alias("pidA"), F.col("cat").alias("catA"))
    b = basket.select(F.col("id_client").alias("c2"), F.col("id_date_commande").alias("d2"),
                      F.col("nom_produit").alias("produit_B"), F.col("n").alias("nB"),
                      F.col("pid").alias("pidB"), F.col("cat").alias("catB"))
    pairs = a.join(b, (a.c == b.c2) & (a.d == b.d2) & (a.produit_A < b.produit_B))
    counted = (pairs.groupBy("produit_A", "produit_B")
               .agg(F.min("pidA").alias("rA"), F.min("catA").alias("kA"),
                    F.min("pidB").alias("rB"), F.min("catB").alias("kB"),
                    F.sum(F.col("nA") * F.col("nB")).alias("nb_occurrences"))
               .where(F.col("nb_occurrences") > 1))
    ids = star.product_ranks.select("id_rank", "id_produit").where(F.col("id_rank").isNotNull())
    cats = star.product_ranks.select("cat_rank", "categorie").where(F.col("cat_rank").isNotNull()).distinct()

    def decode(df, rank_col, dictionary, key, value, out):
        d = dictionary.select(F.col(key).alias(f"_{out}_k"), F.col(value).alias(out))
        return df.join(d, df[rank_col] == d[f"_{out}_k"], "left").drop(f"_{out}_k", rank_col)

    out = decode(counted, "rA", ids, "id_rank", "id_produit", "id_produit_A")
    out = decode(out, "rB", ids, "id_rank", "id_produit", "id_produit_B")
    out = decode(out, "kA", cats, "cat_rank", "categorie", "categorie_A")
    out = decode(out, "kB", cats, "cat_rank", "categorie", "categorie_B")
    return (out.select("produit_A", "id_produit_A", "categorie_A", "produit_B", "id_produit_B", "categorie_B",
                       "nb_occurrences")
            .transform(ranked, F.desc("nb_occurrences")))


def sales_month_peaks(star: Star) -> DataFrame:
    """Monthly catalogue-price revenue against the mean of all months."""
    units = units_by_product_day(star)
    prods = star.dim_produits.select("id_produit", "prix")
    x = units.join(prods, units.id_details_produits == prods.id_produit)
    monthly = (x.groupBy(F.year("date").alias("annee"), F.month("date").alias("mois"))
               .agg(F.round(F.sum(money(F.col("qty"), price(F.col("prix")))), 2).alias("ca")))
    # AVG() OVER () of the reference: a one-row aggregate used as a scalar subquery.
    stats = monthly.agg(F.sum("ca").alias("s"), F.count(F.lit(1)).alias("n"))
    s, n = stats.select("s").scalar(), stats.select("n").scalar()
    # ca > avg * 1.3  <=>  ca * n > sum * 1.3  (exact in DECIMAL, n > 0)
    variation = (F.when(F.col("ca") * n > s * F.lit(MONTH_STRONG_FACTOR).cast("decimal(2,1)"), MONTH_STRONG)
                 .when(F.col("ca") * n < s * F.lit(MONTH_WEAK_FACTOR).cast("decimal(2,1)"), MONTH_WEAK)
                 .otherwise(MONTH_NORMAL))
    return monthly.select(
        F.concat(F.col("annee").cast("string"), F.lit("-"), F.lpad(F.col("mois").cast("string"), 2, "0")).alias("periode"),
        F.col("ca").cast("double").alias("chiffre_affaires"),
        round_ratio(safe_ratio(F.lit(s), F.lit(n))).alias("moyenne_globale"),
        variation.alias("variation"),
    ).orderBy("periode")


PERIOD_RANK = {label: i for i, label in enumerate(PERIOD_LABELS_7D, 1)}


def _promo_lines(star: Star, days_before: int, days_after: int) -> DataFrame:
    """Non-cancelled order lines joined to the promotions of their product, kept when
    the order day lies in [start - days_before, end + days_after]."""
    lines = order_lines(star)
    promos = promotions_with_dates(star).where(F.col("date_debut").isNotNull() & F.col("date_fin").isNotNull())
    promos = promos.select(F.col("id_produit").alias("_pp"), "id_promotion", "valeur_promotion",
                           "date_debut", "date_fin")
    x = lines.join(promos, (lines.id_details_produits == promos._pp)
                   & lines.date.between(F.date_sub(promos.date_debut, days_before),
                                        F.date_add(promos.date_fin, days_after)))
    return x.drop("_pp")


def _promo_windows(star: Star, windows: dict[str, tuple[F.Column, F.Column]], *columns: str) -> DataFrame:
    """Units of each promotion's product in each of its windows that holds a sales day: id_produit, periode, columns, qty.

    windows: label -> (first day, last day) from date_debut and date_fin.
    """
    promos = promotions_with_dates(star).where(F.col("date_debut").isNotNull() & F.col("date_fin").isNotNull())
    spans = F.array(*[F.struct(F.lit(label).alias("periode"), a.alias("_first"), b.alias("_last")) for label, (a, b) in windows.items()])
    asked = promos.select("id_produit", *columns, F.explode(spans).alias("w")).select("id_produit", *columns, "w.*")
    units = units_by_product_day(star).withColumnRenamed("id_details_produits", "id_produit")
    return window_totals(units, asked, "id_produit", "date", "_first", "_last", ("qty",)).where("n_days > 0").drop("_first", "_last", "n_days")


def sales_promo_impact_7d(star: Star, days: int = PROMO_WINDOW_7D) -> DataFrame:
    """Catalogue revenue, units and orders before / during / after each promotion (7 days)."""
    x = _promo_lines(star, days, days)
    prods = star.dim_produits.select("id_produit", "produit", "prix")
    x = x.join(prods, x.id_details_produits == prods.id_produit)
    label = promo_period_label(F.col("date"), F.col("date_debut"), F.col("date_fin"), days,
                               PERIOD_LABELS_7D, PERIOD_OTHER_7D)
    out = (x.groupBy(label.alias("periode_analyse"), "produit", F.col("date_debut").alias("debut_promo"),
                     F.col("date_fin").alias("fin_promo"), F.col("date").alias("date_commande"))
           .agg(round_money(F.sum(money(F.col("quantite"), price(F.col("prix"))))).alias("chiffre_affaires"),
                F.sum("quantite").alias("quantite_vendue"),
                F.countDistinct("id_commande").alias("nb_commandes")))
    rank = F.coalesce(*[F.when(F.col("periode_analyse") == k, v) for k, v in PERIOD_RANK.items()], F.lit(4))
    return out.transform(ranked, "produit", rank)


def sales_promo_variation_30d(star: Star, days: int = PROMO_WINDOW_30D) -> DataFrame:
    """Per product x promotion: revenue and units before / during / after (30 days), and the
    % change of 'during' against the mean of 'before' and 'after'."""
    start, end = F.col("date_debut"), F.col("date_fin")
    windows = {BEFORE: (F.date_sub(start, days), F.least(F.date_sub(start, 1), F.date_add(end, days))), DURING: (start, end),
               AFTER: (F.greatest(F.date_add(end, 1), start), F.date_add(end, days))}
    x = _promo_windows(star, windows, "id_promotion", "valeur_promotion")
    prods = star.dim_produits.select("id_produit", "produit", "variation", "prix")
    x = x.join(prods, "id_produit")
    # a window has one price: a promotion's own days are the discounted ones
    unit = F.when(F.col("periode") == DURING, discounted_price(F.col("prix"), F.col("valeur_promotion"))).otherwise(price(F.col("prix")).cast(UNIT))
    agr = (x.groupBy("id_produit", "produit", "variation", "prix", "id_promotion", "periode")
           .agg(F.sum(money(F.col("qty"), unit)).cast("double").alias("ca"), F.sum("qty").alias("q")))

    def pick(p, c):
        return F.max(F.when(F.col("periode") == p, F.col(c)).otherwise(F.lit(0).cast(agr.schema[c].dataType)))

    comp = (agr.groupBy("id_produit", "produit", "variation", "prix", "id_promotion")
            .agg(pick(BEFORE, "ca").alias("ca_avant"), pick(DURING, "ca").alias("ca_pendant"),
                 pick(AFTER, "ca").alias("ca_apres"), pick(BEFORE, "q").alias("qte_avant"),
                 pick(DURING, "q").alias("qte_pendant"), pick(AFTER, "q").alias("qte_apres")))
    # COUNT(DISTINCT prix) OVER (PARTITION BY produit) over the surviving rows: one row per product
    # and promotion, read twice, so worked out once.
    ensure_checkpoint_dir(star.spark)
    comp = comp.checkpoint()
    nb = comp.groupBy("produit").agg(F.countDistinct("prix").alias("_nb"))
    comp = comp.join(nb, "produit")
    name = F.when((F.col("_nb") > 1) & F.col("variation").isNotNull(),
                  F.concat(F.col("produit"), F.lit(" - "), F.col("variation"))).otherwise(F.col("produit"))

    def pct(during, before, after):
        mean = (F.col(before).cast("double") + F.col(after).cast("double")) / 2
        return round_ratio(safe_ratio(F.col(during).cast("double") - mean, mean) * 100)

    return comp.select(
        "id_produit", name.alias("produit_final"), "id_promotion",
        "ca_avant", "ca_pendant", "ca_apres", "qte_avant", "qte_pendant", "qte_apres",
        pct("ca_pendant", "ca_avant", "ca_apres").alias("variation_ca_pct_moy"),
        pct("qte_pendant", "qte_avant", "qte_apres").alias("variation_qte_pct_moy"),
    ).transform(ranked, F.desc("ca_pendant"))


def sales_promo_sensitivity(star: Star, days: int = PROMO_WINDOW_30D, before_end: str = "promo_end") -> DataFrame:
    """Per product: catalogue revenue and units before vs during promotions.

    As in the reference, "before" runs from start - 30 to **end - 1** and the
    first matching label wins, so "during" is only the promotion's last day.
    `before_end="promo_start"` ends "before" at start - 1 instead.
    """
    start, end = F.col("date_debut"), F.col("date_fin")
    b_end = F.date_sub(end, 1) if before_end == "promo_end" else F.date_sub(start, 1)
    windows = {BEFORE: (F.date_sub(start, days), F.least(b_end, end)), DURING: (F.greatest(start, F.date_add(b_end, 1)), end)}
    x = _promo_windows(star, windows)
    prods = star.dim_produits.select("id_produit", "produit", "prix")
    x = x.join(prods, "id_produit").withColumn("_m", money(F.col("qty"), price(F.col("prix"))))
    # Both periods in one aggregation (the reference self-joins the per-period aggregate).
    comp = (x.groupBy("id_produit", "produit")
            .agg(F.sum(F.when(F.col("periode") == BEFORE, F.col("_m"))).cast("double").alias("ca_avant"),
                 F.sum(F.when(F.col("periode") == DURING, F.col("_m"))).cast("double").alias("ca_pendant"),
                 F.sum(F.when(F.col("periode") == BEFORE, F.col("qty"))).alias("qte_avant"),
                 F.sum(F.when(F.col("periode") == DURING, F.col("qty"))).alias("qte_pendant"),
                 F.max((F.col("periode") == BEFORE).cast("int")).alias("_has_avant"),
                 F.max((F.col("periode") == DURING).cast("int")).alias("_has_pendant"))
            .where((F.col("_has_avant") == 1) & (F.col("_has_pendant") == 1)))
    r_ca = safe_ratio(F.col("ca_pendant") - F.col("ca_avant"), F.col("ca_avant"))
    r_q = safe_ratio(F.col("qte_pendant") - F.col("qte_avant"), F.col("qte_avant"))
    interp = (F.when(r_ca >= SENSITIVITY_HIGH_AT, SENSITIVITY_HIGH).when(r_ca <= SENSITIVITY_LOW_AT, SENSITIVITY_LOW)
              .otherwise(SENSITIVITY_MID))
    return comp.select(
        "produit", "ca_avant", "ca_pendant", round_ratio(r_ca * 100).alias("variation_CA_pct"),
        "qte_avant", "qte_pendant", round_ratio(r_q * 100).alias("variation_qte_pct"),
        interp.alias("interpretation"),
    ).transform(ranked, F.desc("variation_CA_pct"))
