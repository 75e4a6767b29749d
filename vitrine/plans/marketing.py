"""Marketing KPIs (the reference's Marketing_Ticket* models)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.pricing import (discounted_price_by_type, money, price, round_money, round_ratio,
                                       safe_ratio)
from vitrine.functions.text import bq_trim
from vitrine.operators.windows import days_inside, window_totals
from vitrine.plans.common import orders_with_date, promotions_with_dates, ranked, units_by_product_day, with_products
from vitrine.fixed_values import DAY_NO_PROMO, DAY_PROMO, PEAK_SIGMAS, SENTIMENTS
from vitrine.star import Star

BUDGET = "decimal(24,6)"


def _campaigns_by_channel(star: Star) -> DataFrame:
    """Campaign totals per channel id (map-side combined), then the channel name."""
    per_id = (star.facts_campaigns.groupBy("id_canal_dim_canal")
              .agg(F.sum(F.col("budget").cast(BUDGET)).alias("_budget"),
                   F.sum("clics").alias("_clics"), F.sum("conversions").alias("_conv")))
    canal = star.canal_lookup
    return (per_id.join(canal, per_id.id_canal_dim_canal == canal.id_canal)
            .groupBy(F.col("nom_canal").alias("canal"))
            .agg(F.sum("_budget").alias("budget"), F.sum("_clics").alias("clics"), F.sum("_conv").alias("conv")))


def mkt_clicks_by_channel(star: Star) -> DataFrame:
    return (_campaigns_by_channel(star)
            .select("canal", F.col("clics").alias("total_clics"), F.col("conv").alias("total_acquisitions"))
            .orderBy(F.desc("total_clics")))


def mkt_cpc_cpa_by_channel(star: Star) -> DataFrame:
    ch = _campaigns_by_channel(star)
    return ch.select(
        "canal", F.col("budget").cast("double").alias("budget_total"),
        F.col("clics").alias("total_clics"), F.col("conv").alias("total_conversions"),
        round_ratio(safe_ratio(F.col("budget"), F.col("clics"))).alias("cpc"),
        round_ratio(safe_ratio(F.col("budget"), F.col("conv"))).alias("cpa"),
    ).orderBy(F.desc("budget_total"))


def mkt_cpa_converting(star: Star) -> DataFrame:
    ch = _campaigns_by_channel(star).where(F.col("conv") > 0)
    return ch.select(
        "canal", F.col("budget").cast("double").alias("budget_total"),
        F.col("conv").alias("total_conversions"),
        round_ratio(safe_ratio(F.col("budget"), F.col("conv"))).alias("cpa"),
    ).orderBy("cpa", F.desc("total_conversions"))


def mkt_promo_days_vs_others(star: Star) -> DataFrame:
    """Revenue on promotion days (a sold product was in promotion that day) against other days.

    One pass: a sweep over each product's promotions flags its days, and the flag
    and the revenue of a day come out of the same aggregate.
    """
    units = with_products(units_by_product_day(star), star.dim_produits.select("id_produit", "prix")).select("id_produit", "date", "qty", "prix")
    sold = days_inside(units, promotions_with_dates(star), "id_produit", "date", "date_debut", "date_fin")
    per_day = sold.groupBy("date").agg(F.sum(money(F.col("qty"), price(F.col("prix")))).alias("_ca"), F.max("inside").alias("_promo"))
    resume = (per_day.groupBy(F.when(F.col("_promo"), DAY_PROMO).otherwise(DAY_NO_PROMO).alias("statut_jour"))
              .agg(F.sum("_ca").alias("_ca"), F.count("date").alias("nb_jours_vente"))
              .select("statut_jour", F.round("_ca", 2).alias("ca_total"), "nb_jours_vente",
                      round_ratio(safe_ratio(F.col("_ca"), F.col("nb_jours_vente"))).alias("ca_moyen")))

    def pick(tag, c):
        return F.max(F.when(F.col("statut_jour") == tag, F.col(c)))

    piv = resume.agg(
        pick(DAY_PROMO, "ca_total").cast("double").alias("ca_jour_promo"),
        pick(DAY_NO_PROMO, "ca_total").cast("double").alias("ca_jour_hors_promo"),
        pick(DAY_PROMO, "nb_jours_vente").alias("nb_jours_promo"),
        pick(DAY_NO_PROMO, "nb_jours_vente").alias("nb_jours_hors_promo"),
        pick(DAY_PROMO, "ca_moyen").alias("ca_moyen_jour_promo"),
        pick(DAY_NO_PROMO, "ca_moyen").alias("ca_moyen_jour_hors_promo"))
    return piv.select(
        "ca_jour_promo", "ca_jour_hors_promo", "nb_jours_promo", "nb_jours_hors_promo",
        "ca_moyen_jour_promo", "ca_moyen_jour_hors_promo",
        round_ratio(safe_ratio(F.col("ca_jour_promo"), F.col("ca_jour_hors_promo"))).alias("ratio_ca_total_promo_vs_hors"),
        round_ratio(safe_ratio(F.col("ca_moyen_jour_promo"), F.col("ca_moyen_jour_hors_promo")))
        .alias("ratio_ca_moyen_jour_promo_vs_hors"))


def mkt_monthly_promo_vs_budget(star: Star) -> DataFrame:
    """Monthly revenue under / outside promotion, full-outer-joined with the monthly budget
    per channel and event type."""
    units = with_products(units_by_product_day(star), star.dim_produits.select("id_produit", "prix"))
    promos = promotions_with_dates(star).select(
        F.col("id_produit").alias("_pp"), "id_promotion", "type_promotion", "valeur_promotion",
        "date_debut", "date_fin")
    # Range condition inside the LEFT JOIN: unmatched days keep one row with a NULL promotion.
    x = units.join(promos, (units.id_produit == promos._pp)
                   & units.date.between(promos.date_debut, promos.date_fin), "left")
    in_promo = F.col("id_promotion").isNotNull()
    promo_amount = F.when(in_promo, money(F.col("qty"), discounted_price_by_type(
        F.col("prix"), F.col("type_promotion"), F.col("valeur_promotion")))).otherwise(F.lit(0))
    plain_amount = F.when(~in_promo, money(F.col("qty"), price(F.col("prix")))).otherwise(F.lit(0))
    ca = (x.groupBy(F.trunc("date", "month").alias("mois"))
          .agg(F.round(F.sum(promo_amount), 2).alias("ca_promo"),
               F.round(F.sum(plain_amount), 2).alias("ca_hors_promo")))
    camp = star.facts_campaigns
    cal = star.cal.select(F.col("id_date").alias("_id"), F.col("date").alias("_d"))
    budget = (camp.join(cal, camp.id_date == cal._id)
              .join(star.canal_lookup, camp.id_canal_dim_canal == star.canal_lookup.id_canal)
              .groupBy(F.trunc("_d", "month").alias("b_mois"), "id_canal_dim_canal", "evenement_type", "nom_canal")
              .agg(F.round(F.sum(F.col("budget").cast(BUDGET)), 2).alias("b_budget"))
              .select("b_mois", F.col("nom_canal").alias("canal"), "evenement_type", "b_budget"))
    j = ca.join(budget, ca.mois == budget.b_mois, "full")
    ca_promo = F.coalesce(F.col("ca_promo"), F.lit(0))
    ca_hors = F.coalesce(F.col("ca_hors_promo"), F.lit(0))
    return j.select(
        F.coalesce("mois", "b_mois").alias("mois"),
        ca_promo.cast("double").alias("ca_promo"),
        ca_hors.cast("double").alias("ca_hors_promo"),
        (ca_promo + ca_hors).cast("double").alias("ca_total"),
        "canal", "evenement_type",
        F.coalesce(F.col("b_budget"), F.lit(0)).cast("double").alias("budget_marketing"),
        (safe_ratio(ca_promo, ca_promo + ca_hors) * 100).alias("impact_promo_CA"),
    ).orderBy("mois", "canal", "evenement_type")


def promo_numeric_value(valeur: F.Column) -> F.Column:
    """Numeric promotion value: '%', '€' and blanks removed, comma as decimal point."""
    return F.regexp_replace(F.regexp_replace(valeur.cast("string"), "[%€\\s]", ""), ",", ".").try_cast("double")


def mkt_promo_effectiveness(star: Star) -> DataFrame:
    """Per promotion x product: total vs in-promotion revenue and units (cancelled orders included)."""
    promos = (promotions_with_dates(star)
              .where(F.col("date_debut").isNotNull() & F.col("date_fin").isNotNull() & F.col("id_produit").isNotNull())
              .select("id_promotion", "id_produit", "type_promotion",
                      promo_numeric_value(F.col("valeur_promotion")).alias("valeur_promotion"),
                      "date_debut", "date_fin"))
    units = with_products(units_by_product_day(star, exclude_cancelled=False),
                          star.dim_produits.select("id_produit", "prix"))
    daily = units.select("id_produit", F.col("date").alias("date_commande"), F.col("qty").alias("quantite"),
                         F.round(money(F.col("qty"), price(F.col("prix"))), 2).alias("ca_jour"))
    total = daily.groupBy("id_produit").agg(F.sum("ca_jour").alias("_ca"), F.sum("quantite").alias("_q"))
    inside = window_totals(daily, promos, "id_produit", "date_commande", "date_debut", "date_fin", ("ca_jour", "quantite"))
    agg = (inside.join(total, "id_produit").groupBy("id_promotion", "id_produit", "type_promotion", "valeur_promotion")
           .agg(F.sum("_ca").alias("_tot"), F.sum(F.coalesce("ca_jour", F.lit(0))).alias("_promo"),
                F.sum("_q").alias("quantite_total"), F.sum(F.coalesce("quantite", F.lit(0))).alias("quantite_promo"))
           .where(F.col("_tot") > 0))
    return agg.select(
        "id_promotion", "id_produit", "type_promotion", "valeur_promotion",
        F.col("_tot").cast("double").alias("ca_total"), F.col("_promo").cast("double").alias("ca_promo"),
        "quantite_total", "quantite_promo",
        (round_ratio(safe_ratio(F.col("_promo"), F.col("_tot")), 4) * 100).alias("ratio_promo"),
    ).transform(ranked, F.desc("ca_promo"))


SENTIMENT_VALUES = SENTIMENTS


def mkt_sentiment_daily(star: Star) -> DataFrame:
    p = star.facts_posts
    cal = star.cal
    x = p.join(cal, p.id_date == cal.id_date).join(star.canal_lookup, p.id_canal == star.canal_lookup.id_canal)
    s = F.lower(bq_trim(F.col("sentiment_global")))
    return (x.groupBy("date", "nom_canal")
            .agg(F.count(F.lit(1)).alias("total_mentions"),
                 *[F.sum(F.when(s == v, 1).otherwise(0)).cast("long").alias(k) for k, v in SENTIMENT_VALUES.items()])
            .select("date", F.year("date").cast("long").alias("annee"), F.month("date").cast("long").alias("mois"),
                    "nom_canal", "total_mentions", *SENTIMENT_VALUES)
            .orderBy("date", "nom_canal"))


def _mentions_with_peak(star: Star) -> DataFrame:
    p = star.facts_posts
    cal = star.cal
    daily = (p.join(cal, p.id_date == cal.id_date).groupBy(F.col("date").alias("date_jour"))
             .agg(F.sum("volume_mentions").alias("total_mentions")))
    # Mean + 2 sample standard deviations over all days: one scalar, not a global window.
    threshold = daily.select(F.avg("total_mentions") + PEAK_SIGMAS * F.stddev_samp("total_mentions")).scalar()
    return daily.withColumn("pic_mention", F.when(F.col("total_mentions") > threshold, 1).otherwise(0))


def _units_per_day(star: Star) -> DataFrame:
    lines = units_by_product_day(star)
    return lines.groupBy(F.col("date").alias("_jv")).agg(F.sum("qty").alias("volume_ventes"))


def mkt_peaks_vs_sales(star: Star) -> DataFrame:
    m = _mentions_with_peak(star)
    v = _units_per_day(star)
    return (m.join(v, m.date_jour == v._jv, "left")
            .select("date_jour", F.year("date_jour").cast("long").alias("annee"),
                    F.month("date_jour").cast("long").alias("mois"), "total_mentions", "pic_mention",
                    F.coalesce("volume_ventes", F.lit(0)).alias("volume_ventes"))
            .orderBy("date_jour"))


def mkt_peaks_vs_satisfaction(star: Star) -> DataFrame:
    m = _mentions_with_peak(star)
    v = _units_per_day(star)
    orders = orders_with_date(star).select("id_commande", F.col("date").alias("_js"))
    sat = star.dim_satisfaction.select("id_commande", "note_client")
    s = (sat.join(orders, "id_commande").groupBy("_js")
         .agg(round_ratio(safe_ratio(F.sum("note_client"), F.count("note_client"))).alias("satisfaction_moyenne")))
    return (m.join(v, m.date_jour == v._jv, "left").join(s, m.date_jour == s._js, "left")
            .select("date_jour", F.year("date_jour").cast("long").alias("annee"),
                    F.month("date_jour").cast("long").alias("mois"), "total_mentions", "pic_mention",
                    F.coalesce("volume_ventes", F.lit(0)).alias("volume_ventes"), "satisfaction_moyenne")
            .orderBy("date_jour"))
