"""Customer-satisfaction KPIs (the reference's Satisfaction_* models).

Mean ratings are sum / count of the integer ratings (exact sums), rounded
half-up to 2 decimals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.pricing import round_ratio, safe_ratio
from vitrine.functions.text import keyword_counts
from vitrine.plans.common import orders_with_date, ranked
from vitrine.star import Star

from vitrine.fixed_values import (DELIVERY_CANCELLED, DELIVERY_LATE, DELIVERY_OK, KEYWORDS_3, KEYWORDS_8,
                                  MIN_REVIEWS_MONTH, MIN_REVIEWS_WORST, NO_COMPLAINT, RESPONSE_BUCKETS,
                                  RESPONSE_OVER, RESPONSE_UNKNOWN, STATUS_CANCELLED, STATUS_IN_TRANSIT)


def mean_rating(sum_col: Column, count_col: Column) -> Column:
    return round_ratio(safe_ratio(sum_col, count_col))


def _ratings_per_product(star: Star) -> DataFrame:
    """Ratings joined to the order lines of the rated order, pre-aggregated per product."""
    sat = star.dim_satisfaction.select("id_commande", "note_client")
    lines = star.details.select("id_commande", "id_details_produits")
    return (sat.join(lines, "id_commande").groupBy("id_details_produits")
            .agg(F.sum("note_client").alias("_s"), F.count("note_client").alias("_c"),
                 F.count(F.lit(1)).alias("_n")))


def sat_best_rated(star: Star) -> DataFrame:
    per = _ratings_per_product(star)
    prods = star.dim_produits.select("id_produit", "categorie", "produit")
    return (per.join(prods, per.id_details_produits == prods.id_produit)
            .groupBy("categorie", "produit")
            .agg(mean_rating(F.sum("_s"), F.sum("_c")).alias("note_moyenne"), F.sum("_n").alias("nb_avis"))
            .transform(ranked, F.desc("note_moyenne")))


def sat_worst_rated(star: Star, min_reviews: int = MIN_REVIEWS_WORST) -> DataFrame:
    per = _ratings_per_product(star)
    prods = star.dim_produits.select("id_produit", "categorie", "produit")
    return (per.join(prods, per.id_details_produits == prods.id_produit)
            .groupBy("categorie", "id_produit", "produit")
            .agg(mean_rating(F.sum("_s"), F.sum("_c")).alias("note_moyenne"), F.sum("_n").alias("nb_avis"))
            .where(F.col("nb_avis") >= min_reviews)
            .transform(ranked, "note_moyenne"))


def sat_monthly_trend(star: Star, min_reviews: int = MIN_REVIEWS_MONTH) -> DataFrame:
    sat = star.dim_satisfaction.where(F.col("note_client").isNotNull()).select("id_commande", "note_client")
    orders = orders_with_date(star).select("id_commande", "date")
    x = sat.join(orders, "id_commande")
    return (x.groupBy(F.year("date").cast("long").alias("annee"), F.month("date").cast("long").alias("mois"),
                      F.date_format("date", "yyyy-MM").alias("periode"))
            .agg(mean_rating(F.sum("note_client"), F.count("note_client")).alias("note_moyenne"),
                 F.count(F.lit(1)).alias("nb_avis"))
            .where(F.col("nb_avis") >= min_reviews)
            .orderBy("periode"))


def _by_bucket(star: Star, bucket: Column, name: str) -> DataFrame:
    return (star.dim_satisfaction.groupBy(bucket.alias(name))
            .agg(mean_rating(F.sum("note_client"), F.count("note_client")).alias("note_moyenne"),
                 F.count(F.lit(1)).alias("nb_avis"))
            .transform(ranked, "note_moyenne"))


def sat_by_complaint(star: Star) -> DataFrame:
    return _by_bucket(star, F.coalesce(F.col("type_plainte"), F.lit(NO_COMPLAINT)), "type_plainte")


def response_time_bucket(hours: Column) -> Column:
    out = F.when(hours.isNull(), RESPONSE_UNKNOWN)
    for upper, label in RESPONSE_BUCKETS:
        out = out.when(hours <= upper, label)
    return out.otherwise(RESPONSE_OVER)


def sat_by_response_time(star: Star) -> DataFrame:
    return _by_bucket(star, response_time_bucket(F.col("temps_de_reponse")), "delai_support")


def sat_by_delivery_state(star: Star, as_of: str | dt.date | None = None) -> DataFrame:
    """Mean rating per order month and delivery situation.

    The reference compares the due date with CURRENT_DATE(); `as_of` makes the
    run reproducible (default: today).
    """
    today = F.lit(str(as_of)).cast("date") if as_of is not None else F.current_date()
    c = star.orders_dated.select("id_commande", "statut_commande", F.col("date_commande").alias("_do"),
                                 F.col("date_livraison").alias("_dl"))
    sat = star.dim_satisfaction.where(F.col("note_client").isNotNull()).select("id_commande", "note_client")
    x = c.join(sat, "id_commande")
    status = F.lower(F.col("statut_commande"))
    situation = (F.when((status == STATUS_IN_TRANSIT) & (F.col("_dl") < today), DELIVERY_LATE)
                 .when(status == STATUS_CANCELLED, DELIVERY_CANCELLED).otherwise(DELIVERY_OK))
    return (x.groupBy(F.date_format("_do", "yyyy-MM").alias("mois_commande"), situation.alias("situation_livraison"))
            .agg(mean_rating(F.sum("note_client"), F.count("note_client")).alias("note_moyenne"),
                 F.count(F.lit(1)).alias("nb_commandes"))
            .orderBy("mois_commande", "situation_livraison"))


def _keywords(star: Star, keywords: dict[str, str]) -> DataFrame:
    s = star.dim_satisfaction.where(F.col("commentaire").isNotNull())
    return (s.groupBy("note_client")
            .agg(F.count(F.lit(1)).alias("nb_commentaires"), *keyword_counts(F.col("commentaire"), keywords))
            .orderBy("note_client"))


def sat_keywords_3(star: Star) -> DataFrame:
    return _keywords(star, KEYWORDS_3)


def sat_keywords_8(star: Star) -> DataFrame:
    return _keywords(star, KEYWORDS_8)
