"""Join blocks shared by the KPI plans.

Physical plan notes (apply to every KPI built on these blocks):

* Order lines join their order on `id_commande`: the only fact-to-fact join.
  Both sides are large, so it is a sort-merge join; AQE splits a skewed order.
* Before any join on the product key, lines are *pre-aggregated* per
  (product, day).  That rollup is stored once per star (`Star.product_days`,
  live and all units side by side) and read by every KPI on units instead of the
  lines.  A hot product (even a third of all lines) reaches the product /
  promotion joins as at most one row per day, and the promotion fan-out
  multiplies aggregated rows, not lines.
* The calendar is broadcast (bounded by its parameters); products and
  promotions are joined without hints and AQE chooses broadcast or
  sort-merge from their runtime size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.pricing import effective_price, not_cancelled
from vitrine.star import Star


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """df in the given order, ties by its columns from left to right.

    Counts and rounded sums repeat: without the ties, all rows of one value (most
    of a result whose counts are 1) are sorted by a single task.
    """
    return df.orderBy(*order, *df.columns)


def orders_with_date(star: Star, exclude_cancelled: bool = True, date_name: str = "date") -> DataFrame:
    """facts_commandes (optionally without cancelled orders) with the order date from the calendar."""
    c = star.orders_dated.drop("date_livraison").withColumnRenamed("date_commande", date_name)
    if exclude_cancelled:
        c = c.where(not_cancelled(F.col("statut_commande")))
    return c


def order_lines(star: Star, exclude_cancelled: bool = True, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Order lines with their order date: (id_details_produits, quantite, date, *order_cols)."""
    orders = orders_with_date(star, exclude_cancelled).select("id_commande", "date", *order_cols)
    return star.details.select("id_commande", "id_details_produits", "quantite").join(orders, "id_commande")


def units_by_product_day(star: Star, exclude_cancelled: bool = True) -> DataFrame:
    """Sum of quantities per (id_details_produits, date), from the stored rollup."""
    days = star.product_days.where(F.col("date").isNotNull())
    if exclude_cancelled:
        return days.where("live_n > 0").select("id_details_produits", "date", F.col("live_qty").alias("qty"))
    return days.select("id_details_produits", "date", "qty")


def promotions_with_dates(star: Star) -> DataFrame:
    """dim_promotions with the calendar dates of its start / end ids (NULL outside the calendar)."""
    return star.promotions_dated


def with_products(units: DataFrame, products: DataFrame) -> DataFrame:
    return units.join(products, units.id_details_produits == products.id_produit)


def priced_with_promotions(units: DataFrame, star: Star, products: DataFrame | None = None,
                           promo_match: str = "product") -> DataFrame:
    """Price (product, day) units against the product's promotions; adds `unit_price`.

    promo_match="product" (the reference): promotions are LEFT JOINed on the
    product only, so a product with k promotions repeats each row k times;
    each copy is priced with the discount when the day lies inside that
    promotion, with the catalogue price otherwise.
    promo_match="in_window": a promotion joins only the days inside it, so a
    day outside every promotion keeps one row at the catalogue price and units
    are not multiplied (except on days where promotions overlap).
    """
    if promo_match not in ("product", "in_window"):
        raise ValueError(f"promo_match must be 'product' or 'in_window', not {promo_match!r}")
    prods = products if products is not None else star.dim_produits
    promos = promotions_with_dates(star).select(
        F.col("id_produit").alias("_promo_produit"), "valeur_promotion", "date_debut", "date_fin")
    x = with_products(units, prods)
    cond = x.id_produit == promos._promo_produit
    if promo_match == "in_window":
        cond = cond & x.date.between(promos.date_debut, promos.date_fin)
    x = x.join(promos, cond, "left").drop("_promo_produit")
    return x.withColumn("unit_price", effective_price(F.col("prix"), F.col("valeur_promotion"), F.col("date"),
                                                      F.col("date_debut"), F.col("date_fin")))
