"""The star schema as a set of lazily built DataFrames.

A `Star` is built from the ten staging tables.  Nothing runs until a KPI
result is written or collected, except the channel dimension's surrogate ids,
which are checkpointed once per Star (see operators/surrogate.py), and the two
tables that many KPIs share: the display names and the product x day rollup.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vitrine.operators import marts
from vitrine.operators.lookup import size_checked


class Star:
    def __init__(self, spark: SparkSession, staging: dict[str, DataFrame],
                 cal_start: str = marts.REFERENCE_CAL_START, cal_end: str = marts.REFERENCE_CAL_END, root: str | None = None):
        """root: a folder for the star's shared tables; without it they lie in the session's checkpoint folder."""
        self.spark = spark
        self.root = root
        self.stg = staging
        self.cal_start = cal_start
        self.cal_end = cal_end

    # --- calendar ----------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, self.cal_start, self.cal_end)

    @property
    def cal(self) -> DataFrame:
        """The calendar with its broadcast hint (row count bounded by the range)."""
        return marts.calendar_broadcast(self.dim_date, self.cal_start, self.cal_end)

    # --- dimensions ----------------------------------------------------------------
    @cached_property
    def dim_canal(self) -> DataFrame:
        return marts.dim_canal(self.stg["stg_campaigns"], self.stg["stg_posts"])

    @cached_property
    def canal_lookup(self) -> DataFrame:
        """dim_canal with a broadcast hint if its counted rows allow it: facts then meet it without an exchange on the channel name."""
        return size_checked(self.dim_canal)

    @cached_property
    def dim_clients(self) -> DataFrame:
        return marts.dim_clients(self.stg["stg_clients"])

    @cached_property
    def details(self) -> DataFrame:
        """Order lines without the surrogate id (all KPIs read this)."""
        return marts.details_lines(self.stg["stg_details_commandes"])

    def dim_details_commandes(self) -> DataFrame:
        return marts.dim_details_commandes(self.stg["stg_details_commandes"])

    @cached_property
    def dim_entrepots(self) -> DataFrame:
        return marts.dim_entrepots(self.stg["stg_entrepots"])

    @cached_property
    def dim_favoris(self) -> DataFrame:
        return marts.dim_favoris(self.stg["stg_clients"])

    @cached_property
    def dim_machine(self) -> DataFrame:
        return marts.dim_machine(self.stg["stg_entrepots_machine"])

    @cached_property
    def dim_produits(self) -> DataFrame:
        return marts.dim_produits(self.stg["stg_produits"])

    @cached_property
    def products_display(self) -> DataFrame:
        """dim_produits plus `nom_affiche`, the display name ('name - variation' when the name has
        several prices).  Read by several KPIs, so it is materialised once per star (a reliable
        checkpoint in the session's checkpoint folder) instead of recounting prices per name each time."""
        from vitrine.functions.pricing import with_display_name
        from vitrine.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.spark)
        return with_display_name(self.dim_produits, out="nom_affiche").checkpoint(eager=True)

    @cached_property
    def product_ranks(self) -> DataFrame:
        """Per product: dense ranks of its id and of its category, in string order (NULL stays NULL).

        MIN over the ranks equals MIN over the strings, and long buffers keep the
        large aggregates hash-based instead of sort-based (product pairs)."""
        from pyspark.sql import functions as F

        from vitrine.operators.surrogate import ordered_sequence_id

        prods = self.products_display.select("id_produit", "categorie")
        ids = ordered_sequence_id(prods.select("id_produit").where(F.col("id_produit").isNotNull()).distinct(),
                                  ["id_produit"], "id_rank")
        cats = ordered_sequence_id(prods.select("categorie").where(F.col("categorie").isNotNull()).distinct(),
                                   ["categorie"], "cat_rank")
        return prods.join(ids, "id_produit", "left").join(cats, "categorie", "left").checkpoint(eager=True)

    @cached_property
    def product_days(self) -> DataFrame:
        """Units per product and order day, stored once per star: every line, and the lines of orders that aren't cancelled.

        id_details_produits, date (NULL: the line's order is unknown or outside the
        calendar), qty and n (all lines), live_qty and live_n (lines of live orders).
        The one line / order join of the KPIs on units; map-side combined, so a hot
        product leaves a task as one row per day."""
        from pyspark.sql import functions as F

        from vitrine.functions.pricing import not_cancelled
        from vitrine.sources.ingest import scratch_dir
        from vitrine.sources.store import replace_table

        orders = self.orders_dated.select("id_commande", F.col("date_commande").alias("date"),
                                          F.coalesce(not_cancelled(F.col("statut_commande")), F.lit(False)).alias("live"))
        lines = self.details.select("id_commande", "id_details_produits", "quantite").join(orders, "id_commande", "left")
        rollup = lines.groupBy("id_details_produits", "date").agg(
            F.sum("quantite").alias("qty"), F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("live"), F.col("quantite"))).alias("live_qty"), F.count(F.when(F.col("live"), 1)).alias("live_n"))
        target = f"{self.root or scratch_dir(self.spark, 'star')}/product_days"
        return replace_table(rollup, target)

    @cached_property
    def promotions_dated(self) -> DataFrame:
        """dim_promotions plus the calendar dates of its two ids (internal)."""
        return marts.promotions_dated(self.stg["stg_promotions"], self.cal)

    @cached_property
    def dim_promotions(self) -> DataFrame:
        return self.promotions_dated.drop("date_debut", "date_fin")

    @cached_property
    def dim_satisfaction(self) -> DataFrame:
        return marts.dim_satisfaction(self.stg["stg_satisfaction"])

    # --- facts ---------------------------------------------------------------------
    @cached_property
    def facts_campaigns(self) -> DataFrame:
        return marts.facts_campaigns(self.stg["stg_campaigns"], self.canal_lookup, self.cal)

    @cached_property
    def orders_dated(self) -> DataFrame:
        """facts_commandes plus the calendar dates of its two ids (internal)."""
        return marts.orders_dated(self.stg["stg_commandes"], self.cal)

    @cached_property
    def facts_commandes(self) -> DataFrame:
        return self.orders_dated.drop("date_commande", "date_livraison")

    @cached_property
    def facts_entrepots_machine(self) -> DataFrame:
        return marts.facts_entrepots_machine(self.stg["stg_entrepots_machine"])

    @cached_property
    def facts_posts(self) -> DataFrame:
        return marts.facts_posts(self.stg["stg_posts"], self.cal, self.canal_lookup)


_STAR_CACHE: dict[tuple[int, str], Star] = {}


def testdata_star(spark: SparkSession, sf_dir: str) -> Star:
    """Star over the driver's test tables (FIXTURES.md section 2), one per session and folder."""
    from vitrine.sources import testdata

    key = (id(spark), sf_dir)
    star = _STAR_CACHE.get(key)
    if star is None or star.spark is not spark:
        star = Star(spark, testdata.staging_from_testdata(spark, sf_dir), *testdata.calendar_bounds(spark, sf_dir))
        _STAR_CACHE[key] = star
    return star
