"""Query registry: inventory key -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the driver's test tables in `sf_dir` (through the
FIXTURES mapping) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from vitrine.plans import logistics, marketing, sales, satisfaction
from vitrine.plans.satisfaction import sat_by_delivery_state
from vitrine.star import testdata_star

# CURRENT_DATE of the delivery-state KPI, fixed so results are reproducible.
AS_OF = "2000-01-01"

Query = Callable[[SparkSession, str], DataFrame]


def _kpi(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(testdata_star(spark, sf_dir))
    run.__name__ = fn.__name__
    run.kpi = fn
    return run


QUERIES: dict[str, Query] = {
    "sales_daily_revenue": _kpi(sales.sales_daily_revenue),
    "sales_top_products": _kpi(sales.sales_top_products),
    "sales_unsold_products": _kpi(sales.sales_unsold_products),
    "sales_least_sold": _kpi(sales.sales_least_sold),
    "sales_declining_products": _kpi(sales.sales_declining_products),
    "sales_by_age_band": _kpi(sales.sales_by_age_band),
    "sales_wishlist_counts": _kpi(sales.sales_wishlist_counts),
    "sales_product_pairs": _kpi(sales.sales_product_pairs),
    "sales_month_peaks": _kpi(sales.sales_month_peaks),
    "sales_promo_impact_7d": _kpi(sales.sales_promo_impact_7d),
    "sales_promo_variation_30d": _kpi(sales.sales_promo_variation_30d),
    "sales_promo_sensitivity": _kpi(sales.sales_promo_sensitivity),
    "mkt_clicks_by_channel": _kpi(marketing.mkt_clicks_by_channel),
    "mkt_cpc_cpa_by_channel": _kpi(marketing.mkt_cpc_cpa_by_channel),
    "mkt_cpa_converting": _kpi(marketing.mkt_cpa_converting),
    "mkt_promo_days_vs_others": _kpi(marketing.mkt_promo_days_vs_others),
    "mkt_monthly_promo_vs_budget": _kpi(marketing.mkt_monthly_promo_vs_budget),
    "mkt_promo_effectiveness": _kpi(marketing.mkt_promo_effectiveness),
    "mkt_sentiment_daily": _kpi(marketing.mkt_sentiment_daily),
    "mkt_peaks_vs_sales": _kpi(marketing.mkt_peaks_vs_sales),
    "mkt_peaks_vs_satisfaction": _kpi(marketing.mkt_peaks_vs_satisfaction),
    "sat_best_rated": _kpi(satisfaction.sat_best_rated),
    "sat_worst_rated": _kpi(satisfaction.sat_worst_rated),
    "sat_monthly_trend": _kpi(satisfaction.sat_monthly_trend),
    "sat_by_complaint": _kpi(satisfaction.sat_by_complaint),
    "sat_by_response_time": _kpi(satisfaction.sat_by_response_time),
    "sat_keywords_3": _kpi(satisfaction.sat_keywords_3),
    "sat_keywords_8": _kpi(satisfaction.sat_keywords_8),
    "sat_by_delivery_state": _kpi(lambda star: sat_by_delivery_state(star, as_of=AS_OF)),
    "log_downtime_by_warehouse": _kpi(logistics.log_downtime_by_warehouse),
    "log_orders_by_warehouse": _kpi(logistics.log_orders_by_warehouse),
    "log_breakdown_impact": _kpi(logistics.log_breakdown_impact),
    "log_reported_delays": _kpi(logistics.log_reported_delays),
    "log_volume_by_warehouse": _kpi(logistics.log_volume_by_warehouse),
}


def _star_table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = testdata_star(spark, sf_dir)
        if name == "dim_details_commandes":
            return star.dim_details_commandes()
        return getattr(star, name)
    run.__name__ = name
    return run


STAR_KEYS = ("dim_date", "dim_canal", "dim_clients", "dim_details_commandes", "dim_entrepots", "dim_favoris",
             "dim_machine", "dim_produits", "dim_promotions", "dim_satisfaction", "facts_campaigns",
             "facts_commandes", "facts_entrepots_machine", "facts_posts")
QUERIES.update({k: _star_table(k) for k in STAR_KEYS})


def star_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    star = testdata_star(spark, sf_dir)
    models = {k: getattr(star, k) for k in STAR_KEYS if k != "dim_details_commandes"}
    models["dim_details_commandes"] = star.dim_details_commandes()
    return models


def _dq(test: str | None) -> Query:
    from vitrine.operators.quality import dq_report

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dq_report(star_models(spark, sf_dir), test=test)
    return run


def _dq_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while the models are built from the dirty raw tables, in a calendar that ends before the last orders."""
    from vitrine.operators.quality import dq_build_report
    from vitrine.operators.staging import build_staging
    from vitrine.sources import testdata
    from vitrine.sources.ingest import scratch_dir
    from vitrine.sources.raw_fixtures import raw_tables
    from vitrine.star import Star

    staging = build_staging(raw_tables(spark, sf_dir))
    low, high = testdata.calendar_bounds(spark, sf_dir)
    return dq_build_report(Star(spark, staging, low, f"{int(high[:4]) - 1}-06-30"), scratch_dir(spark, "models"))[0]


QUERIES.update({
    "dq_build_report": _dq_build,
    "dq_unique": _dq("unique"),
    "dq_not_null": _dq("not_null"),
    "dq_relationships": _dq("relationships"),
    "dq_report": _dq(None),
})


# --- staging: raw dirty tables derived from the test tables -> cleaned tables --------------

def _staging(name: str) -> Query:
    from vitrine.operators.staging import STAGING_MODELS
    from vitrine.sources.raw_fixtures import raw_table

    raw_name, fn = STAGING_MODELS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(raw_table(spark, sf_dir, raw_name))
    run.__name__ = name
    return run


def _dedup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in and rows kept by dedup_by_completeness, for each staging model."""
    from pyspark.sql import functions as F

    from vitrine.operators.staging import STAGING_MODELS
    from vitrine.sources.raw_fixtures import raw_table

    parts = []
    for name, (raw_name, fn) in STAGING_MODELS.items():
        raw = raw_table(spark, sf_dir, raw_name)
        raw_n = raw.select(F.count(F.lit(1))).scalar()
        kept_n = fn(raw).select(F.count(F.lit(1))).scalar()
        parts.append(spark.range(1).select(F.lit(name).alias("model"), raw_n.alias("raw_rows"),
                                           kept_n.alias("kept_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _strip_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vitrine.functions.cleaning import strip_variation_suffix
    from vitrine.sources.raw_fixtures import raw_table

    raw = raw_table(spark, sf_dir, "raw_produits")
    return raw.select("id", "produit", "variation",
                      strip_variation_suffix(F.col("produit"), F.col("variation")).alias("produit_nettoye"))


def _safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vitrine.functions.cleaning import safe_date, safe_double, safe_long
    from vitrine.sources.raw_fixtures import raw_table

    raw = raw_table(spark, sf_dir, "raw_campaigns")
    return raw.select("id_campagne", safe_date(F.col("date")).alias("date"), safe_double(F.col("budget")).alias("budget"),
                      safe_long(F.col("impressions")).alias("impressions"), safe_long(F.col("clics")).alias("clics"),
                      safe_long(F.col("conversions")).alias("conversions"), safe_double(F.col("ctr")).alias("ctr"))


def _yes_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vitrine.functions.cleaning import yes_no_to_boolean
    from vitrine.sources.raw_fixtures import raw_table

    raw = raw_table(spark, sf_dir, "raw_details_commandes")
    return raw.select("id_commande", "id_produit", "emballage_special",
                      yes_no_to_boolean(F.col("emballage_special")).alias("emballage_bool"))


def _year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vitrine.functions.cleaning import is_year_month, year_month_split
    from vitrine.sources.raw_fixtures import raw_table

    raw = raw_table(spark, sf_dir, "raw_entrepots_machine")
    valid = is_year_month(F.col("mois"))
    mois, annee = year_month_split(F.col("mois"))
    return raw.select("id", F.col("mois").alias("mois_brut"), valid.alias("mois_valide"),
                      F.when(valid, mois).alias("mois"), F.when(valid, annee).alias("annee"))


STAGING_KEYS = ("stg_campaigns", "stg_clients", "stg_commandes", "stg_details_commandes", "stg_entrepots",
                "stg_entrepots_machine", "stg_posts", "stg_produits", "stg_promotions", "stg_satisfaction")
QUERIES.update({k: _staging(k) for k in STAGING_KEYS})
QUERIES.update({
    "dedup_by_completeness": _dedup_summary,
    "strip_variation_suffix": _strip_variation,
    "safe_cast": _safe_cast,
    "yes_no_to_boolean": _yes_no,
    "year_month_split": _year_month,
})


# --- ingest and sinks: export the raw tables as CSV files, load them back ------------------

# Fixed export headers for two files (they normalise back to the raw names); other files
# use the title-cased raw name surrounded by blanks.
EXPORT_HEADERS = {
    "raw_clients": ("ID.Client", "Prénom_Client", "Nom_Client", "Email", "Age", "Genre", "Fréquence_Visites",
                          "Numéro_Téléphone", "Favoris", "Adresse.IP"),
    "raw_produits": ("ID", "Catégorie", "Marque", "Produit", "Prix", "Sous-Catégorie", "Variation"),
}


def export_raw_csv(spark: SparkSession, sf_dir: str, table: str, folder: str) -> str:
    """A folder of packed files: a file is read as a whole anyway, since its fields may hold line breaks."""
    from vitrine.sources.ingest import write_csv
    from vitrine.sources.raw_fixtures import RAW_SPECS, raw_rows

    headers = EXPORT_HEADERS.get(table) or tuple(f" {c.title()} " for c in RAW_SPECS[table].columns)
    path = f"{folder}/{table}.csv"
    write_csv(raw_rows(spark, sf_dir, table).toDF(*headers), path, compression="gzip", **{"zlib.compress.level": "BEST_SPEED"})
    return path


def _ingest_one(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from vitrine.sources.ingest import ingest_csv, scratch_dir

        return ingest_csv(spark, export_raw_csv(spark, sf_dir, table, scratch_dir(spark, "export")))
    return run


def _overwrite_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vitrine.sources.ingest import ingest_overwrite_sink, scratch_dir
    from vitrine.sources.raw_fixtures import raw_table
    from vitrine.sources.store import read_table

    target = scratch_dir(spark, "sink") + "/raw_details_commandes"
    ingest_overwrite_sink(raw_table(spark, sf_dir, "raw_entrepots"), target)        # previous content
    ingest_overwrite_sink(raw_table(spark, sf_dir, "raw_details_commandes"), target)  # replaces it
    return read_table(spark, target)


def _load_all(spark: SparkSession, sf_dir: str, missing: bool = False) -> tuple[DataFrame, str]:
    from vitrine.sources.ingest import ingest_batch_log, scratch_dir
    from vitrine.sources.raw_fixtures import RAW_SPECS

    exports = scratch_dir(spark, "export")
    with ThreadPoolExecutor(4) as pool:
        paths = pool.map(inheritable_thread_target(spark)(lambda t: export_raw_csv(spark, sf_dir, t, exports)), RAW_SPECS)
        files = {t.capitalize(): path for t, path in zip(RAW_SPECS, paths)}
    if missing:
        files["Raw_Manquant"] = f"{exports}/raw_manquant.csv"
    raw_dir = scratch_dir(spark, "raw")
    return ingest_batch_log(spark, files, raw_dir), raw_dir


def _batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    log, _ = _load_all(spark, sf_dir, missing=True)
    return log.select("table_name", "status", "rows",
                      F.regexp_extract("error", r"^\[([A-Z_]+)\]", 1).alias("error_class"))


def _source_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from vitrine.sources.catalogue import DESCRIPTIONS, SOURCES, register_sources

    _, raw_dir = _load_all(spark, sf_dir)
    views = register_sources(spark, raw_dir)
    parts = [spark.sql(f"SELECT COUNT(*) AS rows FROM {t}").select(
        F.lit(t).alias("table_name"), F.lit(DESCRIPTIONS[t]).alias("description"),
        F.lit(len(views[t].columns)).cast("long").alias("n_columns"), "rows") for t in SOURCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stg_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vitrine.operators.staging import stg_produits
    from vitrine.sources.ingest import ingest_csv, scratch_dir, stg_table_sink
    from vitrine.sources.store import read_table

    raw = ingest_csv(spark, export_raw_csv(spark, sf_dir, "raw_produits", scratch_dir(spark, "export")))
    target = scratch_dir(spark, "staging") + "/stg_produits"
    stg_table_sink(stg_produits(raw), target)
    return read_table(spark, target)


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouses and machine interventions exported without quoting: a comma inside a value makes a field too many.

    One row per file of the load log (rows loaded, records in quarantine) and one per quarantined record.
    """
    from pyspark.sql import functions as F

    from vitrine.sources.ingest import ingest_batch_log, scratch_dir, write_csv
    from vitrine.sources.raw_fixtures import raw_table
    from vitrine.sources.store import read_table

    exports, files = scratch_dir(spark, "export"), {}
    for table, value in (("raw_entrepots", "localisation"), ("raw_entrepots_machine", "type_machine")):
        raw = raw_table(spark, sf_dir, table)
        plain = {c: F.coalesce(F.translate(c, '",\t\r\n', ""), F.lit("")) for c in raw.columns}
        surplus = F.when(plain[raw.columns[0]].rlike("[37]$"), ",surplus").otherwise("")
        line = F.concat_ws(",", *[F.concat(x, surplus) if c == value else x for c, x in plain.items()])
        files[table] = f"{exports}/{table}.csv"
        # a single column parted by tabs: its commas, and those of its name, stay bare
        write_csv(raw.select(line.alias(",".join(raw.columns))), files[table], sep="\t")
    target = scratch_dir(spark, "raw")
    log = ingest_batch_log(spark, files, target)
    out = log.select("table_name", F.lit("log").alias("kind"), F.lit(None).cast("string").alias("record"), "rows", "quarantined")
    for table in files:
        own = read_table(spark, f"{target}_quarantine/{table}")
        out = out.unionByName(own.select(F.lit(table).alias("table_name"), F.lit("record").alias("kind"), "record",
                                         F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("quarantined")))
    return out


QUERIES.update({
    "ingest_quarantine": _quarantine,
    "ingest_csv": _ingest_one("raw_clients"),
    "ingest_normalize_headers": _ingest_one("raw_produits"),
    "ingest_overwrite_sink": _overwrite_sink,
    "ingest_batch_log": _batch_log,
    "source_catalogue": _source_catalogue,
    "stg_table_sink": _stg_sink,
})


# KPI functions taking a Star (sat_by_delivery_state also takes `as_of`), for callers
# that bring their own star (the daily run, the bench on materialised staging).
KPI_FUNCTIONS = {k: q.kpi for k, q in QUERIES.items() if hasattr(q, "kpi")}
KPI_FUNCTIONS["sat_by_delivery_state"] = sat_by_delivery_state


# --- shared building blocks of the KPIs, each over the whole test tables -------------------

def _blocks() -> dict[str, Query]:
    from pyspark.sql import functions as F

    from vitrine.functions.pricing import (conditional_pivot, discounted_price_by_type, effective_price,
                                           not_cancelled, promo_period_label)
    from vitrine.functions.text import keyword_counts
    from vitrine.plans.common import order_lines, promotions_with_dates, units_by_product_day
    from vitrine.plans.marketing import _mentions_with_peak
    from vitrine.plans.satisfaction import KEYWORDS_3, KEYWORDS_8

    def star_of(spark, sf_dir):
        return testdata_star(spark, sf_dir)

    def exclude_cancelled(spark, sf_dir):
        star = star_of(spark, sf_dir)
        return star.facts_commandes.where(not_cancelled(F.col("statut_commande")))

    def effective_price_q(spark, sf_dir):
        star = star_of(spark, sf_dir)
        lines = order_lines(star, exclude_cancelled=False).join(
            star.dim_produits.select("id_produit", "prix"), F.col("id_details_produits") == F.col("id_produit"))
        promos = promotions_with_dates(star).select(F.col("id_produit").alias("_pp"), "id_promotion",
                                                    "valeur_promotion", "date_debut", "date_fin")
        x = lines.join(promos, lines.id_produit == promos._pp, "left")
        return x.select("id_commande", "id_details_produits", "id_promotion",
                        effective_price(F.col("prix"), F.col("valeur_promotion"), F.col("date"), F.col("date_debut"),
                                        F.col("date_fin")).cast("double").alias("prix_effectif"))

    def effective_price_by_type(spark, sf_dir):
        star = star_of(spark, sf_dir)
        pr = star.dim_promotions
        prods = star.dim_produits.select(F.col("id_produit").alias("_p"), "prix")
        return pr.join(prods, pr.id_produit == prods._p).select(
            "id_promotion", "id_produit", "type_promotion", "valeur_promotion",
            discounted_price_by_type(F.col("prix"), F.col("type_promotion"), F.col("valeur_promotion"))
            .cast("double").alias("prix_remise"))

    def period_label(spark, sf_dir):
        star = star_of(spark, sf_dir)
        units = units_by_product_day(star)
        promos = promotions_with_dates(star).select(F.col("id_produit").alias("_pp"), "id_promotion",
                                                    "date_debut", "date_fin")
        x = units.join(promos, (units.id_details_produits == promos._pp)
                       & units.date.between(F.date_sub(promos.date_debut, 30), F.date_add(promos.date_fin, 30)))
        return x.select(F.col("id_details_produits").alias("id_produit"), "date", "id_promotion",
                        promo_period_label(F.col("date"), F.col("date_debut"), F.col("date_fin"), 30).alias("periode"))

    def display_name(spark, sf_dir):
        star = star_of(spark, sf_dir)
        return star.products_display.select("id_produit", "produit", "prix", "variation",
                                            F.col("nom_affiche").alias("produit_affiche"))

    def zscore_peak_flag(spark, sf_dir):
        return _mentions_with_peak(star_of(spark, sf_dir)).select("date_jour", "total_mentions", "pic_mention")

    def keyword_counts_q(spark, sf_dir):
        s = star_of(spark, sf_dir).dim_satisfaction.where(F.col("commentaire").isNotNull())
        words = dict(KEYWORDS_3)
        words.update(KEYWORDS_8)
        return (s.groupBy(F.coalesce("type_plainte", F.lit("Aucune")).alias("type_plainte"))
                .agg(F.count(F.lit(1)).alias("nb_commentaires"), *keyword_counts(F.col("commentaire"), words)))

    def conditional_pivot_q(spark, sf_dir):
        star = star_of(spark, sf_dir)
        lines = order_lines(star, exclude_cancelled=False, order_cols=("statut_commande",))
        per_status = (lines.groupBy("id_details_produits", "statut_commande")
                      .agg(F.sum("quantite").alias("q")))
        return conditional_pivot(per_status, ["id_details_produits"], "statut_commande", "q",
                                 {"qte_livree": "Livrée", "qte_en_transit": "En transit", "qte_annulee": "Annulée"})

    return {
        "exclude_cancelled": exclude_cancelled,
        "effective_price": effective_price_q,
        "effective_price_by_type": effective_price_by_type,
        "promo_period_label": period_label,
        "display_name": display_name,
        "zscore_peak_flag": zscore_peak_flag,
        "keyword_counts": keyword_counts_q,
        "conditional_pivot": conditional_pivot_q,
    }


QUERIES.update(_blocks())
