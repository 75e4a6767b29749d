"""Star-schema builders: staging tables -> dimensions and facts.

Each builder is a DataFrame -> DataFrame function with the reference's output
columns.  Notes on the physical plan:

* The calendar is bounded by its two parameters, so it is the one dimension
  that is always broadcast (`calendar_broadcast`).  Every other dimension is
  joined without a hint: AQE broadcasts it at runtime when its measured size
  is under the threshold and keeps a sort-merge join otherwise.
* ``SELECT DISTINCT`` of the reference is kept where staging does not already
  guarantee uniqueness.  Staging keeps one row per business key, and the
  calendar / channel joins are on unique keys, so for dim_produits,
  dim_entrepots and the four facts the DISTINCT cannot remove a row; it is
  skipped there instead of paying a full shuffle of the fact table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.fixed_values import CALENDAR_END, CALENDAR_START
from vitrine.operators.surrogate import day_number_id, ordered_sequence_id

# Calendar of the reference (dim_date); callers pass their own range.
REFERENCE_CAL_START = CALENDAR_START
REFERENCE_CAL_END = CALENDAR_END
MAX_BROADCAST_DAYS = 200_000  # a calendar longer than ~550 years is not hinted


def dim_date(spark: SparkSession, start: str = REFERENCE_CAL_START, end: str = REFERENCE_CAL_END) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(day_number_id(F.col("date"), start).alias("id_date"), "date")


def calendar_broadcast(cal: DataFrame, start: str, end: str) -> DataFrame:
    """Broadcast the calendar when its row count (known from its bounds) is small."""
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return F.broadcast(cal) if n_days <= MAX_BROADCAST_DAYS else cal


def dim_canal(stg_campaigns: DataFrame, stg_posts: DataFrame) -> DataFrame:
    names = (stg_campaigns.select(F.col("canal").alias("nom_canal"))
             .union(stg_posts.select(F.col("canal_social").alias("nom_canal")))
             .distinct())
    return ordered_sequence_id(names, ["nom_canal"], "id_canal").select("id_canal", "nom_canal")


def dim_clients(stg_clients: DataFrame) -> DataFrame:
    # Staging partitions by the untrimmed id, so two rows may share a trimmed id: keep DISTINCT.
    return stg_clients.select(
        "id_client", "prenom_client", "nom_client", "email", "age", "genre",
        F.col("frequence_visites").alias("frequence_visite"),
        "numero_telephone", "favoris", "adresse_ip").distinct()


def details_lines(stg_details: DataFrame) -> DataFrame:
    """dim_details_commandes without its surrogate id (what the KPIs read)."""
    return stg_details.select("quantite", "emballage_special", "id_commande",
                              F.col("id_produit").alias("id_details_produits"))


def dim_details_commandes(stg_details: DataFrame) -> DataFrame:
    lines = details_lines(stg_details)
    return ordered_sequence_id(lines, ["id_commande", "id_details_produits"], "id").select(
        "id", "quantite", "emballage_special", "id_commande", "id_details_produits")


def dim_entrepots(stg_entrepots: DataFrame) -> DataFrame:
    return stg_entrepots.select(
        "id_entrepot", "localisation", "capacite_max", "volume_stocke", "taux_remplissage",
        F.col("temperature_moyenne_entrepot").alias("temp_moyenne"))


def dim_favoris(stg_clients: DataFrame) -> DataFrame:
    # Elements are not trimmed; a null list gives no row, '' gives one empty element.
    return stg_clients.select("id_client", F.explode(F.split("favoris", ",")).alias("favoris"))


def dim_machine(stg_machine: DataFrame) -> DataFrame:
    return stg_machine.select("id_machine", "type_machine").distinct()


def dim_produits(stg_produits: DataFrame) -> DataFrame:
    return stg_produits.select(F.col("id").alias("id_produit"), "produit", "categorie", "prix", "variation")


def promotions_dated(stg_promotions: DataFrame, cal: DataFrame) -> DataFrame:
    """Promotions with both calendar ids and the calendar's dates (NULL outside the calendar).

    Both lookups join the same calendar frame (aliased), so the plan broadcasts it once.
    """
    p, d1, d2 = stg_promotions.alias("p"), cal.alias("d1"), cal.alias("d2")
    return (p.join(d1, F.col("p.date_debut") == F.col("d1.date"), "left")
            .join(d2, F.col("p.date_fin") == F.col("d2.date"), "left")
            .select("p.id_promotion", "p.type_promotion", "p.valeur_promotion", "p.responsable_promotion",
                    F.col("d1.id_date").alias("id_date_debut"), F.col("d2.id_date").alias("id_date_fin"),
                    "p.id_produit", F.col("d1.date").alias("date_debut"), F.col("d2.date").alias("date_fin")))


def dim_promotions(stg_promotions: DataFrame, cal: DataFrame) -> DataFrame:
    return promotions_dated(stg_promotions, cal).select(
        "id_promotion", "type_promotion", "valeur_promotion", "responsable_promotion",
        "id_date_debut", "id_date_fin", "id_produit")


def dim_satisfaction(stg_satisfaction: DataFrame) -> DataFrame:
    return stg_satisfaction.select(
        "id_satisfaction", "note_client", "commentaire",
        F.col("plainte").cast("string").alias("plainte"),
        F.col("temps_reponse_support").alias("temps_de_reponse"),
        "type_plainte", "employe_support", "id_commande")


def facts_campaigns(stg_campaigns: DataFrame, canal: DataFrame, cal: DataFrame) -> DataFrame:
    return (stg_campaigns
            .join(canal, stg_campaigns.canal == canal.nom_canal)
            .join(cal, stg_campaigns.date == cal.date)
            .select(F.col("id_campagne").alias("id_campaign"),
                    F.col("evenement_oui_non").cast("string").alias("evenement"),
                    "evenement_type", "budget", "impressions", "clics", "conversions",
                    F.col("CTR").alias("ctr"),
                    F.col("id_canal").alias("id_canal_dim_canal"), "id_date"))


def orders_in_calendar(stg_commandes: DataFrame, cal: DataFrame, how: str = "left") -> DataFrame:
    """Orders with their calendar ids and dates, NULL where the calendar has no such day.

    Both lookups join the same calendar frame (aliased), so the plan broadcasts it once.
    """
    o, d1, d2 = stg_commandes.alias("o"), cal.alias("d1"), cal.alias("d2")
    return (o.join(d1, F.col("o.date_commande") == F.col("d1.date"), how)
            .join(d2, F.col("o.date_livraison_estimee") == F.col("d2.date"), how)
            .select("o.id_commande", "o.statut_commande",
                    F.col("o.id_promotion_appliquee").alias("id_promotion"),
                    "o.mode_de_paiement", F.col("o.numero_tracking").alias("id_tracking"),
                    "o.id_client", F.col("o.id_entrepot_depart").alias("id_entrepot"),
                    F.col("d1.id_date").alias("id_date_commande"), F.col("d2.id_date").alias("id_date_livraison"),
                    F.col("d1.date").alias("date_commande"), F.col("d2.date").alias("date_livraison")))


def orders_dated(stg_commandes: DataFrame, cal: DataFrame) -> DataFrame:
    """Orders inside the calendar, with their calendar ids and dates (inner joins, as the fact)."""
    return orders_in_calendar(stg_commandes, cal, "inner")


def facts_commandes(stg_commandes: DataFrame, cal: DataFrame) -> DataFrame:
    return orders_dated(stg_commandes, cal).drop("date_commande", "date_livraison")


def facts_entrepots_machine(stg_machine: DataFrame) -> DataFrame:
    # The reference drops the year; it is carried here as an extra column `annee`.
    return stg_machine.select(
        F.col("id").alias("id_intervention_machine"), "etat_machine", "temps_d_arret",
        "volume_traite", "mois", "id_machine", "id_entrepot", "annee")


def facts_posts(stg_posts: DataFrame, cal: DataFrame, canal: DataFrame) -> DataFrame:
    return (stg_posts
            .join(cal, stg_posts.date_post == cal.date)
            .join(canal, stg_posts.canal_social == canal.nom_canal)
            .select("id_post", "volume_mentions", "sentiment_global", "contenu_post",
                    "id_canal", "id_date"))
