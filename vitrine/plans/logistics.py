"""Logistics KPIs (the reference's logistique1_* models)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.fixed_values import BREAKDOWN_STATES
from vitrine.fixed_values import LATE_DELIVERY_COMMENT as LATE_COMMENT
from vitrine.plans.common import ranked
from vitrine.star import Star



def _machine_by_warehouse(star: Star, keys, aggs) -> DataFrame:
    f = star.facts_entrepots_machine
    w = star.dim_entrepots.select(F.col("id_entrepot").alias("_we"), "localisation")
    return f.join(w, f.id_entrepot == w._we).groupBy(*keys).agg(*aggs)


def log_downtime_by_warehouse(star: Star) -> DataFrame:
    return (_machine_by_warehouse(star, ["id_entrepot", "localisation", "mois"],
                                  [F.sum("temps_d_arret").alias("temps_d_arret_total")])
            .transform(ranked, F.desc("temps_d_arret_total")))


def log_volume_by_warehouse(star: Star) -> DataFrame:
    return (_machine_by_warehouse(star, ["id_entrepot", "localisation", "mois"],
                                  [F.sum("volume_traite").alias("volume_total_traite")])
            .transform(ranked, F.desc("volume_total_traite")))


def log_breakdown_impact(star: Star) -> DataFrame:
    broken = F.col("etat_machine").isin(*BREAKDOWN_STATES)
    return (_machine_by_warehouse(star, ["id_machine", "localisation", "mois"], [
        F.count(F.when(broken, F.col("temps_d_arret"))).alias("nombre_de_pannes"),
        F.sum(F.when(broken, F.col("temps_d_arret")).otherwise(0)).alias("temps_total_panne_ou_maintenance"),
        F.sum("volume_traite").alias("volume_total_traite")])
        .transform(ranked, F.desc("temps_total_panne_ou_maintenance")))


def log_orders_by_warehouse(star: Star) -> DataFrame:
    c = star.facts_commandes
    # Orders per (warehouse, day) first: map-side combined, so a hot warehouse stays cheap.
    per_day = (c.where(F.col("id_entrepot").isNotNull())
               .groupBy("id_entrepot", "id_date_commande").agg(F.count(F.lit(1)).alias("nombre_de_commandes")))
    w = star.dim_entrepots.select(F.col("id_entrepot").alias("_we"), "localisation", "taux_remplissage")
    cal = star.cal
    x = per_day.join(w, per_day.id_entrepot == w._we).join(cal, per_day.id_date_commande == cal.id_date)
    return (x.groupBy("id_entrepot", "taux_remplissage", "localisation", "date")
            .agg(F.sum("nombre_de_commandes").alias("nombre_de_commandes"))
            .select("id_entrepot", "localisation", "date", "nombre_de_commandes", "taux_remplissage")
            .transform(ranked, F.desc("nombre_de_commandes")))


def log_reported_delays(star: Star) -> DataFrame:
    s = star.dim_satisfaction.select("id_commande", "commentaire")
    c = star.facts_commandes.select("id_commande", "id_entrepot", "id_date_commande")
    late = F.when(F.col("commentaire").isin(LATE_COMMENT), F.col("id_commande"))
    per_day = (s.join(c, "id_commande").groupBy("id_entrepot", "id_date_commande")
               .agg(F.count(late).alias("nombre_de_retards")))
    w = star.dim_entrepots.select(F.col("id_entrepot").alias("_we"), "localisation")
    cal = star.cal
    x = per_day.join(w, per_day.id_entrepot == w._we).join(cal, per_day.id_date_commande == cal.id_date)
    return (x.groupBy("id_entrepot", "localisation", "date")
            .agg(F.sum("nombre_de_retards").alias("nombre_de_retards"))
            .transform(ranked, F.desc("nombre_de_retards")))
