"""The ten staging models: raw string tables -> typed, trimmed, one row per business key.

Each model states, as in the reference: the row filter, the business key, the
completeness score (computed on the raw columns) and the typed output
columns; `dedup_by_completeness` does the rest.  Raw column names are the
normalised CSV headers (lower case, see sources/ingest.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.cleaning import (filled, filled_text, is_year_month, safe_bool, safe_date, safe_double,
                                        safe_long, strip_variation_suffix, year_month_split, yes_no_to_boolean)
from vitrine.functions.text import bq_trim
from vitrine.operators.dedup import dedup_by_completeness, desc_nulls_last


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def t(name: str) -> Column:
    return bq_trim(c(name))


def not_blank(name: str) -> Column:
    return c(name).isNotNull() & (t(name) != "")


def filled_nonblank(name: str) -> Column:
    """IF(x IS NOT NULL AND TRIM(x) <> '', 1, 0)."""
    return F.when(not_blank(name), 1).otherwise(0)


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for x in terms[1:]:
        out = out + x
    return out


def stg_campaigns(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_campagne")],
        where=not_blank("id_campagne") & c("date").isNotNull(),
        score=_sum([filled(c("date")), filled(c("evenement_oui_non")), filled_text(c("evenement_type")),
                    filled_text(c("canal")), filled(c("budget")), filled(c("impressions")), filled(c("clics")),
                    filled(c("conversions")), filled(c("ctr"))]),
        outputs=[t("id_campagne").alias("id_campagne"), safe_date(c("date")).alias("date"),
                 t("evenement_oui_non").alias("evenement_oui_non"), t("evenement_type").alias("evenement_type"),
                 t("canal").alias("canal"), safe_double(c("budget")).alias("budget"),
                 safe_long(c("impressions")).alias("impressions"), safe_long(c("clics")).alias("clics"),
                 safe_long(c("conversions")).alias("conversions"), safe_double(c("ctr")).alias("CTR")])


def stg_clients(raw: DataFrame) -> DataFrame:
    # Partitioned by the *untrimmed* id (as the reference), so 'A' and ' A' both survive.
    return dedup_by_completeness(
        raw, key=[c("id_client").cast("string")],
        where=c("id_client").isNotNull() & c("prenom_client").isNotNull() & c("nom_client").isNotNull(),
        score=_sum([filled_nonblank("prenom_client"), filled_nonblank("nom_client"), filled_nonblank("email"),
                    filled(c("age")), filled_nonblank("genre"), filled(c("frequence_visites")),
                    filled_nonblank("numero_telephone"), filled_nonblank("favoris"), filled_nonblank("adresse_ip")]),
        outputs=[t("id_client").alias("id_client"), t("prenom_client").alias("prenom_client"),
                 t("nom_client").alias("nom_client"), t("email").alias("email"), safe_long(c("age")).alias("age"),
                 t("genre").alias("genre"), safe_long(c("frequence_visites")).alias("frequence_visites"),
                 t("numero_telephone").alias("numero_telephone"), t("favoris").alias("favoris"),
                 t("adresse_ip").alias("adresse_ip")])


def _filled_untrimmed(name: str) -> Column:
    """IF(x IS NOT NULL AND x != '', 1, 0) - no trim, as in the orders model."""
    return F.when(c(name).isNotNull() & (c(name) != ""), 1).otherwise(0)


def stg_commandes(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_commande")], where=not_blank("id_commande"),
        score=_sum([_filled_untrimmed("id_client"), _filled_untrimmed("id_entrepot_depart"),
                    filled(c("date_commande")), _filled_untrimmed("statut_commande"),
                    _filled_untrimmed("id_promotion_appliquee"), _filled_untrimmed("mode_de_paiement"),
                    _filled_untrimmed("numero_tracking"), filled(c("date_livraison_estimee"))]),
        outputs=[t("id_commande").alias("id_commande"), t("id_client").alias("id_client"),
                 t("id_entrepot_depart").alias("id_entrepot_depart"),
                 safe_date(c("date_commande")).alias("date_commande"), t("statut_commande").alias("statut_commande"),
                 t("id_promotion_appliquee").alias("id_promotion_appliquee"),
                 t("mode_de_paiement").alias("mode_de_paiement"), t("numero_tracking").alias("numero_tracking"),
                 safe_date(c("date_livraison_estimee")).alias("date_livraison_estimee")])


def stg_details_commandes(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_commande"), t("id_produit")],
        where=c("id_commande").isNotNull() & c("id_produit").isNotNull(),
        score=filled(c("quantite")) + filled(c("emballage_special")),
        outputs=[t("id_commande").alias("id_commande"), t("id_produit").alias("id_produit"),
                 safe_long(c("quantite")).alias("quantite"),
                 yes_no_to_boolean(c("emballage_special")).alias("emballage_special")])


def stg_entrepots(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_entrepot")], where=not_blank("id_entrepot"),
        score=_sum([filled_text(c("localisation")), filled(c("capacite_max")), filled(c("volume_stocke")),
                    filled(c("taux_remplissage")), filled(c("temperature_moyenne_entrepot"))]),
        outputs=[t("id_entrepot").alias("id_entrepot"), t("localisation").alias("localisation"),
                 safe_long(c("capacite_max")).alias("capacite_max"),
                 safe_long(c("volume_stocke")).alias("volume_stocke"),
                 safe_double(c("taux_remplissage")).alias("taux_remplissage"),
                 safe_double(c("temperature_moyenne_entrepot")).alias("temperature_moyenne_entrepot")])


def stg_entrepots_machine(raw: DataFrame) -> DataFrame:
    mois, annee = year_month_split(c("mois"))
    return dedup_by_completeness(
        raw, key=[t("id")],
        where=not_blank("id") & not_blank("id_machine") & not_blank("id_entrepot") & is_year_month(c("mois")),
        score=_sum([filled_nonblank("id_machine"), filled_nonblank("id_entrepot"), filled_nonblank("type_machine"),
                    filled_nonblank("etat_machine"), filled(c("temps_d_arret")), filled(c("volume_traite")),
                    F.when(is_year_month(c("mois")), 1).otherwise(0)]),
        tiebreak=[desc_nulls_last(annee), desc_nulls_last(mois)],
        outputs=[t("id").alias("id"), t("id_machine").alias("id_machine"), t("id_entrepot").alias("id_entrepot"),
                 t("type_machine").alias("type_machine"), t("etat_machine").alias("etat_machine"),
                 safe_long(c("temps_d_arret")).alias("temps_d_arret"),
                 safe_long(c("volume_traite")).alias("volume_traite"), mois.alias("mois"), annee.alias("annee")])


def stg_posts(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_post")], where=not_blank("id_post"),
        score=_sum([filled(c("date_post")), filled_text(c("canal_social")), filled(c("volume_mentions")),
                    filled_text(c("sentiment_global")), filled_text(c("contenu_post"))]),
        outputs=[t("id_post").alias("id_post"), safe_date(c("date_post")).alias("date_post"),
                 t("canal_social").alias("canal_social"), safe_long(c("volume_mentions")).alias("volume_mentions"),
                 t("sentiment_global").alias("sentiment_global"), t("contenu_post").alias("contenu_post")])


def stg_produits(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id")],
        where=not_blank("id") & not_blank("produit") & c("prix").isNotNull(),
        score=_sum([filled_nonblank("id"), filled_nonblank("categorie"), filled_nonblank("marque"),
                    filled_nonblank("produit"), filled(c("prix")), filled_nonblank("sous-categorie"),
                    filled_nonblank("variation")]),
        outputs=[t("id").alias("id"), t("categorie").alias("categorie"), t("marque").alias("marque"),
                 strip_variation_suffix(c("produit"), c("variation")).alias("produit"),
                 safe_double(c("prix")).alias("prix"), t("sous-categorie").alias("sous_categorie"),
                 t("variation").alias("variation")])


def stg_promotions(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_promotion"), t("id_produit")], where=not_blank("id_promotion") & not_blank("id_produit"),
        score=_sum([filled_text(c("type_promotion")), filled(c("valeur_promotion")), filled(c("date_debut")),
                    filled(c("date_fin")), filled_text(c("responsable_promotion"))]),
        outputs=[t("id_promotion").alias("id_promotion"), t("id_produit").alias("id_produit"),
                 t("type_promotion").alias("type_promotion"),
                 c("valeur_promotion").cast("string").alias("valeur_promotion"),
                 safe_date(c("date_debut")).alias("date_debut"), safe_date(c("date_fin")).alias("date_fin"),
                 t("responsable_promotion").alias("responsable_promotion")])


def stg_satisfaction(raw: DataFrame) -> DataFrame:
    return dedup_by_completeness(
        raw, key=[t("id_satisfaction")], where=not_blank("id_satisfaction") & not_blank("id_commande"),
        score=_sum([filled_text(c("id_commande")), filled(c("note_client")), filled_text(c("commentaire")),
                    filled(c("plainte")), filled(c("temps_reponse_support")), filled_text(c("type_plainte")),
                    filled_text(c("employe_support"))]),
        outputs=[t("id_satisfaction").alias("id_satisfaction"), t("id_commande").alias("id_commande"),
                 safe_long(c("note_client")).alias("note_client"), t("commentaire").alias("commentaire"),
                 safe_bool(c("plainte")).alias("plainte"),
                 safe_long(c("temps_reponse_support")).alias("temps_reponse_support"),
                 t("type_plainte").alias("type_plainte"), t("employe_support").alias("employe_support")])


STAGING_MODELS = {
    "stg_campaigns": ("raw_campaigns", stg_campaigns),
    "stg_clients": ("raw_clients", stg_clients),
    "stg_commandes": ("raw_commandes", stg_commandes),
    "stg_details_commandes": ("raw_details_commandes", stg_details_commandes),
    "stg_entrepots": ("raw_entrepots", stg_entrepots),
    "stg_entrepots_machine": ("raw_entrepots_machine", stg_entrepots_machine),
    "stg_posts": ("raw_posts", stg_posts),
    "stg_produits": ("raw_produits", stg_produits),
    "stg_promotions": ("raw_promotions", stg_promotions),
    "stg_satisfaction": ("raw_satisfaction", stg_satisfaction),
}


def build_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging tables whose raw tables are given (keyed by raw table name)."""
    return {name: fn(raw[src]) for name, (src, fn) in STAGING_MODELS.items() if src in raw}
