"""Oracle SQL for the shared KPI building blocks."""

from __future__ import annotations

from oracle.kpi_other import DAILY_PEAKS, KEYWORDS, keyword_counts
from oracle.kpi_sales import CATALOGUE, OFFERS, SALES_TABLES, SOLD, UNITS
from oracle.money_sql import by_type, by_value, live, price, within
from oracle.star_sql import with_star

SQL: dict[str, str] = {}

SQL["exclude_cancelled"] = with_star("facts_commandes") + f"FROM facts_commandes WHERE {live('statut_commande')}"

SQL["effective_price"] = with_star(*SALES_TABLES, extra=[SOLD, OFFERS]) + f"""
SELECT cmd AS id_commande, prod AS id_details_produits, offer AS id_promotion,
       CAST({within("jour", "du", "au", by_value("prix", "worth"), price("prix"))} AS DOUBLE) AS prix_effectif
FROM sold JOIN dim_produits ON id_produit = prod LEFT JOIN offers USING (prod)
"""

SQL["effective_price_by_type"] = with_star("dim_promotions", "dim_produits") + f"""
SELECT id_promotion, id_produit, type_promotion, valeur_promotion, CAST({by_type("prix", "type_promotion", "valeur_promotion")} AS DOUBLE) AS prix_remise
FROM dim_promotions JOIN dim_produits USING (id_produit)
"""

SQL["promo_period_label"] = with_star(*SALES_TABLES, extra=[SOLD, UNITS, OFFERS]) + """
SELECT prod AS id_produit, jour AS date, offer AS id_promotion, CASE WHEN jour < du THEN 'avant' WHEN jour > au THEN 'apres' ELSE 'pendant' END AS periode
FROM units JOIN offers USING (prod) WHERE datediff('day', du, jour) >= -30 AND datediff('day', au, jour) <= 30
"""

SQL["display_name"] = with_star("dim_produits", extra=[CATALOGUE]) + "SELECT prod AS id_produit, produit, prix, variation, shown AS produit_affiche FROM catalogue"

SQL["zscore_peak_flag"] = with_star("facts_posts", "dim_date", extra=DAILY_PEAKS) + "SELECT jour AS date_jour, n::BIGINT AS total_mentions, peak AS pic_mention FROM peaks"

SQL["keyword_counts"] = keyword_counts("ifnull(type_plainte, 'Aucune') AS type_plainte", list(KEYWORDS))

SQL["conditional_pivot"] = with_star("facts_commandes", "dim_details_commandes") + """
SELECT id_details_produits, coalesce(sum(quantite) FILTER (statut_commande = 'Livrée'), 0)::BIGINT AS qte_livree,
       coalesce(sum(quantite) FILTER (statut_commande = 'En transit'), 0)::BIGINT AS qte_en_transit,
       coalesce(sum(quantite) FILTER (statut_commande = 'Annulée'), 0)::BIGINT AS qte_annulee
FROM dim_details_commandes JOIN facts_commandes USING (id_commande)
GROUP BY id_details_produits
"""
