"""Oracle SQL for the star-schema builders (dimensions and facts)."""

from __future__ import annotations

from oracle.star_sql import star_query

SQL: dict[str, str] = {
    name: star_query(name)
    for name in ("dim_date", "dim_canal", "dim_clients", "dim_entrepots", "dim_favoris", "dim_machine",
                 "dim_produits", "dim_promotions", "dim_satisfaction", "facts_campaigns", "facts_commandes",
                 "facts_entrepots_machine", "facts_posts")
}

SQL["dim_details_commandes"] = star_query("dim_details_commandes", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY id_commande, id_details_produits) AS BIGINT) AS id,
       quantite, emballage_special, id_commande, id_details_produits
FROM dim_details_commandes
""")
