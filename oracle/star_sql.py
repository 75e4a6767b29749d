"""DuckDB SQL for the oracle side of the correctness check.

The driver registers the test tables (part, orders, lineitem, customer,
supplier, nation, events, ...) as views.  Every oracle string starts with a
WITH prefix that maps those tables onto the retail star schema, following the
rules of FIXTURES.md section 2.  This file is written independently of the
Spark code so that the two sides check each other.

Money is summed as DECIMAL and rounded before it becomes DOUBLE, so both
engines produce bit-identical values regardless of summation order.
"""

from __future__ import annotations

PROMO_EPOCH = "1995-01-01"  # promotions of the test mapping are dated from this day
WAREHOUSES = "(SELECT count(*) FROM supplier)"

# Each CTE: name -> (dependencies, body).  Order of the dict is a valid topological order.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "cal_bounds": ((), """
        SELECT min(low) AS low, max(high) AS high
        FROM (SELECT CAST(o_orderdate AS DATE) AS low, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 + 1 AS INTEGER) AS high FROM orders
              UNION ALL SELECT CAST(ts AS DATE) - 8766, CAST(ts AS DATE) - 8766 FROM events)
    """),
    "dim_date": (("cal_bounds",), """
        SELECT CAST(datediff('day', low, CAST(d AS DATE)) + 1 AS INTEGER) AS id_date, CAST(d AS DATE) AS date
        FROM (SELECT low, unnest(generate_series(low, high, INTERVAL 1 DAY)) AS d FROM cal_bounds)
    """),
    "part_ids": ((), """
        SELECT *, printf('P%05d', p_partkey) AS id FROM part
        UNION ALL SELECT *, printf('NP%05d', p_partkey) FROM part WHERE p_partkey % 50 = 7
    """),
    "dim_produits": (("part_ids",), """
        SELECT id AS id_produit,
               p_name AS produit,
               p_type AS categorie,
               p_retailprice AS prix,
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'V' || CAST(p_size AS VARCHAR) END AS variation
        FROM part_ids
    """),
    "promo_days": ((), f"""
        SELECT p_partkey, CAST(DATE '{PROMO_EPOCH}' + CAST(p_partkey * 13 % 2300 + CASE WHEN p_partkey % 5 = 4 THEN 8000 ELSE 0 END AS INTEGER) AS DATE) AS first_day FROM part
    """),
    "promo_src": (("promo_days",), """
        SELECT printf('PR%d-0', p_partkey) AS id_promotion,
               printf('P%05d', p_partkey) AS id_produit,
               CASE WHEN p_partkey % 2 = 0 THEN 'Pourcentage' ELSE 'Remise fixe' END AS type_promotion,
               CASE WHEN p_partkey % 2 = 0 THEN CAST(5 + p_partkey % 40 AS VARCHAR) || '%'
                    WHEN p_partkey % 3 = 0 THEN '€10,50'
                    ELSE '€' || CAST(p_partkey % 20 AS VARCHAR) || '.00' END AS valeur_promotion,
               'Equipe ' || CAST(p_partkey % 4 AS VARCHAR) AS responsable_promotion,
               first_day AS date_debut, CAST(first_day + 45 AS DATE) AS date_fin
        FROM promo_days
        UNION ALL
        SELECT printf('PR%d-1', p_partkey),
               printf('P%05d', p_partkey),
               'Pourcentage',
               '20%',
               'Equipe ' || CAST(p_partkey % 4 AS VARCHAR),
               CAST(first_day + 20 AS DATE), CAST(first_day + 65 AS DATE)
        FROM promo_days WHERE p_partkey % 20 = 0
    """),
    "dim_promotions": (("promo_src", "dim_date"), """
        SELECT p.id_promotion, p.type_promotion, p.valeur_promotion, p.responsable_promotion,
               d1.id_date AS id_date_debut, d2.id_date AS id_date_fin, p.id_produit
        FROM promo_src p
        LEFT JOIN dim_date d1 ON p.date_debut = d1.date
        LEFT JOIN dim_date d2 ON p.date_fin = d2.date
    """),
    "facts_commandes": (("dim_date",), f"""
        SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS id_commande,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'Annulée'
                    WHEN o_orderstatus = 'P' THEN 'En transit'
                    ELSE 'Livrée' END AS statut_commande,
               CAST(NULL AS VARCHAR) AS id_promotion,
               CASE o_orderkey % 3 WHEN 0 THEN 'Carte' WHEN 1 THEN 'PayPal' ELSE 'Virement' END AS mode_de_paiement,
               'T' || CAST(o_orderkey AS VARCHAR) AS id_tracking,
               'CL' || CAST(o_custkey AS VARCHAR) AS id_client,
               'E' || CAST(o_orderkey % {WAREHOUSES} AS VARCHAR) AS id_entrepot,
               d1.id_date AS id_date_commande,
               d2.id_date AS id_date_livraison
        FROM orders o
        JOIN dim_date d1 ON d1.date = CAST(o.o_orderdate AS DATE)
        JOIN dim_date d2 ON d2.date = CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 10 + 1 AS INTEGER) AS DATE)
    """),
    "dim_details_commandes": ((), """
        SELECT 'C' || CAST(l_orderkey AS VARCHAR) AS id_commande,
               printf('P%05d', l_partkey) AS id_details_produits,
               CAST(max(l_quantity) AS BIGINT) AS quantite,
               min(l_linenumber) = 1 AS emballage_special
        FROM lineitem
        GROUP BY l_orderkey, l_partkey
    """),
    "dim_clients": ((), """
        SELECT 'CL' || CAST(c_custkey AS VARCHAR) AS id_client,
               c_name AS prenom_client,
               c_mktsegment AS nom_client,
               'client' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
               CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 15 + c_custkey % 60 END AS BIGINT) AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS genre,
               CAST(c_custkey % 12 AS BIGINT) AS frequence_visite,
               'TEL' || CAST(c_custkey AS VARCHAR) AS numero_telephone,
               'P' || CAST(c_custkey % (SELECT count(*) FROM part) AS VARCHAR)
                   || ',P' || CAST((c_custkey * 7 + 1) % (SELECT count(*) FROM part) AS VARCHAR) AS favoris,
               '10.0.' || CAST(c_custkey % 256 AS VARCHAR) || '.1' AS adresse_ip
        FROM customer
    """),
    "dim_favoris": (("dim_clients",), """
        SELECT id_client, unnest(string_split(favoris, ',')) AS favoris
        FROM dim_clients
        WHERE favoris IS NOT NULL
    """),
    "dim_satisfaction": ((), """
        SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS id_satisfaction,
               CAST(CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE 1 + o_orderkey % 5 END AS BIGINT) AS note_client,
               CASE o_orderkey % 7 WHEN 0 THEN 'Delivery took too long.'
                                   WHEN 1 THEN 'Product arrived damaged.'
                                   WHEN 2 THEN 'Very happy with the service.'
                                   WHEN 3 THEN 'Average quality, not great.'
                                   WHEN 4 THEN 'Great experience.'
                                   WHEN 5 THEN 'Too long a wait' END AS commentaire,
               CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'true' ELSE 'false' END AS plainte,
               CAST(CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderkey % 31 END AS BIGINT) AS temps_de_reponse,
               CASE o_orderkey % 4 WHEN 0 THEN 'Retard' WHEN 1 THEN 'Produit' END AS type_plainte,
               'EMP' || CAST(o_orderkey % 5 AS VARCHAR) AS employe_support,
               'C' || CAST(o_orderkey AS VARCHAR) AS id_commande
        FROM orders
    """),
    "dim_entrepots": ((), """
        SELECT 'E' || CAST(s_suppkey AS VARCHAR) AS id_entrepot,
               n_name AS localisation,
               CAST(1000 + 100 * s_suppkey AS BIGINT) AS capacite_max,
               CAST(500 + 10 * s_suppkey AS BIGINT) AS volume_stocke,
               CAST(50 + s_suppkey AS DOUBLE) / 100 AS taux_remplissage,
               CAST(10 + s_suppkey AS DOUBLE) AS temp_moyenne
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """),
    "machine_src": ((), f"""
        SELECT (l_suppkey + l_linenumber % 2 * {WAREHOUSES}) % (2 * {WAREHOUSES}) AS m,
               month(CAST(l_shipdate AS DATE)) AS mo,
               year(CAST(l_shipdate AS DATE)) AS yr,
               sum(l_linenumber) AS arret,
               sum(l_quantity) AS vol
        FROM lineitem
        GROUP BY 1, 2, 3
    """),
    "facts_entrepots_machine": (("machine_src",), f"""
        SELECT 'I' || CAST(m AS VARCHAR) || '-' || CAST(mo AS VARCHAR) || '-' || CAST(yr AS VARCHAR) AS id_intervention_machine,
               CASE m % 4 WHEN 0 THEN 'En panne' WHEN 1 THEN 'En maintenance' ELSE 'En service' END AS etat_machine,
               CAST(arret AS BIGINT) AS temps_d_arret,
               CAST(vol AS BIGINT) AS volume_traite,
               CAST(mo AS BIGINT) AS mois,
               'M' || CAST(m AS VARCHAR) AS id_machine,
               'E' || CAST(m % {WAREHOUSES} AS VARCHAR) AS id_entrepot,
               CAST(yr AS BIGINT) AS annee
        FROM machine_src
    """),
    "dim_machine": (("machine_src",), """
        SELECT DISTINCT 'M' || CAST(m AS VARCHAR) AS id_machine,
               CASE m % 3 WHEN 0 THEN 'Convoyeur' WHEN 1 THEN 'Trieuse' ELSE 'Chariot' END AS type_machine
        FROM machine_src
    """),
    "posts_src": ((), """
        SELECT 'POST' || CAST(event_id AS VARCHAR) AS id_post,
               CAST(CAST(ts AS DATE) - 8766 AS DATE) AS date_post,
               event_type AS canal_social,
               CAST((event_id % 50) * CASE WHEN day(CAST(CAST(ts AS DATE) - 8766 AS DATE)) = 15 THEN 10 ELSE 1 END AS BIGINT)
                   AS volume_mentions,
               CASE user_id % 3 WHEN 0 THEN 'Positif' WHEN 1 THEN 'Neutre' ELSE 'Négatif' END AS sentiment_global,
               props AS contenu_post
        FROM events
        WHERE event_type IN ('view', 'click', 'error')
    """),
    "campaign_src": ((), """
        SELECT 'CAMP' || CAST(event_id AS VARCHAR) AS id_campagne,
               CAST(CAST(ts AS DATE) - 8766 AS DATE) AS date,
               CASE WHEN user_id % 2 = 0 THEN 'oui' ELSE 'non' END AS evenement_oui_non,
               CASE WHEN user_id % 2 = 0 THEN 'Soldes' ELSE 'Lancement' END AS evenement_type,
               event_type AS canal,
               value AS budget,
               CAST((event_id % 1000) * 10 AS BIGINT) AS impressions,
               CAST(event_id % 1000 AS BIGINT) AS clics,
               CAST(CASE WHEN event_type = 'purchase' THEN event_id % 20 ELSE 0 END AS BIGINT) AS conversions,
               CAST(event_id % 100 AS DOUBLE) / 1000 AS ctr
        FROM events
        WHERE event_type IN ('signup', 'purchase')
    """),
    "dim_canal": (("posts_src", "campaign_src"), """
        SELECT CAST(row_number() OVER (ORDER BY nom_canal) AS BIGINT) AS id_canal, nom_canal
        FROM (SELECT canal AS nom_canal FROM campaign_src
              UNION
              SELECT canal_social AS nom_canal FROM posts_src)
    """),
    "facts_posts": (("posts_src", "dim_date", "dim_canal"), """
        SELECT p.id_post, p.volume_mentions, p.sentiment_global, p.contenu_post,
               c.id_canal, d.id_date
        FROM posts_src p
        JOIN dim_date d ON p.date_post = d.date
        JOIN dim_canal c ON p.canal_social = c.nom_canal
    """),
    "facts_campaigns": (("campaign_src", "dim_date", "dim_canal"), """
        SELECT ca.id_campagne AS id_campaign, ca.evenement_oui_non AS evenement, ca.evenement_type,
               ca.budget, ca.impressions, ca.clics, ca.conversions, ca.ctr,
               dc.id_canal AS id_canal_dim_canal, d.id_date
        FROM campaign_src ca
        JOIN dim_canal dc ON ca.canal = dc.nom_canal
        JOIN dim_date d ON ca.date = d.date
    """),
}

# Star tables (as opposed to helper CTEs).
STAR_TABLES = (
    "dim_date", "dim_produits", "dim_promotions", "facts_commandes", "dim_details_commandes",
    "dim_clients", "dim_favoris", "dim_satisfaction", "dim_entrepots", "facts_entrepots_machine",
    "dim_machine", "facts_posts", "facts_campaigns", "dim_canal",
)


def _closure(names) -> list[str]:
    need: set[str] = set()

    def visit(n):
        if n in need:
            return
        for d in CTES[n][0]:
            visit(d)
        need.add(n)

    for n in names:
        visit(n)
    return [n for n in CTES if n in need]


def with_star(*tables: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH prefix defining the star tables `tables` (plus dependencies) and
    any `extra` (name, body) CTEs appended after them."""
    parts = [f"{n} AS ({CTES[n][1]})" for n in _closure(tables)]
    for name, body in extra or []:
        parts.append(f"{name} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"


def star_query(table: str, select: str | None = None) -> str:
    return with_star(table) + (select or f"SELECT * FROM {table}")
