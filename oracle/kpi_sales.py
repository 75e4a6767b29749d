"""

The queries share a few steps of their own: `sold` (one row per order line with
its day and whether the order counts), `units` (pieces per product and day),
`offers` (promotions with their dates) and `valued` (units against every offer of
the product, priced by the day).
"""

from __future__ import annotations

from oracle.money_sql import amount, by_value, half_up, live, over, price, rounded, whole, within
from oracle.star_sql import with_star

SALES_TABLES = ("dim_date", "facts_commandes", "dim_details_commandes", "dim_produits", "dim_promotions")

SOLD = ("sold", f"""
    SELECT prod, client, cmd, did, jour, q, counts
    FROM (SELECT id_commande AS cmd, id_details_produits AS prod, quantite AS q FROM dim_details_commandes) AS line
    JOIN (SELECT id_commande AS cmd, id_client AS client, id_date_commande AS did, {live("statut_commande")} AS counts FROM facts_commandes) AS head USING (cmd)
    JOIN (SELECT id_date AS did, date AS jour FROM dim_date) AS agenda USING (did)
""")

UNITS = ("units", "SELECT prod, jour, sum(q) AS q FROM sold WHERE counts GROUP BY ALL")

OFFERS = ("offers", """
    SELECT id_produit AS prod, id_promotion AS offer, type_promotion AS kind, valeur_promotion AS worth,
           (SELECT date FROM dim_date WHERE id_date = id_date_debut) AS du,
           (SELECT date FROM dim_date WHERE id_date = id_date_fin) AS au
    FROM dim_promotions
""")

CATALOGUE = ("catalogue", """
    SELECT id_produit AS prod, produit, categorie, prix, variation,
           CASE WHEN variation IS NOT NULL AND min(prix) OVER same < max(prix) OVER same THEN concat(produit, ' - ', variation) ELSE produit END AS shown
    FROM dim_produits WINDOW same AS (PARTITION BY produit)
""")

_UNIT_PRICE = within("jour", "du", "au", by_value("prix", "worth"), price("prix"))

VALUED = ("valued", f"""
    SELECT prod, jour, q, {amount("q", _UNIT_PRICE)} AS worth_sold
    FROM units JOIN catalogue USING (prod) LEFT JOIN offers USING (prod)
""")

PRICED = [SOLD, UNITS, OFFERS, CATALOGUE, VALUED]

SQL: dict[str, str] = {}

SQL["sales_daily_revenue"] = with_star(*SALES_TABLES, extra=PRICED) + f"""
SELECT v.jour AS periode, {whole("year(v.jour)")} AS annee, {whole("month(v.jour)")} AS mois, {whole("day(v.jour)")} AS jour,
       {rounded("sum(worth_sold)")} AS chiffre_affaires
FROM valued v GROUP BY v.jour
"""

SQL["sales_top_products"] = with_star(*SALES_TABLES, extra=PRICED) + f"""
SELECT categorie, shown AS produit, prix, {whole("sum(pieces)")} AS total_vendus, {rounded("sum(worth_sold)")} AS chiffre_affaires
FROM catalogue
JOIN (SELECT prod, sum(q) AS pieces, sum(worth_sold) AS worth_sold FROM valued GROUP BY prod) USING (prod)
GROUP BY ALL
"""

SQL["sales_unsold_products"] = with_star("dim_produits", "dim_details_commandes") + """
SELECT produit, 0::BIGINT AS total_vendus, 'jamais_vendu' AS type_resultat
FROM dim_produits
WHERE NOT EXISTS (FROM dim_details_commandes WHERE id_details_produits = id_produit)
"""

SQL["sales_least_sold"] = with_star("dim_produits", "dim_details_commandes", extra=[
    ("pieces", "SELECT id_details_produits AS id_produit, sum(quantite) AS n FROM dim_details_commandes GROUP BY 1")]) + f"""
SELECT produit, {whole("sum(n)")} AS total_vendus, 'moins_vendus' AS type_resultat
FROM pieces JOIN dim_produits USING (id_produit)
GROUP BY produit HAVING sum(n) > 0
"""

# a run of falls is an island between two months that don't fall; its list of revenues holds the months before
SQL["sales_declining_products"] = with_star(*SALES_TABLES, extra=PRICED + [
    ("monthly", "SELECT prod, date_trunc('month', jour)::DATE AS mois, round(sum(worth_sold), 2) AS revenue FROM valued GROUP BY ALL"),
    ("months", f"SELECT DISTINCT date_trunc('month', date)::DATE AS mois FROM dim_date JOIN facts_commandes ON id_date = id_date_commande WHERE {live('statut_commande')}"),
    ("filled", "SELECT prod, categorie, mois, coalesce(revenue, 0) AS revenue FROM (SELECT prod, categorie, mois FROM catalogue, months) LEFT JOIN monthly USING (prod, mois)"),
    ("steps", "SELECT *, coalesce(revenue < lag(revenue) OVER (PARTITION BY prod ORDER BY mois), false) AS falls FROM filled"),
    ("islands", "SELECT *, count(*) FILTER (NOT falls) OVER (PARTITION BY prod ORDER BY mois) AS island FROM steps"),
    ("runs", "SELECT *, list(revenue::DOUBLE) OVER (PARTITION BY prod, island ORDER BY mois) AS seen FROM islands"),
]) + """
SELECT prod AS id_produit, categorie, mois, seen[-1] AS ca_mensuel,
       seen[-2] AS m1, seen[-3] AS m2, seen[-4] AS m3, seen[-5] AS m4, seen[-6] AS m5
FROM runs WHERE len(seen) > 5
"""

SQL["sales_by_age_band"] = with_star(*SALES_TABLES, "dim_clients", extra=[SOLD, OFFERS, CATALOGUE,
    ("bands", "SELECT * FROM (VALUES (18, 25, '18-25'), (26, 35, '26-35'), (36, 45, '36-45'), (46, 60, '46-60')) AS b(low, high, band)"),
    ("buyers", "SELECT id_client AS client, coalesce(band, '60+') AS band FROM dim_clients LEFT JOIN bands ON age >= low AND age <= high"),
    ("band_units", "SELECT band, prod, jour, sum(q) AS q FROM sold JOIN buyers USING (client) WHERE counts GROUP BY ALL"),
]) + f"""
SELECT band AS tranche_age, shown AS produit, categorie, {whole("sum(q)")} AS quantite_vendue, {rounded("sum(" + amount("q", _UNIT_PRICE) + ")")} AS chiffre_affaires
FROM band_units JOIN catalogue USING (prod) LEFT JOIN offers USING (prod)
GROUP BY ALL
"""

SQL["sales_wishlist_counts"] = with_star("dim_produits", "dim_favoris") + """
SELECT any_value(produit) AS produit, count(id_client) AS nb_fois_ajoute
FROM (SELECT id_client, regexp_replace(favoris, '^.', '') AS digits FROM dim_favoris) AS wish
JOIN dim_produits ON id_produit = concat('P', repeat('0', greatest(0, 5 - len(digits))), digits)
GROUP BY id_produit
"""

# names of a basket with their multiplicities; a pair counts the product of both
SQL["sales_product_pairs"] = with_star("facts_commandes", "dim_details_commandes", "dim_produits", "dim_date", extra=[SOLD, CATALOGUE,
    ("basket", """
        SELECT client, did, shown, count(*) AS n, min(prod) AS prod, min(categorie) AS categorie
        FROM (SELECT DISTINCT client, did, cmd, prod FROM sold) JOIN catalogue USING (prod) GROUP BY client, did, shown
    """)]) + f"""
SELECT x.shown AS produit_A, min(x.prod) AS id_produit_A, min(x.categorie) AS categorie_A,
       y.shown AS produit_B, min(y.prod) AS id_produit_B, min(y.categorie) AS categorie_B, {whole("sum(x.n * y.n)")} AS nb_occurrences
FROM basket x JOIN basket y USING (client, did)
WHERE x.shown < y.shown
GROUP BY x.shown, y.shown HAVING sum(x.n * y.n) > 1
"""

SQL["sales_month_peaks"] = with_star(*SALES_TABLES, extra=[SOLD, UNITS,
    ("monthly", f"SELECT strftime(jour, '%Y-%m') AS periode, round(sum({amount('q', price('prix'))}), 2) AS revenue FROM units JOIN dim_produits ON id_produit = prod GROUP BY 1"),
    ("spread", "SELECT *, sum(revenue) OVER () AS total, count(*) OVER () AS months FROM monthly"),
]) + f"""
SELECT periode, revenue::DOUBLE AS chiffre_affaires, {half_up("total::DOUBLE / months::DOUBLE")} AS moyenne_globale,
       CASE WHEN revenue * months > 1.3 * total THEN 'Mois fort' WHEN revenue * months < 0.7 * total THEN 'Mois faible' ELSE 'Normal' END AS variation
FROM spread
"""

SQL["sales_promo_impact_7d"] = with_star(*SALES_TABLES, extra=[SOLD, OFFERS]) + f"""
SELECT CASE WHEN jour < du THEN 'Avant promo' WHEN jour > au THEN 'Après promo' ELSE 'Pendant promo' END AS periode_analyse,
       produit, du AS debut_promo, au AS fin_promo, jour AS date_commande,
       {rounded("sum(" + amount("q", price("prix")) + ")")} AS chiffre_affaires, {whole("sum(q)")} AS quantite_vendue, count(DISTINCT cmd) AS nb_commandes
FROM sold JOIN offers USING (prod) JOIN dim_produits ON id_produit = prod
WHERE counts AND datediff('day', du, jour) >= -7 AND datediff('day', au, jour) <= 7
GROUP BY ALL
"""

# the three periods of an offer as sums over its product's days
_PERIODS = (("avant", "jour < du"), ("pendant", "jour >= du AND jour <= au"), ("apres", "jour > au"))
SQL["sales_promo_variation_30d"] = with_star(*SALES_TABLES, extra=[SOLD, UNITS, OFFERS,
    ("around", f"""
        SELECT prod, offer, {", ".join(f"coalesce(sum({amount('q', _UNIT_PRICE)}) FILTER ({when}), 0)::DOUBLE AS ca_{name}, coalesce(sum(q) FILTER ({when}), 0)::BIGINT AS qte_{name}" for name, when in _PERIODS)}
        FROM units JOIN offers USING (prod) JOIN dim_produits ON id_produit = prod
        WHERE datediff('day', du, jour) >= -30 AND datediff('day', au, jour) <= 30
        GROUP BY prod, offer
    """),
    ("compared", "SELECT *, (ca_avant + ca_apres) / 2 AS ca_rest, (qte_avant::DOUBLE + qte_apres::DOUBLE) / 2 AS qte_rest FROM around"),
]) + f"""
SELECT prod AS id_produit,
       CASE WHEN variation IS NOT NULL AND min(prix) OVER same < max(prix) OVER same THEN concat(produit, ' - ', variation) ELSE produit END AS produit_final,
       offer AS id_promotion, ca_avant, ca_pendant, ca_apres, qte_avant, qte_pendant, qte_apres,
       {half_up(over("ca_pendant - ca_rest", "ca_rest") + " * 100")} AS variation_ca_pct_moy,
       {half_up(over("qte_pendant::DOUBLE - qte_rest", "qte_rest") + " * 100")} AS variation_qte_pct_moy
FROM compared JOIN dim_produits ON id_produit = prod
WINDOW same AS (PARTITION BY produit)
"""

# the window before a promotion reaches to the day before its end, so the promotion itself is its last day
_CHANGE = over("ca_pendant - ca_avant", "ca_avant")
SQL["sales_promo_sensitivity"] = with_star(*SALES_TABLES, extra=[SOLD, UNITS, OFFERS,
    ("halves", f"""
        SELECT prod, sum({amount("q", price("prix"))}) FILTER (jour < au)::DOUBLE AS ca_avant, sum({amount("q", price("prix"))}) FILTER (jour = au)::DOUBLE AS ca_pendant,
               sum(q) FILTER (jour < au)::BIGINT AS qte_avant, sum(q) FILTER (jour = au)::BIGINT AS qte_pendant
        FROM units JOIN offers USING (prod) JOIN dim_produits ON id_produit = prod
        WHERE jour <= au AND datediff('day', du, jour) >= -30
        GROUP BY prod HAVING count(*) FILTER (jour < au) > 0 AND count(*) FILTER (jour = au) > 0
    """)]) + f"""
SELECT produit, ca_avant, ca_pendant, {half_up(_CHANGE + " * 100")} AS variation_CA_pct, qte_avant, qte_pendant,
       {half_up(over("qte_pendant - qte_avant", "qte_avant") + " * 100")} AS variation_qte_pct,
       CASE WHEN {_CHANGE} >= 0.3 THEN 'Réagit très bien à la promo' WHEN {_CHANGE} <= 0.1 THEN 'Insensible à la promo' ELSE 'Effet modéré' END AS interpretation
FROM halves JOIN dim_produits ON id_produit = prod
"""
