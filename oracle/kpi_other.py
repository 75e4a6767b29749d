
from __future__ import annotations

from oracle.kpi_sales import OFFERS, SALES_TABLES, SOLD, UNITS
from oracle.money_sql import amount, by_type, half_up, live, mean, over, price, whole
from oracle.star_sql import with_star

AS_OF = "2000-01-01"  # the day on which deliveries are judged

SQL: dict[str, str] = {}

# --- marketing ---------------------------------------------------------------------------

_SPENT = ("spent", """
    SELECT id_canal_dim_canal AS id_canal, sum(CAST(budget AS DECIMAL(24,6))) AS spent, sum(clics)::BIGINT AS clicks, sum(conversions)::BIGINT AS wins
    FROM facts_campaigns GROUP BY 1
""")


def _by_channel(columns: str, where: str = "true") -> str:
    return with_star("facts_campaigns", "dim_canal", extra=[_SPENT]) + f"SELECT nom_canal AS canal, {columns} FROM spent JOIN dim_canal USING (id_canal) WHERE {where}"


_CPA = half_up(over("spent", "wins")) + " AS cpa"
SQL["mkt_clicks_by_channel"] = _by_channel("clicks AS total_clics, wins AS total_acquisitions")
SQL["mkt_cpc_cpa_by_channel"] = _by_channel(
    f"spent::DOUBLE AS budget_total, clicks AS total_clics, wins AS total_conversions, {half_up(over('spent', 'clicks'))} AS cpc, {_CPA}")
SQL["mkt_cpa_converting"] = _by_channel(f"spent::DOUBLE AS budget_total, wins AS total_conversions, {_CPA}", "wins > 0")

# days, not lines, are promotion days: one sold product with a running offer makes the day one
_BASE = "sum(" + amount("q", price("prix")) + ")"
_SIDE = (("promo", "promoted"), ("hors_promo", "NOT promoted"))
SQL["mkt_promo_days_vs_others"] = with_star(*SALES_TABLES, extra=[SOLD, UNITS, OFFERS,
    ("days", f"""
        SELECT jour, {_BASE} AS revenue, bool_or(EXISTS (FROM offers o WHERE o.prod = u.prod AND u.jour >= o.du AND u.jour <= o.au)) AS promoted
        FROM units u JOIN dim_produits ON id_produit = u.prod GROUP BY jour
    """),
    ("sides", "SELECT " + ", ".join(
        f"round(sum(revenue) FILTER ({when}), 2)::DOUBLE AS ca_jour_{name}, nullif(count(*) FILTER ({when}), 0) AS nb_jours_{name}, "
        f"{half_up(over(f'sum(revenue) FILTER ({when})', f'count(*) FILTER ({when})'))} AS ca_moyen_jour_{name}" for name, when in _SIDE) + " FROM days"),
]) + f"""
SELECT *, {half_up(over("ca_jour_promo", "ca_jour_hors_promo"))} AS ratio_ca_total_promo_vs_hors,
       {half_up(over("ca_moyen_jour_promo", "ca_moyen_jour_hors_promo"))} AS ratio_ca_moyen_jour_promo_vs_hors
FROM sides
"""

SQL["mkt_monthly_promo_vs_budget"] = with_star(*SALES_TABLES, "facts_campaigns", "dim_canal", extra=[SOLD, UNITS, OFFERS,
    ("income", f"""
        SELECT date_trunc('month', u.jour)::DATE AS mois,
               coalesce(round(sum({amount("q", by_type("prix", "kind", "worth"))}) FILTER (offer IS NOT NULL), 2), 0) AS promo,
               coalesce(round(sum({amount("q", price("prix"))}) FILTER (offer IS NULL), 2), 0) AS plain
        FROM units u JOIN dim_produits ON id_produit = u.prod LEFT JOIN offers o ON o.prod = u.prod AND u.jour >= o.du AND u.jour <= o.au
        GROUP BY 1
    """),
    ("outlay", """
        SELECT date_trunc('month', date)::DATE AS mois, nom_canal AS canal, evenement_type, round(sum(CAST(budget AS DECIMAL(24,6))), 2) AS spent
        FROM facts_campaigns JOIN dim_date USING (id_date) JOIN dim_canal ON id_canal = id_canal_dim_canal
        GROUP BY ALL
    """)]) + f"""
SELECT mois, coalesce(promo, 0)::DOUBLE AS ca_promo, coalesce(plain, 0)::DOUBLE AS ca_hors_promo, (coalesce(promo, 0) + coalesce(plain, 0))::DOUBLE AS ca_total,
       canal, evenement_type, coalesce(spent, 0)::DOUBLE AS budget_marketing,
       {over("coalesce(promo, 0)", "coalesce(promo, 0) + coalesce(plain, 0)")} * 100 AS impact_promo_CA
FROM income FULL JOIN outlay USING (mois)
"""

SQL["mkt_promo_effectiveness"] = with_star(*SALES_TABLES, extra=[SOLD, OFFERS,
    ("takings", f"SELECT prod, jour, sum(q) AS q, round({_BASE}, 2) AS taken FROM sold JOIN dim_produits ON id_produit = prod GROUP BY prod, jour"),
    ("summed", """
        SELECT offer, prod, any_value(kind) AS kind, any_value(worth) AS worth, sum(taken) AS all_taken, sum(q) AS all_q,
               coalesce(sum(taken) FILTER (jour >= du AND jour <= au), 0) AS taken_then, coalesce(sum(q) FILTER (jour >= du AND jour <= au), 0) AS q_then
        FROM offers JOIN takings USING (prod) WHERE du IS NOT NULL AND au IS NOT NULL GROUP BY offer, prod
    """)]) + f"""
SELECT offer AS id_promotion, prod AS id_produit, kind AS type_promotion,
       TRY_CAST(translate(translate(worth, '%€ ', ''), ',', '.') AS DOUBLE) AS valeur_promotion,
       all_taken::DOUBLE AS ca_total, taken_then::DOUBLE AS ca_promo, {whole("all_q")} AS quantite_total, {whole("q_then")} AS quantite_promo,
       {half_up(over("taken_then", "all_taken"), 4)} * 100 AS ratio_promo
FROM summed WHERE all_taken > 0
"""

_MOODS = (("nb_positif", "positif"), ("nb_neutre", "neutre"), ("nb_negatif", "négatif"))
SQL["mkt_sentiment_daily"] = with_star("facts_posts", "dim_date", "dim_canal", extra=[
    ("moods", "SELECT id_date, id_canal, lower(trim(sentiment_global)) AS mood, count(*) AS n FROM facts_posts GROUP BY ALL")]) + f"""
SELECT date, {whole("year(date)")} AS annee, {whole("month(date)")} AS mois, nom_canal, {whole("sum(n)")} AS total_mentions,
       {", ".join(f"coalesce(sum(n) FILTER (mood = '{m}'), 0)::BIGINT AS {c}" for c, m in _MOODS)}
FROM moods JOIN dim_date USING (id_date) JOIN dim_canal USING (id_canal)
GROUP BY date, nom_canal
"""

DAILY_PEAKS = [
    ("mentions", "SELECT date AS jour, sum(volume_mentions) AS n FROM facts_posts JOIN dim_date USING (id_date) GROUP BY date"),
    ("peaks", "SELECT jour, n, (n > (SELECT avg(n) + 2 * stddev_samp(n) FROM mentions))::INTEGER AS peak FROM mentions"),
]
_PIECES = ("pieces", "SELECT jour, sum(q) AS q FROM sold WHERE counts GROUP BY jour")
_PEAK_COLUMNS = (f"jour AS date_jour, {whole('year(jour)')} AS annee, {whole('month(jour)')} AS mois, {whole('n')} AS total_mentions, peak AS pic_mention, "
                 f"{whole('coalesce(q, 0)')} AS volume_ventes")
_PEAK_TABLES = ("facts_posts", "dim_date", "dim_details_commandes", "facts_commandes")
SQL["mkt_peaks_vs_sales"] = with_star(*_PEAK_TABLES, extra=[*DAILY_PEAKS, SOLD, _PIECES]) + f"SELECT {_PEAK_COLUMNS} FROM peaks LEFT JOIN pieces USING (jour)"
SQL["mkt_peaks_vs_satisfaction"] = with_star(*_PEAK_TABLES, "dim_satisfaction", extra=[*DAILY_PEAKS, SOLD, _PIECES,
    ("ratings", f"""
        SELECT date AS jour, {mean("note_client")} AS rating
        FROM dim_satisfaction JOIN (SELECT id_commande, id_date_commande AS id_date FROM facts_commandes WHERE {live("statut_commande")}) USING (id_commande)
        JOIN dim_date USING (id_date) GROUP BY date
    """)]) + f"SELECT {_PEAK_COLUMNS}, rating AS satisfaction_moyenne FROM peaks LEFT JOIN pieces USING (jour) LEFT JOIN ratings USING (jour)"

# --- satisfaction ------------------------------------------------------------------------

_REVIEWED = ("reviewed", """
    SELECT id_produit, produit, categorie, note_client
    FROM (SELECT id_commande, note_client FROM dim_satisfaction) JOIN (SELECT id_commande, id_details_produits AS id_produit FROM dim_details_commandes) USING (id_commande)
    JOIN dim_produits USING (id_produit)
""")
_RATED = f"{mean('note_client')} AS note_moyenne, count(*) AS nb_avis"


def _rated(key: str, having: str = "true") -> str:
    return with_star("dim_satisfaction", "dim_details_commandes", "dim_produits", extra=[_REVIEWED]) + f"SELECT {key}, {_RATED} FROM reviewed GROUP BY {key} HAVING {having}"


SQL["sat_best_rated"] = _rated("categorie, produit")
SQL["sat_worst_rated"] = _rated("categorie, id_produit, produit", "count(*) >= 5")

_REVIEW_TABLES = ("dim_satisfaction", "facts_commandes", "dim_date")
SQL["sat_monthly_trend"] = with_star(*_REVIEW_TABLES, extra=[("dated", f"""
    SELECT note_client, (SELECT date FROM dim_date WHERE id_date = id_date_commande) AS jour
    FROM dim_satisfaction JOIN facts_commandes USING (id_commande) WHERE {live("statut_commande")} AND note_client IS NOT NULL
""")]) + f"""
SELECT {whole("year(any_value(jour))")} AS annee, {whole("month(any_value(jour))")} AS mois, strftime(jour, '%Y-%m') AS periode, {_RATED}
FROM dated WHERE jour IS NOT NULL GROUP BY strftime(jour, '%Y-%m') HAVING count(*) >= 10
"""

SQL["sat_by_complaint"] = with_star("dim_satisfaction") + f"SELECT ifnull(type_plainte, 'Aucune') AS type_plainte, {_RATED} FROM dim_satisfaction GROUP BY ALL"

SQL["sat_by_response_time"] = with_star("dim_satisfaction", extra=[
    ("limits", "SELECT * FROM (VALUES (1, '≤ 1h'), (4, '1-4h'), (12, '4-12h'), (24, '12-24h')) AS l(top, label)")]) + f"""
SELECT CASE WHEN temps_de_reponse IS NULL THEN 'inconnu'
            ELSE ifnull((SELECT arg_min(label, top) FROM limits WHERE top >= temps_de_reponse), '> 24h') END AS delai_support, {_RATED}
FROM dim_satisfaction GROUP BY 1
"""

SQL["sat_by_delivery_state"] = with_star(*_REVIEW_TABLES, extra=[("states", f"""
    SELECT id_commande, strftime((SELECT date FROM dim_date WHERE id_date = id_date_commande), '%Y-%m') AS mois_commande,
           CASE lower(statut_commande) WHEN 'annulée' THEN 'Annulée'
                WHEN 'en transit' THEN CASE WHEN (SELECT date FROM dim_date WHERE id_date = id_date_livraison) < DATE '{AS_OF}' THEN 'Retard probable' ELSE 'Dans les délais ou terminée' END
                ELSE 'Dans les délais ou terminée' END AS situation_livraison
    FROM facts_commandes
""")]) + f"""
SELECT mois_commande, situation_livraison, {mean("note_client")} AS note_moyenne, count(*) AS nb_commandes
FROM states JOIN dim_satisfaction USING (id_commande) WHERE note_client IS NOT NULL GROUP BY ALL
"""

KEYWORDS = {"nb_average_quality": "average quality", "nb_long": "long", "nb_damaged": "damaged", "nb_very_happy": "very happy", "nb_delivery": "delivery",
            "nb_quality": "quality", "nb_product": "product", "nb_not_great": "not great", "nb_experience": "experience", "nb_service": "service"}


def keyword_counts(key: str, names: list[str]) -> str:
    hits = ", ".join(f"count(*) FILTER (contains(lower(commentaire), '{KEYWORDS[n]}')) AS {n}" for n in names)
    return with_star("dim_satisfaction") + f"SELECT {key}, count(commentaire) AS nb_commentaires, {hits} FROM dim_satisfaction WHERE commentaire IS NOT NULL GROUP BY 1"


SQL["sat_keywords_3"] = keyword_counts("note_client", ["nb_average_quality", "nb_long", "nb_damaged"])
SQL["sat_keywords_8"] = keyword_counts("note_client", [n for n in KEYWORDS if n not in ("nb_average_quality", "nb_long")])

# --- logistics ---------------------------------------------------------------------------


def _machines(key: str, columns: str) -> str:
    return with_star("facts_entrepots_machine", "dim_entrepots") + f"SELECT {key}, localisation, mois, {columns} FROM facts_entrepots_machine JOIN dim_entrepots USING (id_entrepot) GROUP BY {key}, localisation, mois"


_DOWN = "etat_machine = 'En panne' OR etat_machine = 'En maintenance'"
SQL["log_downtime_by_warehouse"] = _machines("id_entrepot", f"{whole('sum(temps_d_arret)')} AS temps_d_arret_total")
SQL["log_volume_by_warehouse"] = _machines("id_entrepot", f"{whole('sum(volume_traite)')} AS volume_total_traite")
SQL["log_breakdown_impact"] = _machines("id_machine", f"count(temps_d_arret) FILTER ({_DOWN}) AS nombre_de_pannes, "
                                        f"coalesce(sum(temps_d_arret) FILTER ({_DOWN}), 0)::BIGINT AS temps_total_panne_ou_maintenance, {whole('sum(volume_traite)')} AS volume_total_traite")

_PLACED = ("placed", "SELECT id_commande, id_entrepot, localisation, taux_remplissage, date FROM facts_commandes JOIN dim_entrepots USING (id_entrepot) JOIN dim_date ON id_date = id_date_commande")
SQL["log_orders_by_warehouse"] = with_star("facts_commandes", "dim_entrepots", "dim_date", extra=[_PLACED]) + """
SELECT id_entrepot, localisation, date, count(*) AS nombre_de_commandes, taux_remplissage FROM placed GROUP BY ALL
"""
SQL["log_reported_delays"] = with_star("dim_satisfaction", "facts_commandes", "dim_entrepots", "dim_date", extra=[_PLACED]) + """
SELECT id_entrepot, localisation, date, count(*) FILTER (commentaire = 'Delivery took too long.') AS nombre_de_retards
FROM placed JOIN dim_satisfaction USING (id_commande) GROUP BY ALL
"""
