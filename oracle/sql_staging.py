"""Oracle SQL for the staging models, their cleaning helpers and dedup_by_completeness.

Raw dirty tables are derived from the star-mapping CTEs with the same rules
as sources/raw_fixtures.py; the staging models are written in the
reference's window form (ROW_NUMBER() ... = 1) with a total tie-break.
"""

from __future__ import annotations

from typing import NamedTuple

from oracle.star_sql import WAREHOUSES, with_star

WS = "' ' || chr(9) || chr(10) || chr(13)"
BLANKS = "' ' || chr(9) || chr(10) || chr(12) || chr(13)"
FLOAT_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def tr(x: str) -> str:
    return f"trim({x}, {WS})"


def s_long(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[+-]?[0-9]+$') THEN TRY_CAST({x} AS BIGINT) END)"


def s_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{FLOAT_SHAPE}') THEN TRY_CAST({x} AS DOUBLE) END)"


def s_date(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN TRY_CAST({x} AS DATE) END)"


def s_bool(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '(?i)^(true|false)$') THEN lower({x}) = 'true' END)"


def yes_no(x: str) -> str:
    return f"(CASE WHEN lower({tr(x)}) = 'oui' THEN TRUE WHEN lower({tr(x)}) = 'non' THEN FALSE ELSE NULL END)"


def strip_suffix(produit: str, variation: str) -> str:
    """The name without a trailing dash and variation: compare the end, then take the dash and the blanks around it."""
    name, end = tr(produit), tr(variation)
    head = f"rtrim(left({name}, len({name}) - len({end})), {BLANKS})"
    return f"(CASE WHEN suffix({name}, {end}) AND suffix({head}, '-') THEN rtrim(left({head}, len({head}) - 1), {BLANKS}) ELSE {name} END)"


def q(name: str) -> str:
    return f'"{name}"'


class Raw(NamedTuple):
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    text: tuple[str, ...]  # padded with blanks
    alt: str               # differs in the equally complete copy


def _raw(columns: str, keys: str, text: str, alt: str) -> Raw:
    return Raw(tuple(columns.split()), tuple(keys.split()), tuple(text.split()), alt)


RAW_SPECS = {
    "raw_campaigns": _raw("id_campagne date evenement_oui_non evenement_type canal budget impressions clics conversions ctr", "id_campagne",
                          "evenement_oui_non evenement_type canal", "evenement_type"),
    "raw_clients": _raw("id_client prenom_client nom_client email age genre frequence_visites numero_telephone favoris adresse_ip", "id_client",
                        "prenom_client nom_client email genre numero_telephone adresse_ip", "email"),
    "raw_commandes": _raw("id_commande id_client id_entrepot_depart date_commande statut_commande id_promotion_appliquee mode_de_paiement numero_tracking "
                          "date_livraison_estimee", "id_commande", "id_client statut_commande mode_de_paiement numero_tracking", "numero_tracking"),
    "raw_details_commandes": _raw("id_commande id_produit quantite emballage_special", "id_commande id_produit", "emballage_special", "emballage_special"),
    "raw_entrepots": _raw("id_entrepot localisation capacite_max volume_stocke taux_remplissage temperature_moyenne_entrepot", "id_entrepot", "localisation", "localisation"),
    "raw_entrepots_machine": _raw("id id_machine id_entrepot type_machine etat_machine temps_d_arret volume_traite mois", "id",
                                  "id_machine id_entrepot type_machine etat_machine mois", "type_machine"),
    "raw_posts": _raw("id_post date_post canal_social volume_mentions sentiment_global contenu_post", "id_post", "canal_social sentiment_global contenu_post", "contenu_post"),
    "raw_produits": _raw("id categorie marque produit prix sous-categorie variation", "id", "categorie marque produit sous-categorie variation", "marque"),
    "raw_promotions": _raw("id_promotion id_produit type_promotion valeur_promotion date_debut date_fin responsable_promotion", "id_promotion id_produit",
                           "type_promotion responsable_promotion", "responsable_promotion"),
    "raw_satisfaction": _raw("id_satisfaction id_commande note_client commentaire plainte temps_reponse_support type_plainte employe_support", "id_satisfaction",
                             "commentaire type_plainte employe_support", "employe_support"),
}

# --- raw tables: base rows as strings ------------------------------------------------------
BASES = {
    "raw_campaigns": (("campaign_src",), """
        SELECT id_campagne, CAST(date AS VARCHAR) AS date, evenement_oui_non, evenement_type, canal,
               CAST(budget AS VARCHAR) AS budget, CAST(impressions AS VARCHAR) AS impressions,
               CAST(clics AS VARCHAR) AS clics, CAST(conversions AS VARCHAR) AS conversions,
               CAST(ctr AS VARCHAR) AS ctr
        FROM campaign_src"""),
    "raw_clients": (("dim_clients",), """
        SELECT id_client, prenom_client, nom_client, email, CAST(age AS VARCHAR) AS age, genre,
               CAST(frequence_visite AS VARCHAR) AS frequence_visites, numero_telephone, favoris, adresse_ip
        FROM dim_clients"""),
    "raw_commandes": ((), f"""
        SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS id_commande, 'CL' || CAST(o_custkey AS VARCHAR) AS id_client,
               'E' || CAST(o_orderkey % {WAREHOUSES} AS VARCHAR) AS id_entrepot_depart,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_commande,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'Annulée'
                    WHEN o_orderstatus = 'P' THEN 'En transit' ELSE 'Livrée' END AS statut_commande,
               CAST(NULL AS VARCHAR) AS id_promotion_appliquee,
               CASE o_orderkey % 3 WHEN 0 THEN 'Carte' WHEN 1 THEN 'PayPal' ELSE 'Virement' END AS mode_de_paiement,
               'T' || CAST(o_orderkey AS VARCHAR) AS numero_tracking,
               CAST(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 + 1 AS INTEGER) AS DATE) AS VARCHAR)
                   AS date_livraison_estimee
        FROM orders"""),
    "raw_details_commandes": (("dim_details_commandes",), """
        SELECT id_commande, id_details_produits AS id_produit, CAST(quantite AS VARCHAR) AS quantite,
               CASE WHEN emballage_special THEN 'oui' ELSE 'non' END AS emballage_special
        FROM dim_details_commandes"""),
    "raw_entrepots": (("dim_entrepots",), """
        SELECT id_entrepot, localisation, CAST(capacite_max AS VARCHAR) AS capacite_max,
               CAST(volume_stocke AS VARCHAR) AS volume_stocke, CAST(taux_remplissage AS VARCHAR) AS taux_remplissage,
               CAST(temp_moyenne AS VARCHAR) AS temperature_moyenne_entrepot
        FROM dim_entrepots"""),
    "raw_entrepots_machine": (("machine_src",), f"""
        SELECT 'I' || CAST(m AS VARCHAR) || '-' || CAST(mo AS VARCHAR) || '-' || CAST(yr AS VARCHAR) AS id,
               'M' || CAST(m AS VARCHAR) AS id_machine, 'E' || CAST(m % {WAREHOUSES} AS VARCHAR) AS id_entrepot,
               CASE m % 3 WHEN 0 THEN 'Convoyeur' WHEN 1 THEN 'Trieuse' ELSE 'Chariot' END AS type_machine,
               CASE m % 4 WHEN 0 THEN 'En panne' WHEN 1 THEN 'En maintenance' ELSE 'En service' END AS etat_machine,
               CAST(CAST(arret AS BIGINT) AS VARCHAR) AS temps_d_arret, CAST(CAST(vol AS BIGINT) AS VARCHAR) AS volume_traite,
               CAST(yr AS VARCHAR) || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') AS mois
        FROM machine_src"""),
    "raw_posts": (("posts_src",), """
        SELECT id_post, CAST(date_post AS VARCHAR) AS date_post, canal_social,
               CAST(volume_mentions AS VARCHAR) AS volume_mentions, sentiment_global, contenu_post
        FROM posts_src"""),
    "raw_produits": (("part_ids",), """
        SELECT id, p_type AS categorie, p_brand AS marque,
               CASE WHEN p_partkey % 3 = 0 AND p_partkey % 10 <> 0 THEN p_name || ' - V' || CAST(p_size AS VARCHAR)
                    ELSE p_name END AS produit,
               CAST(p_retailprice AS VARCHAR) AS prix, p_type AS "sous-categorie",
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'V' || CAST(p_size AS VARCHAR) END AS variation
        FROM part_ids"""),
    "raw_promotions": (("promo_src",), """
        SELECT id_promotion, id_produit, type_promotion, valeur_promotion, CAST(date_debut AS VARCHAR) AS date_debut,
               CAST(date_fin AS VARCHAR) AS date_fin, responsable_promotion
        FROM promo_src"""),
    "raw_satisfaction": (("dim_satisfaction",), """
        SELECT id_satisfaction, id_commande, CAST(note_client AS VARCHAR) AS note_client, commentaire, plainte,
               CAST(temps_de_reponse AS VARCHAR) AS temps_reponse_support, type_plainte, employe_support
        FROM dim_satisfaction"""),
}


def _raw_ctes(table: str) -> tuple[tuple[str, ...], list[tuple[str, str]]]:
    spec = RAW_SPECS[table]
    deps, base_sql = BASES[table]
    kexpr = " + ".join(f"COALESCE(TRY_CAST(regexp_extract({q(k)}, '[0-9]+', 0) AS BIGINT), 0)" for k in spec.keys)
    cols = list(spec.columns)

    def pad(n):
        if n not in spec.text and n not in spec.keys:
            return f"{q(n)}"
        return (f"CASE WHEN _k % 7 = 0 AND {q(n)} IS NOT NULL THEN '  ' || {q(n)} || ' ' "
                f"WHEN _k % 11 = 0 AND {q(n)} IS NOT NULL THEN {q(n)} || chr(9) ELSE {q(n)} END AS {q(n)}")

    v0 = ", ".join(pad(n) for n in cols)
    v1 = ", ".join(q(n) if n in spec.keys else f"CASE WHEN _k % 8 = 0 THEN NULL ELSE '' END AS {q(n)}" for n in cols)
    v2 = ", ".join(f"{q(n)} || 'Z' AS {q(n)}" if n == spec.alt else q(n) for n in cols)
    v3 = ", ".join(f"CASE WHEN _k % 50 = 1 THEN NULL ELSE '   ' END AS {q(n)}" if n == spec.keys[0] else q(n)
                   for n in cols)
    base_name = f"base_{table}"
    body = (f"SELECT {v0} FROM {base_name}k UNION ALL SELECT {v1} FROM {base_name}k WHERE _k % 4 = 0 "
            f"UNION ALL SELECT {v2} FROM {base_name}k WHERE _k % 9 = 0 "
            f"UNION ALL SELECT {v3} FROM {base_name}k WHERE _k % 50 IN (1, 2)")
    return deps, [(base_name, base_sql), (f"{base_name}k", f"SELECT *, {kexpr} AS _k FROM {base_name}"),
                  (table, body)]


def with_raw(*tables: str, extra: list[tuple[str, str]] | None = None) -> str:
    deps: set[str] = set()
    ctes: list[tuple[str, str]] = []
    for t in tables:
        d, c = _raw_ctes(t)
        deps.update(d)
        ctes.extend(c)
    return with_star(*sorted(deps), extra=ctes + (extra or [])) if deps else \
        "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes + (extra or [])) + "\n"


def filled(x):
    return f"IF({x} IS NOT NULL, 1, 0)"


def filled_text(x):
    return f"IF({tr(x)} <> '', 1, 0)"


def filled_nb(x):
    return f"IF({x} IS NOT NULL AND {tr(x)} <> '', 1, 0)"


def staging_sql(raw: str, where: str, keys: list[str], score: list[str], outputs: list[tuple[str, str]],
                tiebreak: list[tuple[str, str]] | None = None) -> str:
    """outputs: (expr, alias); tiebreak: (expr, 'DESC'|'ASC') before the output columns."""
    tb = tiebreak or []
    inner_cols = ([f"{k} AS _key{i}" for i, k in enumerate(keys)] + [f"({' + '.join(score)}) AS _score"]
                  + [f"{e} AS _tb{i}" for i, (e, _) in enumerate(tb)] + [f"{e} AS {q(a)}" for e, a in outputs])
    order = (["_score DESC"] + [f"_tb{i} {d} NULLS LAST" for i, (_, d) in enumerate(tb)]
             + [f"{q(a)} ASC NULLS LAST" for _, a in outputs])
    part = ", ".join(f"_key{i}" for i in range(len(keys)))
    alias_list = ", ".join(q(a) for _, a in outputs)
    return (f"SELECT {alias_list} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {', '.join(order)}) AS rn "
            f"FROM (SELECT {', '.join(inner_cols)} FROM {raw} WHERE {where})) WHERE rn = 1")


def nb(x):
    return f"({x} IS NOT NULL AND {tr(x)} <> '')"


STG: dict[str, tuple[str, str]] = {}

STG["stg_campaigns"] = ("raw_campaigns", staging_sql(
    "raw_campaigns", f"{nb('id_campagne')} AND date IS NOT NULL", [tr("id_campagne")],
    [filled("date"), filled("evenement_oui_non"), filled_text("evenement_type"), filled_text("canal"),
     filled("budget"), filled("impressions"), filled("clics"), filled("conversions"), filled("ctr")],
    [(tr("id_campagne"), "id_campagne"), (s_date("date"), "date"), (tr("evenement_oui_non"), "evenement_oui_non"),
     (tr("evenement_type"), "evenement_type"), (tr("canal"), "canal"), (s_double("budget"), "budget"),
     (s_long("impressions"), "impressions"), (s_long("clics"), "clics"), (s_long("conversions"), "conversions"),
     (s_double("ctr"), "CTR")]))

STG["stg_clients"] = ("raw_clients", staging_sql(
    "raw_clients", "id_client IS NOT NULL AND prenom_client IS NOT NULL AND nom_client IS NOT NULL",
    ["CAST(id_client AS VARCHAR)"],
    [filled_nb("prenom_client"), filled_nb("nom_client"), filled_nb("email"), filled("age"), filled_nb("genre"),
     filled("frequence_visites"), filled_nb("numero_telephone"), filled_nb("favoris"), filled_nb("adresse_ip")],
    [(tr("id_client"), "id_client"), (tr("prenom_client"), "prenom_client"), (tr("nom_client"), "nom_client"),
     (tr("email"), "email"), (s_long("age"), "age"), (tr("genre"), "genre"),
     (s_long("frequence_visites"), "frequence_visites"), (tr("numero_telephone"), "numero_telephone"),
     (tr("favoris"), "favoris"), (tr("adresse_ip"), "adresse_ip")]))


def _fu(x):
    return f"IF({x} IS NOT NULL AND {x} != '', 1, 0)"


STG["stg_commandes"] = ("raw_commandes", staging_sql(
    "raw_commandes", nb("id_commande"), [tr("id_commande")],
    [_fu("id_client"), _fu("id_entrepot_depart"), filled("date_commande"), _fu("statut_commande"),
     _fu("id_promotion_appliquee"), _fu("mode_de_paiement"), _fu("numero_tracking"), filled("date_livraison_estimee")],
    [(tr("id_commande"), "id_commande"), (tr("id_client"), "id_client"), (tr("id_entrepot_depart"), "id_entrepot_depart"),
     (s_date("date_commande"), "date_commande"), (tr("statut_commande"), "statut_commande"),
     (tr("id_promotion_appliquee"), "id_promotion_appliquee"), (tr("mode_de_paiement"), "mode_de_paiement"),
     (tr("numero_tracking"), "numero_tracking"), (s_date("date_livraison_estimee"), "date_livraison_estimee")]))

STG["stg_details_commandes"] = ("raw_details_commandes", staging_sql(
    "raw_details_commandes", "id_commande IS NOT NULL AND id_produit IS NOT NULL",
    [tr("id_commande"), tr("id_produit")], [filled("quantite"), filled("emballage_special")],
    [(tr("id_commande"), "id_commande"), (tr("id_produit"), "id_produit"), (s_long("quantite"), "quantite"),
     (yes_no("emballage_special"), "emballage_special")]))

STG["stg_entrepots"] = ("raw_entrepots", staging_sql(
    "raw_entrepots", nb("id_entrepot"), [tr("id_entrepot")],
    [filled_text("localisation"), filled("capacite_max"), filled("volume_stocke"), filled("taux_remplissage"),
     filled("temperature_moyenne_entrepot")],
    [(tr("id_entrepot"), "id_entrepot"), (tr("localisation"), "localisation"), (s_long("capacite_max"), "capacite_max"),
     (s_long("volume_stocke"), "volume_stocke"), (s_double("taux_remplissage"), "taux_remplissage"),
     (s_double("temperature_moyenne_entrepot"), "temperature_moyenne_entrepot")]))

_YM = f"(mois IS NOT NULL AND regexp_matches({tr('mois')}, '^[0-9]{{4}}-[0-9]{{2}}$'))"
_MOIS = s_long(f"substr({tr('mois')}, 6, 2)")
_ANNEE = s_long(f"substr({tr('mois')}, 1, 4)")

STG["stg_entrepots_machine"] = ("raw_entrepots_machine", staging_sql(
    "raw_entrepots_machine", f"{nb('id')} AND {nb('id_machine')} AND {nb('id_entrepot')} AND {_YM}", [tr("id")],
    [filled_nb("id_machine"), filled_nb("id_entrepot"), filled_nb("type_machine"), filled_nb("etat_machine"),
     filled("temps_d_arret"), filled("volume_traite"), f"IF({_YM}, 1, 0)"],
    [(tr("id"), "id"), (tr("id_machine"), "id_machine"), (tr("id_entrepot"), "id_entrepot"),
     (tr("type_machine"), "type_machine"), (tr("etat_machine"), "etat_machine"),
     (s_long("temps_d_arret"), "temps_d_arret"), (s_long("volume_traite"), "volume_traite"),
     (_MOIS, "mois"), (_ANNEE, "annee")],
    tiebreak=[(_ANNEE, "DESC"), (_MOIS, "DESC")]))

STG["stg_posts"] = ("raw_posts", staging_sql(
    "raw_posts", nb("id_post"), [tr("id_post")],
    [filled("date_post"), filled_text("canal_social"), filled("volume_mentions"), filled_text("sentiment_global"),
     filled_text("contenu_post")],
    [(tr("id_post"), "id_post"), (s_date("date_post"), "date_post"), (tr("canal_social"), "canal_social"),
     (s_long("volume_mentions"), "volume_mentions"), (tr("sentiment_global"), "sentiment_global"),
     (tr("contenu_post"), "contenu_post")]))

STG["stg_produits"] = ("raw_produits", staging_sql(
    "raw_produits", f"{nb('id')} AND {nb('produit')} AND prix IS NOT NULL", [tr("id")],
    [filled_nb("id"), filled_nb("categorie"), filled_nb("marque"), filled_nb("produit"), filled("prix"),
     filled_nb(q("sous-categorie")), filled_nb("variation")],
    [(tr("id"), "id"), (tr("categorie"), "categorie"), (tr("marque"), "marque"),
     (strip_suffix("produit", "variation"), "produit"), (s_double("prix"), "prix"),
     (tr(q("sous-categorie")), "sous_categorie"), (tr("variation"), "variation")]))

STG["stg_promotions"] = ("raw_promotions", staging_sql(
    "raw_promotions", f"{nb('id_promotion')} AND {nb('id_produit')}", [tr("id_promotion"), tr("id_produit")],
    [filled_text("type_promotion"), filled("valeur_promotion"), filled("date_debut"), filled("date_fin"),
     filled_text("responsable_promotion")],
    [(tr("id_promotion"), "id_promotion"), (tr("id_produit"), "id_produit"), (tr("type_promotion"), "type_promotion"),
     ("CAST(valeur_promotion AS VARCHAR)", "valeur_promotion"), (s_date("date_debut"), "date_debut"),
     (s_date("date_fin"), "date_fin"), (tr("responsable_promotion"), "responsable_promotion")]))

STG["stg_satisfaction"] = ("raw_satisfaction", staging_sql(
    "raw_satisfaction", f"{nb('id_satisfaction')} AND {nb('id_commande')}", [tr("id_satisfaction")],
    [filled_text("id_commande"), filled("note_client"), filled_text("commentaire"), filled("plainte"),
     filled("temps_reponse_support"), filled_text("type_plainte"), filled_text("employe_support")],
    [(tr("id_satisfaction"), "id_satisfaction"), (tr("id_commande"), "id_commande"),
     (s_long("note_client"), "note_client"), (tr("commentaire"), "commentaire"), (s_bool("plainte"), "plainte"),
     (s_long("temps_reponse_support"), "temps_reponse_support"), (tr("type_plainte"), "type_plainte"),
     (tr("employe_support"), "employe_support")]))

SQL: dict[str, str] = {name: with_raw(raw) + body for name, (raw, body) in STG.items()}

SQL["dedup_by_completeness"] = with_raw(*[raw for raw, _ in STG.values()], extra=[
    (f"{name}_out", body) for name, (raw, body) in STG.items()]) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS model, (SELECT COUNT(*) FROM {raw}) AS raw_rows, (SELECT COUNT(*) FROM {name}_out) AS kept_rows"
    for name, (raw, _) in STG.items())

SQL["strip_variation_suffix"] = with_raw("raw_produits") + f"""
SELECT id, produit, variation, {strip_suffix("produit", "variation")} AS produit_nettoye FROM raw_produits
"""

SQL["safe_cast"] = with_raw("raw_campaigns") + f"""
SELECT id_campagne, {s_date("date")} AS date, {s_double("budget")} AS budget, {s_long("impressions")} AS impressions,
       {s_long("clics")} AS clics, {s_long("conversions")} AS conversions, {s_double("ctr")} AS ctr
FROM raw_campaigns
"""

SQL["yes_no_to_boolean"] = with_raw("raw_details_commandes") + f"""
SELECT id_commande, id_produit, emballage_special, {yes_no("emballage_special")} AS emballage_bool
FROM raw_details_commandes
"""

SQL["year_month_split"] = with_raw("raw_entrepots_machine") + f"""
SELECT id, mois AS mois_brut, {_YM} AS mois_valide,
       CASE WHEN {_YM} THEN {_MOIS} END AS mois, CASE WHEN {_YM} THEN {_ANNEE} END AS annee
FROM raw_entrepots_machine
"""
