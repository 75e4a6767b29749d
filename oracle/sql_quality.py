"""Oracle SQL for the data-quality keys (one row per declared check)."""

from __future__ import annotations

from typing import NamedTuple

from oracle.sql_staging import STG, with_raw
from oracle.star_sql import with_star


class Declared(NamedTuple):
    model: str
    column: str
    test: str
    to_model: str | None = None
    to_column: str | None = None


# model: its key (unique and not null), then column -> parent model
_KEYS = {"dim_clients": "id_client", "dim_entrepots": "id_entrepot", "dim_machine": "id_machine", "dim_date": "id_date", "dim_canal": "id_canal",
         "dim_produits": "id_produit", "dim_promotions": "id_promotion", "dim_details_commandes": "id", "facts_entrepots_machine": "id_intervention_machine",
         "facts_posts": "id_post", "facts_campaigns": "id_campaign", "facts_commandes": "id_commande"}
_PARENTS = {"dim_satisfaction": {"id_commande": "facts_commandes"}, "dim_promotions": {"id_produit": "dim_produits", "id_date_debut": "dim_date", "id_date_fin": "dim_date"},
            "dim_details_commandes": {"id_details_produits": "dim_produits", "id_commande": "facts_commandes"},
            "facts_entrepots_machine": {"id_entrepot": "dim_entrepots", "id_machine": "dim_machine"}, "facts_posts": {"id_canal": "dim_canal", "id_date": "dim_date"},
            "facts_campaigns": {"id_canal_dim_canal": "dim_canal"},
            "facts_commandes": {"id_client": "dim_clients", "id_promotion": "dim_promotions", "id_entrepot": "dim_entrepots", "id_date_commande": "dim_date", "id_date_livraison": "dim_date"}}
DECLARED_CHECKS = ([Declared(m, k, t) for m, k in _KEYS.items() for t in ("unique", "not_null")] + [Declared("dim_satisfaction", "id_satisfaction", "unique")]
                   + [Declared(m, c, "relationships", p, _KEYS[p]) for m, own in _PARENTS.items() for c, p in own.items()])

_DETAILS_WITH_ID = ("dim_details_commandes_id", """
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY id_commande, id_details_produits) AS BIGINT) AS id, *
    FROM dim_details_commandes
""")


def _t(model: str) -> str:
    return "dim_details_commandes_id" if model == "dim_details_commandes" else model


def _check_sql(c) -> str:
    head = f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, "
    if c.test == "unique":
        return head + (f"CAST(COUNT(*) AS BIGINT) AS violations FROM (SELECT {c.column} FROM {_t(c.model)} "
                       f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING COUNT(*) > 1)")
    if c.test == "not_null":
        return head + f"CAST(COUNT(*) AS BIGINT) AS violations FROM {_t(c.model)} WHERE {c.column} IS NULL"
    return head + (f"CAST(COUNT(*) AS BIGINT) AS violations FROM {_t(c.model)} ch "
                   f"LEFT JOIN {_t(c.to_model)} pa ON ch.{c.column} = pa.{c.to_column} "
                   f"WHERE ch.{c.column} IS NOT NULL AND pa.{c.to_column} IS NULL")


def _report(test: str | None) -> str:
    checks = [c for c in DECLARED_CHECKS if test is None or c.test == test]
    models = sorted({c.model for c in checks} | {c.to_model for c in checks if c.to_model})
    prefix = with_star(*models, extra=[_DETAILS_WITH_ID] if "dim_details_commandes" in models else [])
    return prefix + "\nUNION ALL\n".join(_check_sql(c) for c in checks)


SQL = {
    "dq_unique": _report("unique"),
    "dq_not_null": _report("not_null"),
    "dq_relationships": _report("relationships"),
    "dq_report": _report(None),
}

_BUILT = ("stg_commandes", "stg_promotions", "stg_clients", "stg_produits")
_WISHES = ("wishes", """
    SELECT 'P' || repeat('0', greatest(0, 5 - len(digits))) || digits AS id
    FROM (SELECT substr(unnest(string_split(favoris, ',')), 2) AS digits, id_client FROM stg_clients WHERE favoris IS NOT NULL) WHERE id_client IS NOT NULL
""")
_READ = "CASE WHEN v LIKE '%\\%' ESCAPE '\\' THEN TRY_CAST(replace(v, '%', '') AS DECIMAL(9, 4)) ELSE TRY_CAST(replace(replace(v, '€', ''), ',', '.') AS DECIMAL(18, 6)) END"
_DAYS = """(SELECT low, make_date((year(high) - 1)::INTEGER, 6, 30) AS high FROM (
    SELECT min(low) AS low, max(high) AS high
    FROM (SELECT CAST(o_orderdate AS DATE) AS low, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 + 1 AS INTEGER) AS high FROM orders
          UNION ALL SELECT CAST(ts AS DATE) - 8766, CAST(ts AS DATE) - 8766 FROM events)))"""


def _outside(column: str, of: str) -> str:
    return f"SELECT 'facts_commandes', '{column}', 'outside_calendar', count(*) FILTER ({of} IS NULL OR {of} < low OR {of} > high) FROM stg_commandes, {_DAYS}"


SQL["dq_build_report"] = with_raw(*(STG[m][0] for m in _BUILT), extra=[(m, STG[m][1]) for m in _BUILT] + [_WISHES]) + f"""
SELECT 'dim_promotions' AS model, 'valeur_promotion' AS column_name, 'unreadable' AS test, count(*) FILTER (v IS NOT NULL AND {_READ} IS NULL) AS violations
FROM (SELECT valeur_promotion AS v FROM stg_promotions)
UNION ALL {_outside("id_date_commande", "date_commande")}
UNION ALL {_outside("id_date_livraison", "date_livraison_estimee")}
UNION ALL SELECT 'wishlist', 'favoris', 'unmatched', count(*) FROM wishes WHERE id NOT IN (SELECT id FROM stg_produits WHERE id IS NOT NULL)
"""
