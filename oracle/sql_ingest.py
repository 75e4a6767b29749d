"""Oracle SQL for ingest and sink keys: the raw tables themselves, with empty CSV fields as NULL."""

from __future__ import annotations

from oracle.sql_staging import RAW_SPECS, STG, q, with_raw

DESCRIPTIONS = {
    "raw_campaigns": "Advertising campaigns", "raw_clients": "Customers and their wishlists", "raw_commandes": "Orders", "raw_details_commandes": "Order lines",
    "raw_entrepots": "Warehouses", "raw_entrepots_machine": "Machine interventions by warehouse and month", "raw_posts": "Social media mentions",
    "raw_produits": "Product catalogue", "raw_promotions": "Promotions by product", "raw_satisfaction": "Customer reviews of orders",
}


def _csv_view(table: str) -> tuple[str, str]:
    cols = ", ".join(f"NULLIF({q(c)}, '') AS {q(c)}" for c in RAW_SPECS[table].columns)
    return f"{table}_csv", f"SELECT {cols} FROM {table}"


def _roundtrip(table: str) -> str:
    return with_raw(table, extra=[_csv_view(table)]) + f"SELECT * FROM {table}_csv"


SQL = {
    "ingest_csv": _roundtrip("raw_clients"),
    "ingest_normalize_headers": _roundtrip("raw_produits"),
    "ingest_overwrite_sink": with_raw("raw_details_commandes") + "SELECT * FROM raw_details_commandes",
}

_ALL = list(RAW_SPECS)
SQL["ingest_batch_log"] = with_raw(*_ALL) + "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, 'success' AS status, COUNT(*) AS rows, '' AS error_class FROM {t}" for t in _ALL]
    + ["SELECT 'raw_manquant', 'failed', CAST(0 AS BIGINT), 'PATH_NOT_FOUND'"])

SQL["source_catalogue"] = with_raw(*_ALL) + "\nUNION ALL\n".join(
    "SELECT '{t}' AS table_name, '{d}' AS description, CAST({n} AS BIGINT) AS n_columns, COUNT(*) AS rows FROM {t}"
    .format(t=t, d=DESCRIPTIONS[t].replace("'", "''"), n=len(RAW_SPECS[t].columns)) for t in _ALL)



def _quarantine(table: str, value: str) -> tuple[tuple[str, str], str]:
    """A view of the table's plain lines, and the rows of its load log and of its quarantine."""
    columns = RAW_SPECS[table].columns
    plain = {c: f"coalesce(translate({q(c)}, '\",' || chr(9) || chr(13) || chr(10), ''), '')" for c in columns}
    wrong = f"regexp_matches({plain[columns[0]]}, '[37]$')"
    line = " || ',' || ".join(f"{x} || CASE WHEN wrong THEN ',surplus' ELSE '' END" if c == value else x for c, x in plain.items())
    view = (f"{table}_lines", f"SELECT {line} AS line, wrong FROM (SELECT *, {wrong} AS wrong FROM {table})")
    return view, (f"SELECT '{table}' AS table_name, 'log' AS kind, NULL::VARCHAR AS record, count(*) FILTER (NOT wrong) AS rows, count(*) FILTER (wrong) AS quarantined FROM {view[0]}"
                  f" UNION ALL SELECT '{table}', 'record', line, NULL, NULL FROM {view[0]} WHERE wrong")


_SURPLUS = [_quarantine("raw_entrepots", "localisation"), _quarantine("raw_entrepots_machine", "type_machine")]
SQL["ingest_quarantine"] = with_raw("raw_entrepots", "raw_entrepots_machine", extra=[v for v, _ in _SURPLUS]) + " UNION ALL ".join(rows for _, rows in _SURPLUS)

_stg_raw, _stg_body = STG["stg_produits"]
SQL["stg_table_sink"] = with_raw("raw_produits", extra=[
    _csv_view("raw_produits")]) + _stg_body.replace("FROM raw_produits WHERE", "FROM raw_produits_csv WHERE")
