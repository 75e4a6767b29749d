"""SQL expressions for prices and money: exact decimals, rounded once, then DOUBLE."""

from __future__ import annotations

PRICE, UNIT, QTY = "DECIMAL(18,6)", "DECIMAL(26,12)", "DECIMAL(11,0)"


def live(status: str) -> str:
    """Orders that count: neither cancelled in French nor in English, status known."""
    return f"lower({status}) NOT IN ('annulée', 'cancelled')"


def price(column: str) -> str:
    return f"CAST({column} AS {PRICE})"


def less_percent(prix: str, percent_text: str) -> str:
    return f"CAST({price(prix)} * (100 - TRY_CAST({percent_text} AS DECIMAL(9,4))) * 0.01 AS {UNIT})"


def less_amount(prix: str, amount_text: str) -> str:
    return f"CAST({price(prix)} - TRY_CAST({amount_text} AS DECIMAL(18,6)) AS {UNIT})"


def by_value(prix: str, valeur: str) -> str:
    """The value's own form decides: '12%' is a share, anything else an amount (comma allowed); never below 0."""
    share = less_percent(prix, f"replace({valeur}, '%', '')")
    amount = less_amount(prix, f"replace(replace({valeur}, '€', ''), ',', '.')")
    chosen = f"CASE WHEN {valeur} LIKE '%\\%' ESCAPE '\\' THEN {share} ELSE {amount} END"
    return f"CASE WHEN ({chosen}) < 0 THEN CAST(0 AS {UNIT}) ELSE ({chosen}) END"


def by_type(prix: str, kind: str, valeur: str) -> str:
    """The promotion's type decides; the comma is not a decimal point and there is no floor."""
    bare = f"replace(replace({valeur}, '%', ''), '€', '')"
    return (f"CASE {kind} WHEN 'Remise fixe' THEN {less_amount(prix, bare)} WHEN 'Pourcentage' THEN {less_percent(prix, bare)} "
            f"ELSE CAST({price(prix)} AS {UNIT}) END")


def within(day: str, first: str, last: str, then: str, otherwise: str) -> str:
    return f"CASE WHEN {day} >= {first} AND {day} <= {last} THEN {then} ELSE {otherwise} END"


def amount(quantity: str, unit: str) -> str:
    return f"CAST({quantity} AS {QTY}) * CAST({unit} AS {UNIT})"


def rounded(expression: str) -> str:
    return f"CAST(round({expression}, 2) AS DOUBLE)"


def mean(column: str) -> str:
    """Average, rounded half up in decimal."""
    return f"CAST(round(CAST(avg({column}) AS DECIMAL(28,10)), 2) AS DOUBLE)"


def half_up(expression: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def over(part: str, whole: str) -> str:
    """Quotient in DOUBLE, NULL over 0."""
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
