"""sales_declining_products against a brute-force dense grid on a hand-built star."""

import datetime as dt
import random

from vitrine.plans.sales import sales_declining_products
from vitrine.star import Star

MONTHS = [dt.date(2020, m, 1) for m in range(1, 13)] + [dt.date(2021, m, 1) for m in range(1, 7)]


def brute_force(orders, lines, prices):
    """Dense product x observed-month grid, revenue per month, LAG 1..5, strict decline."""
    month_of = {o: d.replace(day=1) for o, (d, status) in orders.items()}
    observed = sorted({month_of[o] for o, (d, status) in orders.items() if status != "Annulée"})
    rev = {}
    for o, p, q in lines:
        if orders[o][1] == "Annulée":
            continue
        rev[(p, month_of[o])] = rev.get((p, month_of[o]), 0) + q * prices[p]
    out = []
    for p in sorted(prices):
        series = [round(rev.get((p, m), 0), 2) for m in observed]
        for i in range(5, len(series)):
            ca, lags = series[i], [series[i - j] for j in range(1, 6)]
            if ca < lags[0] < lags[1] < lags[2] < lags[3] < lags[4]:
                out.append((p, observed[i], ca, *lags))
    return sorted(out)


def test_declining_matches_dense_grid(spark):
    rnd = random.Random(11)
    prices = {f"P{i:05d}": float(10 + i) for i in range(12)}
    orders, lines = {}, []
    n = 0
    for mi, m in enumerate(MONTHS):
        if mi == 9:
            continue  # a month without any order: not an observed month
        for p in prices:
            idx = int(p[1:])
            if idx == 0:      # steady decline over every month: rows with sales
                qty = 40 - mi
            elif idx == 1:    # decline, then a month without sales: a zero-filled row qualifies
                qty = (30 - mi) if mi < 7 else (0 if mi == 7 else 5)
            elif idx == 2:    # decline broken by a tie
                qty = 20 if mi in (3, 4) else 30 - mi
            else:
                qty = rnd.choice([0, 0, 1, 2, 3, 5, 8])
            if qty == 0:
                continue
            n += 1
            oid = f"C{n}"
            status = "Annulée" if rnd.random() < 0.1 and idx > 2 else "Livrée"
            orders[oid] = (m + dt.timedelta(days=rnd.randrange(0, 27)), status)
            lines.append((oid, p, qty))
    # one cancelled order in an otherwise empty month: the month is not observed
    orders["Cx"] = (dt.date(2020, 10, 5), "Annulée")
    lines.append(("Cx", "P00003", 1))

    stg = {
        "stg_commandes": spark.createDataFrame(
            [(o, "CL1", "E1", d, s, None, "Carte", "T", d + dt.timedelta(days=2)) for o, (d, s) in orders.items()],
            "id_commande string, id_client string, id_entrepot_depart string, date_commande date, "
            "statut_commande string, id_promotion_appliquee string, mode_de_paiement string, "
            "numero_tracking string, date_livraison_estimee date"),
        "stg_details_commandes": spark.createDataFrame(
            [(o, p, q, True) for o, p, q in lines],
            "id_commande string, id_produit string, quantite long, emballage_special boolean"),
        "stg_produits": spark.createDataFrame(
            [(p, "cat", "m", f"name{p}", pr, "s", None) for p, pr in prices.items()],
            "id string, categorie string, marque string, produit string, prix double, sous_categorie string, "
            "variation string"),
        "stg_promotions": spark.createDataFrame(
            [], "id_promotion string, id_produit string, type_promotion string, valeur_promotion string, "
                "date_debut date, date_fin date, responsable_promotion string"),
    }
    star = Star(spark, stg, "2019-06-01", "2021-12-31")
    got = sorted((r.id_produit, r.mois, r.ca_mensuel, r.m1, r.m2, r.m3, r.m4, r.m5)
                 for r in sales_declining_products(star).collect())
    want = brute_force(orders, lines, prices)
    assert got == want
    assert any(r[2] == 0 for r in want), "the fixture must exercise a zero-filled month"
    assert any(r[0] == "P00000" for r in want)
