"""sales_product_pairs against brute-force pair enumeration, with a large repeated basket."""

import datetime as dt
import itertools
import random

from vitrine.plans.sales import sales_product_pairs
from vitrine.star import Star


def test_pairs_match_brute_force(spark):
    rnd = random.Random(5)
    # names shared by several ids with different prices get a display name with the variation
    products = [(f"P{i:05d}", f"n{i % 7}", f"cat{i % 3}", float(10 + (i % 4)), f"V{i}") for i in range(30)]
    orders, lines = [], []
    day = dt.date(2020, 3, 1)
    for o in range(60):
        client = "HOT" if o < 4 else f"CL{o % 9}"        # one client-day holds several orders
        d = day if client == "HOT" else day + dt.timedelta(days=o % 5)
        orders.append((f"C{o}", client, d))
        for p in rnd.sample(products, rnd.randint(1, 12 if client == "HOT" else 4)):
            lines.append((f"C{o}", p[0]))

    price_count = {}
    for pid, name, cat, prix, var in products:
        price_count.setdefault(name, set()).add(prix)
    disp = {pid: (f"{name} - {var}" if len(price_count[name]) > 1 else name, cat) for pid, name, cat, prix, var in products}
    order_of = {o: (c, d) for o, c, d in orders}
    rows = {(order_of[o][0], order_of[o][1], o, p) for o, p in lines}
    counts, min_a, min_b = {}, {}, {}
    for (c1, d1, o1, p1), (c2, d2, o2, p2) in itertools.product(rows, rows):
        if (c1, d1) != (c2, d2) or not disp[p1][0] < disp[p2][0]:
            continue
        k = (disp[p1][0], disp[p2][0])
        counts[k] = counts.get(k, 0) + 1
        min_a[k] = min(min_a.get(k, (p1, disp[p1][1])), (p1, disp[p1][1]))
        min_b[k] = min(min_b.get(k, (p2, disp[p2][1])), (p2, disp[p2][1]))
    want = sorted((a, min(x[0] for x in [min_a[(a, b)]]), None, b, None, None, n)
                  for (a, b), n in counts.items() if n > 1)

    stg = {
        "stg_commandes": spark.createDataFrame(
            [(o, c, "E1", d, "Livrée", None, "Carte", "T", d + dt.timedelta(days=1)) for o, c, d in orders],
            "id_commande string, id_client string, id_entrepot_depart string, date_commande date, "
            "statut_commande string, id_promotion_appliquee string, mode_de_paiement string, "
            "numero_tracking string, date_livraison_estimee date"),
        "stg_details_commandes": spark.createDataFrame(
            [(o, p, 1, True) for o, p in lines],
            "id_commande string, id_produit string, quantite long, emballage_special boolean"),
        "stg_produits": spark.createDataFrame(
            [(pid, cat, "m", name, prix, "s", var) for pid, name, cat, prix, var in products],
            "id string, categorie string, marque string, produit string, prix double, sous_categorie string, "
            "variation string"),
    }
    star = Star(spark, stg, "2020-01-01", "2020-12-31")
    got = {(r.produit_A, r.produit_B): (r.nb_occurrences, r.id_produit_A, r.id_produit_B)
           for r in sales_product_pairs(star).collect()}
    assert len(want) > 20
    for a, pid_a, _, b, _, _, n in want:
        assert got[(a, b)][0] == n
    assert set(got) == {(w[0], w[3]) for w in want}
    # smallest product id per side over all contributing pairs
    for k, (n, pid_a, pid_b) in got.items():
        assert (pid_a, pid_b) == (min_a[k][0], min_b[k][0])
