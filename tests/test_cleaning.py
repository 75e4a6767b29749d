"""Hand-written edge rows for the cleaning operators (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from vitrine.functions.cleaning import safe_bool, safe_date, safe_long, strip_variation_suffix, yes_no_to_boolean
from vitrine.operators import staging
from vitrine.operators.dedup import dedup_by_completeness
from vitrine.sources.ingest import normalize_header


def _key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_dedup_keeps_most_complete_and_is_order_independent(spark):
    data = [("k1", "a", None, None), ("k1", "a", "b", "c"), (" k1\t", None, None, None),
            ("k2", "x", "y", None), ("k2", "x", "z", None), ("  ", "q", "q", "q"), (None, "n", "n", "n")]
    df = spark.createDataFrame(data, "id string, a string, b string, c string")
    key = F.trim(F.col("id"), F.lit(" \t\n\r"))
    score = sum(F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in "abc")
    outs = [key.alias("id"), F.col("a").alias("a"), F.col("b").alias("b"), F.col("c").alias("c")]
    got = dedup_by_completeness(df, [key], score, outs, where=F.col("id").isNotNull() & (key != ""))
    assert rows(got, "id", "a", "b", "c") == [("k1", "a", "b", "c"), ("k2", "x", "y", None)]
    shuffled = dedup_by_completeness(df.repartition(3).orderBy(F.rand(7)), [key], score, outs,
                                     where=F.col("id").isNotNull() & (key != ""))
    assert rows(shuffled, "id", "a", "b", "c") == rows(got, "id", "a", "b", "c")


def test_stg_clients_untrimmed_partition(spark):
    cols = ["id_client", "prenom_client", "nom_client", "email", "age", "genre", "frequence_visites",
            "numero_telephone", "favoris", "adresse_ip"]
    data = [("A", "p", "n", "e", "30", "F", "2", "t", "P1", "ip"),
            (" A", "p", "n", None, None, None, None, None, None, None),
            ("B", None, "n", "e", "30", "F", "2", "t", "P1", "ip"),
            ("C", "", "n", "e", "x", "F", "2", "t", "P1", "ip")]
    got = staging.stg_clients(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)))
    assert rows(got, "id_client", "prenom_client", "age") == [("A", "p", 30), ("A", "p", None), ("C", "", None)]


def test_stg_details_yes_no_and_quantity(spark):
    data = [("o1", "p1", "3", " OUI "), ("o1", "p2", "3.0", "non"), ("o1", "p3", "x", "maybe"),
            ("o1", "p4", None, None), ("o1", "p1", None, None)]
    got = staging.stg_details_commandes(
        spark.createDataFrame(data, "id_commande string, id_produit string, quantite string, emballage_special string"))
    assert rows(got, "id_produit", "quantite", "emballage_special") == [
        ("p1", 3, True), ("p2", None, False), ("p3", None, None), ("p4", None, None)]


def test_stg_machine_year_month(spark):
    cols = ["id", "id_machine", "id_entrepot", "type_machine", "etat_machine", "temps_d_arret", "volume_traite", "mois"]
    base = ["M1", "E1", "T", "En panne", "1", "2"]
    data = [("i1", *base, "2024-03"), ("i2", *base, " 2024-03 "), ("i3", *base, "2024-3"), ("i4", *base, "03-2024"),
            ("i5", *base, None), ("i6", *base, "2023-12"), ("i6", *base, "2024-01")]
    got = staging.stg_entrepots_machine(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)))
    assert rows(got, "id", "mois", "annee") == [("i1", 3, 2024), ("i2", 3, 2024), ("i6", 1, 2024)]


def test_strip_variation_suffix(spark):
    data = [("Mug - Red", "Red"), ("Mug-Red", "Red"), ("Mug (L) - a.b", "a.b"), ("Mug - axb", "a.b"),
            ("Mug - Red", None), ("A - B - Red", "Red"), ("Cup  -\tBlue", "Blue")]
    df = spark.createDataFrame(data, "p string, v string")
    got = [r[0] for r in df.select(strip_variation_suffix(F.col("p"), F.col("v"))).collect()]
    assert got == ["Mug", "Mug", "Mug (L)", "Mug - axb", "Mug - Red", "A - B", "Cup"]


def test_stg_produits_filters(spark):
    cols = ["id", "categorie", "marque", "produit", "prix", "sous-categorie", "variation"]
    data = [("P1", "c", "m", "Mug - Red", "9.5", "s", "Red"), ("P2", "c", "m", "Pen", None, "s", None),
            ("P3", "c", "m", "Cap", "abc", "s", None)]
    got = staging.stg_produits(spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols)))
    assert rows(got, "id", "produit", "prix") == [("P1", "Mug", 9.5), ("P3", "Cap", None)]


def test_safe_casts(spark):
    df = spark.createDataFrame([("true",), ("FALSE",), ("1",), ("oui",), ("2024-01-05",), ("2024",),
                                ("2024-13-01",), ("",), ("12",), ("4.0",)], "s string")
    got = df.select(safe_bool(F.col("s")).alias("b"), safe_date(F.col("s")).alias("d"),
                    safe_long(F.col("s")).alias("l"), yes_no_to_boolean(F.col("s")).alias("y")).collect()
    assert [r.b for r in got] == [True, False, None, None, None, None, None, None, None, None]
    assert [r.d for r in got][4:8] == [dt.date(2024, 1, 5), None, None, None]
    assert [r.l for r in got][8:] == [12, None]
    assert [r.y for r in got][:4] == [None, None, None, True]


def test_normalize_headers():
    assert normalize_header("Prénom client") == "prenom client"
    assert normalize_header("Coût/Jour") == "coût_jour"
    assert normalize_header("Sous-Categorie") == "sous-categorie"
    assert normalize_header("  Id.Client ") == "id_client"
    assert normalize_header("Écart") == "écart"
