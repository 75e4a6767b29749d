"""Raw, dirty CSV-shaped tables derived from the test tables.

The staging models clean the retailer's raw exports.  To exercise them over
the whole test data, every staging-shaped table of sources/testdata.py is
turned back into strings and dirtied with fixed rules driven by the row's key
number `k` (the digits of its business key):

* base rows: every row; text fields padded with blanks when k % 7 = 0 and
  followed by a tab when k % 11 = 0;
* a less complete duplicate when k % 4 = 0 (non-key fields NULL when
  k % 8 = 0, empty otherwise) - it must lose the completeness contest;
* an equally complete duplicate when k % 9 = 0, one text field suffixed with
  'Z' - the deterministic tie-break decides;
* a copy with a NULL key when k % 50 = 1 and a blank key when k % 50 = 2 -
  dropped by the row filters.

The same rules are written independently in SQL for the oracle.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.sources import testdata
from vitrine.sources.ingest import scratch_dir


@dataclass(frozen=True)
class RawSpec:
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    text: tuple[str, ...]
    alt: str


RAW_SPECS: dict[str, RawSpec] = {
    "raw_campaigns": RawSpec(
        ("id_campagne", "date", "evenement_oui_non", "evenement_type", "canal", "budget", "impressions", "clics",
         "conversions", "ctr"), ("id_campagne",), ("evenement_oui_non", "evenement_type", "canal"), "evenement_type"),
    "raw_clients": RawSpec(
        ("id_client", "prenom_client", "nom_client", "email", "age", "genre", "frequence_visites",
         "numero_telephone", "favoris", "adresse_ip"), ("id_client",),
        ("prenom_client", "nom_client", "email", "genre", "numero_telephone", "adresse_ip"), "email"),
    "raw_commandes": RawSpec(
        ("id_commande", "id_client", "id_entrepot_depart", "date_commande", "statut_commande",
         "id_promotion_appliquee", "mode_de_paiement", "numero_tracking", "date_livraison_estimee"),
        ("id_commande",), ("id_client", "statut_commande", "mode_de_paiement", "numero_tracking"), "numero_tracking"),
    "raw_details_commandes": RawSpec(
        ("id_commande", "id_produit", "quantite", "emballage_special"), ("id_commande", "id_produit"),
        ("emballage_special",), "emballage_special"),
    "raw_entrepots": RawSpec(
        ("id_entrepot", "localisation", "capacite_max", "volume_stocke", "taux_remplissage",
         "temperature_moyenne_entrepot"), ("id_entrepot",), ("localisation",), "localisation"),
    "raw_entrepots_machine": RawSpec(
        ("id", "id_machine", "id_entrepot", "type_machine", "etat_machine", "temps_d_arret", "volume_traite", "mois"),
        ("id",), ("id_machine", "id_entrepot", "type_machine", "etat_machine", "mois"), "type_machine"),
    "raw_posts": RawSpec(
        ("id_post", "date_post", "canal_social", "volume_mentions", "sentiment_global", "contenu_post"),
        ("id_post",), ("canal_social", "sentiment_global", "contenu_post"), "contenu_post"),
    "raw_produits": RawSpec(
        ("id", "categorie", "marque", "produit", "prix", "sous-categorie", "variation"), ("id",),
        ("categorie", "marque", "produit", "sous-categorie", "variation"), "marque"),
    "raw_promotions": RawSpec(
        ("id_promotion", "id_produit", "type_promotion", "valeur_promotion", "date_debut", "date_fin",
         "responsable_promotion"), ("id_promotion", "id_produit"), ("type_promotion", "responsable_promotion"),
        "responsable_promotion"),
    "raw_satisfaction": RawSpec(
        ("id_satisfaction", "id_commande", "note_client", "commentaire", "plainte", "temps_reponse_support",
         "type_plainte", "employe_support"), ("id_satisfaction",),
        ("commentaire", "type_plainte", "employe_support"), "employe_support"),
}


def _strings(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    return df.select(*[expr.cast("string").alias(name) for name, expr in mapping.items()])


def _base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    col = F.col
    if table == "raw_campaigns":
        s = testdata.stg_campaigns(spark, sf_dir)
        return _strings(s, {n: col(n) for n in RAW_SPECS[table].columns[:-1]} | {"ctr": col("CTR")})
    if table == "raw_clients":
        return _strings(testdata.stg_clients(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    if table == "raw_commandes":
        return _strings(testdata.stg_commandes(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    if table == "raw_details_commandes":
        s = testdata.stg_details_commandes(spark, sf_dir)
        return _strings(s, {"id_commande": col("id_commande"), "id_produit": col("id_produit"),
                            "quantite": col("quantite"),
                            "emballage_special": F.when(col("emballage_special"), "oui").otherwise("non")})
    if table == "raw_entrepots":
        return _strings(testdata.stg_entrepots(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    if table == "raw_entrepots_machine":
        s = testdata.stg_entrepots_machine(spark, sf_dir)
        m = {n: col(n) for n in RAW_SPECS[table].columns[:-1]}
        m["mois"] = F.concat(col("annee").cast("string"), F.lit("-"), F.lpad(col("mois").cast("string"), 2, "0"))
        return _strings(s, m)
    if table == "raw_posts":
        return _strings(testdata.stg_posts(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    if table == "raw_produits":
        s = testdata.stg_produits(spark, sf_dir)
        k = F.regexp_extract(col("id"), "[0-9]+", 0).cast("long")
        named = F.when((k % 3 == 0) & col("variation").isNotNull(),
                       F.concat(col("produit"), F.lit(" - "), col("variation"))).otherwise(col("produit"))
        return _strings(s, {"id": col("id"), "categorie": col("categorie"), "marque": col("marque"),
                            "produit": named, "prix": col("prix"), "sous-categorie": col("sous_categorie"),
                            "variation": col("variation")})
    if table == "raw_promotions":
        return _strings(testdata.stg_promotions(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    if table == "raw_satisfaction":
        return _strings(testdata.stg_satisfaction(spark, sf_dir), {n: col(n) for n in RAW_SPECS[table].columns})
    raise KeyError(table)


def _key_number(keys) -> Column:
    out = F.lit(0).cast("long")
    for k in keys:
        out = out + F.coalesce(F.regexp_extract(F.col(f"`{k}`"), "[0-9]+", 0).try_cast("long"), F.lit(0))
    return out


def dirty(base: DataFrame, spec: RawSpec) -> DataFrame:
    """The dirty rows of `base` in one pass: a row leaves as its copies' numbers, and each copy takes its own values.

    0: the base row; 1: the less complete duplicate; 2: the equally complete one; 3: the copy without a key.
    """
    k, copy = F.col("_k"), F.col("_copy")
    first = spec.keys[0]
    # one literal array per combination of the rules, so that a row's copies are looked up
    rules = (F.when(k % 4 == 0, 1).otherwise(0) + F.when(k % 9 == 0, 2).otherwise(0)
             + F.when((k % 50 == 1) | (k % 50 == 2), 4).otherwise(0))
    copies = F.array(F.lit(0))
    for m in range(1, 8):
        numbers = [0] + [i + 1 for i in range(3) if m >> i & 1]
        copies = F.when(F.col("_rules") == m, F.array(*[F.lit(n) for n in numbers])).otherwise(copies)

    def q(n):
        return F.col(f"`{n}`")

    def padded(n):
        if n not in spec.text and n not in spec.keys:
            return q(n)
        return (F.when((k % 7 == 0) & q(n).isNotNull(), F.concat(F.lit("  "), q(n), F.lit(" ")))
                .when((k % 11 == 0) & q(n).isNotNull(), F.concat(q(n), F.lit("\t")))
                .otherwise(q(n)))

    def value(n):
        emptied = q(n) if n in spec.keys else F.when(k % 8 != 0, F.lit(""))
        again = F.concat(q(n), F.lit("Z")) if n == spec.alt else q(n)
        keyless = F.when(k % 50 == 2, F.lit("   ")) if n == first else q(n)
        return F.when(copy == 0, padded(n)).when(copy == 1, emptied).when(copy == 2, again).otherwise(keyless).alias(n)

    numbered = base.withColumn("_k", _key_number(spec.keys)).withColumn("_rules", rules).withColumn("_copy", F.explode(copies))
    return numbered.select(*[value(n) for n in spec.columns])


_RAW_CACHE: dict[tuple[int, str, str], DataFrame] = {}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The dirty raw table, materialised once per session like an export at rest.

    The stored table (Parquet under the shared checkpoint folder) also keeps the
    optimizer from pushing a staging model's filters into this derivation, where
    they would run once per source row instead of once per raw row.  It is stored
    as it is, so that a split of the file holds rows in proportion to its size.
    """
    key = (id(spark), sf_dir, table)
    cached = _RAW_CACHE.get(key)
    if cached is None or cached.sparkSession is not spark:
        made = dirty(_base(spark, sf_dir, table), RAW_SPECS[table])
        target = f"{scratch_dir(spark, 'raw-export')}/{table}"
        made.write.options(**{"compression": "none", "parquet.enable.dictionary": "false"}).parquet(target)
        cached = spark.read.schema(made.schema).parquet(target)
        _RAW_CACHE[key] = cached
    return cached


def raw_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of the raw table for a reader that goes over all of them once, as an export does: stored ones if
    the session has them, else as they are derived, so that no second copy of the export is kept."""
    cached = _RAW_CACHE.get((id(spark), sf_dir, table))
    if cached is not None and cached.sparkSession is spark:
        return cached
    return dirty(_base(spark, sf_dir, table), RAW_SPECS[table])


def raw_tables(spark: SparkSession, sf_dir: str, at_once: int = 4) -> dict[str, DataFrame]:
    """All ten raw tables, `at_once` made at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        made = pool.map(inheritable_thread_target(spark)(lambda t: raw_table(spark, sf_dir, t)), RAW_SPECS)
        return dict(zip(RAW_SPECS, made))
