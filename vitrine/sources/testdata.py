"""Map the driver's test tables onto staging-shaped retail tables.

The reference ships no data.  FIXTURES.md section 2 fixes how the generic test
tables (part, orders, lineitem, customer, supplier, nation, events) stand in
for the ten cleaned staging tables; the star schema and every KPI are then
built by the library's own builders, exactly as they would be from the
retailer's CSV exports.  The modulo rules below decide *which* synthetic
attribute a row gets; every row of every input table is read and mapped (the
event type decides whether an event is a post or a campaign).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the mapping (FIXTURES.md section 2).
PROMO_EPOCH = "1995-01-01"  # promotions are dated from this day
EVENT_DAY_SHIFT = 8766  # moves January 2024 onto January 2000, inside the order range
COMMENTS = ("Delivery took too long.", "Product arrived damaged.", "Very happy with the service.",
            "Average quality, not great.", "Great experience.", "Too long a wait")
SENTIMENTS = ("Positif", "Neutre", "Négatif")
MACHINE_STATES = ("En panne", "En maintenance")
MACHINE_TYPES = ("Convoyeur", "Trieuse", "Chariot")
PAYMENT_MODES = ("Carte", "PayPal", "Virement")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _pick(key: Column, values: tuple, default=None) -> Column:
    """CASE key WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... END."""
    expr = F.lit(default)
    for i in reversed(range(len(values))):
        expr = F.when(key == i, F.lit(values[i])).otherwise(expr)
    return expr


def supplier_count(spark: SparkSession, sf_dir: str) -> Column:
    """Number of warehouses, as a scalar subquery (one value, no join)."""
    return read_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of orders, their deliveries and events: one aggregate over each table."""
    day = F.col("o_orderdate").cast("date")
    orders = read_table(spark, sf_dir, "orders").select(day.alias("low"), F.date_add(day, (F.col("o_orderkey") % 10 + 1).cast("int")).alias("high"))
    events = read_table(spark, sf_dir, "events").select(_event_date().alias("low"), _event_date().alias("high"))
    low, high = orders.unionByName(events).agg(F.min("low"), F.max("high")).first()
    return low.isoformat(), high.isoformat()


def product_id(key: Column) -> Column:
    # Zero-padded to at least five digits, never truncated (keys stay unique at any scale).
    return F.format_string("P%05d", key)


def stg_produits(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    # Every 50th part has a sister product that no order line names (never sold).
    ids = F.when(F.col("p_partkey") % 50 == 7, F.array(product_id(F.col("p_partkey")), F.concat(F.lit("N"), product_id(F.col("p_partkey")))))
    return p.withColumn("_id", F.explode(F.coalesce(ids, F.array(product_id(F.col("p_partkey")))))).select(
        F.col("_id").alias("id"),
        F.col("p_type").alias("categorie"),
        F.col("p_brand").alias("marque"),
        F.col("p_name").alias("produit"),
        F.col("p_retailprice").alias("prix"),
        F.col("p_type").alias("sous_categorie"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("V"), _s("p_size"))).alias("variation"),
    )


def stg_promotions(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    # Parts with k % 5 = 4 get dates long after the calendar: promotions that are never active.
    start = F.date_add(F.lit(PROMO_EPOCH).cast("date"), (k * 13 % 2300 + F.when(k % 5 == 4, 8000).otherwise(0)).cast("int"))
    first = p.select(
        F.format_string("PR%d-0", k).alias("id_promotion"),
        product_id(k).alias("id_produit"),
        F.when(k % 2 == 0, "Pourcentage").otherwise("Remise fixe").alias("type_promotion"),
        F.when(k % 2 == 0, F.concat(_s(5 + k % 40), F.lit("%")))
         .when(k % 3 == 0, F.lit("€10,50"))
         .otherwise(F.concat(F.lit("€"), _s(k % 20), F.lit(".00"))).alias("valeur_promotion"),
        start.alias("date_debut"),
        F.date_add(start, 45).alias("date_fin"),
        F.concat(F.lit("Equipe "), _s(k % 4)).alias("responsable_promotion"),
    )
    second = p.where(k % 20 == 0).select(
        F.format_string("PR%d-1", k).alias("id_promotion"),
        product_id(k).alias("id_produit"),
        F.lit("Pourcentage").alias("type_promotion"),
        F.lit("20%").alias("valeur_promotion"),
        F.date_add(start, 20).alias("date_debut"),
        F.date_add(start, 65).alias("date_fin"),
        F.concat(F.lit("Equipe "), _s(k % 4)).alias("responsable_promotion"),
    )
    return first.unionByName(second)


def stg_commandes(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    pending = F.col("o_orderstatus") == "P"
    warehouses = supplier_count(spark, sf_dir)
    return o.select(
        F.concat(F.lit("C"), _s(k)).alias("id_commande"),
        F.concat(F.lit("CL"), _s("o_custkey")).alias("id_client"),
        F.concat(F.lit("E"), _s(k % warehouses)).alias("id_entrepot_depart"),
        d.alias("date_commande"),
        F.when(pending & (k % 4 == 0), "Annulée").when(pending, "En transit").otherwise("Livrée")
         .alias("statut_commande"),
        F.lit(None).cast("string").alias("id_promotion_appliquee"),
        _pick(k % 3, PAYMENT_MODES).alias("mode_de_paiement"),
        F.concat(F.lit("T"), _s(k)).alias("numero_tracking"),
        F.date_add(d, (k % 10 + 1).cast("int")).alias("date_livraison_estimee"),
    )


def stg_details_commandes(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey", "l_partkey")
            .agg(F.max("l_quantity").cast("long").alias("quantite"),
                 (F.min("l_linenumber") == 1).alias("emballage_special"))
            .select(F.concat(F.lit("C"), _s("l_orderkey")).alias("id_commande"),
                    product_id(F.col("l_partkey")).alias("id_produit"),
                    "quantite", "emballage_special"))


def stg_clients(spark, sf_dir) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    # Number of catalogue products, as a scalar subquery (one value, no join).
    n_parts = read_table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("CL"), _s(k)).alias("id_client"),
        F.col("c_name").alias("prenom_client"),
        F.col("c_mktsegment").alias("nom_client"),
        F.concat(F.lit("client"), _s(k), F.lit("@example.com")).alias("email"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(15 + k % 60).cast("long").alias("age"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("genre"),
        (k % 12).cast("long").alias("frequence_visites"),
        F.concat(F.lit("TEL"), _s(k)).alias("numero_telephone"),
        F.concat(F.lit("P"), _s(k % n_parts), F.lit(",P"), _s((k * 7 + 1) % n_parts)).alias("favoris"),
        F.concat(F.lit("10.0."), _s(k % 256), F.lit(".1")).alias("adresse_ip"),
    )


def stg_satisfaction(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("S"), _s(k)).alias("id_satisfaction"),
        F.concat(F.lit("C"), _s(k)).alias("id_commande"),
        F.when(k % 33 == 0, F.lit(None)).otherwise(1 + k % 5).cast("long").alias("note_client"),
        _pick(k % 7, COMMENTS).alias("commentaire"),
        (k % 4 < 2).alias("plainte"),
        F.when(k % 21 == 0, F.lit(None)).otherwise(k % 31).cast("long").alias("temps_reponse_support"),
        _pick(k % 4, ("Retard", "Produit")).alias("type_plainte"),
        F.concat(F.lit("EMP"), _s(k % 5)).alias("employe_support"),
    )


def stg_entrepots(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(F.concat(F.lit("E"), _s(k)).alias("id_entrepot"),
                    F.col("n_name").alias("localisation"),
                    (1000 + 100 * k).cast("long").alias("capacite_max"),
                    (500 + 10 * k).cast("long").alias("volume_stocke"),
                    ((50 + k).cast("double") / 100).alias("taux_remplissage"),
                    (10 + k).cast("double").alias("temperature_moyenne_entrepot")))


def stg_entrepots_machine(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    warehouses = supplier_count(spark, sf_dir)
    # two machines for each warehouse
    agg = (li.groupBy(((F.col("l_suppkey") + F.col("l_linenumber") % 2 * warehouses) % (2 * warehouses)).alias("m"),
                      F.month(ship).alias("mo"), F.year(ship).alias("yr"))
           .agg(F.sum("l_linenumber").alias("arret"), F.sum("l_quantity").alias("vol")))
    m = F.col("m")
    return agg.select(
        F.concat(F.lit("I"), _s(m), F.lit("-"), _s("mo"), F.lit("-"), _s("yr")).alias("id"),
        F.concat(F.lit("M"), _s(m)).alias("id_machine"),
        F.concat(F.lit("E"), _s(m % warehouses)).alias("id_entrepot"),
        _pick(m % 3, MACHINE_TYPES).alias("type_machine"),
        _pick(m % 4, MACHINE_STATES, "En service").alias("etat_machine"),
        F.col("arret").cast("long").alias("temps_d_arret"),
        F.col("vol").cast("long").alias("volume_traite"),
        F.col("mo").cast("long").alias("mois"),
        F.col("yr").cast("long").alias("annee"),
    )


def _event_date() -> Column:
    return F.date_sub(F.col("ts").cast("date"), EVENT_DAY_SHIFT)


def stg_posts(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    d = _event_date()
    return e.where(F.col("event_type").isin("view", "click", "error")).select(
        F.concat(F.lit("POST"), _s("event_id")).alias("id_post"),
        d.alias("date_post"),
        F.col("event_type").alias("canal_social"),
        ((F.col("event_id") % 50) * F.when(F.dayofmonth(d) == 15, 10).otherwise(1)).cast("long")
        .alias("volume_mentions"),
        _pick(F.col("user_id") % 3, SENTIMENTS).alias("sentiment_global"),
        F.col("props").alias("contenu_post"),
    )


def stg_campaigns(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    even_user = F.col("user_id") % 2 == 0
    return e.where(F.col("event_type").isin("signup", "purchase")).select(
        F.concat(F.lit("CAMP"), _s("event_id")).alias("id_campagne"),
        _event_date().alias("date"),
        F.when(even_user, "oui").otherwise("non").alias("evenement_oui_non"),
        F.when(even_user, "Soldes").otherwise("Lancement").alias("evenement_type"),
        F.col("event_type").alias("canal"),
        F.col("value").alias("budget"),
        ((F.col("event_id") % 1000) * 10).cast("long").alias("impressions"),
        (F.col("event_id") % 1000).cast("long").alias("clics"),
        F.when(F.col("event_type") == "purchase", F.col("event_id") % 20).otherwise(0).cast("long")
        .alias("conversions"),
        ((F.col("event_id") % 100).cast("double") / 1000).alias("CTR"),
    )


STAGING_BUILDERS = {
    "stg_produits": stg_produits,
    "stg_promotions": stg_promotions,
    "stg_commandes": stg_commandes,
    "stg_details_commandes": stg_details_commandes,
    "stg_clients": stg_clients,
    "stg_satisfaction": stg_satisfaction,
    "stg_entrepots": stg_entrepots,
    "stg_entrepots_machine": stg_entrepots_machine,
    "stg_posts": stg_posts,
    "stg_campaigns": stg_campaigns,
}


def staging_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy staging-shaped DataFrames over the test tables."""
    return {name: build(spark, sf_dir) for name, build in STAGING_BUILDERS.items()}
