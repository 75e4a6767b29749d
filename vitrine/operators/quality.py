"""Declarative data-quality checks, re-aimed as Spark jobs that count violations.

The reference declares column tests in YAML and runs them after the build.
Here a report over any number of them is one job that reads every model once:

* unique:        values (non-null) that occur more than once;
* not_null:      rows whose value is NULL;
* relationships: child rows whose non-null value has no parent row.

Every model sends its checked values, tagged with what they are checked for, into
one union.  A tag is a domain (a key column, or a parent key with its children)
and a slot in it (0 the key itself, 1.. the child columns); one aggregate per
(domain, value) counts the slots side by side, and the violations of all checks
are sums over its rows.  The aggregate is map-side combined, so a hot value
leaves a task as one row.  Violations are reported, never fixed.  Values meet as
text, so a child must write its key like its parent.

`dq_build_report` has counts of another kind, taken while models are built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                     # unique | not_null | relationships
    to_model: str | None = None
    to_column: str | None = None


def _u(model, column):
    return [Check(model, column, "unique")]


def _un(model, column):
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


def _rel(model, column, to_model, to_column):
    return [Check(model, column, "relationships", to_model, to_column)]


# The reference's declarations, bound to the models that exist (four declared
# names do not: dim_produit, facts_entrepots_machines, facts_campagnes /
# id_campagne and fact_commandes are bound to dim_produits,
# facts_entrepots_machine, facts_campaigns / id_campaign and facts_commandes).
DECLARED_CHECKS: tuple[Check, ...] = tuple(
    _un("dim_clients", "id_client")
    + _un("dim_entrepots", "id_entrepot")
    + _un("dim_machine", "id_machine")
    + _un("dim_date", "id_date")
    + _un("dim_canal", "id_canal")
    + _un("dim_produits", "id_produit")
    + _u("dim_satisfaction", "id_satisfaction")
    + _rel("dim_satisfaction", "id_commande", "facts_commandes", "id_commande")
    + _un("dim_promotions", "id_promotion")
    + _rel("dim_promotions", "id_produit", "dim_produits", "id_produit")
    + _rel("dim_promotions", "id_date_debut", "dim_date", "id_date")
    + _rel("dim_promotions", "id_date_fin", "dim_date", "id_date")
    + _un("dim_details_commandes", "id")
    + _rel("dim_details_commandes", "id_details_produits", "dim_produits", "id_produit")
    + _rel("dim_details_commandes", "id_commande", "facts_commandes", "id_commande")
    + _un("facts_entrepots_machine", "id_intervention_machine")
    + _rel("facts_entrepots_machine", "id_entrepot", "dim_entrepots", "id_entrepot")
    + _rel("facts_entrepots_machine", "id_machine", "dim_machine", "id_machine")
    + _un("facts_posts", "id_post")
    + _rel("facts_posts", "id_canal", "dim_canal", "id_canal")
    + _rel("facts_posts", "id_date", "dim_date", "id_date")
    + _un("facts_campaigns", "id_campaign")
    + _rel("facts_campaigns", "id_canal_dim_canal", "dim_canal", "id_canal")
    + _un("facts_commandes", "id_commande")
    + _rel("facts_commandes", "id_client", "dim_clients", "id_client")
    + _rel("facts_commandes", "id_promotion", "dim_promotions", "id_promotion")
    + _rel("facts_commandes", "id_entrepot", "dim_entrepots", "id_entrepot")
    + _rel("facts_commandes", "id_date_commande", "dim_date", "id_date")
    + _rel("facts_commandes", "id_date_livraison", "dim_date", "id_date")
)


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Failing values: (value, occurrences) for non-null values seen more than once."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1))


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """Failing rows: those whose `column` is NULL."""
    return df.where(F.col(column).isNull())


def dq_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Orphan child values: (value, occurrences) with no parent row."""
    values = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("occurrences")))
    keys = parent.select(F.col(field).alias("value")).distinct()
    return values.join(keys, "value", "left_anti")


def _domains(checks: list[Check]) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """(model, column) of a key -> the columns counted in its domain: the key itself, then the children that refer to it."""
    out: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for c in checks:
        own = (c.model, c.column)
        key = (c.to_model, c.to_column) if c.test == "relationships" else own
        slots = out.setdefault(key, [key])
        if own not in slots:
            slots.append(own)
    return out


def _tagged(df: DataFrame, tags: list[tuple[int, int, str]]) -> DataFrame:
    """One pass over a model: domain, slot, value for every tagged column of every row."""
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(s).alias("slot"), F.col(c).cast("string").alias("value")) for d, s, c in tags])
    return df.select(F.explode(rows).alias("t")).select("t.*")


def _violations(check: Check, domain: int, slots: list[tuple[str, str]]) -> Column:
    here, value, key = F.col("domain") == domain, F.col("value"), F.coalesce("n0", F.lit(0))
    if check.test == "unique":
        return F.count_if(here & value.isNotNull() & (key > 1))
    if check.test == "not_null":
        return F.sum(F.when(here & value.isNull(), key))
    own = F.col(f"n{slots.index((check.model, check.column))}")
    return F.sum(F.when(here & value.isNotNull() & (key == 0), own))


def dq_report(models: dict[str, DataFrame], checks=DECLARED_CHECKS, test: str | None = None) -> DataFrame:
    """All declared checks (optionally one test type), one row each: model, column_name, test, violations."""
    selected = [c for c in checks if test is None or c.test == test]
    unknown = {c.test for c in selected} - {"unique", "not_null", "relationships"}
    if unknown:
        raise ValueError(f"unknown tests {sorted(unknown)}")
    domains = _domains(selected)
    tags: dict[str, list[tuple[int, int, str]]] = {}
    for d, slots in enumerate(domains.values()):
        for s, (model, column) in enumerate(slots):
            tags.setdefault(model, []).append((d, s, column))
    parts = [_tagged(models[m], own) for m, own in tags.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    counts = rows.groupBy("domain", "value").agg(*[F.count(F.when(F.col("slot") == s, 1)).alias(f"n{s}") for s in range(max(map(len, domains.values())))])
    number = {key: d for d, key in enumerate(domains)}

    def found(c: Check) -> Column:
        key = (c.to_model, c.to_column) if c.test == "relationships" else (c.model, c.column)
        return F.coalesce(_violations(c, number[key], domains[key]), F.lit(0)).cast("long")

    one = counts.agg(*[found(c).alias(f"c{k}") for k, c in enumerate(selected)])
    lines = F.array(*[F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"), F.col(f"c{k}").alias("violations"))
                      for k, c in enumerate(selected)])
    return one.select(F.explode(lines).alias("r")).select("r.*")


def dq_build_report(star, root: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """What the models lose or cannot read, counted by the jobs that build them: (report, the models, stored under root).

    * promotion values that are neither a percentage nor an amount (their discount is NULL);
    * orders without a calendar day for their date, or for their estimated delivery (they are not in the fact);
    * wishlist elements without a product.

    The counts are observed metrics of the writes: no model is read a second time.
    """
    from vitrine.functions.pricing import unreadable_promotion
    from vitrine.operators import marts
    from vitrine.plans.sales import wishlist_matches
    from vitrine.sources.store import replace_table

    spark, models, lines = star.spark, {}, []

    def build(name: str, observed: DataFrame, finish, metrics: dict[str, tuple[str, Column]]) -> None:
        seen = Observation()
        counted = observed.observe(seen, *[F.coalesce(x, F.lit(0)).cast("long").alias(c) for c, (_, x) in metrics.items()])
        models[name] = replace_table(finish(counted), f"{root}/{name}")
        lines.extend((name, c, test, seen.get[c]) for c, (test, _) in metrics.items())

    build("dim_promotions", star.dim_promotions, lambda df: df, {"valeur_promotion": ("unreadable", F.count_if(unreadable_promotion(F.col("valeur_promotion"))))})
    build("facts_commandes", marts.orders_in_calendar(star.stg["stg_commandes"], star.cal),
          lambda df: df.where("date_commande IS NOT NULL AND date_livraison IS NOT NULL").drop("date_commande", "date_livraison"),
          {"id_date_commande": ("outside_calendar", F.count_if(F.col("id_date_commande").isNull())),
           "id_date_livraison": ("outside_calendar", F.count_if(F.col("id_date_livraison").isNull()))})
    build("wishlist", wishlist_matches(star), lambda df: df.where("id_produit IS NOT NULL"),
          {"favoris": ("unmatched", F.sum(F.when(F.col("id_produit").isNull(), F.col("nb_fois_ajoute"))))})
    return spark.createDataFrame(lines, "model string, column_name string, test string, violations long"), models
