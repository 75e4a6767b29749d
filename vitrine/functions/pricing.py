"""Column expressions shared by the sales and marketing KPIs.

All are built-in Spark expressions (they stay inside whole-stage codegen).
Money is carried as DECIMAL so that sums are exact and independent of the
order in which partitions are combined; results are rounded and only then
turned into DOUBLE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.fixed_values import CANCELLED_STATUSES, PERIOD_LABELS_30D, PERIOD_OTHER_30D
from vitrine.fixed_values import PROMO_TYPE_FIXED as FIXED_TYPE
from vitrine.fixed_values import PROMO_TYPE_PERCENT as PERCENT_TYPE

PRICE = "decimal(18,6)"        # catalogue price, unrounded
UNIT = "decimal(26,12)"        # a unit price after discount (exact: 6 + 4 + 2 decimals)
QTY = "decimal(11,0)"          # quantities entering a money product
PCT = "decimal(9,4)"           # a percentage such as 12.5
AMOUNT = "decimal(18,6)"       # a fixed discount amount such as 10.50


def not_cancelled(status: Column) -> Column:
    """LOWER(status) NOT IN ('annulée', 'cancelled'); a NULL status is dropped too."""
    return ~F.lower(status).isin(*CANCELLED_STATUSES)


def price(col: Column) -> Column:
    return col.cast(PRICE)


def promo_value_is_percent(valeur: Column) -> Column:
    return valeur.rlike("%$")


def promo_percent(valeur: Column) -> Column:
    return F.regexp_replace(valeur, "%", "").try_cast(PCT)


def promo_amount(valeur: Column) -> Column:
    """'€10.00' -> 10.00, '€10,50' -> 10.50 (euro sign removed, comma as decimal point)."""
    return F.regexp_replace(F.regexp_replace(valeur, "€", ""), ",", ".").try_cast(AMOUNT)


def unreadable_promotion(valeur: Column) -> Column:
    """A promotion value that is there but is neither a percentage nor an amount."""
    return valeur.isNotNull() & F.when(promo_value_is_percent(valeur), promo_percent(valeur).isNull()).otherwise(promo_amount(valeur).isNull())


def discounted_price(prix: Column, valeur: Column) -> Column:
    """Catalogue price after the promotion value, floored at 0.

    A value ending in '%' is a percentage, anything else an amount.  An
    unparsable value gives NULL (the line then adds nothing), and so does a
    NULL value: unlike Spark's GREATEST, the floor propagates NULL.
    """
    p = price(prix)
    pct_price = ((p * (F.lit(100) - promo_percent(valeur))) * F.lit(Decimal("0.01"))).cast(UNIT)
    amount_price = (p - promo_amount(valeur)).cast(UNIT)
    raw = F.when(promo_value_is_percent(valeur), pct_price).otherwise(amount_price)
    return F.when(raw.isNull(), F.lit(None).cast(UNIT)).otherwise(F.greatest(raw, F.lit(0).cast(UNIT)))


def effective_price(prix: Column, valeur: Column, on: Column, start: Column, end: Column) -> Column:
    """Discounted price when `on` lies in [start, end], catalogue price otherwise."""
    return F.when(on.between(start, end), discounted_price(prix, valeur)).otherwise(price(prix).cast(UNIT))


def discounted_price_by_type(prix: Column, type_promotion: Column, valeur: Column) -> Column:
    """Variant driven by the promotion type ('Remise fixe' / 'Pourcentage' / other = price).

    '%' and '€' are stripped, the comma is *not* converted (so '10,50' is NULL),
    and there is no floor at 0.
    """
    p = price(prix)
    v = F.regexp_replace(valeur.cast("string"), "[%€]", "")
    return (F.when(type_promotion == FIXED_TYPE, (p - v.try_cast(AMOUNT)).cast(UNIT))
            .when(type_promotion == PERCENT_TYPE, ((p * (F.lit(100) - v.try_cast(PCT))) * F.lit(Decimal("0.01"))).cast(UNIT))
            .otherwise(p.cast(UNIT)))


def money(qty: Column, unit_price: Column) -> Column:
    """qty * unit price as an exact DECIMAL(38,12)."""
    return qty.cast(QTY) * unit_price.cast(UNIT)


def round_money(total: Column, digits: int = 2) -> Column:
    return F.round(total, digits).cast("double")


def promo_period_label(on: Column, start: Column, end: Column, days: int,
                       labels=PERIOD_LABELS_30D, other: str = PERIOD_OTHER_30D,
                       before_end: Column | None = None) -> Column:
    """Label of `on` against a promotion: [start-days, start-1], [start, end], [end+1, end+days].

    `before_end` overrides the end of the "before" window (the reference's
    sales_promo_sensitivity ends it at end - 1).
    """
    b_end = before_end if before_end is not None else F.date_sub(start, 1)
    return (F.when(on.between(F.date_sub(start, days), b_end), labels[0])
            .when(on.between(start, end), labels[1])
            .when(on.between(F.date_add(end, 1), F.date_add(end, days)), labels[2])
            .otherwise(other))


def with_display_name(products: DataFrame, name_col: str = "produit", out: str = "produit",
                      price_col: str = "prix", variation_col: str = "variation") -> DataFrame:
    """Add `out` = 'name - variation' when the name has several prices and a variation.

    COUNT(DISTINCT prix) OVER (PARTITION BY name) is not available as a window
    in Spark; it is an aggregate per name joined back on the name.
    """
    per_name = (products.groupBy(name_col)
                .agg(F.countDistinct(price_col).alias("_nb_prix")))
    joined = products.join(per_name, name_col)
    name = F.when((F.col("_nb_prix") > 1) & F.col(variation_col).isNotNull(),
                  F.concat(F.col(name_col), F.lit(" - "), F.col(variation_col))).otherwise(F.col(name_col))
    return joined.withColumn(out, name).drop("_nb_prix")


def round_ratio(x: Column, digits: int = 2) -> Column:
    """Round a DOUBLE half-up through its decimal form, then back to DOUBLE."""
    return F.round(x.cast("double").cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE on DOUBLE: NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def conditional_pivot(df: DataFrame, keys: list[str], label_col: str, value_col: str,
                      labels: dict[str, str], default=0) -> DataFrame:
    """One column per label: MAX(IF(label = x, value, default)) grouped by `keys`."""
    dtype = df.schema[value_col].dataType
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(label_col) == lab, F.col(value_col)).otherwise(F.lit(default).cast(dtype))).alias(out)
        for out, lab in labels.items()])
