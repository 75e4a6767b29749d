"""The raw source catalogue: ten named raw tables with their descriptions and columns.

Raw columns are strings (the staging models type them).  `register_sources`
exposes the loaded raw tables as temporary views under their catalogue names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from vitrine.sources.raw_fixtures import RAW_SPECS
from vitrine.sources.store import read_table

DESCRIPTIONS = {
    "raw_produits": "Product catalogue",
    "raw_clients": "Customers and their wishlists",
    "raw_campaigns": "Advertising campaigns",
    "raw_entrepots": "Warehouses",
    "raw_details_commandes": "Order lines",
    "raw_commandes": "Orders",
    "raw_entrepots_machine": "Machine interventions by warehouse and month",
    "raw_promotions": "Promotions by product",
    "raw_posts": "Social media mentions",
    "raw_satisfaction": "Customer reviews of orders",
}


def raw_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in RAW_SPECS[table].columns])


SOURCES: dict[str, StructType] = {t: raw_schema(t) for t in RAW_SPECS}


def register_sources(spark: SparkSession, raw_dir: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Temp views over the raw Parquet tables written by the ingest (one target per table); by default all ten."""
    out = {}
    for table in SOURCES if tables is None else tables:
        df = read_table(spark, f"{raw_dir.rstrip('/')}/{table}")
        df.createOrReplaceTempView(table)
        out[table] = df
    return out
