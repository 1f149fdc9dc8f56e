"""Quotes derived from the order tables, in the shape of a raw quote file.

The tables have no price quotes, so each line item stands for one quote. Defects that the
cleaning has to find (padded labels, alias spellings, missing labels, text in numeric columns,
unreadable dates, impossible prices, outliers) are planted by rule.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.config import PanelConfig

# Roles of the part types in the derived quotes.
FIXTURE_CONFIG = PanelConfig(
    date_formats=("yyyy-MM-dd",),
    state_aliases={f"NATN_{k}": f"NATION_{k}" for k in range(12)},
    dropped_commodity="Medium",
    reference_prices={"promo": 40000.0},
    all_commodities=("ECONOMY", "STANDARD", "PROMO", "SMALL"),
    scope=("ECONOMY", "STANDARD"),
    gap_commodities=("PROMO", "SMALL"),
    expected_years=(1995, 2001),
)

PROMO_END = datetime.date(1997, 6, 1)
SMALL_END = datetime.date(1998, 3, 1)


def _cents(amount: Column) -> Column:
    return (F.floor(amount * 100 + 0.5) / 100).cast("string")


def raw_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Ten text columns, one row per line item of the tables in ``folder``."""

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    places = (
        table("supplier", "s_suppkey", "s_nationkey")
        .join(table("nation", "n_nationkey", "n_name", "n_regionkey"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region", "r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = table(
        "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    ).withColumn("ship_date", F.to_date("l_shipdate"))
    base = (
        lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("part", "p_partkey", "p_type", "p_brand"),
              F.col("l_partkey") == F.col("p_partkey"))
        .where(~((F.col("p_type") == "PROMO") & (F.col("ship_date") >= F.lit(PROMO_END))))
        .where(~((F.col("p_type") == "SMALL") & (F.col("ship_date") >= F.lit(SMALL_END))))
    )

    line = F.col("l_linenumber")
    price = F.when(F.col("l_partkey") % 97 == 0, 10.0).otherwise(1.0) * F.col("l_extendedprice")
    alias = F.concat(F.lit("NATN_"), F.col("n_nationkey").cast("string"))
    return base.select(
        F.when(line == 1, F.concat(F.lit(" "), "n_name"))
        .when((line == 2) & (F.col("n_nationkey") < 12), alias)
        .otherwise(F.col("n_name")).alias("state"),
        F.col("r_name").alias("district_name"),
        F.concat(F.lit("MKT_"), F.col("l_suppkey").cast("string")).alias("market_name"),
        F.when(F.col("l_partkey") % 101 != 0, F.col("p_type")).alias("commodity"),
        F.col("p_brand").alias("variety"),
        F.col("l_returnflag").alias("grade"),
        F.when(F.col("l_quantity") == 50, F.lit("0"))
        .otherwise(_cents(price * (1 - F.col("l_discount")))).alias("min_price"),
        _cents(price * (F.lit(0.98) + F.col("l_tax"))).alias("max_price"),
        F.when((line == 7) & (F.col("l_discount") == 0.05), F.lit("n/a"))
        .otherwise(_cents(price * 0.99)).alias("modal_price"),
        F.when((line == 6) & (F.col("l_tax") == 0.08), F.lit("not-a-date"))
        .otherwise(F.col("ship_date").cast("string")).alias("price_date"),
    )
