"""Ingredients, cost and profit implied by a revenue forecast."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.constants import RECIPES, UNIT_COSTS
from demandcast.functions.columns import title_name
from demandcast.session import local_table


def recipe_table(spark: SparkSession, recipes: Mapping[str, Mapping[str, float]] = RECIPES) -> DataFrame:
    rows = [(p, i, float(q)) for p, parts in recipes.items() for i, q in parts.items()]
    return local_table(spark, rows, product=pa.string(), ingredient=pa.string(), qty=pa.float64())


def cost_table(spark: SparkSession, costs: Mapping[str, float] = UNIT_COSTS) -> DataFrame:
    rows = [(i, float(c)) for i, c in costs.items()]
    return local_table(spark, rows, ingredient=pa.string(), unit_cost=pa.float64())


def last_prices(df: DataFrame, time: str = "datetime", product: str = "product", price: str = "amount") -> DataFrame:
    """Latest known price per product (a running maximum, so it combines map-side)."""
    known = df.where(F.col(price).isNotNull() & F.col(time).isNotNull())
    raw = known.groupBy(product).agg(F.max(F.struct(F.col(time), F.col(price))).alias("_p"))
    # Spellings of one product meet after the heavy step.
    return raw.groupBy(title_name(product).alias(product)).agg(F.max("_p").getField(price).alias("unit_price"))


def supply_detail(forecasts: DataFrame, prices: DataFrame, recipes: DataFrame, costs: DataFrame,
                  product: str = "product") -> DataFrame:
    """Units, ingredient quantities and cost per product and ingredient.

    Forecasts sum to one row per product before they meet the dimensions. Products without a
    recipe or a positive price drop out; an ingredient without a cost counts as free. The
    dimensions carry no broadcast hint: the planner checks their size.
    """
    demand = forecasts.groupBy(title_name(product).alias(product)).agg(F.sum("forecast").alias("revenue"))
    names = recipes.withColumn(product, title_name("product"))
    parts = demand.join(prices.where(F.col("unit_price") > 0), product).join(names, product).join(
        costs, "ingredient", "left")
    units = F.col("revenue") / F.col("unit_price")
    qty = units * F.col("qty")
    cost = F.coalesce("unit_cost", F.lit(0.0))
    return parts.select(
        product, F.round(units, 2).alias("units"), "ingredient", F.round(qty, 2).alias("quantity"),
        cost.alias("unit_cost"), F.round(qty * cost, 2).alias("total_cost"), "revenue")


def supply_summary(detail: DataFrame) -> DataFrame:
    """Need and cost per ingredient, summing the rounded detail rows."""
    return detail.groupBy("ingredient").agg(F.sum("quantity").alias("quantity"), F.sum("total_cost").alias("total_cost"))


def finance_summary(detail: DataFrame, product: str = "product") -> DataFrame:
    """Cost, revenue of the matched products, profit, gross margin and break-even revenue."""
    each = detail.groupBy(product).agg(F.sum("total_cost").alias("c"), F.max("revenue").alias("r"))
    total = each.agg(F.coalesce(F.sum("c"), F.lit(0.0)).alias("total_cost"),
                     F.coalesce(F.sum("r"), F.lit(0.0)).alias("revenue"))
    return total.withColumns({
        "profit": F.col("revenue") - F.col("total_cost"),
        "gross_margin_pct": F.try_divide(F.col("revenue") - F.col("total_cost"), F.col("revenue")) * 100.0,
        "break_even_revenue": F.col("total_cost"),
    })
