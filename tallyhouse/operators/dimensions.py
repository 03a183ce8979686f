"""Dimensions D1-D4."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.functions import aggregate, divided_if_positive, select


def dim_date(context: DataFrame) -> DataFrame:
    """One row per business date with its calendar parts; the week is the ISO week."""
    parts = {
        "year": "year",
        "month": "month",
        "quarter": "quarter",
        "weekofyear": "week_of_year",
        "dayofyear": "day_of_year",
    }
    return select(
        context,
        "business_date, day_name",
        *[f"{part}(business_date) as {name}" for part, name in parts.items()],
        "is_weekend, is_public_holiday, is_city_event, promotion_name, temperature_c, rain_mm",
    )


# Cost of one recipe line: quantity times unit cost, grossed up for wastage.
LINE_COST = "quantity_required * estimated_unit_cost * (1 + estimated_wastage_pct)"


def recipe_costs(recipes: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Bill-of-materials cost per menu item; items without a priced recipe are absent."""
    priced = recipes.join(select(ingredients, "ingredient_id, estimated_unit_cost"), "ingredient_id")
    return aggregate(priced, ["menu_item_id"], f"sum({LINE_COST}) as estimated_item_food_cost")


def with_margin(priced: DataFrame) -> DataFrame:
    """Adds profit and margin share to items that carry a price and a food cost."""
    profit = "(cast(selling_price as double) - estimated_item_food_cost)"
    return priced.selectExpr(
        "*",
        f"{profit} as estimated_gross_profit",
        f"{divided_if_positive(profit, 'selling_price')} as estimated_gross_margin_pct",
    )


def dim_menu_item(menu_items: DataFrame, costs: DataFrame) -> DataFrame:
    """Menu items with their recipe cost; items without a recipe keep NULL costs.

    ``costs`` is unique per item, so a query that reads no cost column loses the join altogether.
    """
    return with_margin(menu_items.drop("source_url").join(costs, "menu_item_id", "left"))


def dim_ingredient(ingredients: DataFrame, suppliers: DataFrame) -> DataFrame:
    """D3: ingredients with supplier attributes."""
    vendor = suppliers.selectExpr(
        "supplier_id",
        "supplier_name",
        "average_lead_time_days as supplier_lead_time_days",
        "reliability_score as supplier_reliability_score",
    )
    return ingredients.drop("is_synthetic_estimate").join(vendor, "supplier_id", "left")


def dim_employee(employees: DataFrame) -> DataFrame:
    """D4."""
    return employees.drop("is_synthetic_estimate")


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    """D4."""
    return suppliers.drop("is_synthetic_estimate")


def dim_channel(reference: DataFrame) -> DataFrame:
    """D4."""
    return select(reference, "channel, channel_label, is_delivery_channel, commission_rate")
