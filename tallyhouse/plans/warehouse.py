"""The layered warehouse: raw tables to staging, intermediate, dimensions, facts and marts.

Every layer is a lazy DataFrame made on first use.  ``store`` writes dimensions, facts and marts;
``StoredWarehouse`` reads them back by name.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators import dimensions, facts, intermediate, marts, staging
from tallyhouse.sources import tables
from tallyhouse.sources.channels import channel_reference
from tallyhouse.sources.workdir import tasks_for

DIMENSIONS = ("dim_date", "dim_menu_item", "dim_ingredient", "dim_employee", "dim_supplier", "dim_channel")
FACTS = (
    "fact_orders",
    "fact_order_items",
    "fact_employee_shifts",
    "fact_reviews",
    "fact_inventory_movements",
)
# Raw tables with a row per event; the others describe what these refer to.
EVENT_TABLES = ("orders", "order_items", "reviews", "employee_shifts", "inventory_movements")
MARTS = (
    "mart_daily_performance",
    "mart_menu_engineering",
    "mart_channel_profitability",
    "mart_labour_productivity",
    "mart_service_quality",
    "mart_inventory_risk",
    "mart_review_analysis",
)


class Warehouse:
    """Lazy layers over the eleven raw tables."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame]):
        self.spark = spark
        self.raw = raw

    @cached_property
    def most_rows(self) -> int:
        """Rows of the largest raw table that grows with the business; counted from file footers where a table is a projection."""
        return max((self.raw[name].count() for name in EVENT_TABLES if name in self.raw), default=0)

    # staging

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stage_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stage_order_items(self.raw["order_items"])

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stage_reviews(self.raw["reviews"])

    @cached_property
    def stg_employee_shifts(self) -> DataFrame:
        return staging.stage_employee_shifts(self.raw["employee_shifts"])

    @cached_property
    def stg_inventory_movements(self) -> DataFrame:
        return staging.stage_inventory_movements(self.raw["inventory_movements"])

    @cached_property
    def stg_daily_context(self) -> DataFrame:
        return staging.stage_daily_context(self.raw["daily_context"])

    @cached_property
    def stg_menu_items(self) -> DataFrame:
        return staging.stage_menu_items(self.raw["menu_items"])

    @cached_property
    def stg_ingredients(self) -> DataFrame:
        return staging.stage_ingredients(self.raw["ingredients"])

    @cached_property
    def stg_suppliers(self) -> DataFrame:
        return staging.stage_suppliers(self.raw["suppliers"])

    @cached_property
    def stg_recipes(self) -> DataFrame:
        return staging.stage_recipes(self.raw["recipes"])

    @cached_property
    def stg_employees(self) -> DataFrame:
        return staging.stage_employees(self.raw["employees"])

    # intermediate

    @cached_property
    def recipe_costs(self) -> DataFrame:
        return dimensions.recipe_costs(self.stg_recipes, self.stg_ingredients)

    @cached_property
    def int_hourly_demand(self) -> DataFrame:
        return intermediate.hourly_demand(self.stg_orders)

    @cached_property
    def int_ingredient_consumption(self) -> DataFrame:
        return intermediate.ingredient_daily_flows(self.stg_inventory_movements, self.stg_ingredients)

    @cached_property
    def int_menu_item_costs(self) -> DataFrame:
        return intermediate.menu_item_costs(self.stg_menu_items, self.recipe_costs)

    @cached_property
    def int_order_financials(self) -> DataFrame:
        return intermediate.order_financials(self.stg_orders, self.stg_order_items)

    @cached_property
    def int_service_performance(self) -> DataFrame:
        return intermediate.service_performance(self.stg_orders, self.stg_reviews)

    @cached_property
    def int_shift_labour_costs(self) -> DataFrame:
        return intermediate.shift_labour(self.stg_employee_shifts, self.stg_employees)

    # dimensions

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.stg_daily_context)

    @cached_property
    def dim_menu_item(self) -> DataFrame:
        return dimensions.dim_menu_item(self.stg_menu_items, self.recipe_costs)

    @cached_property
    def dim_ingredient(self) -> DataFrame:
        return dimensions.dim_ingredient(self.stg_ingredients, self.stg_suppliers)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return dimensions.dim_employee(self.stg_employees)

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return dimensions.dim_supplier(self.stg_suppliers)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return dimensions.dim_channel(channel_reference(self.spark))

    # facts

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.stg_orders, self.int_order_financials)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return facts.fact_order_items(self.stg_order_items, self.stg_orders)

    @cached_property
    def fact_employee_shifts(self) -> DataFrame:
        return facts.fact_employee_shifts(self.stg_employee_shifts, self.stg_employees)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return facts.fact_reviews(self.stg_reviews, self.stg_orders)

    @cached_property
    def fact_inventory_movements(self) -> DataFrame:
        return facts.fact_inventory_movements(self.stg_inventory_movements)

    # marts: they read facts through the columns they need, so joins that only add other columns
    # (line counts on orders, recipe costs on items) are dropped by the optimizer

    @cached_property
    def mart_daily_performance(self) -> DataFrame:
        return marts.daily_performance(
            self.dim_date,
            self.fact_orders,
            self.int_shift_labour_costs,
            self.fact_reviews,
            self.fact_inventory_movements,
        )

    @cached_property
    def mart_menu_engineering(self) -> DataFrame:
        return marts.menu_engineering(self.dim_menu_item, self.stg_orders, self.stg_order_items)

    @cached_property
    def mart_channel_profitability(self) -> DataFrame:
        return marts.channel_profitability(self.dim_channel, self.fact_orders, self.stg_reviews)

    @cached_property
    def mart_labour_productivity(self) -> DataFrame:
        return marts.labour_productivity(self.int_shift_labour_costs, self.fact_orders, self.int_hourly_demand)

    @cached_property
    def mart_service_quality(self) -> DataFrame:
        return marts.service_quality(self.fact_orders)

    @cached_property
    def mart_inventory_risk(self) -> DataFrame:
        return marts.inventory_risk(
            self.dim_ingredient, self.fact_inventory_movements, self.stg_recipes, self.dim_menu_item
        )

    @cached_property
    def mart_review_analysis(self) -> DataFrame:
        return marts.review_analysis(self.fact_reviews, self.fact_orders, self.dim_date)

    # S11

    def store(self, folder: str, names: tuple[str, ...] = DIMENSIONS + FACTS + MARTS) -> dict[str, int]:
        """Writes the named layers under a folder; facts are laid out by business date.

        Later layers read a stored fact back instead of computing it again.  Returns rows per
        table.  Tasks are cut by the rows of the largest raw table.
        """
        counts = {}
        with tasks_for(self.spark, self.most_rows):
            for name in names:
                frame = getattr(self, name)
                layout = ("business_date", frame.columns[0]) if name in FACTS else ()
                counts[name] = tables.replace_table(frame, f"{folder}/{name}", layout)
                if name in FACTS:
                    self.__dict__[name] = tables.read_table(self.spark, f"{folder}/{name}", frame.schema)
        return counts


class StoredWarehouse:
    """Marts written by ``Warehouse.store``, read by allow-listed name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def load_mart(self, name: str) -> DataFrame:
        if name not in MARTS:
            raise ValueError(f"Unknown mart: {name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")
