"""Staging projections P1-P11: raw columns to typed, tidied ones.  Narrow, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.functions import blank_to_null, tidy


def _trim(name: str) -> str:
    return f"trim({name}) as {name}"


def _as(kind: str, *names: str) -> list[str]:
    return [f"cast({name} as {kind}) as {name}" for name in names]


def _money(*names: str) -> list[str]:
    return _as("decimal(10,2)", *names)


def _fine_money(*names: str) -> list[str]:
    return _as("decimal(10,4)", *names)


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "order_id",
        *_as("timestamp_ntz", "order_timestamp"),
        *_as("date", "business_date"),
        tidy("daypart"),
        tidy("channel"),
        _trim("status"),
        *_as("int", "table_number", "customer_count"),
        blank_to_null("promotion_name"),
        *_money("subtotal", "discount_amount", "refund_amount", "platform_commission", "net_sales"),
        *_fine_money("estimated_food_cost", "estimated_gross_profit"),
        *_as("double", "preparation_minutes", "promised_minutes"),
        "late_flag as is_late",
        "missing_item_flag as has_missing_item",
        *_as("int", "kitchen_staff_count", "front_of_house_staff_count"),
        *_as("double", "kitchen_load_ratio", "temperature_c", "rain_mm"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "order_item_id",
        "order_id",
        "menu_item_id",
        *_as("int", "quantity"),
        *_money("unit_price"),
        *_fine_money("estimated_unit_food_cost"),
        *_money("line_total"),
        *_fine_money("estimated_line_food_cost"),
        blank_to_null("special_request"),
        _trim("item_status"),
    )


def stage_reviews(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "review_id",
        "order_id",
        *_as("date", "review_date"),
        tidy("channel"),
        *_as("int", "rating"),
        _trim("review_text"),
        blank_to_null("complaint_category"),
        "response_required_flag as is_response_required",
    )


def stage_employee_shifts(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "shift_id",
        "employee_id",
        *_as("date", "business_date"),
        _trim("role"),
        *_as("timestamp_ntz", "shift_start", "shift_end"),
        *_as("int", "break_minutes"),
        *_as("double", "scheduled_hours", "actual_hours"),
        "absence_flag as is_absent",
        *_money("hourly_rate", "labour_cost"),
    )


def stage_inventory_movements(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "movement_id",
        *_as("timestamp_ntz", "movement_timestamp"),
        *_as("date", "business_date"),
        "ingredient_id",
        _trim("movement_type"),
        *_as("double", "quantity_change"),
        tidy("unit"),
        *_fine_money("unit_cost", "movement_value"),
        _trim("reference_id"),
    )


def stage_daily_context(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        *_as("date", "business_date"),
        _trim("day_name"),
        *_as("double", "temperature_c", "rain_mm"),
        "weekend_flag as is_weekend",
        "public_holiday_flag as is_public_holiday",
        "city_event_flag as is_city_event",
        blank_to_null("promotion_name"),
    )


AFFINITIES = (
    "base_popularity_weight",
    "cold_weather_affinity",
    "hot_weather_affinity",
    "lunch_affinity",
    "dinner_affinity",
    "delivery_affinity",
)


def stage_menu_items(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "menu_item_id",
        _trim("item_name"),
        _trim("category"),
        *_money("selling_price"),
        *_as("int", "estimated_prep_minutes"),
        "vegetarian as is_vegetarian",
        "vegan as is_vegan",
        "gluten_free as is_gluten_free",
        "available_for_delivery as is_available_for_delivery",
        *_as("double", *AFFINITIES),
        tidy("source_type"),
        blank_to_null("source_url"),
    )


def stage_ingredients(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "ingredient_id",
        _trim("ingredient_name"),
        _trim("ingredient_category"),
        tidy("unit"),
        *_fine_money("estimated_unit_cost"),
        *_as("int", "shelf_life_days"),
        *_as("double", "reorder_level", "safety_stock"),
        "supplier_id",
        "synthetic_estimate as is_synthetic_estimate",
    )


def stage_suppliers(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "supplier_id",
        _trim("supplier_name"),
        _trim("supplier_category"),
        *_as("int", "average_lead_time_days"),
        *_as("double", "reliability_score"),
        "synthetic_estimate as is_synthetic_estimate",
    )


def stage_recipes(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "menu_item_id",
        "ingredient_id",
        *_as("double", "quantity_required"),
        tidy("unit"),
        *_as("double", "estimated_wastage_pct"),
    )


def stage_employees(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "employee_id",
        _trim("employee_name"),
        _trim("department"),
        _trim("role"),
        _trim("employment_type"),
        *_money("hourly_rate"),
        *_as("double", "standard_weekly_hours"),
        "active as is_active",
        "synthetic_estimate as is_synthetic_estimate",
    )
