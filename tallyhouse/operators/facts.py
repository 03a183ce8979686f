"""Facts F1-F5."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.functions import select

# Shifts that start before 13:00 serve lunch, the others dinner.
SHIFT_DAYPART = "case when hour(shift_start) < 13 then 'lunch' else 'dinner' end as daypart"


def fact_orders(orders: DataFrame, financials: DataFrame) -> DataFrame:
    """every order with its margin share and line counts.

    ``financials`` holds one row per order, made from pre-summed lines, so the join cannot fan
    out.
    """
    extra = select(financials, "order_id, contribution_margin_pct, item_count, item_quantity_total")
    names = orders.columns
    at = names.index("preparation_minutes")
    return select(orders.join(extra, "order_id", "left"), *names[:at], *extra.columns[1:], *names[at:])


def fact_order_items(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """lines with date, daypart and channel of their order; lines without an order drop out."""
    return select(
        lines.join(select(orders, "order_id, business_date, daypart, channel"), "order_id"),
        "order_item_id, order_id, menu_item_id, business_date, daypart, channel, quantity, unit_price",
        "estimated_unit_food_cost, line_total, estimated_line_food_cost, special_request, item_status",
    )


def fact_employee_shifts(shifts: DataFrame, employees: DataFrame) -> DataFrame:
    """shifts with the department of the employee and the daypart they serve."""
    return select(
        shifts.join(select(employees, "employee_id, department"), "employee_id", "left"),
        "shift_id, employee_id, department, business_date",
        SHIFT_DAYPART,
        "role, shift_start, shift_end, break_minutes, scheduled_hours, actual_hours, is_absent, hourly_rate, labour_cost",
    )


def fact_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """reviews with date and daypart of the order; orphans keep NULLs."""
    return select(
        reviews.join(select(orders, "order_id, business_date, daypart"), "order_id", "left"),
        "review_id, order_id, business_date, daypart, review_date, channel, rating, review_text",
        "complaint_category, is_response_required",
    )


def fact_inventory_movements(movements: DataFrame) -> DataFrame:
    """F5."""
    return select(
        movements,
        "movement_id, movement_timestamp, business_date, ingredient_id, movement_type, quantity_change, unit",
        "unit_cost, movement_value, reference_id",
    )
