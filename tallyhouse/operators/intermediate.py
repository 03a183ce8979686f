"""Intermediate models I1-I6."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.functions import aggregate, count_where, divided_if_positive, mean, or_zero, select
from tallyhouse.operators.dimensions import with_margin
from tallyhouse.operators.facts import SHIFT_DAYPART


def hourly_demand(orders: DataFrame) -> DataFrame:
    """Orders per date, daypart and hour; cancelled orders are part of the load."""
    return aggregate(
        orders.selectExpr("*", "hour(order_timestamp) as order_hour"),
        ["business_date", "daypart", "order_hour"],
        "count(*) as order_count",
        f"{mean('kitchen_load_ratio')} as avg_kitchen_load_ratio",
        f"{mean('preparation_minutes')} as avg_preparation_minutes",
        f"{count_where('is_late')} as late_order_count",
        f"{count_where('has_missing_item')} as missing_item_order_count",
    )


def _moved(kind: str, amount: str) -> str:
    """Sum of one movement type."""
    return f"sum(case when movement_type = '{kind}' then {amount} else 0 end)"


def ingredient_daily_flows(movements: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Quantities and values per ingredient and date, one column per movement type.

    The ledger is summed first and named afterwards, so the ingredient join sees one row per
    ingredient and date and a busy ingredient never travels row by row.  Outflows turn positive.
    """
    flows = aggregate(
        movements,
        ["business_date", "ingredient_id"],
        f"{_moved('Sales Consumption', '-quantity_change')} as quantity_consumed",
        f"{_moved('Sales Consumption', '-movement_value')} as consumption_value",
        f"{_moved('Waste', '-quantity_change')} as quantity_wasted",
        f"{_moved('Waste', '-movement_value')} as waste_value",
        f"{_moved('Expired Stock', '-quantity_change')} as quantity_expired",
        f"{_moved('Supplier Delivery', 'quantity_change')} as quantity_delivered",
    )
    names = ["ingredient_name", "ingredient_category"]
    labels = select(ingredients, "ingredient_id", *names)
    return select(flows.join(labels, "ingredient_id"), *flows.columns[:2], *names, *flows.columns[2:])


def menu_item_costs(menu_items: DataFrame, costs: DataFrame) -> DataFrame:
    """Price, food cost, profit and margin of the items that have a recipe."""
    return with_margin(
        select(menu_items, "menu_item_id, item_name, category, selling_price").join(costs, "menu_item_id")
    )


def order_financials(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """I4: one row per order with its margin share and line counts.

    Lines are summed per order before the join: the join stays one to one and an order with very
    many lines is combined on the map side.
    """
    counts = aggregate(lines, ["order_id"], "count(*) as item_count", "sum(quantity) as item_quantity_total")
    return select(
        orders.join(counts, "order_id", "left"),
        "order_id, business_date, daypart, channel, status, subtotal, discount_amount, refund_amount",
        "platform_commission, net_sales, estimated_food_cost, estimated_gross_profit",
        f"{divided_if_positive('estimated_gross_profit', 'net_sales')} as contribution_margin_pct",
        *or_zero("item_count", "item_quantity_total"),
    )


def service_performance(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with their review, where there is one."""
    feedback = select(reviews, "order_id, review_id, rating, complaint_category, is_response_required")
    return select(
        orders,
        "order_id, business_date, daypart, channel, status, is_late, has_missing_item, kitchen_load_ratio",
        "preparation_minutes, promised_minutes",
    ).join(feedback, "order_id", "left")


def shift_labour(shifts: DataFrame, employees: DataFrame) -> DataFrame:
    """Shifts, absences, hours and cost per date, daypart and department.

    The roster is joined row by row because it is small next to the shifts: once it fits the
    broadcast threshold no shift moves before the map-side sums; a larger one is shuffled, where
    adaptive execution splits an employee with very many shifts.
    """
    placed = shifts.selectExpr("*", SHIFT_DAYPART).join(select(employees, "employee_id, department"), "employee_id")
    return aggregate(
        placed,
        ["business_date", "daypart", "department"],
        "count(*) as shift_count",
        f"{count_where('is_absent')} as absence_count",
        "sum(scheduled_hours) as total_scheduled_hours",
        "sum(actual_hours) as total_actual_hours",
        "sum(labour_cost) as total_labour_cost",
    )
