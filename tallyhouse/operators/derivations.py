"""Derived columns and rollups over orders, lines, shifts and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate, divided, select
from tallyhouse.operators.keys import attach
from tallyhouse.sources.workdir import settle, shuffles_dropped, task_count, tasks_for

# A line counts as sold when it was served and its order was not cancelled.
SERVED = "item_status = 'Fulfilled'"
KEPT = "status <> 'Cancelled'"
# Rows of item-days times recipe lines that one task makes or sums; an ingredient of so many tasks' rows is summed by several.
EXPLODED_PER_TASK = 1_000_000
TASKS_OF_A_BUSY_INGREDIENT = 16


def ingredient_consumption(
    orders: DataFrame, lines: DataFrame, recipes: DataFrame, exploded_per_task: int = EXPLODED_PER_TASK
) -> DataFrame:
    """A1: ingredient quantity used per date, from fulfilled lines of orders not cancelled.

    Lines are summed per date and item *before* the recipe join, so the bill of materials
    multiplies item-days, not lines.  The line count travels along to keep the mean wastage a
    mean over lines.

    Both sides of that join are written (eager), an item's days as arrays in one row.  The arrays travel to the task of the
    ingredient and are unfolded there, so the rows that the join stands for are never shuffled; dates alone would not bring
    them together, nor would sums before the shuffle, as few of them meet in a task that holds some of the items.  No size of
    the input tells how many rows these are, so they are counted per ingredient beforehand and give the number of partitions.
    Where an ingredient has too many for a task, its rows do meet: they are unfolded first and summed on the map side.
    """
    spark = lines.sparkSession
    with tasks_for(spark, lines.count()), shuffles_dropped(spark):
        sold = aggregate(
            select(lines.where(SERVED), "order_id, menu_item_id, quantity").join(
                select(orders.where(KEPT), "order_id, business_date"), "order_id"
            ),
            ["business_date", "menu_item_id"],
            "sum(quantity) as quantity",
            "count(*) as line_count",
        )
        day = ("business_date", "quantity", "line_count")
        folded = aggregate(sold, ["menu_item_id"], f"collect_list(struct({', '.join(day)})) as days")
        sold = settle(folded.selectExpr("menu_item_id", *[f"days.{name} as {name}_list" for name in day]), "sold")
        bill = settle(select(recipes, "menu_item_id, ingredient_id, quantity_required, estimated_wastage_pct"), "bill")
        days = sold.selectExpr("menu_item_id", "size(business_date_list) as days")
        rows = settle(aggregate(select(bill, "menu_item_id, ingredient_id").join(days, "menu_item_id"), ["ingredient_id"], "sum(days) as _rows"), "rows-per-ingredient")
    exploded = rows.agg(F.sum("_rows")).first()[0] or 0
    busy = rows.where(f"_rows > {TASKS_OF_A_BUSY_INGREDIENT * exploded_per_task}").select("ingredient_id")
    count = task_count(spark, exploded, exploded_per_task)

    def joined(bill: DataFrame) -> DataFrame:
        return sold.repartition(count, "menu_item_id").join(bill.repartition(count, "menu_item_id"), "menu_item_id").drop("menu_item_id")

    def summed(folded: DataFrame) -> DataFrame:
        unfolded = folded.selectExpr("*", "posexplode(business_date_list) as (_day, business_date)")
        return aggregate(
            unfolded.selectExpr("*", "quantity_list[_day] as quantity", "line_count_list[_day] as line_count"),
            ["business_date", "ingredient_id"],
            "sum(quantity * quantity_required) as ingredient_quantity",
            f"{divided('sum(estimated_wastage_pct * line_count)', 'sum(line_count)')} as estimated_wastage_pct",
        )

    if busy.isEmpty():
        return summed(joined(bill).repartition(count, "ingredient_id"))
    busy = F.broadcast(busy)  # at most a row for every ``TASKS_OF_A_BUSY_INGREDIENT`` tasks
    others = summed(joined(bill.join(busy, "ingredient_id", "left_anti")).repartition(count, "ingredient_id"))
    return others.unionByName(summed(joined(bill.join(busy, "ingredient_id"))))


def closing_inventory(movements: DataFrame) -> DataFrame:
    """A2: on-hand quantity and value per ingredient, four decimals."""
    return aggregate(
        movements,
        ["ingredient_id"],
        "bround(sum(quantity_change), 4) as closing_quantity",
        "sum(movement_value) as closing_value",
    )


def effective_staffing(shifts: DataFrame) -> DataFrame:
    """A3: people actually present per date and daypart by department, at least one each."""

    def present(department: str) -> str:
        return f"greatest(1L, count_if(department = '{department}' and not is_absent))"

    return aggregate(
        shifts,
        ["business_date", "daypart"],
        f"{present('Kitchen')} as kitchen_staff_count",
        f"{present('Front of House')} as front_of_house_staff_count",
    )


def orders_in_same_hour(orders: DataFrame) -> DataFrame:
    """Each order with the number of orders in its date, daypart and hour.

    Counted by a map-side aggregate and joined back; a window would sort a whole busy hour in
    one task.
    """
    slot = ["business_date", "daypart", "order_hour"]
    timed = orders.selectExpr("*", "hour(order_timestamp) as order_hour")
    return attach(timed, aggregate(timed, slot, "count(*) as orders_in_hour"), slot)


def kitchen_load(orders: DataFrame, staffing: DataFrame, capacity_per_staff_hour: float = 9.0) -> DataFrame:
    """A4: orders sharing the hour over what the kitchen present can handle in an hour, 3 decimals."""
    present = staffing.selectExpr("business_date", "daypart", "kitchen_staff_count as kitchen_present")
    capacity = f"(kitchen_present * {float(capacity_per_staff_hour)}D)"
    return attach(orders_in_same_hour(orders), present, ["business_date", "daypart"]).selectExpr(
        "*", f"bround(orders_in_hour / {capacity}, 3) as computed_load_ratio"
    )


def base_preparation(lines: DataFrame, menu_items: DataFrame, overlap: float = 0.4) -> DataFrame:
    """A5: slowest line's minutes plus a share of the other lines' minutes, per order."""
    timed = select(lines, "order_id, menu_item_id").join(
        select(menu_items, "menu_item_id, estimated_prep_minutes"), "menu_item_id"
    )
    slowest, everything = "max(estimated_prep_minutes)", "sum(estimated_prep_minutes)"
    return aggregate(
        timed, ["order_id"], f"{slowest} + {float(overlap)}D * ({everything} - {slowest}) as base_prep_minutes"
    )


def order_economics(orders: DataFrame) -> DataFrame:
    """Discount, commission, refund, net sales and gross profit from rates.

    Input: ``subtotal``, ``estimated_food_cost``, ``status`` and the decimal rates
    ``discount_rate``, ``commission_rate``, ``refund_fraction``.  Amounts are carried exactly and
    rounded once, at the end.
    """
    exact = orders.selectExpr("*", "subtotal * discount_rate as _discount").selectExpr(
        "*", "subtotal - _discount as _paid"
    )
    exact = exact.selectExpr(
        "*",
        "case when status = 'Cancelled' then 0 else _paid * commission_rate end as _commission",
        "case status when 'Cancelled' then _paid when 'Partially Refunded' then _paid * refund_fraction else 0 end "
        "as _refund",
    ).selectExpr("*", "_paid - _refund - _commission as _net")
    return exact.selectExpr(
        *orders.columns,
        "cast(_discount as decimal(10,2)) as discount_amount",
        "cast(_refund as decimal(10,2)) as refund_amount",
        "cast(_commission as decimal(10,2)) as platform_commission",
        "cast(_net as decimal(10,2)) as net_sales",
        "cast(_net - estimated_food_cost as decimal(10,4)) as estimated_gross_profit",
    )


def complaint_columns(reviews: DataFrame) -> DataFrame:
    """Complaint category from the order's flags and the rating, and whether to respond.

    Input carries ``has_missing_item``, ``is_late`` and ``rating``.  A missing item outranks
    lateness, which outranks a low rating; the reason behind a low rating is not in the data.
    """
    return reviews.selectExpr(
        "*",
        "case when has_missing_item then 'Missing Item' when is_late then 'Late Order' "
        "when rating <= 2 then 'Unspecified' end as derived_complaint_category",
    ).selectExpr(
        "*",
        "coalesce(rating <= 2, false) or derived_complaint_category is not null as derived_response_required",
    )
