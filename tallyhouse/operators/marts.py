"""Marts K1-K7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import (
    aggregate,
    count_where,
    divided,
    divided_if_positive,
    mean,
    or_zero,
    select,
    share_where,
    sums,
)
from tallyhouse.operators.derivations import KEPT, SERVED
from tallyhouse.operators.keys import attach
from tallyhouse.operators.ordering import grouped_percentiles, medians, rank_and_group_total
from tallyhouse.sources.workdir import settle

SALES = (
    f"{mean('net_sales')} as average_order_value",
    f"{mean('preparation_minutes')} as average_preparation_minutes",
    f"{share_where('is_late')} as late_order_pct",
)
RATING = f"{mean('rating')} as average_rating"


def kept(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled."""
    return orders.where(KEPT)


def daily_performance(
    dates: DataFrame, orders: DataFrame, labour: DataFrame, reviews: DataFrame, movements: DataFrame
) -> DataFrame:
    """K1: one row per business date.

    Each fact is summed to the date on its own before any join, so facts cannot multiply one
    another.  Sums and counts default to zero; averages and ratios of an empty day stay NULL.
    """
    day = ["business_date"]
    money = ("net_sales", "estimated_food_cost", "estimated_gross_profit")
    parts = (
        aggregate(kept(orders), day, "count(*) as order_count", *sums(*money), *SALES),
        aggregate(labour, day, "sum(total_labour_cost) as labour_cost"),
        aggregate(reviews, day, RATING),
        aggregate(movements.where("movement_type = 'Waste'"), day, "sum(-movement_value) as waste_cost"),
    )
    joined = dates
    for part in parts:
        joined = joined.join(part, "business_date", "left")
    return select(
        joined,
        "business_date, day_name, is_weekend, is_public_holiday, is_city_event, promotion_name, temperature_c, rain_mm",
        *or_zero("order_count", *money),
        f"{divided_if_positive('estimated_gross_profit', 'net_sales')} as estimated_gross_margin_pct",
        "average_order_value, average_preparation_minutes, late_order_pct",
        *or_zero("labour_cost"),
        f"{divided_if_positive('labour_cost', 'net_sales')} as labour_cost_pct",
        "average_rating",
        *or_zero("waste_cost"),
    )


def channel_profitability(channels: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """K2: one row per listed channel; orders and reviews are summed apart to avoid fan-out."""
    totals = ("gross_sales", "commission", "refunds", "net_sales", "estimated_gross_profit")
    sources = ("subtotal", "platform_commission", "refund_amount", "net_sales", "estimated_gross_profit")
    sales = aggregate(
        kept(orders),
        ["channel"],
        "count(*) as order_count",
        *[f"sum({source}) as {total}" for total, source in zip(totals, sources, strict=True)],
        *SALES,
    )
    return select(
        channels.join(sales, "channel", "left").join(aggregate(reviews, ["channel"], RATING), "channel", "left"),
        *channels.columns,
        *or_zero("order_count", *totals),
        "average_order_value, average_preparation_minutes, late_order_pct, average_rating",
    )


def sold_item_stats(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """K3a-c: units, revenue, cost, orders and margin per item over fulfilled, kept lines.

    The distinct count makes Spark shuffle on (item, order) first, so a best seller is spread
    over tasks.
    """
    eligible = lines.where(SERVED).join(select(kept(orders), "order_id"), "order_id")
    return aggregate(
        eligible,
        ["menu_item_id"],
        "sum(quantity) as units_sold",
        "sum(line_total) as revenue",
        "sum(estimated_line_food_cost) as estimated_food_cost",
        "count(distinct order_id) as orders_containing_item",
        f"{mean('quantity')} as average_quantity_per_order",
    ).selectExpr(
        "*",
        "revenue - estimated_food_cost as estimated_contribution_margin",
        f"{divided_if_positive('(revenue - estimated_food_cost)', 'revenue')} as contribution_margin_pct",
    )


def menu_engineering(menu_items: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """K3: sales, margin, rank and class of every menu item.  Writes the item sums once.

    Medians are taken over *sold* items and unsold items count as zero against them.  The item
    sums feed the medians, the rank and the result, so they are settled to a table first.
    """
    sums_table = settle(sold_item_stats(orders, lines), "item-sums")
    items = select(menu_items, "menu_item_id, item_name, category, selling_price")
    middle = medians(sums_table, ["units_sold", "contribution_margin_pct"])
    ranked = rank_and_group_total(
        items.join(sums_table, "menu_item_id", "left"),
        group="category",
        value="revenue",
        rank="sales_rank_within_category",
        total="_category_revenue",
    )
    limits = ranked.withColumns(
        {
            "_orders": kept(orders).agg(F.count("*")).scalar(),
            "_units": middle["units_sold"],
            "_margin": middle["contribution_margin_pct"],
        }
    ).selectExpr(
        "*",
        "coalesce(units_sold, 0) >= _units as _popular",
        "coalesce(contribution_margin_pct, 0D) >= _margin as _profitable",
    )
    share = divided("revenue", "_category_revenue")
    return select(
        limits,
        "menu_item_id, item_name, category, selling_price",
        *or_zero("units_sold", "revenue", "estimated_food_cost", "estimated_contribution_margin"),
        "contribution_margin_pct",
        f"{divided('orders_containing_item', '_orders')} as order_penetration",
        "average_quantity_per_order",
        "sales_rank_within_category",
        f"case when category is not null and _category_revenue > 0 then {share} end as revenue_pct_within_category",
        "if(_popular, 'High', 'Low') as popularity_classification",
        "if(_profitable, 'High', 'Low') as profitability_classification",
        "if(_popular, if(_profitable, 'Star', 'Plowhorse'), if(_profitable, 'Puzzle', 'Dog')) "
        "as menu_engineering_classification",
    )


def staffing_flag(load: str, high: float = 1.2, low: float = 0.5) -> str:
    """Understaffed above ``high``, Overstaffed below ``low``; an unknown load is Balanced."""
    return (
        f"case when {load} > {float(high)}D then 'Understaffed' when {load} < {float(low)}D then 'Overstaffed' "
        "else 'Balanced' end"
    )


def labour_productivity(labour: DataFrame, orders: DataFrame, demand: DataFrame) -> DataFrame:
    """K4: hours, cost and output per date and daypart, kitchen beside front of house.

    The two departments are pivoted by one conditional aggregate, which equals their full outer
    join: a date and daypart appears when either department worked it.  The load is the plain
    mean of the hourly means.
    """
    slot = ["business_date", "daypart"]
    sides = {"kitchen": "Kitchen", "front_of_house": "Front of House"}
    hours = aggregate(
        labour.where("department in ('Kitchen', 'Front of House')"),
        slot,
        *[
            f"coalesce(sum(total_{measure}) filter (where department = '{department}'), 0) as {side}_{measure}"
            for measure in ("scheduled_hours", "actual_hours", "labour_cost")
            for side, department in sides.items()
        ],
        "sum(absence_count) as absence_count",
        "sum(shift_count) as scheduled_shift_count",
    )
    sales = aggregate(kept(orders), slot, "count(*) as order_count", *sums("net_sales"))
    load = aggregate(demand, slot, f"{mean('avg_kitchen_load_ratio')} as avg_kitchen_load_ratio")
    all_hours = "(kitchen_actual_hours + front_of_house_actual_hours)"
    all_cost = "(kitchen_labour_cost + front_of_house_labour_cost)"
    return select(
        hours.join(sales, slot, "left").join(load, slot, "left"),
        *slot,
        "kitchen_scheduled_hours + front_of_house_scheduled_hours as total_scheduled_hours",
        f"{all_hours} as total_actual_hours",
        f"{all_cost} as total_labour_cost",
        "kitchen_actual_hours, front_of_house_actual_hours, kitchen_labour_cost, front_of_house_labour_cost",
        "absence_count, scheduled_shift_count",
        *or_zero("order_count", "net_sales"),
        f"{divided_if_positive('order_count', all_hours)} as orders_per_labour_hour",
        f"{divided_if_positive('net_sales', all_hours)} as revenue_per_labour_hour",
        f"{divided_if_positive('order_count', 'kitchen_actual_hours')} as orders_per_kitchen_labour_hour",
        f"{divided_if_positive('order_count', 'front_of_house_actual_hours')} as orders_per_front_of_house_labour_hour",
        f"{divided_if_positive(all_cost, 'net_sales')} as labour_cost_pct",
        "avg_kitchen_load_ratio",
        f"{staffing_flag('avg_kitchen_load_ratio')} as staffing_level_flag",
    )


def service_quality(orders: DataFrame) -> DataFrame:
    """K5: preparation times and failure rates per date and daypart.

    The percentiles come from counts per distinct preparation time, so no slot is held or sorted in one task.
    """
    slot = ["business_date", "daypart"]
    times = grouped_percentiles(kept(orders), slot, "preparation_minutes", {"median_preparation_minutes": 0.5, "p90_preparation_minutes": 0.9})
    quality = aggregate(
        kept(orders),
        slot,
        "count(*) as order_count",
        f"{mean('preparation_minutes')} as average_preparation_minutes",
        f"{share_where('is_late')} as late_order_pct",
        f"{share_where('has_missing_item')} as missing_item_pct",
        f"""{share_where("status = 'Partially Refunded'")} as refund_pct""",
        f"{mean('kitchen_load_ratio')} as average_kitchen_load_ratio",
        "max(kitchen_load_ratio) as peak_kitchen_load_ratio",
        f"{mean('kitchen_staff_count')} as average_kitchen_staff_count",
        f"{mean('front_of_house_staff_count')} as average_front_of_house_staff_count",
    )
    first = ["business_date", "daypart", "order_count", "average_preparation_minutes"]
    middle = ["median_preparation_minutes", "p90_preparation_minutes"]
    return attach(quality, times, slot).select(*first, *middle, *[c for c in quality.columns if c not in first])


def ledger_position(movements: DataFrame) -> DataFrame:
    """Stock, losses, use and rush deliveries per ingredient in one pass over the ledger.

    Sums per ingredient and date first (combined on the map side), because the run rate is a mean
    over the days an ingredient moved; the days then add up to the ingredient.
    """

    def lost(kind: str, measure: str) -> str:
        return f"sum(-{measure}) filter (where movement_type = '{kind}')"

    rush = "movement_type = 'Supplier Delivery' and contains(reference_id, 'EMERGENCY')"
    days = aggregate(
        movements,
        ["ingredient_id", "business_date"],
        "sum(quantity_change) as closing_quantity",
        "sum(movement_value) as closing_value",
        f"{lost('Waste', 'quantity_change')} as total_waste_quantity",
        f"{lost('Waste', 'movement_value')} as total_waste_value",
        f"{lost('Expired Stock', 'quantity_change')} as total_expired_quantity",
        f"{lost('Expired Stock', 'movement_value')} as total_expired_value",
        f"{count_where(rush)} as emergency_delivery_count",
        "sum(case when movement_type = 'Sales Consumption' then -quantity_change else 0 end) as _used",
    )
    return aggregate(
        days, ["ingredient_id"], *sums(*days.columns[2:-1]), f"{mean('_used')} as avg_daily_consumption"
    )


def affected_pairs(recipes: DataFrame, menu_items: DataFrame) -> DataFrame:
    """A row per ingredient and name of an item that uses it; repeats fall away per task, before either shuffle."""
    used = select(recipes, "ingredient_id, menu_item_id").distinct()
    named = used.join(select(menu_items, "menu_item_id, item_name").distinct(), "menu_item_id")
    return select(named, "ingredient_id, item_name").distinct()


def affected_items(recipes: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Names of the items that use an ingredient, each once, in alphabetical order, as one string."""
    names = "array_join(array_sort(collect_list(item_name)), ', ') as affected_menu_items"
    return aggregate(affected_pairs(recipes, menu_items), ["ingredient_id"], names)


def inventory_risk(
    ingredients: DataFrame, movements: DataFrame, recipes: DataFrame, menu_items: DataFrame
) -> DataFrame:
    """K6: current position of every ingredient."""
    position = ingredients.join(ledger_position(movements), "ingredient_id", "left")
    return select(
        position.join(affected_items(recipes, menu_items), "ingredient_id", "left"),
        "ingredient_id, ingredient_name, ingredient_category, unit, reorder_level, safety_stock, supplier_name",
        "supplier_lead_time_days",
        *or_zero("closing_quantity", "closing_value"),
        "coalesce(closing_quantity, 0) < reorder_level as is_reorder_alert",
        *or_zero("avg_daily_consumption"),
        f"{divided_if_positive('closing_quantity', 'avg_daily_consumption')} as estimated_days_of_stock_remaining",
        *or_zero(
            "total_waste_quantity",
            "total_waste_value",
            "total_expired_quantity",
            "total_expired_value",
            "emergency_delivery_count",
        ),
        "affected_menu_items",
    )


# Preparation-time bands as (upper limit in minutes, label), then the open band.
PREPARATION_BANDS = ((15, "Under 15 min"), (25, "15-25 min"), (35, "25-35 min"))
SLOWEST_BAND = "Over 35 min"


def band(value: str, bands: tuple[tuple[int, str], ...], last: str) -> str:
    """Label of the first band whose limit exceeds the value; an unknown value falls into the last."""
    steps = " ".join(f"when {value} < {limit} then '{label}'" for limit, label in bands)
    return f"case {steps} else '{last}' end"


def review_analysis(reviews: DataFrame, orders: DataFrame, dates: DataFrame) -> DataFrame:
    """K7: one row per review with weekday and preparation-time band of its order."""
    timed = reviews.join(select(orders, "order_id, preparation_minutes"), "order_id", "left")
    return select(
        timed.join(select(dates, "business_date, day_name"), "business_date", "left"),
        "review_id, order_id, business_date, day_name, daypart, channel, review_date, rating, review_text",
        "complaint_category, is_response_required, preparation_minutes",
        f"{band('preparation_minutes', PREPARATION_BANDS, SLOWEST_BAND)} as preparation_time_band",
    )
