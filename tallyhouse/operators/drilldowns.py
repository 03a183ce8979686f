"""Filters and drill-down queries Q1-Q25 over facts and marts.

Marts hold one row per date, slot, item, ingredient or channel; only the review mart and the
item drill-downs read fact-sized tables, and those are plain map-side-combined aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate, count_where, divided, mean, select, share_where, sums, weighted_mean
from tallyhouse.operators.marts import band
from tallyhouse.operators.ordering import medians, top_rows
from tallyhouse.schemas import WEEKDAYS


def _means(*names: str) -> list[str]:
    return [f"{mean(name)} as {name}" for name in names]


def _sorted(rows: DataFrame, *order: str) -> DataFrame:
    return rows.orderBy(*[F.expr(name).desc_nulls_last() for name in order])


# --- Q1, Q2: filters -------------------------------------------------------------------------


def apply_filters(
    rows: DataFrame,
    *,
    date_range: tuple[date, date] | None = None,
    date_column: str = "business_date",
    members: dict[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Q1: inclusive date range and per-column membership.

    ``None`` leaves a column alone, an empty list keeps no row.
    """
    if date_range is not None:
        rows = rows.where(F.col(date_column).between(F.lit(date_range[0]), F.lit(date_range[1])))
    for column, allowed in (members or {}).items():
        if allowed is not None:
            rows = rows.where(F.col(column).isin(*allowed) if allowed else F.lit(False))
    return rows


def date_domain(rows: DataFrame, column: str = "business_date") -> DataFrame:
    """Q2: first and last date."""
    return rows.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def option_domain(rows: DataFrame, column: str) -> DataFrame:
    """Q2: distinct non-null values, sorted."""
    return rows.selectExpr(f"{column} as option").where("option is not null").distinct().orderBy("option")


# --- Q3-Q9: item, hour and slot drill-downs --------------------------------------------------

# Temperature bands as (upper limit in degrees, label), then the open band.
TEMPERATURE_BANDS = ((15, "Cold (<15°C)"), (25, "Mild (15-25°C)"))
HOTTEST_BAND = "Hot (>25°C)"
DEMAND = ("count(*) as order_count", "sum(quantity) as quantity")


def _item_orders(lines: DataFrame, orders: DataFrame, item: str, column: str) -> DataFrame:
    """Lines of one item with a column of their order; cancelled orders and missing lines included."""
    wanted = lines.where(F.col("menu_item_id") == item)
    return select(wanted, "order_id, quantity").join(select(orders, "order_id", column), "order_id")


def item_demand_by_hour(lines: DataFrame, orders: DataFrame, item: str) -> DataFrame:
    """Q3."""
    timed = _item_orders(lines, orders, item, "order_timestamp").selectExpr("*", "hour(order_timestamp) as order_hour")
    return aggregate(timed, ["order_hour"], *DEMAND).orderBy("order_hour")


def item_demand_by_temperature(lines: DataFrame, orders: DataFrame, item: str) -> DataFrame:
    """Q4: an unknown temperature counts as hot."""
    label = f"{band('temperature_c', TEMPERATURE_BANDS, HOTTEST_BAND)} as temperature_band"
    banded = _item_orders(lines, orders, item, "temperature_c").selectExpr("*", label)
    return aggregate(banded, ["temperature_band"], *DEMAND)


def item_channel_distribution(fact_lines: DataFrame, item: str) -> DataFrame:
    """Q5."""
    wanted = fact_lines.where(F.col("menu_item_id") == item)
    return _sorted(aggregate(wanted, ["channel"], *DEMAND, "sum(line_total) as revenue"), "order_count")


def _weekday(rows: DataFrame, dates: DataFrame) -> DataFrame:
    return rows.join(select(dates, "business_date, day_name"), "business_date")


def hourly_heatmap(demand: DataFrame, dates: DataFrame) -> DataFrame:
    """Q6: weekday by hour; the time is the plain mean of hourly means."""
    return aggregate(
        _weekday(demand, dates), ["day_name", "order_hour"], *sums("order_count"), *_means("avg_preparation_minutes")
    )


def preparation_vs_promise(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Q7: mean preparation and promised minutes per weekday and daypart, all orders.

    Orders are summed per date and daypart before the weekday is attached.
    """
    minutes = ("preparation_minutes", "promised_minutes")
    daily = aggregate(
        orders,
        ["business_date", "daypart"],
        "count(*) as order_count",
        *[f"{how}({name}) as _{how}_{name}" for name in minutes for how in ("sum", "count")],
    )
    means = [f"{divided(f'sum(_sum_{name})', f'sum(_count_{name})')} as avg_{name}" for name in minutes]
    return aggregate(_weekday(daily, dates), ["day_name", "daypart"], *sums("order_count"), *means)


def shift_grain(fact_shifts: DataFrame) -> DataFrame:
    """Q8."""
    return select(fact_shifts, "department, actual_hours, is_absent")


def busiest_slot(prep_vs_promise: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Q9: slot with most orders, its variance to the promise and the sentence about it.

    Ties go to the alphabetically first weekday and daypart.  Without slots there is the sentence alone.
    """
    top = top_rows(prep_vs_promise, "order_count desc, day_name, daypart", 1).selectExpr(
        "*", "avg_preparation_minutes - avg_promised_minutes as variance_minutes"
    )
    # The four sentences of the summary.
    found = top.selectExpr(
        "day_name",
        "daypart",
        "order_count",
        "variance_minutes",
        f"""concat(day_name, ' ', lower(daypart), case
            when variance_minutes > {tolerance}D then concat(
              ' produced the highest order volume, but average preparation time exceeded the target by ',
              format_number(variance_minutes, 1), ' minutes.')
            when variance_minutes < -{tolerance}D then concat(
              ' produced the highest order volume, and average preparation time beat the target by ',
              format_number(-variance_minutes, 1), ' minutes.')
            else ' produced the highest order volume, right at the promised preparation-time target.' end) as insight""",
    )
    # one row that finds no partner but an empty table's
    one = prep_vs_promise.sparkSession.range(1).select(F.lit(True).alias("_one"))
    filled = one.join(found.withColumn("_has", F.lit(True)), F.col("_one") == F.col("_has"), "left").drop("_one", "_has")
    return filled.withColumn("insight", F.expr("coalesce(insight, 'Not enough data to generate a summary yet.')"))


# --- Q10-Q15: executive, menu and channel pages ----------------------------------------------


def executive_kpis(daily: DataFrame) -> DataFrame:
    """Q10: totals, and plain means of the daily values."""
    return aggregate(
        daily,
        [],
        *sums("net_sales", "order_count"),
        *_means(
            "average_order_value",
            "estimated_gross_margin_pct",
            "labour_cost_pct",
            "average_preparation_minutes",
            "average_rating",
        ),
        *sums("waste_cost"),
    )


def orders_by_daypart(service: DataFrame) -> DataFrame:
    """Q11."""
    return aggregate(service, ["daypart"], *sums("order_count"))


def margin_by_category(menu: DataFrame) -> DataFrame:
    """Q11."""
    margin = "estimated_contribution_margin"
    return _sorted(aggregate(menu, ["category"], *sums(margin)), margin)


def menu_top(menu: DataFrame, measure: str, k: int = 8, menu_class: str | None = None) -> DataFrame:
    """Q12: best items by a measure, within one class if given; ties by item id.

    Items without the measure are not listed.
    """
    rows = menu.where(f"{measure} is not null")
    if menu_class is not None:
        rows = rows.where(F.col("menu_engineering_classification") == menu_class)
    return top_rows(select(rows, "menu_item_id, item_name", measure), f"{measure} desc, menu_item_id", k)


def category_comparison(menu: DataFrame) -> DataFrame:
    """Q13."""
    return _sorted(aggregate(menu, ["category"], *sums("revenue", "estimated_contribution_margin")), "revenue")


def per_unit_cost(menu: DataFrame) -> DataFrame:
    """Q14: cost per unit sold, NULL for unsold items."""
    return select(
        menu,
        "menu_item_id, item_name, selling_price",
        f"{divided('estimated_food_cost', 'units_sold')} as per_unit_cost",
        "contribution_margin_pct, units_sold",
    )


def channel_comparison(channels: DataFrame) -> DataFrame:
    """Q15: the channel table with commission as a share of gross sales."""
    compared = select(
        channels,
        "channel, channel_label, order_count, gross_sales, commission, refunds, net_sales, estimated_gross_profit",
        "average_order_value, average_preparation_minutes, average_rating, late_order_pct",
        f"{divided('commission', 'gross_sales')} as commission_share",
    )
    return _sorted(compared, "net_sales")


# --- Q16-Q20: service page -------------------------------------------------------------------

FAILURE_RATES = ("late_order_pct", "missing_item_pct", "refund_pct")


def service_kpis(service: DataFrame) -> DataFrame:
    """Q16: rates weighted by orders."""
    weighted = [f"{weighted_mean(rate, 'order_count')} as {rate}" for rate in FAILURE_RATES]
    return aggregate(service, [], *sums("order_count"), *weighted)


def preparation_by_daypart(service: DataFrame) -> DataFrame:
    """Q17."""
    return aggregate(
        service,
        ["daypart"],
        f"{mean('average_preparation_minutes')} as average",
        f"{mean('median_preparation_minutes')} as median",
        f"{mean('p90_preparation_minutes')} as p90",
    )


def peak_windows(service: DataFrame, k: int = 10) -> DataFrame:
    """Q18: ties by date and daypart."""
    peaks = select(
        service.where("peak_kitchen_load_ratio is not null"),
        "business_date, daypart, peak_kitchen_load_ratio, average_preparation_minutes, order_count",
    )
    return top_rows(peaks, "peak_kitchen_load_ratio desc, business_date, daypart", k)


def outcomes_by_staffing(service: DataFrame, labour: DataFrame) -> DataFrame:
    """Q19: plain means of slot rates per staffing flag."""
    slot = ["business_date", "daypart"]
    flagged = service.join(select(labour, *slot, "staffing_level_flag"), slot)
    return aggregate(flagged, ["staffing_level_flag"], *_means(*FAILURE_RATES))


def demand_pivot(heatmap: DataFrame, hours: Sequence[int] = tuple(range(24))) -> DataFrame:
    """Q20: one row per weekday, Monday first, one column per hour.

    The hours are a fixed list, so the pivot needs no pass to find its columns.
    """
    week = ", ".join(f"'{day}'" for day in WEEKDAYS)
    wide = heatmap.groupBy("day_name").pivot("order_hour", list(hours)).agg(F.sum("order_count"))
    return wide.withColumnsRenamed({str(h): f"h{h:02d}" for h in hours}).orderBy(
        F.expr(f"array_position(array({week}), day_name)")
    )


# --- Q21, Q22: labour page -------------------------------------------------------------------


def labour_kpis(labour: DataFrame) -> DataFrame:
    """Q21: totals and plain means over the slots."""
    return aggregate(
        labour,
        [],
        *sums("total_labour_cost", "total_actual_hours"),
        *_means("revenue_per_labour_hour", "orders_per_labour_hour", "labour_cost_pct"),
        *sums("scheduled_shift_count", "absence_count"),
    )


def hours_trend(labour: DataFrame) -> DataFrame:
    """Q21."""
    return aggregate(
        labour, ["business_date"], "sum(total_scheduled_hours) as scheduled", "sum(total_actual_hours) as actual"
    )


def staffing_windows(labour: DataFrame, flag: str, k: int = 15) -> DataFrame:
    """Q21: worst windows of a flag, highest load first when understaffed, lowest when overstaffed."""
    flagged = select(
        labour.where(F.col("staffing_level_flag") == flag),
        "business_date, daypart, avg_kitchen_load_ratio, order_count, total_actual_hours",
    )
    way = "" if flag == "Overstaffed" else " desc"
    return top_rows(flagged, f"avg_kitchen_load_ratio{way}, business_date, daypart", k)


def labour_cost_quartiles(labour: DataFrame) -> DataFrame:
    """Q22: box-plot figures of the labour cost share per daypart.

    Reads the slot mart: rows are bounded by the calendar, so the exact percentile buffers are.
    """
    names = ("lowest", "q1", "median", "q3", "highest")
    five = aggregate(labour, ["daypart"], "percentile(labour_cost_pct, array(0.0, 0.25, 0.5, 0.75, 1.0)) as _f")
    return five.selectExpr("daypart", *[f"_f[{i}] as {name}" for i, name in enumerate(names)])


# --- Q23: inventory page ---------------------------------------------------------------------


def inventory_kpis(inventory: DataFrame) -> DataFrame:
    """Q23."""
    return aggregate(
        inventory,
        [],
        *sums("closing_value"),
        f"{count_where('is_reorder_alert')} as reorder_alerts",
        *sums("total_waste_value"),
        *_means("estimated_days_of_stock_remaining"),
        *sums("emergency_delivery_count", "total_expired_value"),
    )


def reorder_list(inventory: DataFrame) -> DataFrame:
    """Q23: every ingredient below its reorder level, shortest cover first."""
    return select(
        inventory.where("is_reorder_alert"),
        "ingredient_id, ingredient_name, ingredient_category, closing_quantity, reorder_level",
        "estimated_days_of_stock_remaining, supplier_name, supplier_lead_time_days, affected_menu_items",
    ).orderBy(F.col("estimated_days_of_stock_remaining").asc_nulls_last(), "ingredient_id")


def stock_value_by_category(inventory: DataFrame) -> DataFrame:
    """Q23."""
    return _sorted(aggregate(inventory, ["ingredient_category"], *sums("closing_value")), "closing_value")


def most_wasted(inventory: DataFrame, k: int = 10) -> DataFrame:
    """Q23."""
    return top_rows(
        select(inventory, "ingredient_id, ingredient_name, total_waste_value"),
        "total_waste_value desc, ingredient_id",
        k,
    )


def lowest_cover(inventory: DataFrame, k: int = 20) -> DataFrame:
    """Q23: fewest days of stock; ingredients without a run rate are not listed."""
    return top_rows(
        select(
            inventory.where("estimated_days_of_stock_remaining is not null"),
            "ingredient_id, ingredient_name, estimated_days_of_stock_remaining, is_reorder_alert",
        ),
        "estimated_days_of_stock_remaining, ingredient_id",
        k,
    )


# --- Q24, Q25 --------------------------------------------------------------------------------


def review_kpis(reviews: DataFrame) -> DataFrame:
    """Q24."""
    return aggregate(
        reviews,
        [],
        f"{mean('rating')} as average_rating",
        "count(*) as review_count",
        f"{share_where('rating <= 2')} as low_rating_pct",
        f"{share_where('is_response_required')} as response_required_pct",
    )


def rating_by(reviews: DataFrame, column: str) -> DataFrame:
    """Q24: mean rating per date, channel, band or daypart; rows without the column are left out."""
    return aggregate(reviews.where(f"{column} is not null"), [column], *_means("rating"))


def value_counts(reviews: DataFrame, column: str) -> DataFrame:
    """Q24: rows per non-null value."""
    return aggregate(reviews.where(f"{column} is not null"), [column], "count(*) as count")


def latest_low_ratings(reviews: DataFrame, k: int = 20) -> DataFrame:
    """Q24: newest low ratings; ties by review id."""
    low = select(
        reviews.where("rating <= 2"), "review_id, business_date, channel, rating, complaint_category, review_text"
    )
    return top_rows(low, "business_date desc, review_id", k)


def quadrant_lines(menu: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    """Q25: medians of the filtered menu, which differ from the medians that set the classes."""
    names = ["units_sold", "contribution_margin_pct"]
    middle = medians(apply_filters(menu, members={"category": categories}), names)
    return menu.sparkSession.range(1).select(*[middle[n].alias(f"median_{n}") for n in names])
