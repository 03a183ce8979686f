"""The driver's star-schema tables as the eleven raw tables and the event feed.

Projections only, apart from the recipe table (one aggregate) and the calendar (two scalars).
Amounts are decimals and measured quantities are multiples of 1/8, so sums are exact in any
order.  Labels carry stray blanks and capitals on purpose, for staging to remove.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.calendar import day_spine, enrich_calendar
from tallyhouse.operators.derivations import order_economics
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.schemas import RAW_SCHEMAS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Half-millimetre steps of rain; one day in nine reads below zero, for the checks to find.
WEATHER = (
    "10 + dayofyear(business_date) % 80 / 4.0D as temperature_c",
    "(dayofyear(business_date) % 9 - 1) * 0.5D as rain_mm",
)
PRICE = "cast(o_totalprice as decimal(10,2))"
WEEKEND_DINNER = "weekday(o_orderdate) >= 5 and o_custkey % 10 >= 4"


def raw_orders(orders: DataFrame) -> DataFrame:
    priced = orders.selectExpr(
        "cast(o_orderkey as string) as order_id",
        "o_orderdate + make_dt_interval(0, int(11 + o_custkey % 10), int(o_orderkey % 60), 0) as order_timestamp",
        "to_date(o_orderdate) as business_date",
        "case when o_custkey % 10 < 4 then ' Lunch' else 'DINNER ' end as daypart",
        "case o_orderpriority when '1-URGENT' then ' Dine_In' when '2-HIGH' then 'pickup ' "
        "when '3-MEDIUM' then 'uber_eats' when '4-NOT SPECIFIED' then 'DoorDash' else o_orderpriority end as channel",
        "case o_orderstatus when 'O' then 'Completed' when 'F' then 'Cancelled' else 'Partially Refunded' end as status",
        "case when o_orderpriority = '1-URGENT' and o_custkey % 50 <> 0 then o_orderkey % 40 + 1 "
        "when o_orderpriority = '5-LOW' and o_custkey % 10 = 0 then o_orderkey % 40 + 1 end as table_number",
        "case when o_orderpriority = '1-URGENT' then o_custkey % 6 + 1 end as customer_count",
        "case weekday(o_orderdate) when 0 then 'Banh Mi Monday ' when 5 then 'Weekend Sharing Special' else ' ' end "
        "as promotion_name",
        f"{PRICE} as subtotal",
        f"cast({PRICE} * 0.30BD as decimal(10,4)) as estimated_food_cost",
        "o_custkey % 180 / 4.0D as preparation_minutes",
        "case o_orderpriority when '1-URGENT' then 24.0D when '2-HIGH' then 23.0D when '5-LOW' then 30.0D "
        "else 38.0D end as promised_minutes",
        "o_orderkey % 16 = 0 as missing_item_flag",
        f"if({WEEKEND_DINNER}, 3, 2) as kitchen_staff_count",
        f"if({WEEKEND_DINNER}, 3, 2) as front_of_house_staff_count",
        "o_custkey % 24 / 16.0D as kitchen_load_ratio",
        "cast(case weekday(o_orderdate) when 0 then 0.15 when 5 then 0.10 else 0 end as decimal(4,2)) as discount_rate",
        "cast(case o_orderpriority when '3-MEDIUM' then 0.28 when '4-NOT SPECIFIED' then 0.25 else 0 end "
        "as decimal(4,2)) as commission_rate",
        "cast((10 + o_custkey % 51) * 0.01BD as decimal(4,2)) as refund_fraction",
        # the unlisted channel adds a handling fee of 1 % that its components do not show
        f"cast(if(o_orderpriority = '5-LOW', {PRICE} * 0.01BD, 0) as decimal(10,2)) as _fee",
    ).selectExpr("*", "preparation_minutes > promised_minutes as late_flag", *WEATHER)
    charged = order_economics(priced).withColumn("net_sales", F.expr("cast(net_sales + _fee as decimal(10,2))"))
    return charged.withColumns(
        {
            "estimated_gross_profit": F.expr("cast(net_sales - estimated_food_cost as decimal(10,4))"),
            "temperature_c": F.expr("if(dayofmonth(business_date) = 31, null, temperature_c)"),
        }
    ).drop("_fee")


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    extended = "cast(l_extendedprice as decimal(10,2))"
    cents = "cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)"
    return lineitem.selectExpr("*", f"cast(({cents}) * 0.01BD as decimal(10,2)) as _unit_price").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) as order_item_id",
        "cast(l_orderkey as string) as order_id",
        "cast(l_partkey as string) as menu_item_id",
        "l_quantity as quantity",
        "_unit_price as unit_price",
        "_unit_price * 0.30BD as estimated_unit_food_cost",
        f"cast({extended} * (1 - cast(l_discount as decimal(4,2))) as decimal(10,2)) as line_total",
        f"{extended} * (0.30BD + cast(l_tax as decimal(4,2))) as estimated_line_food_cost",
        "if(l_linestatus = 'O', ' no peanuts ', '  ') as special_request",
        "if(l_returnflag = 'R', 'Missing ', ' Fulfilled') as item_status",
    )


def raw_menu_items(part: DataFrame) -> DataFrame:
    weights = (
        "base_popularity_weight",
        "cold_weather_affinity",
        "hot_weather_affinity",
        "lunch_affinity",
        "dinner_affinity",
        "delivery_affinity",
    )
    return part.selectExpr(
        "cast(p_partkey as string) as menu_item_id",
        "concat(' ', p_name) as item_name",
        "concat(p_type, ' ') as category",
        "p_retailprice as selling_price",
        "p_size as estimated_prep_minutes",
        "p_size % 2 = 0 as vegetarian",
        "p_size % 4 = 0 as vegan",
        "p_size % 3 = 0 as gluten_free",
        "p_size % 5 <> 0 as available_for_delivery",
        *[f"0.5D + p_size % {n} / 4.0D as {name}" for n, name in enumerate(weights, start=2)],
        "' Synthetic' as source_type",
        "if(p_size % 7 = 0, 'https://example.org/menu', ' ') as source_url",
    )


def raw_ingredients(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "cast(s_suppkey as string) as ingredient_id",
        "concat(s_name, ' ') as ingredient_name",
        "concat('Category ', s_nationkey % 5) as ingredient_category",
        "' Kilograms' as unit",
        "cast(cast(abs(s_acctbal) as decimal(10,2)) * 0.0010BD as decimal(10,4)) as estimated_unit_cost",
        "s_suppkey % 30 as shelf_life_days",
        "s_suppkey % 100 * 10.0D as reorder_level",
        "s_suppkey % 50 * 1.0D as safety_stock",
        "cast(s_nationkey as string) as supplier_id",
        "true as synthetic_estimate",
    )


def raw_suppliers(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "cast(n_nationkey as string) as supplier_id",
        "n_name as supplier_name",
        "concat(' Region ', n_regionkey) as supplier_category",
        "n_nationkey % 7 as average_lead_time_days",
        "n_nationkey / 16.0D as reliability_score",
        "true as synthetic_estimate",
    )


def raw_recipes(lineitem: DataFrame) -> DataFrame:
    widest = lineitem.groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("q"), F.max("l_tax").alias("w"))
    return widest.selectExpr(
        "cast(l_partkey as string) as menu_item_id",
        "cast(l_suppkey as string) as ingredient_id",
        "q as quantity_required",
        "'Kilograms ' as unit",
        "w as estimated_wastage_pct",
    )


def raw_employees(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "cast(s_suppkey as string) as employee_id",
        "s_name as employee_name",
        "case when s_nationkey = 24 then 'Office' when s_nationkey % 2 = 0 then 'Kitchen ' else ' Front of House' end "
        "as department",
        "if(s_nationkey % 2 = 0, 'Cook ', 'Waiter') as role",
        "case s_nationkey % 3 when 0 then 'Full-time' when 1 then ' Part-time' else 'Casual' end as employment_type",
        "cast(20 + s_suppkey % 20 as decimal(10,2)) as hourly_rate",
        "38 as standard_weekly_hours",
        "s_acctbal > 0 as active",
        "true as synthetic_estimate",
    )


def _line_key(prefix: str) -> str:
    return f"concat_ws('-', '{prefix}', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def raw_employee_shifts(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "*",
        "l_shipdate + make_dt_interval(0, if(l_linestatus = 'O', 11, 15), 0, 0) as _start",
        "if(l_returnflag = 'R' and l_linenumber < 7, 0.0D, l_quantity / 8.0D) as _worked",
        "cast(20 + l_suppkey % 20 as decimal(10,2)) as _rate",
    ).selectExpr(
        f"{_line_key('S')} as shift_id",
        "cast(l_suppkey as string) as employee_id",
        "to_date(l_shipdate) as business_date",
        "' Chef' as role",
        "_start as shift_start",
        "_start + make_dt_interval(0, 0, 0, cast(l_quantity * 450 - 1800 as decimal(18,6))) as shift_end",
        "30 as break_minutes",
        "l_quantity / 8.0D as scheduled_hours",
        "_worked as actual_hours",
        "l_returnflag = 'R' as absence_flag",
        "_rate as hourly_rate",
        "cast(cast(_worked as decimal(8,3)) * _rate as decimal(10,2)) as labour_cost",
    )


def raw_inventory_movements(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "*",
        "if(l_returnflag = 'N', 2 * l_quantity, -l_quantity) as _change",
        "cast(cast(l_extendedprice as decimal(10,2)) * 0.0001BD as decimal(10,4)) as _unit_cost",
    ).selectExpr(
        f"{_line_key('M')} as movement_id",
        "l_shipdate + make_dt_interval(0, 5 + l_linenumber, int(l_orderkey % 60), 0) as movement_timestamp",
        "to_date(l_shipdate) as business_date",
        "cast(l_suppkey as string) as ingredient_id",
        "case when l_returnflag = 'N' and l_linenumber = 7 then 'Stock Adjustment' "
        "when l_returnflag = 'N' then 'Supplier Delivery ' when l_returnflag = 'A' then 'Sales Consumption' "
        "when l_linestatus = 'O' then ' Waste' else 'Expired Stock' end as movement_type",
        "_change as quantity_change",
        "'KILOGRAMS' as unit",
        "_unit_cost as unit_cost",
        "cast(cast(_change as decimal(6,0)) * _unit_cost as decimal(10,4)) as movement_value",
        "concat(case when l_returnflag = 'N' and l_linenumber = 1 then ' EMERGENCY-' when l_returnflag = 'N' "
        "then 'PO-' when l_returnflag = 'A' then 'ORD-' else 'LOG-' end, l_orderkey) as reference_id",
    )


EVENT_CHANNEL = (
    "case event_type when 'click' then 'dine_in' when 'view' then 'pickup' when 'purchase' then 'uber_eats' "
    "when 'signup' then 'doordash' else event_type end as channel"
)


def raw_reviews(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('R', event_id) as review_id",
        "cast(event_id * 2 as string) as order_id",
        "to_date(ts) as review_date",
        EVENT_CHANNEL,
        "if(event_type = 'signup' and user_id % 7 = 0, null, user_id % 6) as rating",
        "props as review_text",
        "case when event_type = 'error' then ' Late Order' when event_type = 'purchase' and user_id % 5 = 0 "
        "then 'Missing Item' else '  ' end as complaint_category",
    ).selectExpr(
        "*", "coalesce(rating <= 2, false) or trim(complaint_category) <> '' as response_required_flag"
    )


def raw_daily_context(orders: DataFrame) -> DataFrame:
    span = orders.selectExpr("to_date(o_orderdate) as d").agg(
        F.min("d").alias("first_date"), F.max("d").alias("last_date")
    )
    return enrich_calendar(day_spine(span)).selectExpr("*", *WEATHER)


def order_events(events: DataFrame) -> DataFrame:
    """The live feed; ``site`` groups users into four feeds.  Works on a batch and on a stream."""
    return events.selectExpr(
        "concat('site-', user_id % 4) as site",
        "cast(event_id as string) as event_id",
        "cast(ts as timestamp) as timestamp",
        EVENT_CHANNEL,
        "if(hour(ts) < 15, 'lunch', 'dinner') as daypart",
        "try_cast(get_json_object(props, '$.k') as int) as item_count",
        "value as subtotal",
        "'placed' as status",
    )


# Raw table: the driver table it is projected from, and the projection.
BINDINGS = {
    "orders": ("orders", raw_orders),
    "order_items": ("lineitem", raw_order_items),
    "menu_items": ("part", raw_menu_items),
    "ingredients": ("supplier", raw_ingredients),
    "suppliers": ("nation", raw_suppliers),
    "recipes": ("lineitem", raw_recipes),
    "employees": ("supplier", raw_employees),
    "employee_shifts": ("lineitem", raw_employee_shifts),
    "inventory_movements": ("lineitem", raw_inventory_movements),
    "reviews": ("events", raw_reviews),
    "daily_context": ("orders", raw_daily_context),
}


class BoundTables(Mapping[str, DataFrame]):
    """The raw tables by name, each projected when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            source, project = BINDINGS[name]
            self._made[name] = project(read_table(self._spark, self._sf_dir, source))
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)


def raw_tables(spark: SparkSession, sf_dir: str) -> BoundTables:
    return BoundTables(spark, sf_dir)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, raw_tables(spark, sf_dir))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(read_table(spark, sf_dir, "events"))
