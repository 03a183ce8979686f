"""Every registered query by name: operators bound to the driver's tables.

A name starts with the operator's id in the survey.  Each callable takes the session and the
folder of the tables and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse import schemas
from tallyhouse.functions import aggregate, count_where, mean, row_hash, select, share_where, weighted_mean
from tallyhouse.operators import calendar, derivations, drilldowns, forecasting, history, marts, quality
from tallyhouse.operators.ordering import grouped_percentiles, rank_and_group_total, top_rows
from tallyhouse.plans import bindings
from tallyhouse.plans.present import present
from tallyhouse.plans.warehouse import EVENT_TABLES, MARTS, StoredWarehouse, Warehouse
from tallyhouse.sources import csv_tables, tables
from tallyhouse.sources.channels import channel_reference
from tallyhouse.sources.workdir import new_folder, remove, settle, shuffles_dropped, tasks_for
from tallyhouse.streaming import rollups
from tallyhouse.streaming.board import LiveBoard, summary_message
from tallyhouse.streaming.source import finish, split_by_contract, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, build: Query) -> None:
    QUERIES[name] = lambda spark, sf_dir: present(build(spark, sf_dir))


def on_warehouse(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    register(name, lambda spark, sf_dir: build(bindings.warehouse(spark, sf_dir)))


def sized(w: Warehouse, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """A result written (eager) by tasks that the raw tables' rows cut, so that no task grows with them."""
    with tasks_for(w.spark, w.most_rows):
        return settle(build(), label)


def on_feed(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """Queries over the valid events of the live feed."""
    register(name, lambda spark, sf_dir: build(history.valid_events(bindings.feed(spark, sf_dir))))


# --- 2.2 to 2.5: layers ----------------------------------------------------------------------

LAYERS = {
    "p1_stg_orders": "stg_orders",
    "p2_stg_order_items": "stg_order_items",
    "p3_stg_reviews": "stg_reviews",
    "p4_stg_employee_shifts": "stg_employee_shifts",
    "p5_stg_inventory_movements": "stg_inventory_movements",
    "p6_stg_daily_context": "stg_daily_context",
    "p7_stg_menu_items": "stg_menu_items",
    "p8_stg_ingredients": "stg_ingredients",
    "p9_stg_suppliers": "stg_suppliers",
    "p10_stg_recipes": "stg_recipes",
    "p11_stg_employees": "stg_employees",
    "d1_dim_date": "dim_date",
    "d2_dim_menu_item": "dim_menu_item",
    "d3_dim_ingredient": "dim_ingredient",
    "d4_dim_employee": "dim_employee",
    "d4_dim_supplier": "dim_supplier",
    "f1_fact_orders": "fact_orders",
    "f2_fact_order_items": "fact_order_items",
    "f3_fact_employee_shifts": "fact_employee_shifts",
    "f4_fact_reviews": "fact_reviews",
    "f5_fact_inventory_movements": "fact_inventory_movements",
    "i1_hourly_demand": "int_hourly_demand",
    "i2_ingredient_consumption": "int_ingredient_consumption",
    "i3_menu_item_costs": "int_menu_item_costs",
    "i4_order_financials": "int_order_financials",
    "i5_service_performance": "int_service_performance",
    "i6_shift_labour_costs": "int_shift_labour_costs",
    "k1_daily_performance": "mart_daily_performance",
    "k2_channel_profitability": "mart_channel_profitability",
    "k3_menu_engineering": "mart_menu_engineering",
    "k4_labour_productivity": "mart_labour_productivity",
    "k5_service_quality": "mart_service_quality",
    "k6_inventory_risk": "mart_inventory_risk",
    "k7_review_analysis": "mart_review_analysis",
}
for _name, _layer in LAYERS.items():
    on_warehouse(_name, lambda w, layer=_layer: getattr(w, layer))

on_warehouse(
    "d4_dim_channel",
    lambda w: w.dim_channel.join(
        w.stg_orders.groupBy("channel").agg(F.count("*").alias("orders_seen")), "channel", "left"
    ),
)

# --- 2.1: sources and sinks ------------------------------------------------------------------


def _raw_columns(table: str) -> list[str]:
    return StructType.fromDDL(schemas.RAW_SCHEMAS[table]).names


def _as_csv(spark: SparkSession, rows: DataFrame, table: str) -> str:
    folder = new_folder(spark, f"csv-{table}")
    declared = StructType.fromDDL(schemas.RAW_SCHEMAS[table])
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in declared])
    # at its fastest, gzip takes about snappy's time and a quarter less of the disk
    typed.write.option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(folder)
    return folder


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_tables(spark, sf_dir)["orders"]
    schema = StructType.fromDDL(schemas.RAW_SCHEMAS["orders"])
    scanned = csv_tables.scan_csv(spark, _as_csv(spark, raw, "orders"), schema)
    return Warehouse(spark, {"orders": scanned}).stg_orders


def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables are there as files, the others are missing."""
    raw = bindings.raw_tables(spark, sf_dir)
    absent = new_folder(spark, "absent")
    paths = {t: _as_csv(spark, raw[t], t) if t in ("orders", "reviews") else f"{absent}/{t}.csv" for t in sorted(raw)}
    return csv_tables.source_report(spark, paths).select("table_name", "is_missing", "row_count")


def seed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_tables(spark, sf_dir)["menu_items"]
    schema = StructType.fromDDL(schemas.RAW_SCHEMAS["menu_items"])
    scanned = csv_tables.scan_seed(spark, _as_csv(spark, raw, "menu_items"), schema)
    return Warehouse(spark, {"menu_items": scanned}).stg_menu_items


def load_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = csv_tables.with_load_metadata(
        spark.read.parquet(f"{sf_dir}/customer.parquet"), "batch-1", datetime(2024, 1, 1)
    )
    return loaded.select("c_custkey", *csv_tables.METADATA)


def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.read_table(spark, sf_dir, "lineitem")
    return lines.selectExpr("l_orderkey", "l_linenumber", f"{row_hash(lines.columns)} as record_hash")


def batch_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the lines; the later one has shipped lines closed, returned ones gone and new ones added."""
    lines = bindings.read_table(spark, sf_dir, "lineitem")
    earlier = lines.where("l_shipdate < timestamp_ntz '2001-01-01 00:00:00'")
    later = lines.where("l_returnflag <> 'R'").withColumn("l_linestatus", F.expr("if(l_returnflag = 'A', 'F', l_linestatus)"))
    loads = []
    for batch_id, rows in (("batch-1", earlier), ("batch-2", later)):
        path = new_folder(spark, batch_id)
        stamped = csv_tables.with_load_metadata(rows, batch_id, datetime(2024, 1, 1), F.lit("lineitem.csv"))
        tables.replace_table(stamped, path)
        loads.append(spark.read.parquet(path))
    return csv_tables.changed_rows(*loads, ["l_orderkey", "l_linenumber"])


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = bindings.warehouse(spark, sf_dir)
    path = new_folder(spark, "replaced")
    tables.replace_table(w.stg_reviews, path)
    tables.replace_table(w.stg_orders, path)
    return spark.read.parquet(path).groupBy("channel", "status").agg(F.count("*").alias("rows"))


def channel_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = bindings.warehouse(spark, sf_dir).stg_orders
    return (
        orders.groupBy("channel")
        .agg(F.count("*").alias("order_count"))
        .join(F.broadcast(channel_reference(spark)), "channel", "left")
    )


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "marts")
    bindings.warehouse(spark, sf_dir).store(folder, ("mart_service_quality",))
    return StoredWarehouse(spark, folder).load_mart("mart_service_quality")


def stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "layers")
    names = ("dim_date", "fact_orders", "mart_channel_profitability", "mart_service_quality")
    bindings.warehouse(spark, sf_dir).store(folder, names)
    merged = None
    for name in names:
        line = spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        merged = line if merged is None else merged.unionByName(line)
    return merged


def _rows_of(tables_by_name: dict[str, DataFrame], *more: str) -> DataFrame:
    """One line per table: its name, its rows and further aggregates."""
    merged = None
    for name, rows in tables_by_name.items():
        line = rows.selectExpr(f"'{name}' as table_name", "*").groupBy("table_name").agg(F.count("*").alias("rows"), *map(F.expr, more))
        merged = line if merged is None else merged.unionByName(line)
    return merged


def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw table from its CSV, as one load.

    All sources are there when the load begins.  A source, which is this query's own, goes once its table holds every row of
    it.  Tables with a row per event come first: a source is smaller than its table, so the disk is fullest at the end.
    """
    raw, folder = bindings.raw_tables(spark, sf_dir), new_folder(spark, "raw")
    names = sorted(schemas.RAW_SCHEMAS, key=lambda t: t not in EVENT_TABLES)
    with shuffles_dropped(spark):
        sources = {t: _as_csv(spark, raw[t], t) for t in names}
        counts = csv_tables.load_raw_tables(spark, sources, folder, lambda t: remove(spark, sources[t]))
        lines = [_load_line(spark, f"{folder}/{t}", t, n) for t, n in counts.items()]
    return reduce(DataFrame.unionByName, lines)


def _load_line(spark: SparkSession, path: str, table: str, rows: int) -> DataFrame:
    """Rows, distinct hashes and batches of a loaded table, written (eager), so that one table's hashes are shuffled at a time.

    The hashes are compared as their 16 bytes, which stand for the 32 digits one to one.
    """
    loaded = spark.read.parquet(path)
    with tasks_for(spark, rows):
        hashes = settle(aggregate(loaded.selectExpr("unhex(record_hash) as hash").distinct(), [], "count(hash) as hashes"), f"hashes-{table}")
        batches = aggregate(loaded.selectExpr(f"'{table}' as table_name", "batch_id"), ["table_name"], "count(*) as rows", "count(distinct batch_id) as batches")
        return settle(batches.withColumn("hashes", hashes.scalar()).select("table_name", "rows", "hashes", "batches"), f"load-{table}")


def load_all_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seed table from its CSV, through staging."""
    raw, seeds = bindings.raw_tables(spark, sf_dir), {}
    for t in schemas.SEED_TABLES:
        seeds[t] = csv_tables.scan_seed(spark, _as_csv(spark, raw[t], t), StructType.fromDDL(schemas.RAW_SCHEMAS[t]))
    w = Warehouse(spark, seeds)
    return _rows_of({t: getattr(w, f"stg_{t}") for t in schemas.SEED_TABLES})


def store_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dimension, fact and mart, written and read back; marts by their allow-listed name."""
    folder = new_folder(spark, "layers")
    counts = bindings.warehouse(spark, sf_dir).store(folder)
    stored = StoredWarehouse(spark, folder)
    return _rows_of({t: stored.load_mart(t) if t in MARTS else spark.read.parquet(f"{folder}/{t}") for t in counts})


def table_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return tables.freshness(
        {t: bindings.read_table(spark, sf_dir, t).select(F.col(c).alias("loaded_at")) for t, c in stamped.items()}
    )


register("s1_csv_scan", csv_scan)
register("s2_missing_sources", source_report)
register("s1_load_all", load_all)
register("s3_load_metadata", load_metadata)
register("s4_row_hash", row_hashes)
register("s4_batch_changes", batch_changes)
register("s5_replace_table", replaced_table)
register("s6_seed_scan", seed_scan)
register("s6_load_all_seeds", load_all_seeds)
register("s7_channel_reference", channel_lookup)
register("s8_load_mart", stored_mart)
register("s11_layered_store", stored_layers)
register("s11_store_all", store_all)
register("s12_freshness", table_freshness)

# --- 2.6: joins ------------------------------------------------------------------------------

on_warehouse(
    "j1_inner_join",
    lambda w: w.fact_order_items.groupBy("channel", "daypart").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity")
    ),
)
on_warehouse(
    "j2_left_join",
    lambda w: aggregate(w.fact_reviews, ["daypart"], "count(*) as reviews", f"{mean('rating')} as rating"),
)
on_warehouse(
    "j3_full_outer_join",
    lambda w: w.stg_orders.groupBy("business_date")
    .agg(F.count("*").alias("orders"))
    .join(
        w.stg_inventory_movements.groupBy("business_date").agg(F.count("*").alias("movements")),
        "business_date",
        "full",
    ),
)
on_warehouse(
    "j4_one_row_scalar",
    lambda w: aggregate(w.stg_orders, ["channel"], "count(*) as orders")
    .withColumn("_all", w.stg_orders.agg(F.count("*")).scalar())
    .selectExpr("channel", "orders", "orders / _all as share"),
)
on_warehouse(
    "j5_using_join",
    lambda w: w.stg_order_items.join(w.stg_orders, on="order_id")
    .groupBy("status", "item_status")
    .agg(F.count("*").alias("lines")),
)
on_warehouse(
    "j6_composite_merge",
    lambda w: w.mart_service_quality.join(w.mart_labour_productivity.drop("order_count"), on=["business_date", "daypart"])
    .select("business_date", "daypart", "order_count", "staffing_level_flag"),
)
on_warehouse("j7_left_merge", lambda w: quality.menu_summary(w.stg_menu_items, w.recipe_costs))
on_warehouse(
    "j8_orphan_reviews",
    lambda w: quality.orphans(w.stg_reviews, "review_id", "order_id", w.stg_orders, "order_id", "unknown order"),
)

# --- 2.7: aggregates -------------------------------------------------------------------------

on_warehouse(
    "g1_basic_aggregates",
    lambda w: aggregate(
        w.stg_orders,
        ["channel"],
        "count(*) as orders",
        "sum(net_sales) as net_sales",
        f"{mean('net_sales')} as average_net_sales",
        "max(net_sales) as largest",
    ),
)
on_warehouse(
    "g2_count_distinct",
    lambda w: w.stg_order_items.groupBy("menu_item_id").agg(F.countDistinct("order_id").alias("orders")),
)
on_warehouse(
    "g3_conditional_aggregates",
    lambda w: aggregate(
        w.stg_orders,
        ["daypart"],
        f"{count_where('is_late')} as late",
        f"{share_where('has_missing_item')} as missing_share",
    ),
)
on_warehouse("g4_median", lambda w: grouped_percentiles(w.stg_orders, ["channel"], "preparation_minutes", {"median": 0.5}))
on_warehouse("g5_percentile_cont", lambda w: grouped_percentiles(w.stg_orders, ["channel"], "preparation_minutes", {"p90": 0.9}))
on_warehouse("g6_distinct_pairs", lambda w: marts.affected_pairs(w.stg_recipes, w.stg_menu_items))
on_warehouse("g6_distinct_names", lambda w: marts.affected_items(w.stg_recipes, w.stg_menu_items))
on_warehouse(
    "g7_weighted_mean",
    lambda w: aggregate(
        w.stg_order_items, ["item_status"], f"{weighted_mean('unit_price', 'quantity')} as mean_unit_price"
    ),
)
on_warehouse("g8_value_counts", lambda w: drilldowns.value_counts(w.stg_inventory_movements, "movement_type"))
on_warehouse(
    "g9_boolean_mean",
    lambda w: aggregate(w.stg_reviews, ["channel"], f"{share_where('is_response_required')} as share"),
)
on_warehouse(
    "g10_argmax",
    lambda w: aggregate(
        w.int_hourly_demand,
        ["daypart"],
        "max_by(struct(business_date, order_hour, order_count), struct(order_count, business_date, order_hour)) as top",
    ).selectExpr("daypart", "top.business_date", "top.order_hour", "top.order_count"),
)
on_warehouse("g11_pivot", lambda w: drilldowns.demand_pivot(drilldowns.hourly_heatmap(w.int_hourly_demand, w.dim_date)))
on_warehouse(
    "g12_quartiles",
    lambda w: grouped_percentiles(w.stg_orders, ["daypart"], "preparation_minutes", {"q1": 0.25, "median": 0.5, "q3": 0.75}),
)
on_feed(
    "g13_count_map",
    lambda e: e.groupBy("site", "channel").agg(F.count("*").alias("n")).groupBy("site").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "n")))).alias("orders_by_channel")
    ),
)

# --- 2.8: windows, sorts, limits, sets -------------------------------------------------------


def _sales(w: Warehouse) -> DataFrame:
    items = w.stg_menu_items.select("menu_item_id", "category")
    sold = marts.sold_item_stats(w.stg_orders, w.stg_order_items)
    return select(items.join(sold, "menu_item_id", "left"), "menu_item_id, category, revenue")


on_warehouse(
    "w1_rank_in_category",
    lambda w: rank_and_group_total(
        settle(_sales(w), "ranked-items"), "category", "revenue", "sales_rank", "category_revenue"
    ),
)
on_warehouse("w2_running_balance", lambda w: quality.running_balance(w.fact_inventory_movements))
on_warehouse(
    "w3_running_sum_by_item",
    lambda w: quality.running_balance(w.fact_inventory_movements)
    .groupBy("ingredient_id")
    .agg(F.min("balance").alias("lowest"), F.max("balance").alias("highest")),
)


def each_channel(days: DataFrame) -> DataFrame:
    """Every row once per listed channel."""
    return days.selectExpr("*", f"explode(array{schemas.CHANNELS}) as channel")


def daily_by_channel(w: Warehouse) -> DataFrame:
    """Orders per channel and calendar day, quiet days as zero; the series of the forecasts."""
    counts = w.stg_orders.groupBy("channel", "business_date").agg(F.count("*").alias("order_count"))
    return each_channel(w.dim_date).join(counts, ["channel", "business_date"], "left").select(
        "channel", *forecasting.CONTEXT_COLUMNS, F.coalesce("order_count", F.lit(0)).alias("order_count")
    )


LAGS = ["previous_day_orders", "previous_week_orders", "rolling_7day_avg"]
on_warehouse(
    "w4_lags",
    lambda w: forecasting.with_lags(daily_by_channel(w), ["channel"]).select(
        "channel", "business_date", "order_count", *LAGS[:2]
    ),
)
on_warehouse(
    "w5_trailing_mean",
    lambda w: forecasting.with_lags(daily_by_channel(w), ["channel"]).select("channel", "business_date", LAGS[2]),
)
on_warehouse(
    "w6_orders_in_same_hour",
    lambda w: derivations.orders_in_same_hour(w.stg_orders).select("order_id", "order_hour", "orders_in_hour"),
)
on_feed("w7_trailing_window", lambda e: history.rolling_kpis(e, 15))

on_warehouse(
    "o1_top_items",
    lambda w: top_rows(
        aggregate(w.stg_order_items, ["menu_item_id"], "sum(quantity) as units"), "units desc, menu_item_id", 10
    ),
)
on_warehouse(
    "o2_bottom_ingredients",
    lambda w: top_rows(
        select(w.dim_ingredient, "ingredient_id, estimated_unit_cost"), "estimated_unit_cost, ingredient_id", 5
    ),
)
on_warehouse(
    "o3_sort_head",
    lambda w: top_rows(
        select(w.stg_orders.where("status = 'Cancelled'"), "order_id, business_date, net_sales, subtotal"),
        "subtotal desc, order_id",
        15,
    ),
)
on_feed("o4_sorted_history", lambda e: history.history_table(e, "pickup", "subtotal", descending=False))
on_feed("o5_latest_events", lambda e: history.latest_events(e, history.FEED_LIMIT))
on_warehouse(
    "u1_append_rows",
    lambda w: w.stg_orders.select("business_date", "channel")
    .unionByName(w.stg_reviews.select(F.col("review_date").alias("business_date"), "channel"))
    .groupBy("business_date", "channel")
    .agg(F.count("*").alias("rows")),
)
on_warehouse(
    "u2_key_difference",
    lambda w: w.stg_orders.select("order_id").join(w.stg_order_items.select("order_id"), "order_id", "left_anti"),
)

# --- 2.10: filters and drill-downs -----------------------------------------------------------

ITEM = "7"
SPAN = (date(1996, 1, 1), date(1996, 12, 31))

on_warehouse("q1_apply_filters", lambda w: drilldowns.apply_filters(
    w.stg_orders.select("order_id", "business_date", "channel"), date_range=SPAN, members={"channel": ["dine_in", "pickup"]}
))
on_warehouse("q1_filters_open", lambda w: drilldowns.apply_filters(
    w.stg_orders.select("order_id", "business_date", "channel"), members={"channel": None}
))
on_warehouse("q1_filters_empty_list", lambda w: drilldowns.apply_filters(
    w.stg_orders.select("order_id", "business_date", "channel"), members={"channel": []}
))
on_warehouse("q2_date_domain", lambda w: drilldowns.date_domain(w.mart_service_quality))
on_warehouse("q2_option_domain", lambda w: drilldowns.option_domain(w.stg_menu_items, "category"))
on_warehouse("q3_item_demand_by_hour", lambda w: drilldowns.item_demand_by_hour(w.stg_order_items, w.stg_orders, ITEM))
on_warehouse(
    "q4_item_demand_by_temperature",
    lambda w: drilldowns.item_demand_by_temperature(w.stg_order_items, w.stg_orders, ITEM),
)
on_warehouse("q5_item_channel_distribution", lambda w: drilldowns.item_channel_distribution(w.fact_order_items, ITEM))
on_warehouse("q6_hourly_heatmap", lambda w: drilldowns.hourly_heatmap(w.int_hourly_demand, w.dim_date))
on_warehouse("q7_prep_vs_promise", lambda w: drilldowns.preparation_vs_promise(w.stg_orders, w.dim_date))
on_warehouse("q8_shift_grain", lambda w: drilldowns.shift_grain(w.fact_employee_shifts))
on_warehouse(
    "q9_busiest_slot",
    lambda w: drilldowns.busiest_slot(drilldowns.preparation_vs_promise(w.stg_orders, w.dim_date)),
)
on_warehouse(
    "q9_no_slot",
    lambda w: drilldowns.busiest_slot(drilldowns.preparation_vs_promise(w.stg_orders.where("preparation_minutes < 0"), w.dim_date)),
)
on_warehouse("q10_executive_kpis", lambda w: drilldowns.executive_kpis(w.mart_daily_performance))
on_warehouse("q11_orders_by_daypart", lambda w: drilldowns.orders_by_daypart(w.mart_service_quality))
on_warehouse("q11_margin_by_category", lambda w: drilldowns.margin_by_category(w.mart_menu_engineering))
on_warehouse("q12_best_sellers", lambda w: drilldowns.menu_top(w.mart_menu_engineering, "units_sold"))
on_warehouse("q12_highest_margin", lambda w: drilldowns.menu_top(w.mart_menu_engineering, "contribution_margin_pct"))
on_warehouse(
    "q12_plowhorses", lambda w: drilldowns.menu_top(w.mart_menu_engineering, "units_sold", menu_class="Plowhorse")
)
on_warehouse(
    "q12_puzzles",
    lambda w: drilldowns.menu_top(w.mart_menu_engineering, "contribution_margin_pct", menu_class="Puzzle"),
)
on_warehouse("q13_category_comparison", lambda w: drilldowns.category_comparison(w.mart_menu_engineering))
on_warehouse("q14_per_unit_cost", lambda w: drilldowns.per_unit_cost(w.mart_menu_engineering))
on_warehouse("q15_channel_comparison", lambda w: drilldowns.channel_comparison(w.mart_channel_profitability))
on_warehouse("q16_service_kpis", lambda w: drilldowns.service_kpis(w.mart_service_quality))
on_warehouse("q17_preparation_by_daypart", lambda w: drilldowns.preparation_by_daypart(w.mart_service_quality))
on_warehouse("q18_peak_windows", lambda w: drilldowns.peak_windows(w.mart_service_quality))
on_warehouse(
    "q19_outcomes_by_staffing",
    lambda w: drilldowns.outcomes_by_staffing(w.mart_service_quality, w.mart_labour_productivity),
)
on_warehouse(
    "q20_demand_pivot",
    lambda w: drilldowns.demand_pivot(drilldowns.hourly_heatmap(w.int_hourly_demand, w.dim_date)),
)
on_warehouse("q21_labour_kpis", lambda w: drilldowns.labour_kpis(w.mart_labour_productivity))
on_warehouse("q21_hours_trend", lambda w: drilldowns.hours_trend(w.mart_labour_productivity))
on_warehouse("q21_understaffed", lambda w: drilldowns.staffing_windows(w.mart_labour_productivity, "Understaffed"))
on_warehouse("q21_overstaffed", lambda w: drilldowns.staffing_windows(w.mart_labour_productivity, "Overstaffed"))
on_warehouse("q22_labour_cost_quartiles", lambda w: drilldowns.labour_cost_quartiles(w.mart_labour_productivity))
on_warehouse("q23_inventory_kpis", lambda w: drilldowns.inventory_kpis(w.mart_inventory_risk))
on_warehouse("q23_reorder_list", lambda w: drilldowns.reorder_list(w.mart_inventory_risk))
on_warehouse("q23_stock_value_by_category", lambda w: drilldowns.stock_value_by_category(w.mart_inventory_risk))
on_warehouse("q23_most_wasted", lambda w: drilldowns.most_wasted(w.mart_inventory_risk))
on_warehouse("q23_lowest_cover", lambda w: drilldowns.lowest_cover(w.mart_inventory_risk))
on_warehouse("q24_review_kpis", lambda w: drilldowns.review_kpis(w.mart_review_analysis))
for _column in ("business_date", "channel", "preparation_time_band", "daypart"):
    on_warehouse(
        f"q24_rating_by_{_column}", lambda w, c=_column: drilldowns.rating_by(w.mart_review_analysis, c)
    )
for _column in ("rating", "complaint_category"):
    on_warehouse(
        f"q24_counts_by_{_column}", lambda w, c=_column: drilldowns.value_counts(w.mart_review_analysis, c)
    )
on_warehouse("q24_latest_low_ratings", lambda w: drilldowns.latest_low_ratings(w.mart_review_analysis))
CATEGORIES = ["ECONOMY", "SMALL", "PROMO"]
on_warehouse(
    "q25_quadrant_lines",
    lambda w: drilldowns.quadrant_lines(settle(w.mart_menu_engineering, "menu"), CATEGORIES),
)

# --- 2.11: data quality ----------------------------------------------------------------------

on_warehouse("v1_violation_report", lambda w: quality.report("orders", quality.failures(
    w.stg_orders, "order_id",
    {"large refund": "refund_amount > 200000", "late": "is_late", "never": "subtotal < 0"},
)))
on_warehouse("v2_daily_context", lambda w: quality.check_daily_context(w.stg_daily_context))
on_warehouse("v3_orders", lambda w: quality.check_orders(w.stg_orders))
on_warehouse("v4_order_items", lambda w: quality.check_order_items(w.stg_order_items, w.stg_orders, w.stg_menu_items))
on_warehouse("v5_reviews", lambda w: quality.check_reviews(w.stg_reviews, w.stg_orders))
on_warehouse("v6_shifts", lambda w: quality.check_shifts(w.stg_employee_shifts, w.stg_employees))
on_warehouse(
    "v7_inventory", lambda w: quality.check_inventory_movements(w.stg_inventory_movements, w.stg_ingredients)
)
on_warehouse("v8_all_checks", lambda w: quality.run_all_checks(
    w.stg_daily_context, w.stg_orders, w.stg_order_items, w.stg_reviews, w.stg_menu_items,
    w.stg_employee_shifts, w.stg_employees, w.stg_inventory_movements, w.stg_ingredients,
))
on_warehouse("v9_unique", lambda w: quality.duplicated_keys(w.stg_order_items, "order_item_id"))
on_warehouse("v9_not_null", lambda w: quality.missing_keys(w.stg_reviews, "rating").select("review_id"))
on_warehouse("v9_key_summary", lambda w: quality.key_test_summary({
    "stg_menu_items": (w.stg_menu_items, "menu_item_id"),
    "stg_ingredients": (w.stg_ingredients, "ingredient_id"),
    "stg_suppliers": (w.stg_suppliers, "supplier_id"),
    "stg_employees": (w.stg_employees, "employee_id"),
    "stg_daily_context": (w.stg_daily_context, "business_date"),
    "stg_orders": (w.stg_orders, "order_id"),
    "stg_order_items": (w.stg_order_items, "order_item_id"),
    "stg_reviews": (w.stg_reviews, "review_id"),
    "stg_employee_shifts": (w.stg_employee_shifts, "shift_id"),
    "stg_inventory_movements": (w.stg_inventory_movements, "movement_id"),
}))
on_warehouse("v10_accepted_channels", lambda w: quality.unaccepted_values(w.stg_orders, "channel", schemas.CHANNELS))
on_warehouse(
    "v10_accepted_departments",
    lambda w: quality.unaccepted_values(w.dim_employee, "department", schemas.DEPARTMENTS),
)
on_warehouse(
    "v11_review_orders",
    lambda w: sized(
        w, lambda: quality.broken_references(w.fact_reviews, "order_id", w.stg_orders, "order_id"), "broken-references"
    ),
)
on_warehouse(
    "v11_order_channels", lambda w: quality.broken_references(w.stg_orders, "channel", w.dim_channel, "channel")
)


def _per_column(parts: dict[tuple[str, str], DataFrame]) -> DataFrame:
    merged = None
    for (table, column), rows in parts.items():
        named = rows.selectExpr(f"'{table}' as table_name", f"'{column}' as column_name", "*")
        merged = named if merged is None else merged.unionByName(named)
    return merged


on_warehouse(
    "v9_declared_keys", lambda w: quality.key_test_summary({t: (getattr(w, t), k) for t, k in schemas.DECLARED_KEYS.items()})
)
on_warehouse(
    "v10_declared_values",
    lambda w: _per_column(
        {(t, c): quality.unaccepted_values(getattr(w, t), c, allowed) for (t, c), allowed in schemas.DECLARED_VALUES.items()}
    ),
)
on_warehouse(
    "v11_declared_references",
    lambda w: sized(w, lambda: _per_column({
        (t, c): quality.broken_references(getattr(w, t), c, getattr(w, parent), c)
        for (t, c), parent in schemas.DECLARED_REFERENCES.items()
    }), "broken-references"),
)
on_warehouse("v12_negative_balance", lambda w: quality.negative_balances(w.fact_inventory_movements))
on_warehouse("v12_quantity", lambda w: quality.nonpositive_quantities(w.stg_order_items))
on_warehouse("v12_reconciliation", lambda w: quality.unreconciled_orders(w.stg_orders))
on_warehouse("v12_money", lambda w: quality.negative_money(w.stg_orders))
on_warehouse("v12_rating_range", lambda w: quality.ratings_out_of_range(w.stg_reviews))
on_warehouse("v12_shift_end", lambda w: quality.shifts_ending_early(w.stg_employee_shifts))
def seed_faults(w: Warehouse) -> DataFrame:
    """Every seed row, and beside them an item without a recipe, a recipe of nothing and an ingredient of no supplier."""

    def beside(rows: DataFrame, **fault: str) -> DataFrame:
        faulty = w.spark.range(1).selectExpr(*[f"'{v}' as {k}" for k, v in fault.items()])
        return rows.unionByName(faulty, allowMissingColumns=True)

    return quality.seed_reference_errors(
        beside(w.stg_menu_items, menu_item_id="MI998"),
        beside(w.stg_ingredients, ingredient_id="IN998", supplier_id="SU999"),
        w.stg_suppliers,
        beside(w.stg_recipes, menu_item_id="MI999", ingredient_id="IN999"),
    )


on_warehouse("v13_seed_references", seed_faults)
for _table in schemas.RAW_SCHEMAS:
    register(
        f"v14_bounds_{_table}",
        lambda spark, sf_dir, t=_table: quality.check_field_bounds(
            t, bindings.raw_tables(spark, sf_dir)[t].select(*_raw_columns(t))
        ),
    )
on_warehouse(
    "v15_seed_report",
    lambda w: quality.seed_report(w.stg_menu_items, w.stg_ingredients, w.stg_recipes, w.recipe_costs),
)
on_warehouse("v16_menu_summary", lambda w: quality.menu_summary(w.stg_menu_items, w.recipe_costs))

# --- 2.12: forecasting and staffing ----------------------------------------------------------

SERIES = ["channel"]
BASELINES = (forecasting.NAIVE, forecasting.MOVING_AVERAGE)


def _features(w: Warehouse) -> DataFrame:
    return forecasting.feature_frame(settle(w.mart_daily_performance, "daily"))


def _split(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    return forecasting.chronological_split(settle(_features(w), "features"))


def future_days(w: Warehouse, days: int = forecasting.FORECAST_DAYS) -> DataFrame:
    """Calendar rows after the last known date, with the bindings' weather."""
    last = w.stg_daily_context.agg(F.max("business_date").alias("d"))
    span = last.selectExpr("date_add(d, 1) as first_date", f"date_add(d, {days}) as last_date")
    raw = calendar.enrich_calendar(calendar.day_spine(span)).selectExpr("*", *bindings.WEATHER)
    return Warehouse(w.spark, {"daily_context": raw}).stg_daily_context


def _predictions(w: Warehouse, fit: Callable) -> DataFrame:
    train, test = _split(w)
    return fit(train)(test).select("business_date", "order_count", "prediction")


def normal_equations(w: Warehouse) -> DataFrame:
    """Per column, its products with the fitted values, summed over the rows fitted on.

    Least squares makes these equal to the products with the actual values, which a statement can sum.
    """
    train, _ = _split(w)
    values = [f"struct('{c}' as feature, double({c}) as value)" for c in forecasting.NUMERIC_FEATURES]
    flags = [f"struct(concat('{c}=', {c}) as feature, 1D as value)" for c in forecasting.CATEGORICAL_FEATURES]
    fitted = forecasting.fit_linear_regression(train)(train).dropna(subset=forecasting.NUMERIC_FEATURES)
    products = fitted.selectExpr("prediction", f"inline(array({', '.join(values + flags)}))")
    return aggregate(products, ["feature"], "count(*) as rows", "floor(sum(prediction * value) * 1000 + 0.5) / 1000D as product")


def score_baselines(w: Warehouse) -> DataFrame:
    train, test = _split(w)
    return forecasting.score_models(forecasting.fit_models(train, names=BASELINES), test)


def score_all(w: Warehouse) -> DataFrame:
    train, test = _split(w)
    return forecasting.score_models(forecasting.fit_models(train), test)


def score_by_channel(w: Warehouse) -> DataFrame:
    features = settle(forecasting.feature_frame(daily_by_channel(w), SERIES), "channel-features")
    train, test = forecasting.chronological_split(features, SERIES)
    return forecasting.score_models(forecasting.fit_models(train, SERIES), test)


def forecast_with(w: Warehouse, model: forecasting.Model) -> DataFrame:
    daily = settle(w.mart_daily_performance, "daily")
    return forecasting.forecast(daily, future_days(w), model)


def forecast_by_channel(w: Warehouse) -> DataFrame:
    daily = settle(daily_by_channel(w), "daily-channel")
    return forecasting.forecast(daily, each_channel(future_days(w)), forecasting.moving_average_model, SERIES)


def forecast_best(w: Warehouse) -> DataFrame:
    """The whole chain: score all models, refit the best on all history, forecast, staff."""
    daily = settle(w.mart_daily_performance, "daily")
    features = settle(forecasting.feature_frame(daily), "features")
    train, test = forecasting.chronological_split(features)
    best = forecasting.best_model(forecasting.score_models(forecasting.fit_models(train), test))
    predicted = forecasting.forecast(daily, future_days(w), forecasting.FITTERS[best](features))
    return forecasting.recommend_staffing(predicted, w.mart_labour_productivity, w.fact_employee_shifts)


def staffing_from_history(w: Warehouse) -> DataFrame:
    days = w.mart_daily_performance.select("business_date", F.col("order_count").alias("predicted_orders"))
    return forecasting.recommend_staffing(days, w.mart_labour_productivity, w.fact_employee_shifts)


on_warehouse("x1_features", lambda w: forecasting.feature_frame(w.mart_daily_performance))
on_warehouse("x1_features_by_channel", lambda w: forecasting.feature_frame(daily_by_channel(w), SERIES))
on_warehouse(
    "x2_chronological_split",
    lambda w: forecasting.mark_holdout(forecasting.feature_frame(daily_by_channel(w), SERIES), SERIES)
    .groupBy("channel", "is_test")
    .agg(F.min("business_date").alias("first"), F.max("business_date").alias("last"), F.count("*").alias("rows")),
)
on_warehouse("x3_metrics", score_baselines)
on_warehouse("x4_previous_week", lambda w: _predictions(w, lambda train: forecasting.previous_week_model))
on_warehouse("x5_moving_average", lambda w: _predictions(w, lambda train: forecasting.moving_average_model))
on_warehouse("x6_linear_regression", lambda w: _predictions(w, forecasting.fit_linear_regression))
on_warehouse("x6_normal_equations", normal_equations)
on_warehouse("x7_random_forest", lambda w: _predictions(w, lambda t: forecasting.fit_random_forest(t, trees=200)))
on_warehouse("x8_model_scores", score_all)
on_warehouse("x8_scores_by_channel", score_by_channel)
on_warehouse("x9_forecast_previous_week", lambda w: forecast_with(w, forecasting.previous_week_model))
on_warehouse("x9_forecast_moving_average", lambda w: forecast_with(w, forecasting.moving_average_model))
on_warehouse("x9_forecast_by_channel", forecast_by_channel)
on_warehouse("x9_forecast_best_model", forecast_best)
on_warehouse("x10_staffing", staffing_from_history)

# --- 2.13: the live feed in batch ------------------------------------------------------------

SESSION_START = "timestamp '2024-01-01 00:00:00'"
NOON = "timestamp '2024-01-15 12:00:00'"


on_feed("r1_rolling_kpis", lambda e: history.rolling_kpis(e, 15, ["site"]))
on_feed("r2_snapshot_latest", lambda e: history.snapshot(e, 600))
on_feed("r2_snapshot_as_of", lambda e: history.snapshot(e.where(f"timestamp <= {NOON}"), 600, NOON))
on_feed("r3_recent_events", lambda e: history.recent_events(e, 20, 600))
on_feed("r4_session_history", lambda e: history.latest_events(e, history.HISTORY_LIMIT))
on_feed("r5_session_summary", lambda e: history.session_summary(e, SESSION_START))
on_feed(
    "r5_session_summary_capped",
    lambda e: history.session_summary(history.latest_events(e, history.HISTORY_LIMIT), SESSION_START),
)
on_feed("r6_minute_buckets", lambda e: history.minute_buckets(e, 600))
on_feed("r7_channel_breakdown", history.channel_breakdown)
on_feed("r8_history_table", lambda e: history.history_table(history.latest_events(e, history.HISTORY_LIMIT)))
register(
    "r10_rejected_events", lambda spark, sf_dir: history.rejected_events(bindings.feed(spark, sf_dir))
)
register("r10_valid_events", lambda spark, sf_dir: history.valid_events(bindings.feed(spark, sf_dir)))

# --- 2.13: the live feed as a stream ---------------------------------------------------------

def _event_files(sf_dir: str) -> str:
    """The one events file as a pattern; a stream takes folders or patterns, not a file."""
    return f"{sf_dir}/[e]vents.parquet"


def _raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files."""
    schema = bindings.read_table(spark, sf_dir, "events").schema
    return bindings.order_events(spark.readStream.schema(schema).parquet(_event_files(sf_dir)))


#: Events of a slice of the feed, about; a batch of a stream is held in Python by feed and share.
SLICE_EVENTS = 1_000_000
#: Files of a slice, so that several tasks read it.
SLICE_FILES = 8


def _slices(spark: SparkSession, sf_dir: str, least: int) -> Iterator[DataFrame]:
    """The events in order of time and id, in as many parts as their number asks for; those without a time are in the first.

    They are dealt to ranges once, and each part reads its own ranges only.
    """
    events, folder = bindings.read_table(spark, sf_dir, "events"), new_folder(spark, "slices")
    count = max(least, -(-events.count() // SLICE_EVENTS))
    dealt = events.repartitionByRange(count * SLICE_FILES, "ts", "event_id")
    dealt.withColumn("slice", F.expr(f"spark_partition_id() div {SLICE_FILES}")).write.partitionBy("slice").parquet(folder)
    schema = StructType(events.schema.fields).add("slice", "integer")
    for n in range(count):
        yield spark.read.schema(schema).parquet(folder).where(F.col("slice") == n).drop("slice")


def _sliced_stream(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], list], least: int = 2) -> None:
    """Runs streams over the events as they arrive in parts, in order of time, restarting from the checkpoint."""
    schema, folder = bindings.read_table(spark, sf_dir, "events").schema, new_folder(spark, "arrivals")
    for part in _slices(spark, sf_dir, least):
        part.write.mode("append").parquet(folder)
        finish(*start(bindings.order_events(spark.readStream.schema(schema).parquet(folder))))


def stream_contract(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "contract")
        finish(*split_by_contract(_raw_stream(spark, sf_dir), folder))
        return spark.read.parquet(f"{folder}/{name}")

    return run


def stream_board(show: Callable[[LiveBoard], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        board = LiveBoard(spark, new_folder(spark, "board"))
        _sliced_stream(spark, sf_dir, lambda events: [board.start(events)])
        return show(board)

    return run


def stream_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 on the stream: a tick a day behind the last event moves the clock past every window, which empties."""
    board, ticks, arrivals = LiveBoard(spark, new_folder(spark, "board"), timers=True), new_folder(spark, "ticks"), new_folder(spark, "arrivals")
    events = bindings.read_table(spark, sf_dir, "events")
    tick = events.selectExpr("max(cast(ts as timestamp)) + interval 1 day as timestamp")
    tick.where("false").write.parquet(ticks)

    def follow() -> None:
        stream, clock = (spark.readStream.schema(s).parquet(f) for s, f in ((events.schema, arrivals), (tick.schema, ticks)))
        finish(board.start(bindings.order_events(stream), clock))

    for part in _slices(spark, sf_dir, 1):
        part.write.mode("append").parquet(arrivals)
        follow()
    tick.write.mode("append").parquet(ticks)
    follow()
    return board.latest().selectExpr("site", "timestamp", "window_minutes", "order_count", "total_revenue", "average_items_per_order", "bigint(size(orders_by_channel)) as channels")


def stream_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "minutes")
    _sliced_stream(
        spark,
        sf_dir,
        lambda events: [rollups.write_changes(rollups.minute_counts(history.valid_events(events)), folder, "minutes")],
    )
    return rollups.read_minutes(spark, folder, "minutes")


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "totals")
    _sliced_stream(
        spark,
        sf_dir,
        lambda events: [rollups.write_latest(rollups.channel_totals(history.valid_events(events)), folder, "totals")],
    )
    return rollups.latest_table(spark, folder, "totals").read()


def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 on the stream: both rollups run over the arrivals, and their tables make the summary."""
    folder = new_folder(spark, "session")

    def start(events: DataFrame) -> list:
        valid = history.valid_events(events)
        return [
            rollups.write_changes(rollups.minute_counts(valid), folder, "minutes"),
            rollups.write_latest(rollups.channel_totals(valid), folder, "totals"),
        ]

    _sliced_stream(spark, sf_dir, start)
    totals = rollups.latest_table(spark, folder, "totals").read()
    return history.summarise_session(totals, rollups.read_minutes(spark, folder, "minutes"), SESSION_START)


def _summary_fields(messages: DataFrame) -> DataFrame:
    fields = {"type": "$.type", "order_count": "$.summary.order_count", "dine_in": "$.summary.orders_by_channel.dine_in"}
    return messages.selectExpr(*[f"get_json_object(value, '{path}') as {name}" for name, path in fields.items()])


def _message_fields(messages: DataFrame) -> DataFrame:
    fields = {
        "type": "$.type",
        "event_id": "$.event.event_id",
        "channel": "$.event.channel",
        "order_count": "$.summary.order_count",
        "dine_in": "$.summary.orders_by_channel.dine_in",
    }
    return messages.selectExpr(*[f"get_json_object(value, '{path}') as {name}" for name, path in fields.items()])


register("s9_event_stream", stream_contract("valid"))
register("r10_stream_rejects", stream_contract("rejected"))
register("r1_stream_rolling", stream_board(LiveBoard.kpis))
register("r2_stream_idle", stream_idle)
register("r3_stream_open_window", stream_board(LiveBoard.open_window))
register("r4_stream_history", stream_board(LiveBoard.recent_history))
register("r9_stream_latest", stream_board(LiveBoard.latest))
register("r9_summary_messages", stream_board(lambda board: _summary_fields(summary_message(board.latest()))))
register("r5_stream_session", stream_session)
register("s10_messages", stream_board(lambda board: _message_fields(board.messages())))
register("r5_stream_totals", stream_totals)
register("r6_stream_minutes", stream_minutes)

# --- 2.15: derived tables --------------------------------------------------------------------

on_warehouse(
    "a1_ingredient_consumption",
    lambda w: derivations.ingredient_consumption(w.stg_orders, w.stg_order_items, w.stg_recipes),
)
on_warehouse("a2_closing_inventory", lambda w: derivations.closing_inventory(w.stg_inventory_movements))
on_warehouse("a3_effective_staffing", lambda w: derivations.effective_staffing(w.fact_employee_shifts))
on_warehouse(
    "a4_kitchen_load",
    lambda w: derivations.kitchen_load(w.stg_orders, derivations.effective_staffing(w.fact_employee_shifts)).select(
        "order_id", "orders_in_hour", "kitchen_present", "computed_load_ratio"
    ),
)
on_warehouse("a5_base_preparation", lambda w: derivations.base_preparation(w.stg_order_items, w.stg_menu_items))
register(
    "a6_order_economics",
    lambda spark, sf_dir: derivations.order_economics(
        bindings.raw_tables(spark, sf_dir)["orders"].select(
            "order_id", "status", "subtotal", "estimated_food_cost", "discount_rate", "commission_rate", "refund_fraction"
        )
    ),
)
on_warehouse(
    "a7_complaints",
    lambda w: derivations.complaint_columns(
        w.stg_reviews.join(w.stg_orders.select("order_id", "has_missing_item", "is_late"), "order_id", "left")
    ).select("review_id", "rating", "derived_complaint_category", "derived_response_required"),
)
register(
    "a8_calendar",
    lambda spark, sf_dir: calendar.enrich_calendar(
        bindings.read_table(spark, sf_dir, "orders")
        .select(F.to_date("o_orderdate").alias("business_date"))
        .distinct()
    ).withColumnRenamed("holiday_name", "holiday"),
)

