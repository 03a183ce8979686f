"""The DuckDB statement of each registered query."""

from __future__ import annotations

from oracle.ctes import avg_exact, d, div, m2, m4, n, pick, r2, share, statement

SQL: dict[str, str] = {}


def add(name: str, body: str, **extra: str) -> None:
    SQL[name] = statement(body, extra)


# --- staged tables ---------------------------------------------------------------------------

ORDER_MONEY = "m2 {0}subtotal, m2 {0}discount_amount, m2 {0}refund_amount, m2 {0}platform_commission, " \
    "m2 {0}net_sales, m4 {0}estimated_food_cost, m4 {0}estimated_gross_profit"
ORDER_HEAD = "order_id, order_timestamp, business_date, daypart, channel, status, n table_number, n customer_count, " \
    "promotion_name, " + ORDER_MONEY.format("")
ORDER_TAIL = "d preparation_minutes, d promised_minutes, is_late, has_missing_item, n kitchen_staff_count, " \
    "n front_of_house_staff_count, d kitchen_load_ratio, d temperature_c, d rain_mm"
ITEM = "menu_item_id, item_name, category, m2 selling_price, n estimated_prep_minutes, is_vegetarian, is_vegan, " \
    "is_gluten_free, is_available_for_delivery, d base_popularity_weight, d cold_weather_affinity, " \
    "d hot_weather_affinity, d lunch_affinity, d dinner_affinity, d delivery_affinity, source_type"

add("p1_stg_orders", f"select {pick(ORDER_HEAD + ', ' + ORDER_TAIL)} from s_orders")
SQL["s1_csv_scan"] = SQL["p1_stg_orders"]
add("s2_missing_sources", """select t as table_name, t not in ('orders', 'reviews') as is_missing, case
    when t = 'orders' then (select count(*) from s_orders) when t = 'reviews' then (select count(*) from s_reviews) end as row_count
    from (select unnest(['daily_context', 'employee_shifts', 'employees', 'ingredients', 'inventory_movements', 'menu_items',
      'order_items', 'orders', 'recipes', 'reviews', 'suppliers']) as t)""")
add("p2_stg_order_items", f"""select {pick('order_item_id, order_id, menu_item_id, n quantity, m2 unit_price, '
    'm4 estimated_unit_food_cost, m2 line_total, m4 estimated_line_food_cost, special_request, item_status')}
    from s_order_items""")
add("p3_stg_reviews", f"""select {pick('review_id, order_id, review_date, channel, n rating, review_text, '
    'complaint_category, is_response_required')} from s_reviews""")
SHIFT = "role, shift_start, shift_end, n break_minutes, d scheduled_hours, d actual_hours, is_absent, " \
    "m2 hourly_rate, m2 labour_cost"
add("p4_stg_employee_shifts", f"select {pick('shift_id, employee_id, business_date, ' + SHIFT)} from s_employee_shifts")
MOVE = "movement_id, movement_timestamp, business_date, ingredient_id, movement_type, d quantity_change, unit, " \
    "m4 unit_cost, m4 movement_value, reference_id"
add("p5_stg_inventory_movements", f"select {pick(MOVE)} from s_inventory_movements")
SQL["f5_fact_inventory_movements"] = SQL["p5_stg_inventory_movements"]
add("p6_stg_daily_context", f"""select {pick('business_date, day_name, d temperature_c, d rain_mm, is_weekend, '
    'is_public_holiday, is_city_event, promotion_name')} from s_daily_context""")
add("p7_stg_menu_items", f"select {pick(ITEM + ', source_url')} from s_menu_items")
SQL["s6_seed_scan"] = SQL["p7_stg_menu_items"]
INGREDIENT = "ingredient_id, ingredient_name, ingredient_category, unit, m4 estimated_unit_cost, n shelf_life_days, " \
    "d reorder_level, d safety_stock, i.supplier_id"
add("p8_stg_ingredients", f"select {pick(INGREDIENT + ', is_synthetic_estimate')} from s_ingredients i")
add("p9_stg_suppliers", f"""select {pick('supplier_id, supplier_name, supplier_category, n average_lead_time_days, '
    'd reliability_score, is_synthetic_estimate')} from s_suppliers""")
add("p10_stg_recipes", f"""select {pick('menu_item_id, ingredient_id, d quantity_required, unit, '
    'd estimated_wastage_pct')} from s_recipes""")
EMPLOYEE = "employee_id, employee_name, department, role, employment_type, m2 hourly_rate, d standard_weekly_hours, " \
    "is_active"
add("p11_stg_employees", f"select {pick(EMPLOYEE + ', is_synthetic_estimate')} from s_employees")

# --- dimensions, facts, intermediate ---------------------------------------------------------

PRICE = "cast(i.selling_price as double)"
MARGIN = f"""{d('c.cost')} as estimated_item_food_cost, {d(f'{PRICE} - c.cost')} as estimated_gross_profit,
    {d(div(f'({PRICE} - c.cost)', PRICE))} as estimated_gross_margin_pct"""
add("d1_dim_date", f"""select business_date, day_name, {n('year(business_date)')} as year,
    {n('month(business_date)')} as month, {n('quarter(business_date)')} as quarter,
    {n('weekofyear(business_date)')} as week_of_year, {n('dayofyear(business_date)')} as day_of_year,
    {pick('is_weekend, is_public_holiday, is_city_event, promotion_name, d temperature_c, d rain_mm')}
    from s_daily_context""")
add("d2_dim_menu_item", f"""select {pick(ITEM.replace('menu_item_id', 'i.menu_item_id'))}, {MARGIN}
    from s_menu_items i left join item_cost c using (menu_item_id)""")
add("d3_dim_ingredient", f"""select {pick(INGREDIENT + ', supplier_name, '
    'n average_lead_time_days>supplier_lead_time_days, d reliability_score>supplier_reliability_score')}
    from s_ingredients i left join s_suppliers s on s.supplier_id = i.supplier_id""")
add("d4_dim_employee", f"select {pick(EMPLOYEE)} from s_employees")
add("d4_dim_supplier", f"""select {pick('supplier_id, supplier_name, supplier_category, n average_lead_time_days, '
    'd reliability_score')} from s_suppliers""")
add("d4_dim_channel", """select c.*, o.orders_seen from channels c
    left join (select channel, count(*) as orders_seen from s_orders group by 1) o using (channel)""")
add("f1_fact_orders", f"""select {pick(ORDER_HEAD)},
    {d('case when net_sales > 0 then cast(estimated_gross_profit as double) / cast(net_sales as double) end')}
      as contribution_margin_pct,
    {n('coalesce(item_count, 0)')} as item_count, {n('coalesce(item_quantity_total, 0)')} as item_quantity_total,
    {pick(ORDER_TAIL)} from s_orders left join line_counts using (order_id)""")
LINE = "order_item_id, order_id, menu_item_id, business_date, daypart, channel, n quantity, m2 unit_price, " \
    "m4 estimated_unit_food_cost, m2 line_total, m4 estimated_line_food_cost, special_request, item_status"
add("f2_fact_order_items", f"select {pick(LINE)} from f_order_lines")
add("f3_fact_employee_shifts", f"""select {pick('shift_id, employee_id, department, business_date, daypart, ' + SHIFT)}
    from f_shifts""")
add("f4_fact_reviews", f"""select {pick('review_id, order_id, business_date, daypart, review_date, channel, n rating, '
    'review_text, complaint_category, is_response_required')} from f_reviews""")
add("i1_hourly_demand", f"""select {pick('business_date, daypart, n order_hour, n order_count, '
    'd avg_load>avg_kitchen_load_ratio, d avg_prep>avg_preparation_minutes, n late>late_order_count, '
    'n missing>missing_item_order_count')} from hourly""")
add("i2_ingredient_consumption", f"""select {pick('business_date, ingredient_id, ingredient_name, ingredient_category, '
    'd quantity_consumed, m4 consumption_value, d quantity_wasted, m4 waste_value, d quantity_expired, '
    'd quantity_delivered')} from flows""")
add("i3_menu_item_costs", f"""select i.menu_item_id, item_name, category, {m2('selling_price')} as selling_price,
    {MARGIN} from s_menu_items i join item_cost c on c.menu_item_id = i.menu_item_id""")
add("i4_order_financials", f"""select order_id, business_date, daypart, channel, status,
    {pick(ORDER_MONEY.format(''))},
    {d('case when net_sales > 0 then cast(estimated_gross_profit as double) / cast(net_sales as double) end')}
      as contribution_margin_pct,
    {n('coalesce(item_count, 0)')} as item_count, {n('coalesce(item_quantity_total, 0)')} as item_quantity_total
    from s_orders left join line_counts using (order_id)""")
add("i5_service_performance", f"""select {pick('o.order_id, business_date, daypart, o.channel, status, is_late, '
    'has_missing_item, d kitchen_load_ratio, d preparation_minutes, d promised_minutes, review_id, n rating, '
    'complaint_category, is_response_required')}
    from s_orders o left join s_reviews r on r.order_id = o.order_id""")
add("i6_shift_labour_costs", f"""select {pick('business_date, daypart, department, n shifts>shift_count, '
    'n absences>absence_count, d scheduled>total_scheduled_hours, d worked>total_actual_hours, '
    'm2 cost>total_labour_cost')} from labour_slots""")

# --- marts -----------------------------------------------------------------------------------

add("k1_daily_performance", f"""select {pick('business_date, day_name, is_weekend, is_public_holiday, is_city_event, '
    'promotion_name, d temperature_c, d rain_mm, n order_count, m2 net_sales, m4 estimated_food_cost, '
    'm4 estimated_gross_profit, d estimated_gross_margin_pct, d average_order_value, d average_preparation_minutes, '
    'd late_order_pct, m2 labour_cost, d labour_cost_pct, d average_rating, m4 waste_cost')} from k1""")
CHANNEL = "n order_count, m2 gross_sales, m2 commission, m2 refunds, m2 net_sales, m4 estimated_gross_profit, " \
    "d average_order_value, d average_preparation_minutes"
add("k2_channel_profitability", f"""select {pick('channel, channel_label, is_delivery_channel, d commission_rate, '
    + CHANNEL + ', d late_order_pct, d average_rating')} from k2""")
add("k3_menu_engineering", f"""select {pick('menu_item_id, item_name, category, m2 selling_price, n units_sold, '
    'm2 revenue, m4 estimated_food_cost, m4 estimated_contribution_margin, d contribution_margin_pct, '
    'd order_penetration, d average_quantity_per_order, n sales_rank_within_category, d revenue_pct_within_category')},
    if(hot, 'High', 'Low') as popularity_classification, if(rich, 'High', 'Low') as profitability_classification,
    class as menu_engineering_classification from k3""")
add("k4_labour_productivity", f"""select {pick('business_date, daypart, d sched>total_scheduled_hours, '
    'd work>total_actual_hours, m2 cost>total_labour_cost, d k_work>kitchen_actual_hours, '
    'd f_work>front_of_house_actual_hours, m2 k_cost>kitchen_labour_cost, m2 f_cost>front_of_house_labour_cost, '
    'n absences>absence_count, n shifts>scheduled_shift_count, n order_count, m2 net_sales, '
    'd per_hour>orders_per_labour_hour, d rev_per_hour>revenue_per_labour_hour, '
    'd per_kitchen_hour>orders_per_kitchen_labour_hour, d per_front_hour>orders_per_front_of_house_labour_hour, '
    'd cost_pct>labour_cost_pct, d load>avg_kitchen_load_ratio, flag>staffing_level_flag')} from k4""")
add("k5_service_quality", f"""select {pick('business_date, daypart, n order_count, '
    'd prep_avg>average_preparation_minutes, d prep_mid>median_preparation_minutes, '
    'd prep_p90>p90_preparation_minutes, d late>late_order_pct, d missing>missing_item_pct, d refunded>refund_pct, '
    'd load_avg>average_kitchen_load_ratio, d load_max>peak_kitchen_load_ratio, '
    'd cooks>average_kitchen_staff_count, d waiters>average_front_of_house_staff_count')} from k5""")
SQL["s8_load_mart"] = SQL["k5_service_quality"]
add("k6_inventory_risk", f"""select {pick('ingredient_id, ingredient_name, ingredient_category, unit, d reorder_level, '
    'd safety_stock, supplier_name, n lead_days>supplier_lead_time_days, d closing_quantity, m4 closing_value, '
    'alert>is_reorder_alert, d run_rate>avg_daily_consumption, d days_left>estimated_days_of_stock_remaining, '
    'd wq>total_waste_quantity, m4 wv>total_waste_value, d xq>total_expired_quantity, m4 xv>total_expired_value, '
    'n rush>emergency_delivery_count, items>affected_menu_items')} from k6""")
add("k7_review_analysis", f"""select {pick('review_id, order_id, business_date, day_name, daypart, channel, '
    'review_date, n rating, review_text, complaint_category, is_response_required, d preparation_minutes, '
    'band>preparation_time_band')} from k7""")

# --- sources and sinks -----------------------------------------------------------------------

add("s3_load_metadata", """select c_custkey, md5(concat_ws('|', coalesce(cast(c_custkey as varchar), 'nan'),
    coalesce(c_name, 'nan'), coalesce(cast(c_nationkey as varchar), 'nan'), coalesce(cast(c_acctbal as varchar), 'nan'),
    coalesce(c_mktsegment, 'nan'))) as record_hash, timestamp '2024-01-01 00:00:00' as loaded_at,
    'customer.parquet' as source_file, 'batch-1' as batch_id from customer""")
LINE_CELLS = ", ".join(
    f"coalesce(cast({c} as varchar), 'nan')"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
)
add("s4_row_hash", f"""select l_orderkey, {n('l_linenumber')} as l_linenumber, md5(concat_ws('|', {LINE_CELLS}))
    as record_hash from lineitem""")
LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, " \
    "l_returnflag, l_linestatus, l_shipdate"
add("s4_batch_changes", f"""select l_orderkey, {n('l_linenumber')} as l_linenumber, {n('new - least(new, old)')} as inserted_rows,
    {n('least(new, old)')} as changed_rows, {n('old - least(new, old)')} as gone_rows from (
      select l_orderkey, l_linenumber, sum(greatest(c, 0)) as new, sum(greatest(-c, 0)) as old from (
        select {LINE_COLUMNS}, sum(side) as c from (
          select {LINE_COLUMNS}, -1 as side from lineitem where l_shipdate < timestamp '2001-01-01'
          union all select * replace (case when l_returnflag = 'A' then 'F' else l_linestatus end as l_linestatus)
          from (select {LINE_COLUMNS}, 1 as side from lineitem where l_returnflag <> 'R'))
        group by all) where c <> 0 group by 1, 2)""")
add("s5_replace_table", "select channel, status, count(*) as rows from s_orders group by all")
add("s7_channel_reference", """select o.channel, o.order_count, c.channel_label, c.is_delivery_channel, c.commission_rate
    from (select channel, count(*) as order_count from s_orders group by 1) o left join channels c using (channel)""")
add("s11_layered_store", """select 'dim_date' as table_name, count(*) as rows from s_daily_context
    union all select 'fact_orders', count(*) from s_orders
    union all select 'mart_channel_profitability', count(*) from k2
    union all select 'mart_service_quality', count(*) from k5""")
STORED = {
    "dim_date": "s_daily_context", "dim_menu_item": "s_menu_items", "dim_ingredient": "s_ingredients", "dim_employee": "s_employees",
    "dim_supplier": "s_suppliers", "dim_channel": "channels", "fact_orders": "s_orders", "fact_order_items": "f_order_lines",
    "fact_employee_shifts": "f_shifts", "fact_reviews": "f_reviews", "fact_inventory_movements": "s_inventory_movements",
    "mart_daily_performance": "k1", "mart_channel_profitability": "k2", "mart_menu_engineering": "k3",
    "mart_labour_productivity": "k4", "mart_service_quality": "k5", "mart_inventory_risk": "k6", "mart_review_analysis": "k7",
}
add("s11_store_all", " union all ".join(f"select '{t}' as table_name, count(*) as rows from {s}" for t, s in STORED.items()))
SEEDS = ("menu_items", "ingredients", "suppliers", "recipes", "employees")
add("s6_load_all_seeds", " union all ".join(f"select '{t}' as table_name, count(*) as rows from s_{t}" for t in SEEDS))
add("s1_load_all", " union all ".join(
    f"select '{t}' as table_name, count(*) as rows, count(distinct x) as hashes, 1 as batches from s_{t} x"
    for t in (*SEEDS, "daily_context", "orders", "order_items", "reviews", "employee_shifts", "inventory_movements")
).replace("1 as batches", "cast(1 as bigint) as batches"))
add("s12_freshness", """select 'orders' as table_name, max(o_orderdate) as latest_loaded_at from orders
    union all select 'lineitem', max(l_shipdate) from lineitem union all select 'events', max(ts) from events""")

# --- joins and aggregates --------------------------------------------------------------------

add("j1_inner_join", f"""select channel, daypart, count(*) as lines, {n('sum(quantity)')} as quantity
    from f_order_lines group by all""")
add("j2_left_join", f"""select daypart, count(*) as reviews, {d('avg(rating)')} as rating from f_reviews
    group by all""")
add("j3_full_outer_join", """select coalesce(a.d, b.d) as business_date, a.c as orders, b.c as movements
    from (select business_date d, count(*) c from s_orders group by 1) a
    full join (select business_date d, count(*) c from s_inventory_movements group by 1) b on a.d = b.d""")
add("j4_one_row_scalar", f"""select channel, count(*) as orders, {d('count(*) / (select count(*) from s_orders)::double')}
    as share from s_orders group by 1""")
add("j5_using_join", "select status, item_status, count(*) as lines from f_order_lines group by all")
add("j6_composite_merge", """select a.business_date, a.daypart, a.order_count, b.flag as staffing_level_flag
    from k5 a join k4 b on a.business_date = b.business_date and a.daypart = b.daypart""")
add("j7_left_merge", f"""select i.menu_item_id, item_name, category, {m2('selling_price')} as selling_price, {MARGIN}
    from s_menu_items i left join item_cost c on c.menu_item_id = i.menu_item_id""")
SQL["v16_menu_summary"] = SQL["j7_left_merge"]
add("j8_orphan_reviews", """select 'unknown order' as "check", review_id as id from s_reviews
    where order_id not in (select order_id from s_orders)""")
add("g1_basic_aggregates", f"""select channel, count(*) as orders, {m2('sum(net_sales)')} as net_sales,
    {d(avg_exact('net_sales'))} as average_net_sales, {m2('max(net_sales)')} as largest from s_orders group by 1""")
add("g2_count_distinct", "select menu_item_id, count(distinct order_id) as orders from s_order_items group by 1")
add("g3_conditional_aggregates", f"""select daypart, count(*) filter (where is_late) as late,
    {d(share('has_missing_item'))} as missing_share from s_orders group by 1""")
add("g4_median", f"select channel, {d('median(preparation_minutes)')} as median from s_orders group by 1")
add("g5_percentile_cont", f"""select channel, {d('quantile_cont(preparation_minutes, 0.9)')} as p90
    from s_orders group by 1""")
add("g6_distinct_pairs", "select distinct r.ingredient_id, i.item_name from s_recipes r join s_menu_items i using (menu_item_id)")
add("g6_distinct_names", "select ingredient_id, items as affected_menu_items from uses")
add("g7_weighted_mean", f"""select item_status, {d(div('sum(unit_price * quantity)', 'sum(quantity)'))}
    as mean_unit_price from s_order_items group by 1""")
add("g8_value_counts", """select movement_type, count(*) as "count" from s_inventory_movements group by 1""")
add("g9_boolean_mean", f"select channel, {d(share('is_response_required'))} as share from s_reviews group by 1")
add("g10_argmax", f"""select daypart, business_date, {n('order_hour')} as order_hour, order_count
    from (select *, row_number() over (partition by daypart order by order_count desc, business_date desc,
      order_hour desc) as place from hourly) where place = 1""")


def heat_columns(hours: range) -> str:
    return ", ".join(f"cast(sum(order_count) filter (where order_hour = {h}) as bigint) as h{h:02d}" for h in hours)


add("g11_pivot", f"""select day_name, {heat_columns(range(24))} from hourly join s_daily_context using (business_date)
    group by 1""")
add("q20_demand_pivot", f"""select day_name, {heat_columns(range(24))} from hourly
    join s_daily_context using (business_date) group by 1""")
add("g12_quartiles", f"""select daypart, {d('quantile_cont(preparation_minutes, 0.25)')} as q1,
    {d('median(preparation_minutes)')} as median, {d('quantile_cont(preparation_minutes, 0.75)')} as q3
    from s_orders group by 1""")
add("g13_count_map", """select site, string_agg(channel || '=' || c, ',' order by channel) as orders_by_channel
    from (select site, channel, count(*) as c from valid_events group by all) group by 1""")

# --- windows, sorts, sets --------------------------------------------------------------------

add("w1_rank_in_category", f"""select i.menu_item_id, i.category, {m2('g.revenue')} as revenue,
    rank() over (partition by i.category order by g.revenue desc nulls last) as sales_rank,
    {m2('sum(g.revenue) over (partition by i.category)')} as category_revenue
    from s_menu_items i left join item_sales g on g.menu_item_id = i.menu_item_id""")
BALANCE = """select movement_id, ingredient_id, movement_timestamp, sum(quantity_change) over (
    partition by ingredient_id order by movement_timestamp, movement_id rows unbounded preceding) as balance
    from s_inventory_movements"""
add("w2_running_balance", f"""select movement_id, ingredient_id, movement_timestamp, {d('balance')} as balance
    from stock""", stock=BALANCE)
add("w3_running_sum_by_item", f"""select ingredient_id, {d('min(balance)')} as lowest, {d('max(balance)')} as highest
    from stock group by 1""", stock=BALANCE)
add("v12_negative_balance", f"""select movement_id, ingredient_id, movement_timestamp, {d('balance')} as balance
    from stock where balance < -0.01""", stock=BALANCE)
CHANNEL_DAYS = """select ch.channel, c.*, coalesce(o.cnt, 0) as order_count
    from s_daily_context c cross join (select channel from channels) ch
    left join (select channel, business_date, count(*) as cnt from s_orders group by all) o
      on o.channel = ch.channel and o.business_date = c.business_date"""
LAGGED = """select *, lag(order_count, 1) over w as lag1, lag(order_count, 7) over w as lag7,
    case when count(*) over past = 7 then avg(order_count) over past end as week_mean
    from {source} window w as (partition by {key} order by business_date),
      past as (partition by {key} order by business_date rows between 7 preceding and 1 preceding)"""
channel_lagged = {"channel_days": CHANNEL_DAYS, "lagged": LAGGED.format(source="channel_days", key="channel")}
add("w4_lags", f"""select channel, business_date, {n('order_count')} as order_count, {d('lag1')} as previous_day_orders,
    {d('lag7')} as previous_week_orders from lagged""", **channel_lagged)
add("w5_trailing_mean", f"select channel, business_date, {d('week_mean')} as rolling_7day_avg from lagged",
    **channel_lagged)
add("w6_orders_in_same_hour", f"""select order_id, {n('hour(order_timestamp)')} as order_hour,
    count(*) over (partition by business_date, daypart, hour(order_timestamp)) as orders_in_hour from s_orders""")


def channel_text(condition: str = "true", over: str = "") -> str:
    """Counts per channel as text, only those that occur, in channel order."""
    parts = [
        f"case when count(*) filter (where channel = '{c}' and {condition}) {over} > 0 "
        f"then '{c}=' || count(*) filter (where channel = '{c}' and {condition}) {over} end"
        for c in ("dine_in", "doordash", "pickup", "uber_eats")
    ]
    return f"concat_ws(',', {', '.join(parts)})"


def trailing(feed: str) -> str:
    partition = f"partition by {feed} " if feed else ""
    over = f"""over ({partition}order by "timestamp" range between interval 15 minutes preceding and current row)"""
    return f"""select {feed + ',' if feed else ''} event_id, "timestamp", 15.0::double as window_minutes,
      count(*) {over} as order_count,
      {d(r2(f"cast(sum(cast(subtotal as decimal(18,6))) {over} as double)"))} as total_revenue,
      {d(r2(f"sum(item_count) {over} / cast(count(*) {over} as double)"))} as average_items_per_order,
      {channel_text(over=over)} as orders_by_channel from valid_events"""


add("w7_trailing_window", trailing(""))
add("r1_rolling_kpis", trailing("site"))
add("o1_top_items", f"""select menu_item_id, {n('sum(quantity)')} as units from s_order_items group by 1
    order by 2 desc, 1 limit 10""")
add("o2_bottom_ingredients", f"""select ingredient_id, {m4('estimated_unit_cost')} as estimated_unit_cost
    from s_ingredients order by 2, 1 limit 5""")
add("o3_sort_head", f"""select order_id, business_date, {pick('m2 net_sales, m2 subtotal')} from s_orders
    where status = 'Cancelled' order by subtotal desc, order_id limit 15""")
EVENT = 'site, event_id, timestamp, channel, daypart, n item_count, d subtotal, status'
add("o4_sorted_history", f"select {pick(EVENT)} from valid_events where channel = 'pickup' order by subtotal")
LATEST = 'select * from valid_events order by "timestamp" desc, event_id desc limit {0}'
add("o5_latest_events", f"select {pick(EVENT)} from latest", latest=LATEST.format(30))
add("r4_session_history", f"select {pick(EVENT)} from latest", latest=LATEST.format(500))
SQL["r8_history_table"] = SQL["r4_session_history"]
add("u1_append_rows", """select business_date, channel, count(*) as rows from (
    select business_date, channel from s_orders union all select review_date, channel from s_reviews) group by all""")
add("u2_key_difference", "select order_id from s_orders except select order_id from s_order_items")

# --- filters and drill-downs -----------------------------------------------------------------

add("q1_apply_filters", """select order_id, business_date, channel from s_orders
    where year(business_date) = 1996 and channel in ('dine_in', 'pickup')""")
add("q1_filters_open", "select order_id, business_date, channel from s_orders")
add("q1_filters_empty_list", "select order_id, business_date, channel from s_orders where false")
add("q2_date_domain", "select min(business_date) as min_date, max(business_date) as max_date from k5")
add("q2_option_domain", 'select distinct category as "option" from s_menu_items where category is not null')
add("q3_item_demand_by_hour", f"""select {n('hour(order_timestamp)')} as order_hour, count(*) as order_count,
    {n('sum(quantity)')} as quantity from f_order_lines where menu_item_id = '7' group by 1""")
add("q4_item_demand_by_temperature", f"""select case when temperature_c < 15 then 'Cold (<15°C)'
    when temperature_c < 25 then 'Mild (15-25°C)' else 'Hot (>25°C)' end as temperature_band,
    count(*) as order_count, {n('sum(quantity)')} as quantity from f_order_lines where menu_item_id = '7' group by 1""")
add("q5_item_channel_distribution", f"""select channel, count(*) as order_count, {n('sum(quantity)')} as quantity,
    {m2('sum(line_total)')} as revenue from f_order_lines where menu_item_id = '7' group by 1""")
add("q6_hourly_heatmap", f"""select day_name, {n('order_hour')} as order_hour, {n('sum(order_count)')} as order_count,
    {d('avg(avg_prep)')} as avg_preparation_minutes from hourly join s_daily_context using (business_date)
    group by all""")
PREP = """select c.day_name, o.daypart, count(*) as order_count, avg(o.preparation_minutes) as prep,
    avg(o.promised_minutes) as promise from s_orders o join s_daily_context c using (business_date) group by all"""
add("q7_prep_vs_promise", f"""select day_name, daypart, order_count, {d('prep')} as avg_preparation_minutes,
    {d('promise')} as avg_promised_minutes from prep_promise""", prep_promise=PREP)
add("q8_shift_grain", f"select department, {d('actual_hours')} as actual_hours, is_absent from f_shifts")
add("q9_busiest_slot", f"""select day_name, daypart, order_count, {d('prep - promise')} as variance_minutes,
    day_name || ' ' || daypart || case
      when prep - promise > 0.5 then ' produced the highest order volume, but average preparation time exceeded the '
        || 'target by ' || printf('%.1f', prep - promise) || ' minutes.'
      when prep - promise < -0.5 then ' produced the highest order volume, and average preparation time beat the '
        || 'target by ' || printf('%.1f', promise - prep) || ' minutes.'
      else ' produced the highest order volume, right at the promised preparation-time target.' end as insight
    from prep_promise order by order_count desc, day_name, daypart limit 1""", prep_promise=PREP)
add("q9_no_slot", """select cast(null as varchar) as day_name, cast(null as varchar) as daypart,
    cast(null as bigint) as order_count, cast(null as double) as variance_minutes,
    'Not enough data to generate a summary yet.' as insight""")
add("q10_executive_kpis", f"""select {m2('sum(net_sales)')} as net_sales, {n('sum(order_count)')} as order_count,
    {', '.join(f"{d(f'avg({c})')} as {c}" for c in ('average_order_value', 'estimated_gross_margin_pct',
        'labour_cost_pct', 'average_preparation_minutes', 'average_rating'))},
    {m4('sum(waste_cost)')} as waste_cost from k1""")
add("q11_orders_by_daypart", f"select daypart, {n('sum(order_count)')} as order_count from k5 group by 1")
add("q11_margin_by_category", f"""select category, {m4('sum(estimated_contribution_margin)')}
    as estimated_contribution_margin from k3 group by 1""")
for name, measure, cast, condition in (
    ("q12_best_sellers", "units_sold", n, "true"),
    ("q12_highest_margin", "contribution_margin_pct", d, "true"),
    ("q12_plowhorses", "units_sold", n, "class = 'Plowhorse'"),
    ("q12_puzzles", "contribution_margin_pct", d, "class = 'Puzzle'"),
):
    add(name, f"""select menu_item_id, item_name, {cast(measure)} as {measure} from k3
        where {condition} and {measure} is not null order by k3.{measure} desc, menu_item_id limit 8""")
add("q13_category_comparison", f"""select category, {m2('sum(revenue)')} as revenue,
    {m4('sum(estimated_contribution_margin)')} as estimated_contribution_margin from k3 group by 1""")
add("q14_per_unit_cost", f"""select menu_item_id, item_name, {m2('selling_price')} as selling_price,
    {d(div('estimated_food_cost', 'units_sold'))} as per_unit_cost,
    {d('contribution_margin_pct')} as contribution_margin_pct, {n('units_sold')} as units_sold from k3""")
add("q15_channel_comparison", f"""select channel, channel_label, {pick(CHANNEL + ', d average_rating, d late_order_pct')},
    {d(div('commission', 'gross_sales'))} as commission_share from k2""")
add("q16_service_kpis", f"""select {n('sum(order_count)')} as order_count,
    {', '.join(f"{d(div(f'sum({c} * order_count)', 'sum(order_count)'))} as {a}" for c, a in (
        ('late', 'late_order_pct'), ('missing', 'missing_item_pct'), ('refunded', 'refund_pct')))} from k5""")
add("q17_preparation_by_daypart", f"""select daypart, {d('avg(prep_avg)')} as average, {d('avg(prep_mid)')} as median,
    {d('avg(prep_p90)')} as p90 from k5 group by 1""")
add("q18_peak_windows", f"""select business_date, daypart, {d('load_max')} as peak_kitchen_load_ratio,
    {d('prep_avg')} as average_preparation_minutes, order_count from k5 where load_max is not null
    order by load_max desc, business_date, daypart limit 10""")
add("q19_outcomes_by_staffing", f"""select b.flag as staffing_level_flag, {d('avg(a.late)')} as late_order_pct,
    {d('avg(a.missing)')} as missing_item_pct, {d('avg(a.refunded)')} as refund_pct
    from k5 a join k4 b on a.business_date = b.business_date and a.daypart = b.daypart group by 1""")
add("q21_labour_kpis", f"""select {m2('sum(cost)')} as total_labour_cost, {d('sum(work)')} as total_actual_hours,
    {d('avg(rev_per_hour)')} as revenue_per_labour_hour, {d('avg(per_hour)')} as orders_per_labour_hour,
    {d('avg(cost_pct)')} as labour_cost_pct, {n('sum(shifts)')} as scheduled_shift_count,
    {n('sum(absences)')} as absence_count from k4""")
add("q21_hours_trend", f"""select business_date, {d('sum(sched)')} as scheduled, {d('sum(work)')} as actual
    from k4 group by 1""")
for name, flag, way in (("q21_understaffed", "Understaffed", "desc"), ("q21_overstaffed", "Overstaffed", "asc")):
    add(name, f"""select business_date, daypart, {d('load')} as avg_kitchen_load_ratio, order_count,
        {d('work')} as total_actual_hours from k4 where flag = '{flag}'
        order by load {way}, business_date, daypart limit 15""")
add("q22_labour_cost_quartiles", f"""select daypart, {d('min(cost_pct)')} as lowest,
    {d('quantile_cont(cost_pct, 0.25)')} as q1, {d('median(cost_pct)')} as median,
    {d('quantile_cont(cost_pct, 0.75)')} as q3, {d('max(cost_pct)')} as highest from k4 group by 1""")
add("q23_inventory_kpis", f"""select {m4('sum(closing_value)')} as closing_value,
    count(*) filter (where alert) as reorder_alerts, {m4('sum(wv)')} as total_waste_value,
    {d('avg(days_left)')} as estimated_days_of_stock_remaining, {n('sum(rush)')} as emergency_delivery_count,
    {m4('sum(xv)')} as total_expired_value from k6""")
add("q23_reorder_list", f"""select {pick('ingredient_id, ingredient_name, ingredient_category, d closing_quantity, '
    'd reorder_level, d days_left>estimated_days_of_stock_remaining, supplier_name, n lead_days>supplier_lead_time_days, '
    'items>affected_menu_items')} from k6 where alert""")
add("q23_stock_value_by_category", f"""select ingredient_category, {m4('sum(closing_value)')} as closing_value
    from k6 group by 1""")
add("q23_most_wasted", f"""select ingredient_id, ingredient_name, {m4('wv')} as total_waste_value from k6
    order by wv desc, ingredient_id limit 10""")
add("q23_lowest_cover", f"""select ingredient_id, ingredient_name, {d('days_left')} as estimated_days_of_stock_remaining,
    alert as is_reorder_alert from k6 where days_left is not null order by days_left, ingredient_id limit 20""")
add("q24_review_kpis", f"""select {d('avg(rating)')} as average_rating, count(*) as review_count,
    {d(share('rating <= 2'))} as low_rating_pct, {d(share('is_response_required'))} as response_required_pct from k7""")
for column, source in (("business_date", "business_date"), ("channel", "channel"), ("preparation_time_band", "band"),
                       ("daypart", "daypart")):
    add(f"q24_rating_by_{column}", f"""select {source} as {column}, {d('avg(rating)')} as rating from k7
        where {source} is not null group by 1""")
for column, cast in (("rating", n), ("complaint_category", str)):
    add(f"q24_counts_by_{column}", f"""select {cast(column)} as {column}, count(*) as "count" from k7
        where {column} is not null group by 1""")
add("q24_latest_low_ratings", f"""select {pick('review_id, business_date, channel, n rating, complaint_category, '
    'review_text')} from k7 where rating <= 2 order by business_date desc nulls last, review_id limit 20""")
add("q25_quadrant_lines", f"""select {d('median(units_sold)')} as median_units_sold,
    {d('median(contribution_margin_pct)')} as median_contribution_margin_pct from k3
    where category in ('ECONOMY', 'SMALL', 'PROMO')""")

# --- data quality ----------------------------------------------------------------------------

REPORT = """select t as table_name, c as "check", count(*) as violations,
    array_to_string(list_sort(list(id order by id)[1:5]), ', ') as examples from failed group by all"""


def failed(table: str, source: str, row_id: str, checks: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}' as t, '{message}' as c, cast({row_id} as varchar) as id from {source} where {condition}"
        for message, condition in checks.items()
    )


def outside(column: str, *allowed: str) -> str:
    listed = ", ".join(f"'{a}'" for a in allowed)
    return f"not coalesce({column} in ({listed}), false)"


CHANNEL_SET = ("dine_in", "pickup", "uber_eats", "doordash")
GAP = "abs(net_sales - (subtotal - discount_amount - refund_amount - platform_commission)) > 0.02"
CHECKS = {
    "v2_daily_context": failed("daily_context", "s_daily_context", "business_date", {
        "Negative rain_mm": "rain_mm < 0", "Missing business_date": "business_date is null"}),
    "v3_orders": failed("orders", "s_orders", "order_id", {
        "Invalid channel value": outside("channel", *CHANNEL_SET),
        "Invalid status value": outside("status", "Completed", "Cancelled", "Partially Refunded"),
        "Invalid daypart value": outside("daypart", "lunch", "dinner"),
        "Negative subtotal": "subtotal < 0",
        "Non-positive preparation_minutes": "preparation_minutes <= 0",
        "Missing order_timestamp": "order_timestamp is null",
        "net_sales does not reconcile to subtotal - discount - refund - commission": GAP,
        "dine_in order missing table_number": "channel = 'dine_in' and table_number is null",
        "non-dine_in order has a table_number": "channel <> 'dine_in' and table_number is not null"}),
    "v4_order_items": failed("order_items", "s_order_items", "order_item_id", {
        "Non-positive quantity": "quantity <= 0", "Negative line_total": "line_total < 0",
        "order_id not found in orders": "order_id not in (select order_id from s_orders)",
        "menu_item_id not found in menu_items": "menu_item_id not in (select menu_item_id from s_menu_items)",
        "Invalid item_status value": outside("item_status", "Fulfilled", "Missing")}),
    "v5_reviews": failed("reviews", "s_reviews", "review_id", {
        "Rating outside 1-5": "rating < 1 or rating > 5",
        "order_id not found in orders": "order_id not in (select order_id from s_orders)",
        "Invalid channel value": outside("channel", *CHANNEL_SET)}),
    "v6_shifts": failed("shifts", "s_employee_shifts", "shift_id", {
        "shift_end not after shift_start": "shift_end <= shift_start",
        "Non-positive scheduled_hours": "scheduled_hours <= 0", "Negative actual_hours": "actual_hours < 0",
        "Negative labour_cost": "labour_cost < 0",
        "Absent shift has non-zero actual_hours": "is_absent and actual_hours <> 0",
        "employee_id not found in employees": "employee_id not in (select employee_id from s_employees)"}),
    "v7_inventory": failed("inventory_movements", "s_inventory_movements", "movement_id", {
        "Invalid movement_type value": outside("movement_type", "Supplier Delivery", "Sales Consumption", "Waste",
                                               "Stock Adjustment", "Expired Stock"),
        "ingredient_id not found in ingredients": "ingredient_id not in (select ingredient_id from s_ingredients)",
        "Negative unit_cost": "unit_cost < 0"})
    + " union all " + failed("inventory_movements", f"({BALANCE})", "movement_id", {
        "Running inventory balance went negative": "balance < -0.01"}),
}
for name, source in CHECKS.items():
    add(name, REPORT, failed=source)
add("v8_all_checks", REPORT, failed=" union all ".join(CHECKS.values()))
add("v1_violation_report", REPORT, failed=failed("orders", "s_orders", "order_id", {
    "large refund": "refund_amount > 200000", "late": "is_late", "never": "subtotal < 0"}))
add("v9_unique", """select order_item_id as "key", count(*) as copies from s_order_items group by 1
    having count(*) > 1""")
add("v9_not_null", "select review_id from s_reviews where rating is null")
KEYS = {"s_menu_items": "menu_item_id", "s_ingredients": "ingredient_id", "s_suppliers": "supplier_id",
        "s_employees": "employee_id", "s_daily_context": "business_date", "s_orders": "order_id",
        "s_order_items": "order_item_id", "s_reviews": "review_id", "s_employee_shifts": "shift_id",
        "s_inventory_movements": "movement_id"}
add("v9_key_summary", " union all ".join(
    f"""select 'stg_{t[2:]}' as table_name, count(*) filter (where k is not null and c > 1) as duplicated_keys,
    cast(coalesce(sum(c) filter (where k is null), 0) as bigint) as missing_keys
    from (select {k} as k, count(*) as c from {t} group by 1)""" for t, k in KEYS.items()))
add("v10_accepted_channels", f"""select channel as "value", count(*) as rows from s_orders
    where channel not in {CHANNEL_SET} group by 1""")
add("v10_accepted_departments", """select department as "value", count(*) as rows from s_employees
    where department not in ('Kitchen', 'Front of House') group by 1""")
add("v11_review_orders", """select order_id as "key", count(*) as rows from s_reviews
    where order_id not in (select order_id from s_orders) group by 1""")
add("v11_order_channels", """select channel as "key", count(*) as rows from s_orders
    where channel not in (select channel from channels) group by 1""")
DECLARED_KEYS = ("business_date", "menu_item_id", "ingredient_id", "employee_id", "supplier_id", "channel", "order_id",
                 "order_item_id", "shift_id", "review_id", "movement_id")
add("v9_declared_keys", " union all ".join(
    f"""select '{t}' as table_name, count(*) filter (where k is not null and c > 1) as duplicated_keys,
    cast(coalesce(sum(c) filter (where k is null), 0) as bigint) as missing_keys
    from (select {k} as k, count(*) as c from {source} group by 1)"""
    for (t, source), k in zip(list(STORED.items())[:11], DECLARED_KEYS, strict=True)))
ACCEPTED = {
    ("dim_menu_item", "category"): "('Starters', 'Dumplings', 'Rice Paper Rolls', 'Banh Mi', 'Pho Noodles', 'Pho Xao', "
    "'Rice Bowls', 'Vermicelli Salad', 'Sharing Plates', 'Sides', 'Drinks')",
    ("dim_employee", "department"): "('Kitchen', 'Front of House')",
    ("dim_channel", "channel"): CHANNEL_SET,
    ("fact_orders", "status"): "('Completed', 'Cancelled', 'Partially Refunded')",
    ("fact_orders", "daypart"): "('lunch', 'dinner')",
    ("fact_order_items", "item_status"): "('Fulfilled', 'Missing')",
    ("fact_inventory_movements", "movement_type"):
        "('Supplier Delivery', 'Sales Consumption', 'Waste', 'Stock Adjustment', 'Expired Stock')",
}
add("v10_declared_values", " union all ".join(
    f"""select '{t}' as table_name, '{c}' as column_name, {c} as "value", count(*) as rows from {STORED[t]}
    where {c} not in {allowed} group by {c}""" for (t, c), allowed in ACCEPTED.items()))
PARENTS = {
    ("dim_ingredient", "supplier_id"): "dim_supplier", ("fact_orders", "channel"): "dim_channel",
    ("fact_order_items", "order_id"): "fact_orders", ("fact_order_items", "menu_item_id"): "dim_menu_item",
    ("fact_employee_shifts", "employee_id"): "dim_employee", ("fact_reviews", "order_id"): "fact_orders",
    ("fact_inventory_movements", "ingredient_id"): "dim_ingredient",
}
add("v11_declared_references", " union all ".join(
    f"""select '{t}' as table_name, '{c}' as column_name, {c} as "key", count(*) as rows from {STORED[t]}
    where {c} not in (select {c} from {STORED[p]}) group by {c}""" for (t, c), p in PARENTS.items()))
add("v12_quantity", f"select order_item_id, {n('quantity')} as quantity from s_order_items where quantity <= 0")
add("v12_reconciliation", f"""select order_id, {pick('m2 subtotal, m2 discount_amount, m2 refund_amount, '
    'm2 platform_commission, m2 net_sales')},
    {m2('subtotal - discount_amount - refund_amount - platform_commission')} as expected_net_sales
    from s_orders where {GAP}""")
add("v12_money", f"""select order_id, {pick('m2 subtotal, m2 net_sales')} from s_orders
    where subtotal < 0 or net_sales < 0""")
add("v12_rating_range", f"""select review_id, {n('rating')} as rating from s_reviews
    where rating not between 1 and 5""")
add("v12_shift_end", """select shift_id, shift_start, shift_end from s_employee_shifts
    where shift_end <= shift_start""")
add("v13_seed_references", """
    select 'ingredients: ' || ingredient_id || ' references unknown supplier_id ''' || supplier_id || '''' as error
      from seed_ingredients where supplier_id not in (select supplier_id from s_suppliers)
    union all select 'recipes: unknown menu_item_id ''' || menu_item_id || '''' from seed_recipes
      where menu_item_id not in (select menu_item_id from seed_items)
    union all select 'recipes: unknown ingredient_id ''' || ingredient_id || ''' for menu item ''' || menu_item_id
      || '''' from seed_recipes where ingredient_id not in (select ingredient_id from seed_ingredients)
    union all select 'menu_items: ' || menu_item_id || ' has no recipe rows' from seed_items
      where menu_item_id not in (select menu_item_id from seed_recipes)""",
    seed_items="select menu_item_id from s_menu_items union all select 'MI998'",
    seed_ingredients="select ingredient_id, supplier_id from s_ingredients union all select 'IN998', 'SU999'",
    seed_recipes="select menu_item_id, ingredient_id from s_recipes union all select 'MI999', 'IN999'")

# raw tables hold the untidied labels, so the closed sets reject padded and capitalised ones
RAW_DAYPART = "case when daypart = 'lunch' then ' Lunch' else 'DINNER ' end"
RAW_CHANNEL = "case channel when 'dine_in' then ' Dine_In' when 'pickup' then 'pickup ' when 'doordash' " \
    "then 'DoorDash' when '5-low' then '5-LOW' else channel end"
BOUNDS = {
    "orders": ("s_orders", "order_id", {
        "daypart must be one of lunch, dinner": f"{RAW_DAYPART} not in ('lunch', 'dinner')",
        "channel must be one of dine_in, pickup, uber_eats, doordash": f"{RAW_CHANNEL} not in {CHANNEL_SET}",
        "preparation_minutes must be gt 0": "preparation_minutes <= 0", "rain_mm must be ge 0": "rain_mm < 0",
        "temperature_c is required": "temperature_c is null"}),
    "order_items": ("s_order_items", "order_item_id", {
        "item_status must be one of Fulfilled, Missing": "true", "unit_price must be gt 0": "unit_price <= 0"}),
    "reviews": ("s_reviews", "review_id", {
        "channel must be one of dine_in, pickup, uber_eats, doordash": f"channel not in {CHANNEL_SET}",
        "rating must be ge 1": "rating < 1", "rating must be le 5": "rating > 5", "rating is required": "rating is null"}),
    "employee_shifts": ("s_employee_shifts", "shift_id", {"scheduled_hours must be gt 0": "scheduled_hours <= 0"}),
    "menu_items": ("s_menu_items", "menu_item_id", {"source_type must be one of synthetic, public_source": "true"}),
    "recipes": ("s_recipes", "menu_item_id", {"unit must be one of kilograms, litres, each, portions": "true"}),
    "inventory_movements": ("s_inventory_movements", "movement_id", {
        "movement_type must be one of Supplier Delivery, Sales Consumption, Waste, Stock Adjustment, Expired Stock":
            "movement_type in ('Waste', 'Supplier Delivery')",
        "unit must be one of kilograms, litres, each, portions": "true"}),
    "daily_context": ("s_daily_context", "business_date", {"rain_mm must be ge 0": "rain_mm < 0"}),
    "ingredients": ("s_ingredients", "ingredient_id", {
        "unit must be one of kilograms, litres, each, portions": "true",
        "shelf_life_days must be gt 0": "shelf_life_days <= 0"}),
    "suppliers": ("s_suppliers", "supplier_id", {"reliability_score must be le 1": "reliability_score > 1"}),
    "employees": ("s_employees", "employee_id", {
        "department must be one of Kitchen, Front of House": "department in ('Kitchen', 'Front of House', 'Office')",
        "employment_type must be one of Full-time, Part-time, Casual": "employment_type = 'Part-time'"}),
}
for table, (source, row_id, checks) in BOUNDS.items():
    add(f"v14_bounds_{table}", REPORT, failed=failed(table, source, row_id, checks))
add("v15_seed_report", f"""select count(*) as number_of_menu_items, count(distinct category) as number_of_categories,
    (select count(*) from s_ingredients) as number_of_ingredients,
    {d('(select count(distinct menu_item_id) from s_recipes) / count(*)::double')} as recipe_coverage_pct,
    {d(f'avg(c.cost / {PRICE})')} as average_estimated_food_cost_pct
    from s_menu_items i left join item_cost c on c.menu_item_id = i.menu_item_id""")

# --- forecasting -----------------------------------------------------------------------------

K1_LAGGED = {"lagged": LAGGED.format(source="k1", key="1")}
FEATURES = f"""business_date, day_name, {n('month(business_date)')} as month, is_weekend, is_public_holiday,
    is_city_event, promotion_name is not null as has_promotion, {pick('d temperature_c, d rain_mm')},
    {d('lag1')} as previous_day_orders, {d('lag7')} as previous_week_orders, {d('week_mean')} as rolling_7day_avg,
    {n('order_count')} as order_count"""
COMPLETE = "lag7 is not null and week_mean is not null"
add("x1_features", f"select {FEATURES} from lagged where {COMPLETE}", **K1_LAGGED)
add("x1_features_by_channel", f"select channel, {FEATURES} from lagged where {COMPLETE}", **channel_lagged)
add("x2_chronological_split", f"""select channel, place <= 60 as is_test, min(business_date) as first,
    max(business_date) as last, count(*) as rows from (select *, row_number() over (partition by channel
    order by business_date desc) as place from lagged where {COMPLETE}) group by all""", **channel_lagged)
HOLDOUT = f"select * from lagged where {COMPLETE} order by business_date desc limit 60"


def scores(model: str, prediction: str) -> str:
    error = f"(order_count - {prediction})"
    return f"""select '{model}' as model, {d(f'avg(abs({error}))')} as mae, {d(f'sqrt(avg({error} * {error}))')} as rmse,
        {d(f'avg(abs({error} / nullif(order_count, 0)::double)) * 100')} as mape from holdout"""


add("x3_metrics", scores("Naive (previous week)", "lag7") + " union all " + scores("Moving average (7-day)", "week_mean"),
    **K1_LAGGED, holdout=HOLDOUT)
add("x4_previous_week", f"""select business_date, {n('order_count')} as order_count, {d('lag7')} as prediction
    from holdout""", **K1_LAGGED, holdout=HOLDOUT)
add("x5_moving_average", f"""select business_date, {n('order_count')} as order_count, {d('week_mean')} as prediction
    from holdout""", **K1_LAGGED, holdout=HOLDOUT)
COLUMNS_OF_DAY = {
    "is_weekend": "is_weekend", "is_public_holiday": "is_public_holiday", "is_city_event": "is_city_event",
    "has_promotion": "promotion_name is not null", "temperature_c": "temperature_c", "rain_mm": "rain_mm",
    "previous_day_orders": "lag1", "previous_week_orders": "lag7", "rolling_7day_avg": "week_mean",
}
add("x6_normal_equations", f"""select feature, count(*) as rows,
    {d('floor(sum(order_count * value) * 1000 + 0.5) / 1000')} as product from (
    {' union all '.join(f"select '{c}' as feature, cast({x} as double) as value, order_count from taught" for c, x in COLUMNS_OF_DAY.items())}
    union all select 'day_name=' || day_name, 1, order_count from taught
    union all select 'month=' || month(business_date), 1, order_count from taught) group by 1""", **K1_LAGGED,
    taught=f"""select * from lagged where {COMPLETE} and temperature_c is not null and rain_mm is not null
      and business_date not in (select business_date from ({HOLDOUT}))""")
add("x9_forecast_previous_week", f"""select cast(business_date + 7 as date) as business_date,
    dayname(business_date) as day_name, {d('order_count')} as predicted_orders
    from (select * from k1 order by business_date desc limit 7)""")


def recursive_mean(source: str, key: str) -> dict[str, str]:
    """Seven days of the moving average, each day's mean taken over the days before it."""
    steps = {"day0": f"select {key} as k, business_date, cast(order_count as double) as y from {source}"}
    for i in range(1, 8):
        steps[f"day{i}"] = f"""select * from day{i - 1} union all select k, max(business_date) + 1, avg(y)
            from (select * from day{i - 1} qualify row_number() over (partition by k order by business_date desc) <= 7)
            group by k"""
    return steps


add("x9_forecast_moving_average", f"""select cast(business_date as date) as business_date, dayname(business_date)
    as day_name, {d('y')} as predicted_orders from day7 where business_date > (select max(business_date) from k1)""",
    **recursive_mean("k1", "1"))
add("x9_forecast_by_channel", f"""select k as channel, cast(business_date as date) as business_date,
    dayname(business_date) as day_name, {d('y')} as predicted_orders from day7
    where business_date > (select max(business_date) from channel_days)""",
    channel_days=CHANNEL_DAYS, **recursive_mean("channel_days", "channel"))
add("x10_staffing", f"""select business_date, {n('order_count')} as predicted_orders,
    {d('order_count / kr')} as kitchen_hours, {d('order_count / fr')} as front_of_house_hours,
    {n('ceil(order_count / kr / kh)')} as kitchen_headcount, {n('ceil(order_count / fr / fh)')} as front_of_house_headcount
    from k1, (select median(per_kitchen_hour) as kr, median(per_front_hour) as fr from k4 where flag = 'Balanced'),
    (select avg(actual_hours) filter (where department = 'Kitchen') as kh,
      avg(actual_hours) filter (where department = 'Front of House') as fh from f_shifts where not is_absent)""")

# --- live feed -------------------------------------------------------------------------------

RECENT = """select * from valid_events where "timestamp" >= (select max("timestamp") from valid_events) - interval 10 hours"""


def one_snapshot(source: str) -> str:
    return f"""select 600.0::double as window_minutes, count(*) as order_count,
      {d(r2('coalesce(cast(sum(cast(subtotal as decimal(18,6))) as double), 0)'))} as total_revenue,
      {d(r2('coalesce(sum(item_count) / nullif(count(*), 0)::double, 0)'))} as average_items_per_order,
      {channel_text()} as orders_by_channel from {source}"""


add("r2_snapshot_latest", one_snapshot("recent"), recent=RECENT)
add("r2_snapshot_as_of", one_snapshot("at_noon"), at_noon="""select * from valid_events where "timestamp" between
    timestamp '2024-01-15 02:00:00' and timestamp '2024-01-15 12:00:00'""")
add("r3_recent_events", f"""select {pick(EVENT)} from recent order by "timestamp" desc, event_id desc limit 20""",
    recent=RECENT)


def session(source: str) -> str:
    return f"""select timestamp '2024-01-01 00:00:00' as session_start,
      {d(r2("date_diff('microsecond', timestamp '2024-01-01 00:00:00', max(\"timestamp\")) / 60000000.0::double"))}
        as session_duration_minutes,
      count(*) as total_orders,
      {d(r2('cast(sum(cast(subtotal as decimal(18,6))) as double)'))} as total_revenue,
      (select channel from {source} group by 1 order by count(*) desc, min("timestamp") limit 1) as busiest_channel,
      {channel_text()} as orders_by_channel,
      (select max(c) from (select count(*) as c from {source} group by date_trunc('minute', "timestamp")))
        as peak_orders_per_minute from {source}"""


add("r5_session_summary", session("valid_events"))
add("r5_session_summary_capped", session("latest"), latest=LATEST.format(500))
add("r6_minute_buckets", """select date_trunc('minute', "timestamp") as minute, count(*) as "count" from recent
    group by 1""", recent=RECENT)
add("r7_channel_breakdown", f"""select channel, count(*) as order_count,
    {d('count(*) * 100 / (select count(*) from valid_events)::double')} as pct from valid_events group by 1""")
add("r10_valid_events", f"select {pick(EVENT)} from valid_events")
add("r10_rejected_events", f"""select {pick(EVENT)}, violations from (select *, concat_ws(',',
    case when {outside('channel', *CHANNEL_SET)} then 'channel' end,
    case when not coalesce(item_count > 0, false) then 'item_count' end,
    case when not coalesce(subtotal > 0, false) then 'subtotal' end) as violations from s_events) where violations <> ''""")

SQL["s9_event_stream"] = SQL["r10_valid_events"]
SQL["r10_stream_rejects"] = SQL["r10_rejected_events"]
SQL["r1_stream_rolling"] = SQL["r1_rolling_kpis"]
add("r2_stream_idle", """select site, max("timestamp") + interval 15 minutes as "timestamp", 15.0::double as window_minutes,
    cast(0 as bigint) as order_count, 0.0::double as total_revenue, 0.0::double as average_items_per_order,
    cast(0 as bigint) as channels from valid_events group by 1""")
add("r9_stream_latest", f"""select * exclude place from (select *, row_number() over (partition by site
    order by "timestamp" desc) as place from rolled) where place = 1""", rolled=trailing("site"))
SQL["r5_stream_session"] = SQL["r5_session_summary"]
add("r9_summary_messages", """select 'summary' as type, cast(order_count as varchar) as order_count,
    nullif(regexp_extract(orders_by_channel, 'dine_in=([0-9]+)', 1), '') as dine_in
    from (select *, row_number() over (partition by site order by "timestamp" desc) as place from rolled) where place = 1""",
    rolled=trailing("site"))
add("s10_messages", """select 'order' as type, event_id, channel, cast(order_count as varchar) as order_count,
    nullif(regexp_extract(orders_by_channel, 'dine_in=([0-9]+)', 1), '') as dine_in
    from rolled join valid_events using (event_id)""", rolled=trailing("site"))
add("r4_stream_history", f"""select {pick(EVENT)} from (select *, row_number() over (partition by site
    order by "timestamp" desc, event_id desc) as place from valid_events) where place <= 500""")
add("r3_stream_open_window", f"""select {pick(EVENT)} from (select *, max("timestamp") over (partition by site) as newest
    from valid_events) where "timestamp" >= newest - interval 15 minutes""")
add("r5_stream_totals", """select channel, count(*) as order_count,
    cast(sum(cast(subtotal as decimal(18,6))) as decimal(38,6)) as revenue, min("timestamp") as first_order,
    max("timestamp") as last_order from valid_events group by 1""")
add("r6_stream_minutes", """select date_trunc('minute', "timestamp") as minute, count(*) as "count" from valid_events
    group by 1""")

# --- derived tables --------------------------------------------------------------------------

add("a1_ingredient_consumption", f"""select l.business_date, r.ingredient_id,
    {d('sum(l.quantity * r.quantity_required)')} as ingredient_quantity,
    {d('avg(r.estimated_wastage_pct)')} as estimated_wastage_pct
    from f_order_lines l join s_recipes r using (menu_item_id)
    where l.status <> 'Cancelled' and l.item_status = 'Fulfilled' group by all""")
add("a2_closing_inventory", f"""select ingredient_id, {d('round(sum(quantity_change), 4)')} as closing_quantity,
    {m4('sum(movement_value)')} as closing_value from s_inventory_movements group by 1""")
STAFF = """select business_date, daypart,
    greatest(1, count(*) filter (where department = 'Kitchen' and not is_absent)) as cooks,
    greatest(1, count(*) filter (where department = 'Front of House' and not is_absent)) as waiters
    from f_shifts group by all"""
add("a3_effective_staffing", f"""select business_date, daypart, {n('cooks')} as kitchen_staff_count,
    {n('waiters')} as front_of_house_staff_count from staff""", staff=STAFF)
add("a4_kitchen_load", f"""select order_id, in_hour as orders_in_hour, {n('cooks')} as kitchen_present,
    {d('round_even(in_hour / (cooks * 9.0::double), 3)')} as computed_load_ratio
    from (select *, count(*) over (partition by business_date, daypart, hour(order_timestamp)) as in_hour
      from s_orders) left join staff using (business_date, daypart)""", staff=STAFF)
add("a5_base_preparation", f"""select order_id,
    {d('max(estimated_prep_minutes) + 0.4::double * (sum(estimated_prep_minutes) - max(estimated_prep_minutes))')}
    as base_prep_minutes from s_order_items join s_menu_items using (menu_item_id) group by 1""")
RATES = "m2 discount_rate, m2 commission_rate, m2 refund_fraction"
add("a6_order_economics", f"""select cast(o_orderkey as varchar) as order_id,
    case o_orderstatus when 'O' then 'Completed' when 'F' then 'Cancelled' else 'Partially Refunded' end as status,
    {m2('amount')} as subtotal, {m4('cast(amount * 0.30 as decimal(10,4))')} as estimated_food_cost,
    {m2('promo_rate')} as discount_rate, {m2('channel_rate')} as commission_rate, {m2('part_back')} as refund_fraction,
    {m2('cast(disc as decimal(10,2))')} as discount_amount, {m2('cast(back as decimal(10,2))')} as refund_amount,
    {m2('cast(comm as decimal(10,2))')} as platform_commission,
    {m2('cast(amount - disc - back - comm as decimal(10,2))')} as net_sales,
    {m4('cast(amount - disc - back - comm - cast(amount * 0.30 as decimal(10,4)) as decimal(10,4))')}
      as estimated_gross_profit from money_orders""")
add("a7_complaints", f"""select review_id, {n('rating')} as rating, reason as derived_complaint_category,
    coalesce(rating <= 2, false) or reason is not null as derived_response_required
    from (select r.review_id, r.rating, case when o.has_missing_item then 'Missing Item' when o.is_late then 'Late Order'
      when r.rating <= 2 then 'Unspecified' end as reason
      from s_reviews r left join s_orders o on o.order_id = r.order_id)""")
add("a8_calendar", """select business_date, day_name, is_weekend as weekend_flag,
    is_public_holiday as public_holiday_flag, is_city_event as city_event_flag, promotion_name,
    case when not is_public_holiday then null
      when month(business_date) = 1 and day(business_date) = 1 then 'New Year''s Day'
      when month(business_date) = 1 then 'Australia Day'
      when month(business_date) = 12 and day(business_date) = 25 then 'Christmas Day'
      when month(business_date) = 12 then 'Boxing Day'
      when month(business_date) = 6 then 'King''s Birthday' when month(business_date) = 11 then 'Melbourne Cup Day'
      when month(business_date) = 3 and day(business_date) between 8 and 14 then 'Labour Day'
      when isodow(business_date) = 5 and business_date + 2 in (EASTERS) then 'Good Friday'
      when isodow(business_date) = 1 and business_date - 1 in (EASTERS) then 'Easter Monday'
      else 'ANZAC Day' end as holiday
    from s_daily_context where business_date in (select cast(o_orderdate as date) from orders)""".replace(
    "EASTERS", "date '1995-04-16', date '1996-04-07', date '1997-03-30', date '1998-04-12', date '1999-04-04', "
    "date '2000-04-23', date '2001-04-15'"))
