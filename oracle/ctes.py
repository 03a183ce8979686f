"""Common table expressions: the driver's tables as staged tables, facts and marts, in DuckDB SQL.

``statement(body)`` puts the expressions a body needs in front of it.  Helper functions write the
result types the Spark side presents: bigint counts, decimal(38, s) money, doubles to 6 digits.
"""

from __future__ import annotations

import re


def n(x: str) -> str:
    """Whole number."""
    return f"cast({x} as bigint)"


def d(x: str) -> str:
    """Double, six digits, by the same arithmetic as the Spark side so that ties fall alike."""
    return f"floor(cast({x} as double) * 1000000 + 0.5) / 1000000"


def r2(x: str) -> str:
    """Double to two digits by its exact binary value, ties to even, as formatted output rounds."""
    return f"cast(printf('%.2f', cast({x} as double)) as double)"


def m2(x: str) -> str:
    return f"cast({x} as decimal(38,2))"


def m4(x: str) -> str:
    return f"cast({x} as decimal(38,4))"


def div(top: str, bottom: str) -> str:
    """Division that yields NULL on a zero divisor."""
    return f"(cast({top} as double) / nullif(cast({bottom} as double), 0))"


def div_pos(top: str, bottom: str) -> str:
    """Division only where the divisor is positive."""
    return f"(case when {bottom} > 0 then cast({top} as double) / cast({bottom} as double) end)"


def avg_exact(x: str) -> str:
    return f"(cast(sum({x}) as double) / nullif(count({x}), 0))"


def share(condition: str) -> str:
    return f"(cast(count(*) filter (where {condition}) as double) / count(*))"


EASTERS = "date '1995-04-16', date '1996-04-07', date '1997-03-30', date '1998-04-12', date '1999-04-04', " \
    "date '2000-04-23', date '2001-04-15'"

CTES: dict[str, str] = {}

# --- staged tables ---------------------------------------------------------------------------

CTES["pre_orders"] = """
select *, cast(o_orderdate as date) as bd, isodow(o_orderdate) - 1 as wd,
  cast(o_totalprice as decimal(10,2)) as amount,
  case isodow(o_orderdate) when 1 then cast(0.15 as decimal(4,2)) when 6 then cast(0.10 as decimal(4,2))
    else cast(0 as decimal(4,2)) end as promo_rate,
  case o_orderpriority when '3-MEDIUM' then cast(0.28 as decimal(4,2)) when '4-NOT SPECIFIED'
    then cast(0.25 as decimal(4,2)) else cast(0 as decimal(4,2)) end as channel_rate,
  cast(cast(10 + o_custkey % 51 as decimal(4,0)) * 0.01 as decimal(4,2)) as part_back,
  (o_custkey % 180) / 4.0::double as prep,
  case o_orderpriority when '1-URGENT' then 24.0::double when '2-HIGH' then 23.0::double
    when '3-MEDIUM' then 38.0::double when '4-NOT SPECIFIED' then 38.0::double else 30.0::double end as promise
from orders"""

CTES["money_orders"] = """
select *, amount * promo_rate as disc, amount - amount * promo_rate as paid,
  case when o_orderstatus = 'F' then 0 else (amount - amount * promo_rate) * channel_rate end as comm,
  case o_orderstatus when 'F' then amount - amount * promo_rate
    when 'P' then (amount - amount * promo_rate) * part_back else 0 end as back,
  case when o_orderpriority = '5-LOW' then cast(amount * 0.01 as decimal(10,2)) else 0 end as fee
from pre_orders"""

CTES["s_orders"] = """
select cast(o_orderkey as varchar) as order_id,
  o_orderdate + to_hours(11 + o_custkey % 10) + to_minutes(o_orderkey % 60) as order_timestamp,
  bd as business_date,
  case when o_custkey % 10 < 4 then 'lunch' else 'dinner' end as daypart,
  case o_orderpriority when '1-URGENT' then 'dine_in' when '2-HIGH' then 'pickup' when '3-MEDIUM' then 'uber_eats'
    when '4-NOT SPECIFIED' then 'doordash' else '5-low' end as channel,
  case o_orderstatus when 'O' then 'Completed' when 'F' then 'Cancelled' else 'Partially Refunded' end as status,
  case when o_orderpriority = '1-URGENT' and o_custkey % 50 <> 0 then o_orderkey % 40 + 1
    when o_orderpriority = '5-LOW' and o_custkey % 10 = 0 then o_orderkey % 40 + 1 end as table_number,
  case when o_orderpriority = '1-URGENT' then o_custkey % 6 + 1 end as customer_count,
  case wd when 0 then 'Banh Mi Monday' when 5 then 'Weekend Sharing Special' end as promotion_name,
  amount as subtotal,
  cast(disc as decimal(10,2)) as discount_amount,
  cast(back as decimal(10,2)) as refund_amount,
  cast(comm as decimal(10,2)) as platform_commission,
  cast(cast(amount - disc - back - comm as decimal(10,2)) + fee as decimal(10,2)) as net_sales,
  cast(amount * 0.30 as decimal(10,4)) as estimated_food_cost,
  cast(cast(cast(amount - disc - back - comm as decimal(10,2)) + fee as decimal(10,2))
    - cast(amount * 0.30 as decimal(10,4)) as decimal(10,4)) as estimated_gross_profit,
  prep as preparation_minutes, promise as promised_minutes, prep > promise as is_late,
  o_orderkey % 16 = 0 as has_missing_item,
  case when wd >= 5 and o_custkey % 10 >= 4 then 3 else 2 end as kitchen_staff_count,
  case when wd >= 5 and o_custkey % 10 >= 4 then 3 else 2 end as front_of_house_staff_count,
  (o_custkey % 24) / 16.0::double as kitchen_load_ratio,
  case when day(bd) <> 31 then 10 + (dayofyear(bd) % 80) / 4.0::double end as temperature_c,
  (dayofyear(bd) % 9 - 1) * 0.5::double as rain_mm,
  discount_rate, commission_rate, refund_fraction
from (select *, promo_rate as discount_rate, channel_rate as commission_rate, part_back as refund_fraction
      from money_orders)"""

CTES["s_order_items"] = """
select l_orderkey || '-' || l_linenumber as order_item_id,
  cast(l_orderkey as varchar) as order_id, cast(l_partkey as varchar) as menu_item_id,
  cast(l_quantity as integer) as quantity, unit_price,
  cast(unit_price * 0.30 as decimal(10,4)) as estimated_unit_food_cost,
  cast(ext * (1 - cast(l_discount as decimal(4,2))) as decimal(10,2)) as line_total,
  cast(ext * (0.30 + cast(l_tax as decimal(4,2))) as decimal(10,4)) as estimated_line_food_cost,
  case when l_linestatus = 'O' then 'no peanuts' end as special_request,
  case when l_returnflag = 'R' then 'Missing' else 'Fulfilled' end as item_status
from (select *, cast(l_extendedprice as decimal(10,2)) as ext,
        cast(cast(cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint) as decimal(10,0)) * 0.01
          as decimal(10,2)) as unit_price
      from lineitem)"""

CTES["s_menu_items"] = """
select cast(p_partkey as varchar) as menu_item_id, p_name as item_name, p_type as category,
  cast(p_retailprice as decimal(10,2)) as selling_price, p_size as estimated_prep_minutes,
  p_size % 2 = 0 as is_vegetarian, p_size % 4 = 0 as is_vegan, p_size % 3 = 0 as is_gluten_free,
  p_size % 5 <> 0 as is_available_for_delivery,
  0.5::double + (p_size % 2) / 4.0::double as base_popularity_weight,
  0.5::double + (p_size % 3) / 4.0::double as cold_weather_affinity,
  0.5::double + (p_size % 4) / 4.0::double as hot_weather_affinity,
  0.5::double + (p_size % 5) / 4.0::double as lunch_affinity,
  0.5::double + (p_size % 6) / 4.0::double as dinner_affinity,
  0.5::double + (p_size % 7) / 4.0::double as delivery_affinity,
  'synthetic' as source_type,
  case when p_size % 7 = 0 then 'https://example.org/menu' end as source_url
from part"""

CTES["s_ingredients"] = """
select cast(s_suppkey as varchar) as ingredient_id, s_name as ingredient_name,
  'Category ' || (s_nationkey % 5) as ingredient_category, 'kilograms' as unit,
  cast(cast(abs(s_acctbal) as decimal(10,2)) * 0.0010 as decimal(10,4)) as estimated_unit_cost,
  cast(s_suppkey % 30 as integer) as shelf_life_days,
  (s_suppkey % 100) * 10.0::double as reorder_level, (s_suppkey % 50) * 1.0::double as safety_stock,
  cast(s_nationkey as varchar) as supplier_id, true as is_synthetic_estimate
from supplier"""

CTES["s_suppliers"] = """
select cast(n_nationkey as varchar) as supplier_id, n_name as supplier_name,
  'Region ' || n_regionkey as supplier_category, n_nationkey % 7 as average_lead_time_days,
  n_nationkey / 16.0::double as reliability_score, true as is_synthetic_estimate
from nation"""

CTES["s_recipes"] = """
select cast(l_partkey as varchar) as menu_item_id, cast(l_suppkey as varchar) as ingredient_id,
  max(l_quantity) as quantity_required, 'kilograms' as unit, max(l_tax) as estimated_wastage_pct
from lineitem group by l_partkey, l_suppkey"""

CTES["s_employees"] = """
select cast(s_suppkey as varchar) as employee_id, s_name as employee_name,
  case when s_nationkey = 24 then 'Office' when s_nationkey % 2 = 0 then 'Kitchen' else 'Front of House' end
    as department,
  if(s_nationkey % 2 = 0, 'Cook', 'Waiter') as role,
  case s_nationkey % 3 when 0 then 'Full-time' when 1 then 'Part-time' else 'Casual' end as employment_type,
  cast(20 + s_suppkey % 20 as decimal(10,2)) as hourly_rate, 38.0::double as standard_weekly_hours,
  s_acctbal > 0 as is_active, true as is_synthetic_estimate
from supplier"""

CTES["s_employee_shifts"] = """
select 'S-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as shift_id,
  cast(l_suppkey as varchar) as employee_id, cast(l_shipdate as date) as business_date, 'Chef' as role,
  l_shipdate + to_hours(start_hour) as shift_start,
  l_shipdate + to_hours(start_hour) + to_seconds(cast(l_quantity * 450 - 1800 as bigint)) as shift_end,
  30 as break_minutes, l_quantity / 8.0::double as scheduled_hours, worked as actual_hours,
  l_returnflag = 'R' as is_absent, cast(20 + l_suppkey % 20 as decimal(10,2)) as hourly_rate,
  cast(cast(worked as decimal(8,3)) * cast(20 + l_suppkey % 20 as decimal(10,2)) as decimal(10,2)) as labour_cost
from (select *, case when l_linestatus = 'O' then 11 else 15 end as start_hour,
        case when l_returnflag = 'R' and l_linenumber < 7 then 0::double else l_quantity / 8.0::double end as worked
      from lineitem)"""

CTES["s_inventory_movements"] = """
select 'M-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as movement_id,
  l_shipdate + to_hours(5 + l_linenumber) + to_minutes(l_orderkey % 60) as movement_timestamp,
  cast(l_shipdate as date) as business_date, cast(l_suppkey as varchar) as ingredient_id,
  case when l_returnflag = 'N' then if(l_linenumber = 7, 'Stock Adjustment', 'Supplier Delivery')
    when l_returnflag = 'A' then 'Sales Consumption'
    else if(l_linestatus = 'O', 'Waste', 'Expired Stock') end as movement_type,
  change as quantity_change, 'kilograms' as unit, unit_cost,
  cast(cast(change as decimal(6,0)) * unit_cost as decimal(10,4)) as movement_value,
  case l_returnflag when 'N' then if(l_linenumber = 1, 'EMERGENCY-', 'PO-') when 'A' then 'ORD-' else 'LOG-' end
    || l_orderkey as reference_id
from (select *, case when l_returnflag = 'N' then 2 * l_quantity else -l_quantity end as change,
        cast(cast(l_extendedprice as decimal(10,2)) * 0.0001 as decimal(10,4)) as unit_cost
      from lineitem)"""

CTES["s_reviews"] = """
select 'R' || event_id as review_id, cast(event_id * 2 as varchar) as order_id, cast(ts as date) as review_date,
  case event_type when 'click' then 'dine_in' when 'view' then 'pickup' when 'purchase' then 'uber_eats'
    when 'signup' then 'doordash' else event_type end as channel,
  stars as rating, props as review_text, complaint as complaint_category,
  coalesce(stars <= 2, false) or complaint is not null as is_response_required
from (select *, case when event_type = 'signup' and user_id % 7 = 0 then null else cast(user_id % 6 as integer) end
          as stars,
        case when event_type = 'error' then 'Late Order'
          when event_type = 'purchase' and user_id % 5 = 0 then 'Missing Item' end as complaint
      from events)"""

CTES["s_daily_context"] = f"""
select bd as business_date, dayname(bd) as day_name,
  10 + (dayofyear(bd) % 80) / 4.0::double as temperature_c, (dayofyear(bd) % 9 - 1) * 0.5::double as rain_mm,
  isodow(bd) >= 6 as is_weekend,
  (month(bd) * 100 + day(bd)) in (101, 126, 425, 1225, 1226)
    or (month(bd) in (3, 6) and isodow(bd) = 1 and day(bd) between 8 and 14)
    or (month(bd) = 11 and isodow(bd) = 2 and day(bd) <= 7)
    or bd + 2 in ({EASTERS}) or bd - 1 in ({EASTERS}) as is_public_holiday,
  (month(bd) * 100 + day(bd)) in (314, 1108) as is_city_event,
  case isodow(bd) when 1 then 'Banh Mi Monday' when 6 then 'Weekend Sharing Special' end as promotion_name
from (select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
        interval 1 day)) as date) as bd from orders)"""

CTES["s_events"] = """
select 'site-' || (user_id % 4) as site, cast(event_id as varchar) as event_id, ts as "timestamp",
  case event_type when 'click' then 'dine_in' when 'view' then 'pickup' when 'purchase' then 'uber_eats'
    when 'signup' then 'doordash' else event_type end as channel,
  if(hour(ts) < 15, 'lunch', 'dinner') as daypart,
  cast(json_extract_string(props, '$.k') as integer) as item_count, value as subtotal, 'placed' as status
from events"""

CTES["valid_events"] = """
select * from s_events
where channel in ('dine_in', 'pickup', 'uber_eats', 'doordash') and item_count > 0 and subtotal > 0"""

CTES["channels"] = """
select * from (values ('dine_in', 'Dine-In', false, 0.0::double), ('pickup', 'Pickup', false, 0.0::double),
  ('uber_eats', 'Uber Eats', true, 0.28::double), ('doordash', 'DoorDash', true, 0.25::double))
  t(channel, channel_label, is_delivery_channel, commission_rate)"""

# --- dimensions, facts, intermediate ---------------------------------------------------------

CTES["item_cost"] = """
select r.menu_item_id,
  sum(r.quantity_required * cast(i.estimated_unit_cost as double) * (1 + r.estimated_wastage_pct)) as cost
from s_recipes r, s_ingredients i where i.ingredient_id = r.ingredient_id group by all"""

CTES["f_order_lines"] = """
select l.*, o.business_date, o.daypart, o.channel, o.status, o.order_timestamp, o.temperature_c
from s_order_items l join s_orders o using (order_id)"""

CTES["line_counts"] = """
select order_id, count(*) as item_count, sum(quantity) as item_quantity_total from s_order_items group by order_id"""

CTES["f_shifts"] = """
select s.*, e.department, case when hour(s.shift_start) < 13 then 'lunch' else 'dinner' end as daypart
from s_employee_shifts s left join s_employees e on e.employee_id = s.employee_id"""

CTES["f_reviews"] = """
select r.*, o.business_date, o.daypart, o.preparation_minutes
from s_reviews r left join s_orders o on o.order_id = r.order_id"""

CTES["hourly"] = f"""
select business_date, daypart, hour(order_timestamp) as order_hour, count(*) as order_count,
  avg(kitchen_load_ratio) as avg_load, avg(preparation_minutes) as avg_prep,
  count(*) filter (where is_late) as late, count(*) filter (where has_missing_item) as missing
from s_orders group by all"""

CTES["labour_slots"] = """
select business_date, daypart, department, count(*) as shifts, count(*) filter (where is_absent) as absences,
  sum(scheduled_hours) as scheduled, sum(actual_hours) as worked, sum(labour_cost) as cost
from f_shifts where department is not null group by all"""

CTES["flows"] = """
select v.business_date, v.ingredient_id, i.ingredient_name, i.ingredient_category,
  coalesce(sum(-quantity_change) filter (where movement_type = 'Sales Consumption'), 0) as quantity_consumed,
  coalesce(sum(-movement_value) filter (where movement_type = 'Sales Consumption'), 0) as consumption_value,
  coalesce(sum(-quantity_change) filter (where movement_type = 'Waste'), 0) as quantity_wasted,
  coalesce(sum(-movement_value) filter (where movement_type = 'Waste'), 0) as waste_value,
  coalesce(sum(-quantity_change) filter (where movement_type = 'Expired Stock'), 0) as quantity_expired,
  coalesce(sum(quantity_change) filter (where movement_type = 'Supplier Delivery'), 0) as quantity_delivered
from s_inventory_movements v join s_ingredients i on i.ingredient_id = v.ingredient_id group by all"""

# --- marts -----------------------------------------------------------------------------------

CTES["live_orders"] = "select * from s_orders where status <> 'Cancelled'"

CTES["k1"] = f"""
select c.business_date, c.day_name, c.is_weekend, c.is_public_holiday, c.is_city_event, c.promotion_name,
  c.temperature_c, c.rain_mm, coalesce(a.cnt, 0) as order_count, coalesce(a.net, 0) as net_sales,
  coalesce(a.food, 0) as estimated_food_cost, coalesce(a.profit, 0) as estimated_gross_profit,
  {div_pos('a.profit', 'a.net')} as estimated_gross_margin_pct, a.aov as average_order_value,
  a.prep as average_preparation_minutes, a.late as late_order_pct, coalesce(w.cost, 0) as labour_cost,
  {div_pos('w.cost', 'a.net')} as labour_cost_pct, r.stars as average_rating, coalesce(x.lost, 0) as waste_cost
from s_daily_context c
left join (select business_date, count(*) cnt, sum(net_sales) net, sum(estimated_food_cost) food,
    sum(estimated_gross_profit) profit, {avg_exact('net_sales')} aov, avg(preparation_minutes) prep,
    {share('is_late')} late from live_orders group by 1) a using (business_date)
left join (select business_date, sum(cost) cost from labour_slots group by 1) w using (business_date)
left join (select business_date, avg(rating) stars from f_reviews where rating is not null group by 1) r
  using (business_date)
left join (select business_date, -sum(movement_value) lost from s_inventory_movements
  where movement_type = 'Waste' group by 1) x using (business_date)"""

CTES["k2"] = f"""
select c.*, coalesce(o.cnt, 0) as order_count, coalesce(o.gross, 0) as gross_sales, coalesce(o.fee, 0) as commission,
  coalesce(o.back, 0) as refunds, coalesce(o.net, 0) as net_sales, coalesce(o.profit, 0) as estimated_gross_profit,
  o.aov as average_order_value, o.prep as average_preparation_minutes, o.late as late_order_pct,
  r.stars as average_rating
from channels c
left join (select channel, count(*) cnt, sum(subtotal) gross, sum(platform_commission) fee, sum(refund_amount) back,
    sum(net_sales) net, sum(estimated_gross_profit) profit, {avg_exact('net_sales')} aov,
    avg(preparation_minutes) prep, {share('is_late')} late from live_orders group by 1) o using (channel)
left join (select channel, avg(rating) stars from s_reviews where rating is not null group by 1) r using (channel)"""

CTES["item_sales"] = """
select menu_item_id, sum(quantity) as units, sum(line_total) as revenue, sum(estimated_line_food_cost) as cost,
  count(distinct order_id) as baskets, avg(quantity) as avg_qty
from f_order_lines where status <> 'Cancelled' and item_status = 'Fulfilled' group by 1"""

CTES["item_margin"] = f"""
select *, revenue - cost as margin, {div_pos('revenue - cost', 'revenue')} as margin_pct from item_sales"""

CTES["middles"] = """
select median(units) as mid_units, median(margin_pct) as mid_pct from item_margin"""

CTES["k3"] = f"""
select *, case when hot and rich then 'Star' when hot then 'Plowhorse' when rich then 'Puzzle' else 'Dog' end as class
from (
  select i.menu_item_id, i.item_name, i.category, i.selling_price, coalesce(g.units, 0) as units_sold,
    coalesce(g.revenue, 0) as revenue, coalesce(g.cost, 0) as estimated_food_cost,
    coalesce(g.margin, 0) as estimated_contribution_margin, g.margin_pct as contribution_margin_pct,
    {div('g.baskets', '(select count(*) from live_orders)')} as order_penetration,
    g.avg_qty as average_quantity_per_order,
    rank() over (partition by i.category order by g.revenue desc nulls last) as sales_rank_within_category,
    {div('g.revenue', 'sum(g.revenue) over (partition by i.category)')} as revenue_pct_within_category,
    coalesce(g.units, 0) >= (select mid_units from middles) as hot,
    coalesce(g.margin_pct, 0) >= (select mid_pct from middles) as rich
  from s_menu_items i left join item_margin g on g.menu_item_id = i.menu_item_id)"""

CTES["k4"] = f"""
select h.*, k_sched + f_sched as sched, k_work + f_work as work, k_cost + f_cost as cost,
  coalesce(o.cnt, 0) as order_count, coalesce(o.net, 0) as net_sales,
  {div_pos('o.cnt', '(k_work + f_work)')} as per_hour, {div_pos('o.net', '(k_work + f_work)')} as rev_per_hour,
  {div_pos('o.cnt', 'k_work')} as per_kitchen_hour, {div_pos('o.cnt', 'f_work')} as per_front_hour,
  {div_pos('(k_cost + f_cost)', 'o.net')} as cost_pct, d.load,
  case when d.load > 1.2 then 'Understaffed' when d.load < 0.5 then 'Overstaffed' else 'Balanced' end as flag
from (
  select coalesce(k.business_date, f.business_date) as business_date, coalesce(k.daypart, f.daypart) as daypart,
    coalesce(k.scheduled, 0) as k_sched, coalesce(f.scheduled, 0) as f_sched, coalesce(k.worked, 0) as k_work,
    coalesce(f.worked, 0) as f_work, coalesce(k.cost, 0) as k_cost, coalesce(f.cost, 0) as f_cost,
    coalesce(k.absences, 0) + coalesce(f.absences, 0) as absences, coalesce(k.shifts, 0) + coalesce(f.shifts, 0) as shifts
  from (select * from labour_slots where department = 'Kitchen') k
  full join (select * from labour_slots where department = 'Front of House') f
    on f.business_date = k.business_date and f.daypart = k.daypart) h
left join (select business_date, daypart, count(*) cnt, sum(net_sales) net from live_orders group by all) o
  on o.business_date = h.business_date and o.daypart = h.daypart
left join (select business_date, daypart, avg(avg_load) as load from hourly group by all) d
  on d.business_date = h.business_date and d.daypart = h.daypart"""

CTES["k5"] = f"""
select business_date, daypart, count(*) as order_count, avg(preparation_minutes) as prep_avg,
  median(preparation_minutes) as prep_mid, quantile_cont(preparation_minutes, 0.9) as prep_p90,
  {share('is_late')} as late, {share('has_missing_item')} as missing,
  {share("status = 'Partially Refunded'")} as refunded, avg(kitchen_load_ratio) as load_avg,
  max(kitchen_load_ratio) as load_max, avg(kitchen_staff_count) as cooks, avg(front_of_house_staff_count) as waiters
from live_orders group by all"""

CTES["uses"] = """
select ingredient_id, string_agg(item_name, ', ' order by item_name) as items
from (select distinct r.ingredient_id, i.item_name from s_recipes r join s_menu_items i using (menu_item_id))
group by 1"""

CTES["k6"] = f"""
select i.ingredient_id, i.ingredient_name, i.ingredient_category, i.unit, i.reorder_level, i.safety_stock,
  s.supplier_name, s.average_lead_time_days as lead_days, coalesce(t.qty, 0) as closing_quantity,
  coalesce(t.val, 0) as closing_value, coalesce(t.qty, 0) < i.reorder_level as alert,
  coalesce(u.run, 0) as run_rate, {div_pos('t.qty', 'u.run')} as days_left,
  coalesce(t.wq, 0) as wq, coalesce(t.wv, 0) as wv, coalesce(t.xq, 0) as xq, coalesce(t.xv, 0) as xv,
  coalesce(t.rush, 0) as rush, a.items
from s_ingredients i left join s_suppliers s using (supplier_id)
left join (select ingredient_id, sum(quantity_change) qty, sum(movement_value) val,
    -sum(quantity_change) filter (where movement_type = 'Waste') wq,
    -sum(movement_value) filter (where movement_type = 'Waste') wv,
    -sum(quantity_change) filter (where movement_type = 'Expired Stock') xq,
    -sum(movement_value) filter (where movement_type = 'Expired Stock') xv,
    count(*) filter (where movement_type = 'Supplier Delivery' and reference_id like '%EMERGENCY%') rush
  from s_inventory_movements group by 1) t using (ingredient_id)
left join (select ingredient_id, avg(quantity_consumed) run from flows group by 1) u using (ingredient_id)
left join uses a using (ingredient_id)"""

CTES["k7"] = """
select r.*, c.day_name, case when r.preparation_minutes < 15 then 'Under 15 min'
  when r.preparation_minutes < 25 then '15-25 min' when r.preparation_minutes < 35 then '25-35 min'
  else 'Over 35 min' end as band
from f_reviews r left join s_daily_context c on c.business_date = r.business_date"""


def pick(spec: str) -> str:
    """Select list from ``kind source>alias`` items; a bare name is taken as it is."""
    kinds = {"n": n, "d": d, "m2": m2, "m4": m4}
    items = []
    for token in spec.split(","):
        *kind, name = token.split()
        source, _, alias = name.partition(">")
        expression = kinds[kind[0]](source) if kind else source
        items.append(f"{expression} as {alias or source.split('.')[-1]}")
    return ", ".join(items)


def _needed(sql: str, found: list[str], open_names: tuple[str, ...] = ()) -> None:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    for name in CTES:
        if name in words and name not in found and name not in open_names:
            _needed(CTES[name], found, (*open_names, name))
            found.append(name)


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """The body with every expression it needs in front, dependencies first."""
    found: list[str] = []
    for part in [*(extra or {}).values(), body]:
        _needed(part, found)
    parts = {name: CTES[name] for name in found} | (extra or {})
    if not parts:
        return body.strip()
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in parts.items()) + "\n" + body.strip()
