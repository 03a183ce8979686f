"""Data-quality operators V1-V16.

Reports have one row per failing check: ``table_name, check, violations, examples``.  A table's
row checks share one pass; each failing row is exploded to one (check, id) pair per failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate, divided, mean, not_in, select
from tallyhouse.operators.ordering import prefix_sums
from tallyhouse.schemas import (
    CHANNELS,
    DAYPARTS,
    FIELD_BOUNDS,
    ITEM_STATUSES,
    MOVEMENT_TYPES,
    NULLABLE_FIELDS,
    ORDER_STATUSES,
    ROW_ID,
)
from tallyhouse.sources.workdir import settle, tasks_for

EXAMPLES = 5
MONEY_TOLERANCE = 0.02
BALANCE_TOLERANCE = 0.01


# --- V1: the report --------------------------------------------------------------------------


def failures(rows: DataFrame, row_id: str, checks: dict[str, str]) -> DataFrame:
    """One ``(check, id)`` pair per row and failed check; a NULL condition is no failure."""
    named = [f"if({condition}, '{message}', null)" for message, condition in checks.items()]
    return rows.selectExpr(
        f"explode(array_compact(array({', '.join(named)}))) as check", f"cast({row_id} as string) as id"
    )


def orphans(child: DataFrame, row_id: str, key: str, parent: DataFrame, parent_key: str, message: str) -> DataFrame:
    """Rows whose key, NULL included, is not among the parent's keys."""
    known = parent.selectExpr(f"{parent_key} as {key}").where(f"{key} is not null").distinct()
    missing = select(child, row_id, key).join(known, key, "left_anti")
    return missing.selectExpr(f"'{message}' as check", f"cast({row_id} as string) as id")


def report(table: str, failed: DataFrame) -> DataFrame:
    """V1: count and first ids per failed check.

    The failures are written first (eager), so the checked tables are read once.  The examples come
    from ``row_number() <= 5``, which Spark cuts to five per task before the shuffle, so a check that
    a third of a table fails still sends a handful of ids.
    """
    failed = settle(failed, "failures")
    first = failed.selectExpr("*", "row_number() over (partition by check order by id nulls last) as _n")
    examples = aggregate(
        first.where(f"_n <= {EXAMPLES}"), ["check"], "array_join(array_sort(collect_list(id)), ', ') as examples"
    )
    counted = aggregate(failed, ["check"], "count(*) as violations").join(examples, "check")
    return counted.selectExpr(f"'{table}' as table_name", "check", "violations", "examples")


# --- V2-V8: checks of the loaded tables ------------------------------------------------------
# The messages of the checks, the text before each condition.


def check_daily_context(context: DataFrame) -> DataFrame:
    """V2."""
    checks = {"Negative rain_mm": "rain_mm < 0", "Missing business_date": "business_date is null"}
    return report("daily_context", failures(context, "business_date", checks))


EXPECTED_NET = "(subtotal - discount_amount - refund_amount - platform_commission)"


def off_balance(tolerance: float) -> str:
    return f"abs(net_sales - {EXPECTED_NET}) > {tolerance}BD"


def check_orders(orders: DataFrame, tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    """V3."""
    dine_in = "channel <=> 'dine_in'"
    checks = {
        "Invalid channel value": not_in("channel", CHANNELS),
        "Invalid status value": not_in("status", ORDER_STATUSES),
        "Invalid daypart value": not_in("daypart", DAYPARTS),
        "Negative subtotal": "subtotal < 0",
        "Non-positive preparation_minutes": "preparation_minutes <= 0",
        "Missing order_timestamp": "order_timestamp is null",
        "net_sales does not reconcile to subtotal - discount - refund - commission": off_balance(tolerance),
        "dine_in order missing table_number": f"{dine_in} and table_number is null",
        "non-dine_in order has a table_number": f"not ({dine_in}) and table_number is not null",
    }
    return report("orders", failures(orders, "order_id", checks))


def check_order_items(lines: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    """V4."""
    own = failures(
        lines,
        "order_item_id",
        {
            "Non-positive quantity": "quantity <= 0",
            "Negative line_total": "line_total < 0",
            "Invalid item_status value": not_in("item_status", ITEM_STATUSES),
        },
    )
    no_order = orphans(lines, "order_item_id", "order_id", orders, "order_id", "order_id not found in orders")
    no_item = orphans(
        lines, "order_item_id", "menu_item_id", menu_items, "menu_item_id", "menu_item_id not found in menu_items"
    )
    return report("order_items", own.unionByName(no_order).unionByName(no_item))


def check_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """V5: an empty table is clean."""
    own = failures(
        reviews,
        "review_id",
        {
            "Rating outside 1-5": "rating not between 1 and 5",
            "Invalid channel value": not_in("channel", CHANNELS),
        },
    )
    no_order = orphans(reviews, "review_id", "order_id", orders, "order_id", "order_id not found in orders")
    return report("reviews", own.unionByName(no_order))


def check_shifts(shifts: DataFrame, employees: DataFrame) -> DataFrame:
    """V6."""
    own = failures(
        shifts,
        "shift_id",
        {
            "shift_end not after shift_start": "shift_end <= shift_start",
            "Non-positive scheduled_hours": "scheduled_hours <= 0",
            "Negative actual_hours": "actual_hours < 0",
            "Negative labour_cost": "labour_cost < 0",
            "Absent shift has non-zero actual_hours": "is_absent and actual_hours <> 0",
        },
    )
    nobody = orphans(
        shifts, "shift_id", "employee_id", employees, "employee_id", "employee_id not found in employees"
    )
    return report("shifts", own.unionByName(nobody))


def running_balance(movements: DataFrame) -> DataFrame:
    """Stock after each ledger movement of an ingredient.

    Movements at the same instant follow their id.  The ledger is cut into ranges of ingredient, instant and id, so neither
    a busy ingredient nor a busy instant is sorted in one task.
    """
    rows = select(movements, "movement_id, ingredient_id, movement_timestamp, quantity_change")
    totals = prefix_sums(rows, ["ingredient_id"], ["movement_timestamp", "movement_id"], {"balance": "quantity_change"})
    return select(totals, "movement_id, ingredient_id, movement_timestamp, balance")


def negative_balances(movements: DataFrame, tolerance: float = BALANCE_TOLERANCE) -> DataFrame:
    """Movements after which the stock is below zero."""
    return running_balance(movements).where(f"balance < -{tolerance}D")


def check_inventory_movements(movements: DataFrame, ingredients: DataFrame) -> DataFrame:
    """V7."""
    own = failures(
        movements,
        "movement_id",
        {
            "Invalid movement_type value": not_in("movement_type", MOVEMENT_TYPES),
            "Negative unit_cost": "unit_cost < 0",
        },
    )
    unknown = orphans(
        movements,
        "movement_id",
        "ingredient_id",
        ingredients,
        "ingredient_id",
        "ingredient_id not found in ingredients",
    )
    below = negative_balances(movements).selectExpr(
        "'Running inventory balance went negative' as check", "movement_id as id"
    )
    return report("inventory_movements", own.unionByName(unknown).unionByName(below))


def run_all_checks(
    context: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    reviews: DataFrame,
    menu_items: DataFrame,
    shifts: DataFrame | None = None,
    employees: DataFrame | None = None,
    movements: DataFrame | None = None,
    ingredients: DataFrame | None = None,
) -> DataFrame:
    """V8: every report in one frame; shifts and movements are checked when given.

    The failures are written by tasks cut by the rows of the largest table, so no sort or running sum spills as it grows.
    """
    counted = [rows.count() for rows in (orders, lines, reviews, shifts, movements) if rows is not None]
    with tasks_for(orders.sparkSession, max(counted)):
        reports = [
            check_daily_context(context),
            check_orders(orders),
            check_order_items(lines, orders, menu_items),
            check_reviews(reviews, orders),
        ]
        if shifts is not None and employees is not None:
            reports.append(check_shifts(shifts, employees))
        if movements is not None and ingredients is not None:
            reports.append(check_inventory_movements(movements, ingredients))
    merged = reports[0]
    for part in reports[1:]:
        merged = merged.unionByName(part)
    return merged


# --- V9-V11: declarative column tests --------------------------------------------------------


def duplicated_keys(rows: DataFrame, key: str) -> DataFrame:
    """V9 unique: non-null key values found more than once."""
    keyed = rows.where(f"{key} is not null").selectExpr(f"{key} as key")
    return aggregate(keyed, ["key"], "count(*) as copies").where("copies > 1")


def missing_keys(rows: DataFrame, key: str) -> DataFrame:
    """V9 not_null."""
    return rows.where(f"{key} is null")


def unaccepted_values(rows: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Non-null values outside a list, with their row counts."""
    outside = rows.where(f"{column} is not null and {not_in(column, accepted)}").selectExpr(f"{column} as value")
    return aggregate(outside, ["value"], "count(*) as rows")


def broken_references(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, with their row counts.

    The child is counted per key first, so a frequent key reaches the join as one row.
    """
    keyed = child.where(f"{key} is not null").selectExpr(f"{key} as key")
    used = aggregate(keyed, ["key"], "count(*) as rows")
    return used.join(parent.selectExpr(f"{parent_key} as key"), "key", "left_anti")


def key_test_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """V9 over several tables: duplicated key values and missing keys per table."""
    merged = None
    for name, (rows, key) in tables.items():
        per_key = aggregate(rows.selectExpr(f"cast({key} as string) as key"), ["key"], "count(*) as n")
        line = per_key.selectExpr(
            f"'{name}' as table_name",
            "count_if(key is not null and n > 1) as duplicated_keys",
            "coalesce(sum(n) filter (where key is null), 0) as missing_keys",
        )
        merged = line if merged is None else merged.unionByName(line)
    return merged


# --- V12: assertions that return the failing rows --------------------------------------------


def nonpositive_quantities(lines: DataFrame) -> DataFrame:
    return select(lines.where("quantity <= 0"), "order_item_id, quantity")


def unreconciled_orders(orders: DataFrame, tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    return select(
        orders.where(off_balance(tolerance)),
        "order_id, subtotal, discount_amount, refund_amount, platform_commission, net_sales",
        f"{EXPECTED_NET} as expected_net_sales",
    )


def negative_money(orders: DataFrame) -> DataFrame:
    return select(orders.where("subtotal < 0 or net_sales < 0"), "order_id, subtotal, net_sales")


def ratings_out_of_range(reviews: DataFrame) -> DataFrame:
    return select(reviews.where("rating not between 1 and 5"), "review_id, rating")


def shifts_ending_early(shifts: DataFrame) -> DataFrame:
    return select(shifts.where("shift_end <= shift_start"), "shift_id, shift_start, shift_end")


# --- V13-V16: seed tables --------------------------------------------------------------------


def seed_reference_errors(
    menu_items: DataFrame, ingredients: DataFrame, suppliers: DataFrame, recipes: DataFrame
) -> DataFrame:
    """A message per broken seed reference, and per menu item without a recipe."""

    def unknown(rows: DataFrame, key: str, parent: DataFrame, message: str) -> DataFrame:
        lost = rows.join(select(parent, key).distinct(), key, "left_anti")
        return lost.selectExpr(f"concat({message}) as error")

    found = (
        unknown(
            select(ingredients, "ingredient_id, supplier_id"),
            "supplier_id",
            suppliers,
            """'ingredients: ', ingredient_id, " references unknown supplier_id '", supplier_id, "'" """,
        ),
        unknown(
            select(recipes, "menu_item_id"),
            "menu_item_id",
            menu_items,
            """"recipes: unknown menu_item_id '", menu_item_id, "'" """,
        ),
        unknown(
            select(recipes, "menu_item_id, ingredient_id"),
            "ingredient_id",
            ingredients,
            """"recipes: unknown ingredient_id '", ingredient_id, "' for menu item '", menu_item_id, "'" """,
        ),
        unknown(
            select(menu_items, "menu_item_id"),
            "menu_item_id",
            recipes,
            "'menu_items: ', menu_item_id, ' has no recipe rows'",
        ),
    )
    merged = found[0]
    for part in found[1:]:
        merged = merged.unionByName(part)
    return merged


def require_seed_references(
    menu_items: DataFrame, ingredients: DataFrame, suppliers: DataFrame, recipes: DataFrame, shown: int = 20
) -> None:
    """V13 as a gate: raises with the count and the first messages when any reference is broken."""
    errors = seed_reference_errors(menu_items, ingredients, suppliers, recipes)
    first = [row.error for row in errors.orderBy("error").limit(shown).collect()]
    if first:
        raise ValueError(
            f"Seed data referential-integrity check failed ({errors.count()} errors):\n" + "\n".join(first)
        )


# Condition under which a value breaks a bound.
_BROKEN = {"gt": "{0} <= {1}", "ge": "{0} < {1}", "lt": "{0} >= {1}", "le": "{0} > {1}"}


def field_bound_checks(table: str, columns: Sequence[str]) -> dict[str, str]:
    """Message and failure condition of every declared bound, and of every required column."""
    checks = {}
    for column, rule, limit in FIELD_BOUNDS[table]:
        if rule == "in":
            checks[f"{column} must be one of {', '.join(limit)}"] = f"{column} is not null and {not_in(column, limit)}"
        else:
            checks[f"{column} must be {rule} {limit}"] = _BROKEN[rule].format(column, limit)
    optional = NULLABLE_FIELDS.get(table, ())
    checks.update({f"{c} is required": f"{c} is null" for c in columns if c not in optional})
    return checks


def check_field_bounds(table: str, rows: DataFrame) -> DataFrame:
    """Report of one table against its declared field bounds, in one pass."""
    return report(table, failures(rows, ROW_ID[table], field_bound_checks(table, rows.columns)))


def menu_summary(menu_items: DataFrame, costs: DataFrame) -> DataFrame:
    """Price, food cost, profit and margin of every item, with or without a recipe."""
    profit = "(cast(selling_price as double) - estimated_item_food_cost)"
    return (
        select(menu_items, "menu_item_id, item_name, category, selling_price")
        .join(costs, "menu_item_id", "left")
        .selectExpr(
            "*",
            f"{profit} as estimated_gross_profit",
            f"{divided(profit, 'selling_price')} as estimated_gross_margin_pct",
        )
    )


def seed_report(menu_items: DataFrame, ingredients: DataFrame, recipes: DataFrame, costs: DataFrame) -> DataFrame:
    """One row of counts, recipe coverage and mean food-cost share."""
    items = aggregate(
        menu_summary(menu_items, costs),
        [],
        "count(*) as number_of_menu_items",
        "count(distinct category) as number_of_categories",
        f"{mean(divided('estimated_item_food_cost', 'selling_price'))} as average_estimated_food_cost_pct",
    )
    counted = items.withColumns(
        {
            "number_of_ingredients": ingredients.agg(F.count("*")).scalar(),
            "_with_recipe": recipes.agg(F.countDistinct("menu_item_id")).scalar(),
        }
    )
    return select(
        counted,
        "number_of_menu_items, number_of_categories, number_of_ingredients",
        f"{divided('_with_recipe', 'number_of_menu_items')} as recipe_coverage_pct",
        "average_estimated_food_cost_pct",
    )
