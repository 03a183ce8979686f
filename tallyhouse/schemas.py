"""Declared shapes of the raw tables, their closed value sets and their field bounds.

Everything in this module is fixed data: names, types, limits.
"""

from __future__ import annotations

# The closed sets of the order, staffing and ledger tables.
CHANNELS = ("dine_in", "pickup", "uber_eats", "doordash")
DAYPARTS = ("lunch", "dinner")
ORDER_STATUSES = ("Completed", "Cancelled", "Partially Refunded")
ITEM_STATUSES = ("Fulfilled", "Missing")
DEPARTMENTS = ("Kitchen", "Front of House")
EMPLOYMENT_TYPES = ("Full-time", "Part-time", "Casual")
MOVEMENT_TYPES = ("Supplier Delivery", "Sales Consumption", "Waste", "Stock Adjustment", "Expired Stock")
UNITS = ("kilograms", "litres", "each", "portions")
SOURCE_TYPES = ("synthetic", "public_source")
EVENT_STATUSES = ("placed", "in_kitchen", "ready", "completed")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# The channel reference table (channel, label, is delivery, commission rate).
CHANNEL_REFERENCE = (
    ("dine_in", "Dine-In", False, 0.00),
    ("pickup", "Pickup", False, 0.00),
    ("uber_eats", "Uber Eats", True, 0.28),
    ("doordash", "DoorDash", True, 0.25),
)

# Raw tables as they lie in CSV files, in column order.
RAW_SCHEMAS = {
    "menu_items": (
        "menu_item_id string, item_name string, category string, selling_price double, "
        "estimated_prep_minutes int, vegetarian boolean, vegan boolean, gluten_free boolean, "
        "available_for_delivery boolean, base_popularity_weight double, cold_weather_affinity double, "
        "hot_weather_affinity double, lunch_affinity double, dinner_affinity double, "
        "delivery_affinity double, source_type string, source_url string"
    ),
    "ingredients": (
        "ingredient_id string, ingredient_name string, ingredient_category string, unit string, "
        "estimated_unit_cost double, shelf_life_days int, reorder_level double, safety_stock double, "
        "supplier_id string, synthetic_estimate boolean"
    ),
    "suppliers": (
        "supplier_id string, supplier_name string, supplier_category string, average_lead_time_days int, "
        "reliability_score double, synthetic_estimate boolean"
    ),
    "recipes": (
        "menu_item_id string, ingredient_id string, quantity_required double, unit string, "
        "estimated_wastage_pct double"
    ),
    "employees": (
        "employee_id string, employee_name string, department string, role string, "
        "employment_type string, hourly_rate double, standard_weekly_hours double, active boolean, "
        "synthetic_estimate boolean"
    ),
    "daily_context": (
        "business_date date, day_name string, temperature_c double, rain_mm double, weekend_flag boolean, "
        "public_holiday_flag boolean, city_event_flag boolean, promotion_name string"
    ),
    "orders": (
        "order_id string, order_timestamp timestamp_ntz, business_date date, daypart string, channel string, "
        "status string, table_number double, customer_count double, promotion_name string, subtotal double, "
        "discount_amount double, refund_amount double, platform_commission double, net_sales double, "
        "estimated_food_cost double, estimated_gross_profit double, preparation_minutes double, "
        "promised_minutes double, late_flag boolean, missing_item_flag boolean, kitchen_staff_count int, "
        "front_of_house_staff_count int, kitchen_load_ratio double, temperature_c double, rain_mm double"
    ),
    "order_items": (
        "order_item_id string, order_id string, menu_item_id string, quantity int, unit_price double, "
        "estimated_unit_food_cost double, line_total double, estimated_line_food_cost double, "
        "special_request string, item_status string"
    ),
    "reviews": (
        "review_id string, order_id string, review_date date, channel string, rating int, "
        "review_text string, complaint_category string, response_required_flag boolean"
    ),
    "employee_shifts": (
        "shift_id string, employee_id string, business_date date, role string, shift_start timestamp_ntz, "
        "shift_end timestamp_ntz, break_minutes int, scheduled_hours double, actual_hours double, "
        "absence_flag boolean, hourly_rate double, labour_cost double"
    ),
    "inventory_movements": (
        "movement_id string, movement_timestamp timestamp_ntz, business_date date, ingredient_id string, "
        "movement_type string, quantity_change double, unit string, unit_cost double, "
        "movement_value double, reference_id string"
    ),
}

SEED_TABLES = ("menu_items", "ingredients", "suppliers", "recipes", "employees")

EVENT_SCHEMA = (
    "event_id string, timestamp timestamp, channel string, daypart string, item_count int, "
    "subtotal double, status string"
)

# Field bounds per raw table as (column, rule, limit).  Rules: gt, ge, lt, le compare
# with the limit, "in" tests a closed set.  A column not listed as nullable must be present.
FIELD_BOUNDS = {
    "menu_items": (
        ("selling_price", "gt", 0),
        ("estimated_prep_minutes", "gt", 0),
        ("base_popularity_weight", "gt", 0),
        ("cold_weather_affinity", "gt", 0),
        ("hot_weather_affinity", "gt", 0),
        ("lunch_affinity", "gt", 0),
        ("dinner_affinity", "gt", 0),
        ("delivery_affinity", "gt", 0),
        ("source_type", "in", SOURCE_TYPES),
    ),
    "ingredients": (
        ("unit", "in", UNITS),
        ("estimated_unit_cost", "ge", 0),
        ("shelf_life_days", "gt", 0),
        ("reorder_level", "ge", 0),
        ("safety_stock", "ge", 0),
    ),
    "suppliers": (
        ("average_lead_time_days", "ge", 0),
        ("reliability_score", "ge", 0),
        ("reliability_score", "le", 1),
    ),
    "recipes": (
        ("quantity_required", "gt", 0),
        ("unit", "in", UNITS),
        ("estimated_wastage_pct", "ge", 0),
        ("estimated_wastage_pct", "lt", 1),
    ),
    "employees": (
        ("department", "in", DEPARTMENTS),
        ("employment_type", "in", EMPLOYMENT_TYPES),
        ("hourly_rate", "gt", 0),
        ("standard_weekly_hours", "gt", 0),
    ),
    "daily_context": (("rain_mm", "ge", 0),),
    "orders": (
        ("daypart", "in", DAYPARTS),
        ("channel", "in", CHANNELS),
        ("status", "in", ORDER_STATUSES),
        ("subtotal", "ge", 0),
        ("discount_amount", "ge", 0),
        ("refund_amount", "ge", 0),
        ("platform_commission", "ge", 0),
        ("estimated_food_cost", "ge", 0),
        ("preparation_minutes", "gt", 0),
        ("promised_minutes", "gt", 0),
        ("kitchen_staff_count", "gt", 0),
        ("front_of_house_staff_count", "gt", 0),
        ("kitchen_load_ratio", "ge", 0),
        ("rain_mm", "ge", 0),
    ),
    "order_items": (
        ("quantity", "gt", 0),
        ("unit_price", "gt", 0),
        ("estimated_unit_food_cost", "ge", 0),
        ("line_total", "ge", 0),
        ("estimated_line_food_cost", "ge", 0),
        ("item_status", "in", ITEM_STATUSES),
    ),
    "reviews": (
        ("channel", "in", CHANNELS),
        ("rating", "ge", 1),
        ("rating", "le", 5),
    ),
    "employee_shifts": (
        ("break_minutes", "ge", 0),
        ("scheduled_hours", "gt", 0),
        ("actual_hours", "ge", 0),
        ("hourly_rate", "gt", 0),
        ("labour_cost", "ge", 0),
    ),
    "inventory_movements": (
        ("movement_type", "in", MOVEMENT_TYPES),
        ("unit", "in", UNITS),
        ("unit_cost", "ge", 0),
    ),
}

NULLABLE_FIELDS = {
    "menu_items": ("source_url",),
    "daily_context": ("promotion_name",),
    "orders": ("table_number", "customer_count", "promotion_name"),
    "order_items": ("special_request",),
    "reviews": ("complaint_category",),
}

# The column that names a row in reports.
ROW_ID = {
    "menu_items": "menu_item_id",
    "ingredients": "ingredient_id",
    "suppliers": "supplier_id",
    "recipes": "menu_item_id",
    "employees": "employee_id",
    "daily_context": "business_date",
    "orders": "order_id",
    "order_items": "order_item_id",
    "reviews": "review_id",
    "employee_shifts": "shift_id",
    "inventory_movements": "movement_id",
}

# The menu's categories, and the column tests declared for dimensions and facts.
MENU_CATEGORIES = (
    "Starters", "Dumplings", "Rice Paper Rolls", "Banh Mi", "Pho Noodles", "Pho Xao", "Rice Bowls", "Vermicelli Salad",
    "Sharing Plates", "Sides", "Drinks",
)
DECLARED_KEYS = {
    "dim_date": "business_date",
    "dim_menu_item": "menu_item_id",
    "dim_ingredient": "ingredient_id",
    "dim_employee": "employee_id",
    "dim_supplier": "supplier_id",
    "dim_channel": "channel",
    "fact_orders": "order_id",
    "fact_order_items": "order_item_id",
    "fact_employee_shifts": "shift_id",
    "fact_reviews": "review_id",
    "fact_inventory_movements": "movement_id",
}
DECLARED_VALUES = {
    ("dim_menu_item", "category"): MENU_CATEGORIES,
    ("dim_employee", "department"): DEPARTMENTS,
    ("dim_channel", "channel"): CHANNELS,
    ("fact_orders", "status"): ORDER_STATUSES,
    ("fact_orders", "daypart"): DAYPARTS,
    ("fact_order_items", "item_status"): ITEM_STATUSES,
    ("fact_inventory_movements", "movement_type"): MOVEMENT_TYPES,
}
DECLARED_REFERENCES = {
    ("dim_ingredient", "supplier_id"): "dim_supplier",
    ("fact_orders", "channel"): "dim_channel",
    ("fact_order_items", "order_id"): "fact_orders",
    ("fact_order_items", "menu_item_id"): "dim_menu_item",
    ("fact_employee_shifts", "employee_id"): "dim_employee",
    ("fact_reviews", "order_id"): "fact_orders",
    ("fact_inventory_movements", "ingredient_id"): "dim_ingredient",
}
