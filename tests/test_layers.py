"""Hand-computed cases of the layers, the checks and the sources."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import calendar, derivations, dimensions, drilldowns, intermediate, marts, quality, staging
from tallyhouse.plans import bindings
from tallyhouse.plans.warehouse import MARTS, StoredWarehouse
from tallyhouse.sources import csv_tables, tables, workdir


def test_food_cost_of_one_recipe_line(table):
    recipes = table([("M", "I", 0.20, 0.02)], "menu_item_id string, ingredient_id string, quantity_required double, estimated_wastage_pct double")
    ingredients = table([("I", 2.40)], "ingredient_id string, estimated_unit_cost double")
    cost = dimensions.recipe_costs(recipes, ingredients)
    assert cost.first().estimated_item_food_cost == pytest.approx(0.4896)
    items = table([("M", "x", "c", 4.0), ("N", "y", "c", 0.0)], "menu_item_id string, item_name string, category string, selling_price double")
    assert intermediate.menu_item_costs(items, cost).count() == 1
    kept = {r.menu_item_id: r.estimated_gross_margin_pct for r in quality.menu_summary(items, cost).collect()}
    assert kept == {"M": pytest.approx((4 - 0.4896) / 4), "N": None}


def test_staging_tidies_labels(table):
    raw = table(
        [("R1", "O1", "2026-01-02", " Dine_In ", "4", " ok ", "  ", True)],
        "review_id string, order_id string, review_date string, channel string, rating string, review_text string, "
        "complaint_category string, response_required_flag boolean",
    )
    row = staging.stage_reviews(raw).first()
    assert (row.channel, row.rating, row.review_text, row.complaint_category) == ("dine_in", 4, "ok", None)
    assert row.review_date == date(2026, 1, 2)


def test_orders_without_lines_count_zero(table):
    orders = table(
        [("A", "Completed", 10.0), ("B", "Completed", 0.0)], "order_id string, status string, net_sales double"
    ).selectExpr(
        "*", "date '2026-01-01' as business_date", "'lunch' as daypart", "'dine_in' as channel", "1.0 as subtotal",
        "0.0 as discount_amount", "0.0 as refund_amount", "0.0 as platform_commission", "1.0 as estimated_food_cost",
        "4.0 as estimated_gross_profit",
    )
    lines = table([("A", 2), ("A", 3)], "order_id string, quantity int")
    got = {r.order_id: r for r in intermediate.order_financials(orders, lines).collect()}
    assert (got["A"].item_count, got["A"].item_quantity_total, got["A"].contribution_margin_pct) == (2, 5, 0.4)
    assert (got["B"].item_count, got["B"].contribution_margin_pct) == (0, None)


def test_flags_and_bands_keep_unknowns_in_the_last_branch(table):
    loads = table([(1.3,), (0.4,), (1.0,), (None,)], "x double").selectExpr(f"{marts.staffing_flag('x')} as f")
    assert [r.f for r in loads.collect()] == ["Understaffed", "Overstaffed", "Balanced", "Balanced"]
    band = marts.band("x", marts.PREPARATION_BANDS, marts.SLOWEST_BAND)
    bands = table([(14.9,), (15.0,), (34.9,), (None,)], "x double").selectExpr(f"{band} as b")
    assert [r.b for r in bands.collect()] == ["Under 15 min", "15-25 min", "25-35 min", "Over 35 min"]


def test_filters_none_and_empty_list(table):
    rows = table([("a", date(2026, 1, 1)), ("b", date(2026, 1, 3))], "channel string, business_date date")
    assert drilldowns.apply_filters(rows, members={"channel": None}).count() == 2
    assert drilldowns.apply_filters(rows, members={"channel": []}).count() == 0
    both_ends = drilldowns.apply_filters(rows, date_range=(date(2026, 1, 1), date(2026, 1, 3)))
    assert both_ends.count() == 2


def test_holidays_of_2026(table):
    days = table([(date(2026, 1, 1),)], "d date").selectExpr(
        "explode(sequence(date '2026-01-01', date '2026-12-31')) as business_date"
    )
    rows = calendar.enrich_calendar(days).where("holiday_name is not null").collect()
    found = {r.holiday_name: r.business_date for r in rows}
    assert len(found) == 10
    assert found["Good Friday"] == date(2026, 4, 3) and found["Easter Monday"] == date(2026, 4, 6)
    assert found["Labour Day"].weekday() == 0 and found["King's Birthday"].weekday() == 0
    assert found["Melbourne Cup Day"].weekday() == 1
    assert found["ANZAC Day"] == date(2026, 4, 25) and found["Boxing Day"] == date(2026, 12, 26)


# Published Easter dates far apart, among them the latest possible one.
@pytest.mark.parametrize("day", [date(1943, 4, 25), date(1981, 4, 19), date(2008, 3, 23), date(2049, 4, 18), date(2100, 3, 28)])
def test_easter(table, day):
    assert calendar.with_easter(table([(day,)], "business_date date")).first()._easter == day


def test_complaints(table):
    reviews = table(
        [(True, True, 5), (False, True, 5), (False, False, 2), (False, False, 4)],
        "has_missing_item boolean, is_late boolean, rating int",
    )
    got = [(r.derived_complaint_category, r.derived_response_required) for r in derivations.complaint_columns(reviews).collect()]
    assert got == [("Missing Item", True), ("Late Order", True), ("Unspecified", True), (None, False)]


def test_consumption_matches_recipe_usage(table):
    orders = table([("A", date(2026, 1, 1), "Completed"), ("B", date(2026, 1, 1), "Cancelled")], "order_id string, business_date date, status string")
    lines = table(
        [("A", "M", 2, "Fulfilled"), ("A", "M", 3, "Fulfilled"), ("A", "N", 1, "Missing"), ("B", "M", 9, "Fulfilled")],
        "order_id string, menu_item_id string, quantity int, item_status string",
    )
    recipes = table([("M", "rice", 0.5, 0.1), ("N", "rice", 4.0, 0.2)], "menu_item_id string, ingredient_id string, quantity_required double, estimated_wastage_pct double")
    row = derivations.ingredient_consumption(orders, lines, recipes).collect()
    assert [(r.ingredient_id, r.ingredient_quantity, r.estimated_wastage_pct) for r in row] == [("rice", 2.5, 0.1)]


def test_consumption_gets_partitions_by_the_rows_the_recipes_make(table):
    orders = table([(str(i), date(2026, 7, 1 + i % 20), "Completed") for i in range(60)], "order_id string, business_date date, status string")
    lines = table([(str(i), f"M{i % 3}", 1, "Fulfilled") for i in range(60)], "order_id string, menu_item_id string, quantity int, item_status string")
    recipes = table(
        [(f"M{m}", f"I{i}", 0.5, 0.0) for m in range(3) for i in range(40)],
        "menu_item_id string, ingredient_id string, quantity_required double, estimated_wastage_pct double",
    )
    used = derivations.ingredient_consumption(orders, lines, recipes, exploded_per_task=100)
    assert used.rdd.getNumPartitions() == 60 * 40 // 100
    assert used.count() == 20 * 40 and {r.ingredient_quantity for r in used.collect()} == {1.5}


def test_consumption_shuffles_a_row_per_recipe_line_and_busy_ingredients_in_part_sums(table):
    """The rows that recipes make of item-days were shuffled one by one and filled the disk."""
    dates = [date(2026, 7, 1 + i) for i in range(20)]
    orders = table([(f"{d}-{m}", d, "Completed") for d in dates for m in range(6)], "order_id string, business_date date, status string")
    lines = table(
        [(f"{d}-{m}", f"M{m}", 1 + m, "Fulfilled") for d in dates for m in range(6)] + [(f"{dates[0]}-0", None, 9, "Fulfilled"), (f"{dates[0]}-0", "M0", 9, "Missing")],
        "order_id string, menu_item_id string, quantity int, item_status string",
    )
    bill = [(f"M{m}", f"I{m}{i}", 0.5, 0.25 * (m % 2)) for m in range(6) for i in range(5)] + [(f"M{m}", "salt", 0.25, 0.5) for m in range(6)] + [("M0", None, 1.0, 0.0), ("M9", "I00", 1.0, 0.0)]
    recipes = table(bill, "menu_item_id string, ingredient_id string, quantity_required double, estimated_wastage_pct double")
    wanted = {(d, f"I{m}{i}"): (0.5 * (1 + m), 0.25 * (m % 2)) for d in dates for m in range(6) for i in range(5)}
    wanted |= {(d, "salt"): (0.25 * 21, 0.5) for d in dates} | {(d, None): (1.0, 0.0) for d in dates}

    def largest_exchange(plan) -> int:
        """Most rows that an exchange below the last sums wrote."""
        most, ahead = 0, [plan]
        while ahead:
            node = ahead.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                node = node.executedPlan()
            if "Exchange" in node.nodeName() and "shuffleRecordsWritten" in node.metrics().toString():
                most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
            ahead += [node.plan()] if "QueryStage" in node.nodeName() else [node.children().apply(i) for i in range(node.children().size())]
        return most

    for each, busy in ((1000, False), (5, True)):  # salt has 120 rows, more than 16 tasks of 5; the others have 20
        used = derivations.ingredient_consumption(orders, lines, recipes, exploded_per_task=each)
        assert len(rows := used.collect()) == len(wanted)
        assert {(r.business_date, r.ingredient_id): (r.ingredient_quantity, r.estimated_wastage_pct) for r in rows} == wanted
        assert ("Union" in used._jdf.queryExecution().optimizedPlan().toString()) == busy
        assert 0 < largest_exchange(used._jdf.queryExecution().executedPlan()) <= len(bill) + (len(dates) * 6 if busy else 0)
    assert derivations.ingredient_consumption(orders, lines.limit(0), recipes).count() == 0


def test_tasks_follow_the_rows_and_settings_return(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(n) for n in names]
    with workdir.tasks_for(spark, 1000):
        assert [spark.conf.get(n) for n in names] == before
    with pytest.raises(ZeroDivisionError), workdir.tasks_for(spark, 100 * workdir.ROWS_PER_TASK + 1):
        assert [spark.conf.get(n) for n in names] == ["101", str(16 << 20), str(8 << 20)]
        raise ZeroDivisionError
    assert [spark.conf.get(n) for n in names] == before


@pytest.mark.parametrize("name", ["v11_declared_references", "v11_review_orders"])
def test_references_are_checked_in_tasks_cut_by_rows(spark, sf_dir, monkeypatch, name):
    from tallyhouse.plans import catalogue

    asked = []
    monkeypatch.setattr(catalogue, "tasks_for", lambda spark, rows: asked.append(rows) or workdir.tasks_for(spark, rows, 1000))
    sized = catalogue.QUERIES[name](spark, sf_dir)
    assert asked == [spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()]
    monkeypatch.undo()
    assert sorted(sized.collect()) == sorted(catalogue.QUERIES[name](spark, sf_dir).collect())


def test_report_counts_all_and_shows_five(table):
    rows = table([(f"O{i:02d}", i) for i in range(20)], "order_id string, x int")
    found = quality.report("t", quality.failures(rows, "order_id", {"big": "x >= 3", "none": "x < 0", "unknown": "null"}))
    assert [tuple(r) for r in found.collect()] == [("t", "big", 17, "O03, O04, O05, O06, O07")]


def test_empty_reviews_are_clean(table):
    empty = table([], "review_id string, order_id string, rating int, channel string")
    assert quality.check_reviews(empty, table([("A",)], "order_id string")).count() == 0


def test_seed_references(table):
    menu = table([("MI999",)], "menu_item_id string")
    ingredients = table([("I1", "S9")], "ingredient_id string, supplier_id string")
    suppliers = table([("S1",)], "supplier_id string")
    recipes = table([("MI001", "I7")], "menu_item_id string, ingredient_id string")
    errors = {r.error for r in quality.seed_reference_errors(menu, ingredients, suppliers, recipes).collect()}
    assert errors == {
        "ingredients: I1 references unknown supplier_id 'S9'",
        "recipes: unknown menu_item_id 'MI001'",
        "recipes: unknown ingredient_id 'I7' for menu item 'MI001'",
        "menu_items: MI999 has no recipe rows",
    }
    with pytest.raises(ValueError, match="referential-integrity check failed"):
        quality.require_seed_references(menu, ingredients, suppliers, recipes)


def test_load_adds_metadata_and_hashes_content_only(spark, tmp_path):
    path = tmp_path / "widgets.csv"
    path.write_text("widget_id,quantity\nW1,3\nW2,\n")
    rows = csv_tables.scan_csv(spark, str(path), spark.range(0).selectExpr("'' as widget_id", "0 as quantity").schema)
    first = csv_tables.with_load_metadata(rows, "b1", datetime(2026, 1, 1)).orderBy("widget_id").collect()
    second = csv_tables.with_load_metadata(rows, "b2", datetime(2026, 1, 2)).orderBy("widget_id").collect()
    assert [r.source_file for r in first] == ["widgets.csv"] * 2 and first[0].batch_id == "b1"
    assert [r.record_hash for r in first] == [r.record_hash for r in second]
    assert first[0].record_hash == hashlib.md5(b"W1|3").hexdigest()
    assert first[1].record_hash == hashlib.md5(b"W2|nan").hexdigest()


def test_missing_sources_are_all_listed_and_nothing_is_loaded(spark, tmp_path):
    present = tmp_path / "orders.csv"
    present.write_text("x\n")
    paths = {"orders": str(present), "reviews": str(tmp_path / "a.csv"), "recipes": str(tmp_path / "b.csv")}
    with pytest.raises(FileNotFoundError) as caught:
        csv_tables.load_raw_tables(spark, paths, str(tmp_path / "raw"))
    assert "a.csv" in str(caught.value) and "b.csv" in str(caught.value)
    assert not (tmp_path / "raw").exists()


def test_load_raw_tables_counts_rows(spark, tmp_path):
    path = tmp_path / "suppliers.csv"
    path.write_text(
        "supplier_id,supplier_name,supplier_category,average_lead_time_days,reliability_score,synthetic_estimate\n"
        "S1,Acme,Dry,2,0.9,true\nS2,Bolt,Dry,3,0.8,false\n"
    )
    assert csv_tables.load_raw_tables(spark, {"suppliers": str(path)}, str(tmp_path / "raw")) == {"suppliers": 2}
    stored = spark.read.parquet(str(tmp_path / "raw" / "suppliers"))
    assert set(csv_tables.METADATA) <= set(stored.columns) and stored.select("batch_id").distinct().count() == 1


def test_seed_scan_turns_blank_and_bad_cells_into_null(spark, tmp_path):
    (tmp_path / "recipes.csv").write_text(
        "menu_item_id,ingredient_id,quantity_required,unit,estimated_wastage_pct\nM1,I1, 0.5 ,each,\nM2,I2,lots,each,0.1\n"
    )
    seeds = csv_tables.load_seeds(spark, str(tmp_path), ("recipes",))["recipes"].orderBy("menu_item_id").collect()
    assert (seeds[0].quantity_required, seeds[0].estimated_wastage_pct, seeds[1].quantity_required) == (0.5, None, None)


def test_unknown_mart_is_refused(spark):
    with pytest.raises(ValueError, match="Unknown mart"):
        StoredWarehouse(spark, "/nowhere").load_mart("mart_secret")
    assert len(MARTS) == 7


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workdir.shared_folder(Session())


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans_drop_joins_and_columns_nobody_reads(spark, sf_dir):
    w = bindings.warehouse(spark, sf_dir)
    assert "lineitem" not in _plan(w.mart_channel_profitability)
    assert "lineitem" not in _plan(w.mart_service_quality)
    demand = _plan(w.int_hourly_demand)
    assert "o_totalprice" not in demand and "ReadSchema" in demand


def test_examples_are_cut_per_task_before_the_shuffle(spark, sf_dir):
    plan = _plan(quality.check_orders(bindings.warehouse(spark, sf_dir).stg_orders))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_running_balance_sorts_no_whole_ingredient(spark, sf_dir):
    plan = _plan(quality.running_balance(bindings.warehouse(spark, sf_dir).fact_inventory_movements))
    assert "Join" not in plan
    assert "hashpartitioning(ingredient_id" in plan and "_range" in plan


def test_stored_facts_skip_files_by_date(spark, sf_dir, tmp_path):
    w = bindings.warehouse(spark, sf_dir)
    rows = w.stg_orders.count()
    assert w.store(str(tmp_path), ("fact_orders",)) == {"fact_orders": rows}
    one_year = w.fact_orders.where("business_date >= date '1996-01-01' and business_date < date '1997-01-01'")
    assert "PushedFilters: [IsNotNull(business_date), GreaterThanOrEqual(business_date" in _plan(one_year)
    spans = w.fact_orders.groupBy(F.input_file_name()).agg(F.min("business_date").alias("a"), F.max("business_date").alias("b"))
    ordered = sorted((r.a, r.b) for r in spans.collect())
    assert all(before[1] <= after[0] for before, after in zip(ordered, ordered[1:], strict=False))


def test_a_busy_date_is_dealt_by_id_and_the_rows_are_made_once(table):
    rows = [(str(i), date(2026, 7, 1 + max(0, i - 900) // 10) if i % 50 else None) for i in range(1200)]
    frame = table(rows, "id string, d date")
    dealt = tables.laid_out(frame, "d", "id", each=100)
    parts = [p for p in dealt.rdd.glom().collect() if p]
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(rows, key=str)
    assert len(parts) >= 10 and max(map(len, parts)) <= 300
    assert all(p == sorted(p, key=lambda r: (r.d is not None, r.d or date.min, r.id)) for p in parts)
    plan = _plan(dealt)
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan


def test_all_checks_write_in_tasks_cut_by_rows(spark, sf_dir, monkeypatch):
    from tallyhouse.plans import catalogue

    asked = []
    monkeypatch.setattr(quality, "tasks_for", lambda spark, rows: asked.append(rows) or workdir.tasks_for(spark, rows, 1000))
    sized = catalogue.QUERIES["v8_all_checks"](spark, sf_dir).collect()
    assert asked == [spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()]
    monkeypatch.undo()
    assert sorted(sized) == sorted(catalogue.QUERIES["v8_all_checks"](spark, sf_dir).collect())


def test_schemas_cover_every_bound(spark):
    for name, bounds in schemas.FIELD_BOUNDS.items():
        ddl = schemas.RAW_SCHEMAS[name]
        assert all(f"{column} " in ddl for column, _, _ in bounds)


def test_changed_rows_count_repeats_and_null_keys(table):
    schema = "k string, record_hash string, x int"
    before = table([("a", "1", 0), ("a", "1", 0), ("b", "2", 0), ("c", "3", 0), (None, "4", 0), ("same", "9", 0)], schema)
    after = table([("a", "1", 1), ("b", "5", 1), ("d", "6", 1), ("d", "6", 1), (None, "7", 1), (None, "8", 1), ("same", "9", 1)], schema)
    rows = {r.k: (r.inserted_rows, r.changed_rows, r.gone_rows) for r in csv_tables.changed_rows(before, after, ["k"]).collect()}
    assert rows == {"a": (0, 0, 1), "b": (0, 1, 0), "c": (0, 0, 1), "d": (2, 0, 0), None: (1, 1, 0)}
    assert csv_tables.changed_rows(before, before, ["k"]).isEmpty() and csv_tables.changed_rows(before.limit(0), after.limit(0), ["k"]).isEmpty()


def test_pairs_of_names_are_distinct(table):
    recipes = table([("i1", "m1"), ("i1", "m1"), ("i1", "m2"), ("i1", "m3"), ("i2", "m9")], "ingredient_id string, menu_item_id string")
    items = table([("m1", "Tart"), ("m2", "Broth"), ("m3", "Tart")], "menu_item_id string, item_name string")
    assert sorted(map(tuple, marts.affected_pairs(recipes, items).collect())) == [("i1", "Broth"), ("i1", "Tart")]
    assert [tuple(r) for r in marts.affected_items(recipes, items).collect()] == [("i1", "Broth, Tart")]


def test_a_load_of_all_tables_leaves_no_source_files_and_packs_hashes(spark, sf_dir):
    """The sources that the query writes for itself go once loaded; 64 hexadecimal digits take little more than 32 bytes."""
    from pathlib import Path

    from tallyhouse.plans.catalogue import QUERIES

    shared = Path(workdir.shared_folder(spark).removeprefix("file:"), "tallyhouse")
    before = set(shared.glob("*"))
    assert QUERIES["s1_load_all"](spark, sf_dir).count() == len(schemas.RAW_SCHEMAS)
    added = set(shared.glob("*")) - before
    assert not [p for p in added if p.name.startswith("csv-")]
    (loaded,) = [p for p in added if p.name.startswith("raw-")]
    assert all(p.name.endswith(".zstd.parquet") for p in loaded.glob("*/part-*"))


def test_a_load_of_all_tables_drops_each_source_once_loaded(spark, sf_dir, monkeypatch):
    """The disk held all sources beside all tables, and then the hashes of all tables in one shuffle."""
    from pathlib import Path

    from tallyhouse.plans.catalogue import QUERIES

    shared = Path(workdir.shared_folder(spark).removeprefix("file:"), "tallyhouse")
    there_before, sources, write = set(shared.glob("csv-*")), [], csv_tables.replace_table

    def counted(rows, path):
        sources.append(len(set(shared.glob("csv-*")) - there_before))
        return write(rows, path)

    monkeypatch.setattr(csv_tables, "replace_table", counted)
    counts = {r.table_name: (r["rows"], r.hashes, r.batches) for r in QUERIES["s1_load_all"](spark, sf_dir).collect()}
    assert sources == list(range(len(schemas.RAW_SCHEMAS), 0, -1))
    assert counts["order_items"][2] == 1 and counts["order_items"][0] >= counts["order_items"][1] > 0


def test_shuffle_files_go_when_an_eager_write_ends(spark):
    from pathlib import Path

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [Path(f.getPath()) for f in env.blockManager().diskBlockManager().localDirs()]

    def files():
        return {f.name for d in folders for f in d.glob("*/shuffle_*")}

    rows = spark.range(1000).groupBy(F.expr("id % 7").alias("k")).agg(F.count("*").alias("n"))
    before = files()
    with workdir.shuffles_dropped(spark):
        assert workdir.settle(rows.withColumn("most", rows.agg(F.max("n")).scalar()), "dropped").count() == 7
    assert not files() - before
    assert spark.conf.get(workdir.CLEANUP_SETTING) == "false"
