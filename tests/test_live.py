"""The live feed: windows, caps, summaries and buckets in batch, and the streams against them."""

import json
from datetime import datetime, timedelta

import pytest

from tallyhouse.operators import history
from tallyhouse.schemas import EVENT_SCHEMA
from tallyhouse.streaming.board import SHARES, LiveBoard, summary_message
from tallyhouse.streaming.source import event_stream, finish, split_by_contract
from tallyhouse.streaming.versions import VersionedTable

BASE = datetime(2026, 1, 5, 12, 0)
SCHEMA = f"site string, {EVENT_SCHEMA}"


def event(i, minutes=0.0, seconds=0, channel="dine_in", subtotal=10.0, site="s", items=2):
    return (site, f"e{i:03d}", BASE + timedelta(minutes=minutes, seconds=seconds), channel, "lunch", items, subtotal, "placed")


@pytest.fixture
def feed(table):
    return lambda *rows: table(list(rows), SCHEMA)


def at(minutes):
    return f"timestamp '{BASE + timedelta(minutes=minutes)}'"


def test_window_is_closed_and_evicts(feed):
    events = feed(event(1, subtotal=10.0), event(2, 10, subtotal=20.0))
    now = history.snapshot(events, 10, at(10)).first()
    assert (now.order_count, now.total_revenue) == (2, 30.0)
    later = history.snapshot(events, 10, at(16)).first()
    assert (later.order_count, later.total_revenue) == (1, 20.0)
    empty = history.snapshot(events, 10, at(60)).first()
    assert (empty.order_count, empty.average_items_per_order, empty.orders_by_channel) == (0, 0.0, {})


def test_counts_by_channel(feed):
    events = feed(event(1), event(2, 1), event(3, 2, channel="pickup"))
    assert history.snapshot(events, 60, at(3)).first().orders_by_channel == {"dine_in": 2, "pickup": 1}


def test_rolling_kpis_equal_arrival_by_arrival(feed):
    """Ties in time, a window edge met exactly, and two feeds, against a plain loop."""
    steps = [0, 0, 1, 7.5, 10, 10, 10, 17.5, 40, 50.001]
    rows = [event(i, m, channel="pickup" if i % 3 else "dine_in", subtotal=i + 0.25, site="ab"[i % 2], items=i + 1) for i, m in enumerate(steps)]
    got = {r.event_id: r for r in history.rolling_kpis(feed(*rows), 10, ["site"]).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        window = [e for e in rows[: i + 1] if e[0] == row[0] and e[2] >= row[2] - timedelta(minutes=10)]
        kpi = got[row[1]]
        assert kpi.order_count == len(window) and kpi.total_revenue == pytest.approx(sum(e[6] for e in window))
        assert kpi.average_items_per_order == pytest.approx(sum(e[5] for e in window) / len(window), abs=0.005)
        assert sum(kpi.orders_by_channel.values()) == len(window)


def test_recent_and_history_caps(feed):
    events = feed(*[event(i, i) for i in range(5)])
    assert [r.event_id for r in history.recent_events(events, 2, 60).collect()] == ["e004", "e003"]
    assert {r.event_id for r in history.latest_events(events, 3).collect()} == {"e002", "e003", "e004"}


def test_session_summary(feed):
    events = feed(event(1, 0, subtotal=10.0), event(2, 1, subtotal=20.0), event(3, 2, channel="pickup", subtotal=15.0))
    row = history.session_summary(events, at(0)).first()
    assert (row.total_orders, row.total_revenue, row.busiest_channel) == (3, 45.0, "dine_in")
    assert row.orders_by_channel == {"dine_in": 2, "pickup": 1} and row.session_duration_minutes == 2.0
    burst = history.session_summary(feed(event(1), event(2, seconds=30), event(3, 1)), at(0)).first()
    assert burst.peak_orders_per_minute == 2
    tie = history.session_summary(feed(event(1, channel="pickup"), event(2, 1)), at(0)).first()
    assert tie.busiest_channel == "pickup"


def test_session_summary_of_nothing(feed):
    row = history.session_summary(feed(), at(0)).first()
    assert (row.total_orders, row.total_revenue, row.busiest_channel) == (0, 0.0, None)
    assert (row.orders_by_channel, row.peak_orders_per_minute, row.session_duration_minutes) == ({}, 0, 0.0)


def test_minute_buckets(feed):
    rows = history.minute_buckets(feed(event(1, seconds=10), event(2, seconds=40), event(3, 1, 5))).collect()
    assert [(r.minute, r["count"]) for r in rows] == [(BASE, 2), (BASE + timedelta(minutes=1), 1)]
    anchored = history.minute_buckets(feed(event(1, 0), event(2, 20), event(3, 29))).collect()
    assert [r.minute.minute for r in anchored] == [20, 29]


def test_history_table(feed):
    events = feed(event(1, 0, subtotal=40.0), event(2, 5, channel="uber_eats", subtotal=10.0), event(3, 2, subtotal=20.0))

    def ids(**how):
        return [r.event_id for r in history.history_table(events, **how).collect()]

    assert ids() == ["e002", "e003", "e001"]
    assert ids(channel="dine_in") == ["e003", "e001"]
    assert ids(sort_column="subtotal", descending=False) == ["e002", "e003", "e001"]
    with pytest.raises(ValueError):
        ids(sort_column="site")


def test_contract(feed):
    events = feed(event(1), event(2, channel="fax"), event(3, items=0, subtotal=0.0)).selectExpr("* except (status)", "string(null) as status")
    assert [(r.event_id, r.status) for r in history.valid_events(events).collect()] == [("e001", "placed")]
    assert {r.event_id: r.violations for r in history.rejected_events(events).collect()} == {"e002": "channel", "e003": "item_count,subtotal"}


def test_contract_split_of_a_json_stream(spark, feed, tmp_path):
    feed(event(1), event(2, channel="fax")).drop("site").write.json(str(tmp_path / "in"))
    stream = event_stream(spark, str(tmp_path / "in"), file_format="json")
    finish(*split_by_contract(stream, str(tmp_path / "out")))
    assert spark.read.parquet(str(tmp_path / "out" / "valid")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).first().violations == "channel"


def test_board_over_batches_equals_the_batch_form(spark, feed, tmp_path):
    rows = [event(i, i * 1.5, channel="pickup" if i % 4 else "dine_in", subtotal=1.5 * i + 1, site="ab"[i % 3 == 0]) for i in range(40)]
    board = LiveBoard(spark, str(tmp_path / "board"), minutes=15, history=7, lateness_minutes=5)
    late = event(99, 20, site="a")
    for part in (rows[:15], rows[15:16], rows[16:33], [late], rows[33:]):
        feed(*part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        finish(board.start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))))
    wanted = {r.event_id: r for r in history.rolling_kpis(feed(*rows), 15, ["site"]).collect()}
    got = {r.event_id: r for r in board.kpis().collect()}
    assert set(got) == set(wanted)
    for key, row in wanted.items():
        assert (got[key].order_count, got[key].total_revenue, got[key].orders_by_channel) == (
            row.order_count, row.total_revenue, row.orders_by_channel
        )
    assert spark.read.parquet(f"{board.folder}/late").first().event_id == "e099"
    kept = history.latest_per_feed(feed(*rows), ["site"], 7)
    assert {r.event_id for r in board.recent_history().collect()} == {r.event_id for r in kept.collect()}
    newest = {r.site: r.event_id for r in board.latest().collect()}
    assert newest == {"a": "e038", "b": "e039"}
    message = json.loads(board.messages().where("value like '%e038%'").first().value)
    assert message["type"] == "order" and message["summary"]["order_count"] == wanted["e038"].order_count
    assert json.loads(summary_message(board.latest()).first().value)["type"] == "summary"


def follow(board, spark, folder, ticks=None):
    clock = None if ticks is None else spark.readStream.schema("timestamp timestamp").parquet(ticks)
    finish(board.start(spark.readStream.schema(SCHEMA).parquet(folder), clock))


def test_a_batch_run_again_changes_nothing(spark, feed, table, tmp_path):
    board, arrivals = LiveBoard(spark, str(tmp_path / "board"), minutes=15), str(tmp_path / "in")
    for rows in ([event(1), event(2, 3)], [event(3, 5), event(3, 5)]):
        feed(*rows).coalesce(1).write.mode("append").parquet(arrivals)
        follow(board, spark, arrivals)
    answers = spark.read.parquet(f"{board.folder}/answers/batch=1")
    board.update(table(answers.collect(), answers.schema), 1)
    assert board.kpis().count() == 4
    assert board.latest().first().order_count == 4


def test_a_hot_feed_is_dealt_to_several_states(spark, feed, tmp_path):
    """One feed only: its events lie in several sub-states, none of which holds all."""
    board, arrivals = LiveBoard(spark, str(tmp_path / "board"), minutes=15), str(tmp_path / "in")
    feed(*[event(i, seconds=i) for i in range(200)]).write.parquet(arrivals)
    follow(board, spark, arrivals)
    kept = board._state("window").selectExpr("key.share").groupBy("share").count().collect()
    assert sum(r["count"] for r in kept) == 200 and len(kept) == SHARES and max(r["count"] for r in kept) < 100
    assert not (tmp_path / "board" / "state").exists()


def test_an_idle_window_empties_when_the_clock_passes(spark, feed, table, tmp_path):
    """Feed a goes quiet; events of feed b, then a tick, move the clock."""
    arrivals, ticks = str(tmp_path / "in"), str(tmp_path / "ticks")
    board = LiveBoard(spark, str(tmp_path / "board"), minutes=15, lateness_minutes=5, timers=True)
    table([], "timestamp timestamp").write.parquet(ticks)
    feed(event(1, site="a"), event(2, 4, site="a"), event(3, 2, site="b")).coalesce(1).write.parquet(arrivals)
    follow(board, spark, arrivals, ticks)
    assert {r.site: r.order_count for r in board.latest().collect()} == {"a": 2, "b": 1}
    feed(event(4, 30, site="b")).coalesce(1).write.mode("append").parquet(arrivals)
    follow(board, spark, arrivals, ticks)
    rows = {r.site: r for r in board.latest().collect()}
    assert (rows["a"].order_count, rows["a"].total_revenue, rows["a"].orders_by_channel) == (0, 0.0, {})
    assert rows["a"].timestamp == BASE + timedelta(minutes=19) and rows["b"].order_count == 1
    table([(BASE + timedelta(minutes=90),)], "timestamp timestamp").coalesce(1).write.mode("append").parquet(ticks)
    follow(board, spark, arrivals, ticks)
    assert {r.site: r.order_count for r in board.latest().collect()} == {"a": 0, "b": 0}
    assert board.kpis().count() == 4


def test_a_reader_sees_whole_versions(spark, table, tmp_path):
    """A frame opened before a write, and the pointer until it is replaced, give the version before."""
    kept = VersionedTable(spark, str(tmp_path / "latest"))
    assert kept.read(below=0) is None
    with pytest.raises(ValueError):
        kept.read()
    kept.write(table([(1, 10), (2, 10)], "k int, v int"), 0)
    opened = kept.read()
    # a batch that breaks off has written files and not moved the pointer
    table([(1, 99)], "k int, v int").write.parquet(str(tmp_path / "latest" / "version=1"))
    assert sorted(map(tuple, kept.read().collect())) == [(1, 10), (2, 10)]
    kept.write(table([(1, 11), (2, 11)], "k int, v int"), 1)
    assert sorted(map(tuple, opened.collect())) == [(1, 10), (2, 10)]
    assert sorted(map(tuple, kept.read().collect())) == [(1, 11), (2, 11)]
    assert sorted(map(tuple, kept.read(below=1).collect())) == [(1, 10), (2, 10)]
    kept.write(table([(3, 12)], "k int, v int"), 2)
    assert not (tmp_path / "latest" / "version=0").exists() and (tmp_path / "latest" / "version=1").exists()


def test_a_batch_of_the_stream_holds_a_slice_of_the_events(spark, sf_dir, monkeypatch):
    """Three slices of the 1,000 events, in order of time, give the rows that the statement gives."""
    from pathlib import Path

    from compare import differences, duck

    import __spark_entry__ as entry
    from tallyhouse.plans import catalogue
    from tallyhouse.sources import workdir

    monkeypatch.setattr(catalogue, "SLICE_EVENTS", 400)
    shared = Path(workdir.shared_folder(spark).removeprefix("file:"), "tallyhouse")
    name, before = "r2_stream_idle", set(shared.glob("board-*"))
    assert differences(catalogue.QUERIES[name](spark, sf_dir), duck(sf_dir), entry.oracle_sql()[name]) is None
    (board,) = set(shared.glob("board-*")) - before
    sizes = [spark.read.parquet(str(p)).where("kind = 'order'").select("uid").distinct().count() for p in board.glob("answers/batch=*")]
    assert len([n for n in sizes if n]) == 3 and max(sizes) < 700
