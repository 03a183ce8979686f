"""Cases of the live feed that statements do not reach: rounding, repeated ids, missing feeds, no feed column."""

from datetime import datetime, timedelta

import pytest

from tallyhouse.functions import two_digits
from tallyhouse.operators import history
from tallyhouse.streaming.board import LiveBoard
from tallyhouse.streaming.source import finish

EVENT = "event_id string, timestamp timestamp, channel string, daypart string, item_count int, subtotal double, status string"
START = datetime(2024, 5, 1, 12)


def event(i, minute, subtotal=10.0, items=1, channel="pickup"):
    return (i, START + timedelta(minutes=minute), channel, "lunch", items, subtotal, "placed")


def arrive(board, frame):
    """Events arrive as a further file of the board's stream, which runs until it has taken them."""
    folder = f"{board.folder}-in"
    frame.coalesce(1).write.mode("append").parquet(folder)
    finish(board.start(board.spark.readStream.schema(frame.schema).parquet(folder)))


@pytest.mark.parametrize("value", [0.125, 10.125, 1.115, 2.675, 0.375, 0.005, 0.015, 7.995, 0.0, 123456.785])
def test_two_digits_as_python(spark, value):
    assert spark.range(1).selectExpr(f"{two_digits(repr(value) + 'D')} as v").first().v == round(value, 2)


def test_events_that_share_an_id_are_two(table):
    rows = table([event("a", 0), event("a", 5), event("a", 5), event("b", 6)], EVENT)
    got = sorted((r.event_id, r.timestamp, r.order_count) for r in history.rolling_kpis(rows, 10).collect())
    assert [x[2] for x in got if x[0] == "b"] == [4] and sorted(x[2] for x in got if x[0] == "a") == [1, 2, 3]


def test_a_missing_feed_is_a_feed(spark, table, tmp_path):
    rows = [(*event("a", 0), None), (*event("b", 1), None), (*event("c", 1), "x")]
    events = table(rows, EVENT + ", site string")
    board = LiveBoard(spark, str(tmp_path / "board"))
    arrive(board, events)
    got = sorted((r.event_id, r.site, r.order_count) for r in board.kpis().collect())
    assert got == [("a", None, 1), ("b", None, 2), ("c", "x", 1)]
    assert board.messages().count() == 3 and board.latest().count() == 2


def test_a_board_without_feeds(spark, table, tmp_path):
    board = LiveBoard(spark, str(tmp_path / "board"), feed=(), history=2)
    arrive(board, table([event("a", 0), event("b", 1)], EVENT))
    arrive(board, table([event("c", 2), event("c", 2, 0.125, 3)], EVENT))
    assert sorted(r.order_count for r in board.kpis().collect()) == [1, 2, 3, 4]
    assert {r.event_id for r in board.recent_history().collect()} == {"c"}
    assert board.latest().first().order_count in (3, 4) and board.open_window().count() == 4


def test_lateness_counts_from_the_batch_before(spark, table, tmp_path):
    """Two events two hours apart: on time in one batch, the older one late in a batch of its own."""
    one, two = LiveBoard(spark, str(tmp_path / "one"), feed=()), LiveBoard(spark, str(tmp_path / "two"), feed=())
    old, new = [event("old", 0)], [event("new", 120)]
    arrive(one, table(new + old, EVENT))
    assert one.kpis().count() == 2
    arrive(two, table(new, EVENT))
    arrive(two, table(old, EVENT))
    assert two.kpis().count() == 1 and spark.read.parquet(str(tmp_path / "two" / "late")).count() == 1
