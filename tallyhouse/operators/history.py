"""Live-feed questions answered in batch: W7, R1-R8, R10, O4, O5.

Rows are order events (see ``schemas.EVENT_SCHEMA``).  Events count as arriving in the order of
their timestamp, then their id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate, divided, minutes_between, not_in, select, two_digits
from tallyhouse.operators.ordering import running_totals, top_rows
from tallyhouse.schemas import CHANNELS, DAYPARTS, EVENT_STATUSES

WINDOW_MINUTES = 15
RECENT_LIMIT = 20
FEED_LIMIT = 30
HISTORY_LIMIT = 500
NEWEST_FIRST = "timestamp desc, event_id desc"

# --- R10: contract ---------------------------------------------------------------------------

# The condition under which an event breaks the contract, per field.
CONTRACT = {
    "event_id": "event_id is null",
    "timestamp": "timestamp is null",
    "channel": not_in("channel", CHANNELS),
    "daypart": not_in("daypart", DAYPARTS),
    "item_count": "not coalesce(item_count > 0, false)",
    "subtotal": "not coalesce(subtotal > 0, false)",
    "status": not_in("status", EVENT_STATUSES),
}
BROKEN_FIELDS = f"concat_ws(',', {', '.join(f"if({broken}, '{name}', null)" for name, broken in CONTRACT.items())})"


def with_defaults(events: DataFrame) -> DataFrame:
    """A missing status means the order was placed."""
    return events.withColumn("status", F.expr("coalesce(status, 'placed')"))


def valid_events(events: DataFrame) -> DataFrame:
    """Events that keep the contract.  Works on batches and streams."""
    return with_defaults(events).where(" and ".join(f"not ({broken})" for broken in CONTRACT.values()))


def rejected_events(events: DataFrame) -> DataFrame:
    """R10 side output: events that break the contract, with the fields at fault."""
    return with_defaults(events).selectExpr("*", f"{BROKEN_FIELDS} as violations").where("violations <> ''")


# --- R1, R2, R3, W7: the trailing window -----------------------------------------------------

REVENUE = "cast(subtotal as decimal(18,6))"


def summary_columns(minutes: float) -> list[str]:
    """The KPI columns from ``_n``, ``_revenue``, ``_items`` and one ``_n_<channel>`` per channel."""
    entries = ", ".join(f"struct('{c}' as key, bigint(_n_{c}) as value)" for c in CHANNELS)
    return [
        f"{float(minutes)}D as window_minutes",
        "bigint(_n) as order_count",
        f"{two_digits('double(_revenue)')} as total_revenue",
        f"{two_digits(f'coalesce({divided("_items", "_n")}, 0D)')} as average_items_per_order",
        f"map_from_entries(filter(array({entries}), e -> e.value > 0)) as orders_by_channel",
    ]


def rolling_kpis(
    events: DataFrame, minutes: float = WINDOW_MINUTES, feed: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """For every event, the KPIs of the window that ends with it, closed at both ends.

    One feed may hold the whole table, so no feed, and no window of one, is sorted in a task.
    Every event asks for two running totals: up to and including itself, and up to just before
    its window opens.  The second is asked by a probe row placed at the opening instant, ahead of
    the events there.  Events and probes share one running total, sliced by hour and second; the
    window is the difference.  An event and its probe carry one row number, so events that share an
    id stay apart and a missing feed is a feed of its own.  ``keep`` names further columns to return.
    """
    feed, keep = list(feed), [c for c in keep if c not in ("event_id", "timestamp", *feed)]
    measures = {
        "_n": "1L",
        "_revenue": REVENUE,
        "_items": "bigint(item_count)",
        **{f"_n_{c}": f"bigint(channel = '{c}')" for c in CHANNELS},
    }
    opening = f"timestamp - make_dt_interval(0, 0, 0, {minutes * 60})"
    numbered = events.selectExpr("*", "monotonically_increasing_id() as _row")
    points = numbered.selectExpr(
        *feed, *keep, "event_id", "_row", *[f"{v} as {m}" for m, v in measures.items()],
        f"explode(array(struct(timestamp as at, 1 as kind), struct({opening} as at, 0 as kind))) as _p",
    )
    points = points.selectExpr(
        *feed, *[f"if(_p.kind = 1, {c}, null) as {c}" for c in keep], "event_id", "_row", "_p.at as _at", "_p.kind as _kind",
        *[f"{m} * _p.kind as {m}" for m in measures], "date_trunc('hour', _p.at) as _hour", "date_trunc('second', _p.at) as _second",
    )
    totals = {f"t{m}": m for m in measures}
    sums = running_totals(points, feed, ["_hour", "_second"], "_at, _kind, event_id, _row", totals)
    paired = aggregate(
        sums,
        [*feed, "event_id", "_row"],
        "max(_at) as timestamp",
        *[f"max_by({c}, _kind) as {c}" for c in keep],
        *[f"max(t{m}) filter (where _kind = 1) - max(t{m}) filter (where _kind = 0) as {m}" for m in measures],
    )
    return paired.selectExpr(*feed, "event_id", "timestamp", *keep, *summary_columns(minutes))


def in_window(events: DataFrame, minutes: float = WINDOW_MINUTES, as_of: str | None = None) -> DataFrame:
    """Events of the window that ends at the SQL instant ``as_of``, or at the last event."""
    end = F.expr(as_of) if as_of is not None else events.agg(F.max("timestamp")).scalar()
    return events.where(F.col("timestamp") >= end - F.expr(f"make_dt_interval(0, 0, 0, {minutes * 60})"))


def snapshot(events: DataFrame, minutes: float = WINDOW_MINUTES, as_of: str | None = None) -> DataFrame:
    """R2: the KPIs of one window; zeros and an empty map when it holds nothing."""
    totals = aggregate(
        in_window(events, minutes, as_of),
        [],
        "count(*) as _n",
        f"coalesce(sum({REVENUE}), 0) as _revenue",
        "coalesce(sum(item_count), 0) as _items",
        *[f"count_if(channel = '{c}') as _n_{c}" for c in CHANNELS],
    )
    return totals.selectExpr(*summary_columns(minutes))


def recent_events(
    events: DataFrame, limit: int = RECENT_LIMIT, minutes: float = WINDOW_MINUTES, as_of: str | None = None
) -> DataFrame:
    """The last events of the window."""
    return top_rows(in_window(events, minutes, as_of), NEWEST_FIRST, limit)


def latest_events(events: DataFrame, limit: int) -> DataFrame:
    """The last events of the feed, whatever their age."""
    return top_rows(events, NEWEST_FIRST, limit)


def latest_per_feed(events: DataFrame, feed: Sequence[str], limit: int) -> DataFrame:
    """R4 per feed; ``row_number() <= limit`` is cut per task before the shuffle.  Without feeds all events are one."""
    if not feed:
        return latest_events(events, limit)
    ranked = events.selectExpr(
        "*", f"row_number() over (partition by {', '.join(feed)} order by {NEWEST_FIRST}) as _n"
    )
    return ranked.where(f"_n <= {limit}").drop("_n")


# --- R5: session summary ---------------------------------------------------------------------


def session_summary(events: DataFrame, session_start: str) -> DataFrame:
    """Totals, channel counts, busiest channel and minute, and duration, as one row.

    Pass the last ``HISTORY_LIMIT`` events for the capped form, all events for the whole session;
    ``session_start`` is a SQL instant.  Channels tie by who came first.  Each part is an
    aggregate of a map-side-combined grouping; none needs the events in one place.
    """
    minutes = aggregate(events.selectExpr("date_trunc('minute', timestamp) as minute"), ["minute"], "count(*) as count")
    return summarise_session(totals_by_channel(events), minutes, session_start)


def totals_by_channel(events: DataFrame) -> DataFrame:
    """Totals per channel.  Works on batches and streams."""
    return aggregate(
        events,
        ["channel"],
        "count(*) as order_count",
        f"sum({REVENUE}) as revenue",
        "min(timestamp) as first_order",
        "max(timestamp) as last_order",
    )


def summarise_session(by_channel: DataFrame, minutes: DataFrame, session_start: str) -> DataFrame:
    """R5 from totals per channel and counts per minute, however they were kept."""
    totals = aggregate(
        by_channel,
        [],
        "coalesce(sum(order_count), 0) as total_orders",
        f"{two_digits('double(coalesce(sum(revenue), 0))')} as total_revenue",
        "max_by(channel, struct(order_count, -unix_micros(first_order))) as busiest_channel",
        "map_from_entries(array_sort(collect_list(struct(channel, order_count)))) as orders_by_channel",
        "max(last_order) as _last",
    )
    lasted = minutes_between(session_start, f"coalesce(_last, {session_start})")
    return totals.withColumn("_peak", minutes.agg(F.max("count")).scalar()).selectExpr(
        f"{session_start} as session_start",
        f"{two_digits(f'greatest({lasted}, 0D)')} as session_duration_minutes",
        "total_orders",
        "total_revenue",
        "busiest_channel",
        "orders_by_channel",
        "coalesce(_peak, 0) as peak_orders_per_minute",
    )


# --- R6-R8 -----------------------------------------------------------------------------------


def minute_buckets(events: DataFrame, minutes: float = WINDOW_MINUTES) -> DataFrame:
    """Orders per minute over the window before the latest event; empty minutes are absent."""
    timed = in_window(events, minutes).selectExpr("date_trunc('minute', timestamp) as minute")
    return aggregate(timed, ["minute"], "count(*) as count").orderBy("minute")


def channel_breakdown(events: DataFrame) -> DataFrame:
    """Orders and percent of all orders per channel, largest first."""
    counts = aggregate(events, ["channel"], "count(*) as order_count")
    shares = counts.withColumn("_all", counts.agg(F.sum("order_count")).scalar())
    return select(
        shares, "channel, order_count", f"coalesce({divided('order_count', '_all')}, 0D) * 100 as pct"
    ).orderBy(F.desc("order_count"), "channel")


SORTABLE = ("timestamp", "channel", "daypart", "item_count", "subtotal")


def history_table(
    events: DataFrame, channel: str | None = None, sort_column: str = "timestamp", descending: bool = True
) -> DataFrame:
    """Events of one channel or all, sorted by a column; descending turns ties round too."""
    if sort_column not in SORTABLE:
        raise ValueError(f"cannot sort by {sort_column}")
    rows = events if channel is None else events.where(F.col("channel") == channel)
    order = [F.col(c) for c in dict.fromkeys([sort_column, "timestamp", "event_id"])]
    return rows.orderBy(*[c.desc() if descending else c.asc() for c in order])
