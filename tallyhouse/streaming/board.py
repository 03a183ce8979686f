"""The live board, rolling KPIs per event from Spark's keyed state.

A feed may carry most events, so it is dealt to ``SHARES`` sub-states by the event's hash.  Every event goes to all of them:
to its own to be kept, to the others to be answered.  Each answers with the sums of the events it keeps in the window that
ends with the asked one, and the answers are added per event.  Spark holds the sub-states (list state in RocksDB, versioned
with the query's checkpoint); a batch that is run again starts from the same version and overwrites its own folders.

Under ``folder``, per batch:

- ``answers/batch=n``   what the sub-states say, written once and read by the steps below
- ``kpis/batch=n``      R1: one row of KPIs per event
- ``messages/batch=n``  S10: the same as JSON lines ``{type, event, summary}``
- ``late/batch=n``      events older than the lateness allowed, not rolled up: an event is measured against the latest of its
  feed in the batches before, so nothing is late in the first one
- ``latest``            R9: the newest summary of each feed, a ``VersionedTable``

R3 and R4, the events of the open window and the last events of each feed, are read from the state itself.  With ``timers``
a feed's window also empties when the clock passes its last event by the window's length (R2): the clock is the watermark,
moved by the events of all feeds and by ``ticks``, rows with a time alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tallyhouse.functions import aggregate
from tallyhouse.operators.history import HISTORY_LIMIT, REVENUE, WINDOW_MINUTES, latest_per_feed, summary_columns, valid_events
from tallyhouse.schemas import CHANNELS
from tallyhouse.streaming.source import let_workers_import
from tallyhouse.streaming.versions import VersionedTable

SUMMARY = "window_minutes, order_count, total_revenue, average_items_per_order, orders_by_channel"
EVENT_FIELDS = "event_id, timestamp, channel, daypart, item_count, subtotal, status"
#: Sub-states of a feed.
SHARES = 4
#: What a sub-state keeps of an event, and the sums it answers with.
KEPT = "at long, event_id string, channel string, daypart string, item_count int, subtotal double, status string, revenue long"
SUMS = ["n", "revenue", "items", *[f"n_{c}" for c in CHANNELS]]
PROVIDER = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def order_message(events: DataFrame) -> DataFrame:
    """One JSON message per event with its KPIs: its type, the event and the summary at that event."""
    return events.selectExpr(
        f"to_json(struct('order' as type, struct({EVENT_FIELDS}) as event, struct({SUMMARY}) as summary)) as value"
    )


def summary_message(latest: DataFrame) -> DataFrame:
    """What a new subscriber gets first, the current summary of each feed."""
    return latest.selectExpr(f"to_json(struct('summary' as type, struct({SUMMARY}) as summary)) as value")


class FeedWindow(StatefulProcessor):
    """One sub-state of a feed: the events of its window and the last ones, and the feed's latest time."""

    def __init__(self, feed: list[str], minutes: float, lateness_minutes: float, history: int, timers: bool):
        self.feed, self.history, self.timers = feed, history, timers
        self.reach, self.lateness = round(minutes * 60e6), round(lateness_minutes * 60e6)
        self.columns = [f.split()[0] for f in KEPT.split(", ")]

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getListState("window", KEPT)
        self.last = handle.getListState("last", KEPT)
        self.latest = handle.getValueState("latest", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [part[part["event_id"].notna()] for part in rows]  # ticks only move the clock
        asked = self._together(parts, [*self.columns, "uid", "own"])
        if asked.empty:
            return
        before = self.latest.get()[0] if self.latest.exists() else None
        late = asked["at"] < before - self.lateness if before is not None else pd.Series(False, index=asked.index)
        if (late & asked["own"]).any():
            yield self._out(key, asked[late & asked["own"]], "late")
        asked = asked[~late]
        if asked.empty:
            return
        # an event kept from an earlier batch has no uid and is ahead of new ones of its time and id
        rolled = self._in_order(self._together([self._held(self.window).assign(own=True), asked], [*self.columns, "uid", "own"]))
        new = (rolled["uid"] != "").to_numpy()
        asked, mine = rolled[new], rolled[rolled["own"].to_numpy()]
        yield self._out(key, asked, "order", self._sums(rolled, new, mine))
        newest = max(int(asked["at"].iloc[-1]), before if before is not None else -(1 << 62))
        self.latest.update((newest,))
        fresh = asked[asked["own"]]
        if len(fresh):
            last = self._together([self._held(self.last), fresh.tail(self.history)], [*self.columns, "uid"])
            self.last.put(self._rows(self._in_order(last)[self.columns].tail(self.history)))
        # what a later event, late ones within the lateness too, may still reach
        open_ = mine[mine["at"] >= newest - self.reach - self.lateness]
        if len(open_):
            self.window.put(self._rows(open_[self.columns]))
        else:
            self.window.clear()
        if self.timers:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer((newest + self.reach) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The clock has passed the window of the feed's last event: nothing is in it any more."""
        at = self.latest.get()[0]
        self.window.clear()
        row = pd.DataFrame([{**dict.fromkeys(self.columns), "at": at + self.reach, "uid": "", "own": True, **dict.fromkeys(SUMS, 0)}])
        yield self._out(key, row, "idle", row[SUMS])

    def close(self) -> None:
        pass

    def _held(self, state) -> pd.DataFrame:
        return pd.DataFrame(list(state.get()), columns=self.columns).assign(uid="")

    @staticmethod
    def _together(parts: list[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
        """Rows of several frames, with whole numbers as such whatever nulls the frames were read with."""
        rows = pd.DataFrame({c: np.concatenate([p[c].to_numpy(object) for p in parts]) for c in columns})
        for c in ("item_count", "revenue"):  # null where a sub-state is only asked
            if c in columns:
                rows[c] = rows[c].where(rows[c].notna(), 0)
        return rows.astype({c: k for c, k in (("at", "int64"), ("item_count", "int64"), ("revenue", "int64"), ("own", "bool")) if c in columns})

    def _rows(self, frame: pd.DataFrame) -> list[tuple]:
        return [tuple(v.item() if isinstance(v, np.generic) else v for v in row) for row in frame.itertuples(index=False, name=None)]

    @staticmethod
    def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows by time, id and uid; Arrow compares the strings, which as Python objects take most of a batch's time."""
        keys = pa.table({c: pa.array(rows[c].to_numpy(), pa.int64() if c == "at" else pa.string()) for c in ("at", "event_id", "uid")})
        return rows.iloc[pc.sort_indices(keys, [(c, "ascending") for c in keys.column_names]).to_numpy()]

    def _sums(self, rolled: pd.DataFrame, new: np.ndarray, mine: pd.DataFrame) -> pd.DataFrame:
        """Of each new event the sums of the own events from the window's opening up to itself, in order of time and id."""
        upto = np.cumsum(rolled["own"].to_numpy())[new]
        opening = np.searchsorted(mine["at"].to_numpy(), rolled["at"].to_numpy()[new] - self.reach, "left")
        values = {"n": np.ones(len(mine), np.int64), "revenue": mine["revenue"].to_numpy(np.int64), "items": mine["item_count"].to_numpy(np.int64)}
        values |= {f"n_{c}": (mine["channel"] == c).to_numpy(np.int64) for c in CHANNELS}
        total = {k: np.concatenate([[0], np.cumsum(v)]) for k, v in values.items()}
        return pd.DataFrame({k: total[k][upto] - total[k][np.minimum(opening, upto)] for k in SUMS})

    def _out(self, key, events: pd.DataFrame, kind: str, sums: pd.DataFrame | None = None) -> pd.DataFrame:
        out = pd.DataFrame({"kind": kind, "uid": events["uid"]})
        for name, value in zip(self.feed, key, strict=False):
            out[name] = value
        for name in self.columns:
            out[name] = events[name].where(events["own"]) if kind == "order" and name not in ("at", "event_id") else events[name]
        out["item_count"] = out["item_count"].astype("Int32")
        out["revenue"] = out["revenue"].astype("Int64")
        for name in SUMS:
            out[f"_{name}"] = sums[name].to_numpy() if sums is not None else 0
        return out


class LiveBoard:
    """Rolling KPIs, recent history and the latest summary of every feed of an event stream."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        feed: Sequence[str] = ("site",),
        minutes: float = WINDOW_MINUTES,
        history: int = HISTORY_LIMIT,
        lateness_minutes: float = 10,
        timers: bool = False,
    ):
        self.spark = spark
        self.folder = folder
        self.feed = list(feed)
        self.minutes = minutes
        self.history = history
        self.lateness_minutes = lateness_minutes
        self.timers = timers
        self.versions = VersionedTable(spark, f"{folder}/latest")

    def start(self, events: DataFrame, ticks: DataFrame | None = None, **trigger) -> StreamingQuery:
        """Follows a stream of events; ``trigger`` is Spark's, e.g. ``processingTime="5 seconds"`` to keep running.

        Without one it takes what is there and stops.  ``ticks`` is a stream of times that move the clock.
        """
        let_workers_import(self.spark)
        self._feed_kinds = [events.schema[c].dataType.simpleString() for c in self.feed]
        name, provider = PROVIDER
        usual = self.spark.conf.get(name)
        self.spark.conf.set(name, provider)  # the query keeps what holds when it starts
        try:
            return self._start(events, ticks, trigger)
        finally:
            self.spark.conf.set(name, usual)

    def _start(self, events: DataFrame, ticks: DataFrame | None, trigger: dict) -> StreamingQuery:
        return (
            self._answers(valid_events(events), ticks)
            .writeStream.foreachBatch(self.update)
            .outputMode("update")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def _answers(self, events: DataFrame, ticks: DataFrame | None) -> DataFrame:
        kept = [f.split()[0] for f in KEPT.split(", ")]
        rows = events.selectExpr(
            *self.feed, "timestamp", "unix_micros(cast(timestamp as timestamp)) as at", "event_id", "channel", "daypart",
            "cast(item_count as int) as item_count", "cast(subtotal as double) as subtotal", "status",
            f"cast({REVENUE} * 1000000 as long) as revenue", "uuid() as uid",  # tells events of a batch apart that share an id
        )
        if ticks is not None:
            rows = rows.unionByName(ticks.select("timestamp"), allowMissingColumns=True)
        own = f"pmod(xxhash64(uid), {SHARES}) = share"
        rows = rows.withColumn("share", F.expr(f"explode(sequence(0, {SHARES - 1}))")).withColumn("own", F.expr(own))
        # a sub-state that is only asked needs the event's time and names
        rows = rows.withColumns({c: F.expr(f"if(own, {c}, null)") for c in kept if c not in ("at", "event_id")})
        if self.timers:
            rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", f"{round(self.lateness_minutes * 60)} seconds")
        schema = ", ".join(
            ["kind string", "uid string", *(f"{c} {k}" for c, k in zip(self.feed, self._feed_kinds, strict=True)), KEPT, *(f"_{s} long" for s in SUMS)]
        )
        columns = [*self.feed, "share", *(["timestamp"] if self.timers else []), *kept, "uid", "own"]
        return rows.select(*columns).groupBy(*self.feed, "share").transformWithStateInPandas(
            FeedWindow(self.feed, self.minutes, self.lateness_minutes, self.history, self.timers),
            outputStructType=schema, outputMode="update", timeMode="eventTime" if self.timers else "none",
        )

    # tables

    def kpis(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/kpis").drop("batch")

    def messages(self) -> DataFrame:
        return self.spark.read.text(f"{self.folder}/messages").select("value")

    def recent_history(self) -> DataFrame:
        """Last events per feed, from the state: each sub-state holds as many, so the feed's last are among them."""
        return latest_per_feed(self._kept("last"), self.feed, self.history)

    def open_window(self) -> DataFrame:
        """Events of each feed still inside its window, from the state."""
        rows = self._kept("window")
        latest = self._state("latest").selectExpr(*[f"key.{c} as _{c}" for c in self.feed], "value.at as _at")
        latest = aggregate(latest, [f"_{c}" for c in self.feed], "max(_at) as _at")
        same = " and ".join(f"{c} <=> _{c}" for c in self.feed) or "true"
        reach = f"unix_micros(cast(timestamp as timestamp)) >= _at - {round(self.minutes * 60e6)}"
        return rows.join(latest, F.expr(f"{same} and {reach}")).select(*rows.columns)

    def latest(self) -> DataFrame:
        """Last KPIs per feed."""
        return self.versions.read()

    # one micro-batch

    def update(self, batch: DataFrame, batch_id: int) -> None:
        part = f"batch={batch_id}"
        answers = self._write(batch, f"answers/{part}")
        if answers.isEmpty():
            return
        time = "timestamp_micros(at)"
        fields = [f.strip() for f in EVENT_FIELDS.split(",")]
        late = answers.where("kind = 'late'").withColumn("timestamp", F.expr(time))
        late.selectExpr(*self.feed, *fields).write.mode("overwrite").parquet(f"{self.folder}/late/{part}")
        merged = aggregate(
            answers.where("kind <> 'late'"), ["kind", *self.feed, "uid", "at", "event_id"],
            *[f"max({c}) as {c}" for c in fields if c not in ("event_id", "timestamp")], *[f"sum(_{s}) as _{s}" for s in SUMS],
        )
        merged = merged.withColumn("_revenue", F.expr("cast(_revenue as decimal(20,0)) * cast('0.000001' as decimal(7,6))"))
        merged = merged.withColumn("timestamp", F.expr(time))
        rolled = self._write(merged.selectExpr("kind", *self.feed, *fields, *summary_columns(self.minutes)), f"rolled/{part}")
        orders = rolled.where("kind = 'order'")
        kpis = self._write(orders.drop("kind", *[f for f in fields if f not in ("event_id", "timestamp")]), f"kpis/{part}")
        order_message(orders).write.mode("overwrite").text(f"{self.folder}/messages/{part}")
        # an idle row comes behind its feed's events, whose window it closes
        idle = rolled.where("kind = 'idle'").select(*kpis.columns)
        before = self.versions.read(below=batch_id)
        fresh = kpis.withColumn("_idle", F.lit(0)).unionByName(idle.withColumn("_idle", F.lit(1)))
        known = fresh if before is None else before.withColumn("_idle", F.expr("if(event_id is null, 1, 0)")).unionByName(fresh)
        order = ["timestamp desc", "_idle desc", "event_id desc", "order_count desc"]
        newest = f"row_number() over (partition by {', '.join(self.feed) or '0'} order by {', '.join(order)})"
        self.versions.write(known.selectExpr("*", f"{newest} as _n").where("_n = 1").drop("_n", "_idle"), batch_id)

    def _write(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")

    def _state(self, name: str) -> DataFrame:
        return self.spark.read.format("statestore").option("stateVarName", name).load(f"{self.folder}/checkpoint")

    def _kept(self, name: str) -> DataFrame:
        rows = self._state(name).selectExpr(*[f"key.{c} as {c}" for c in self.feed], "list_element.*")
        fields = [f.strip() for f in EVENT_FIELDS.split(",")]
        rows = rows.withColumn("timestamp", F.timestamp_micros("at"))
        return rows.select(*self.feed, *fields)
