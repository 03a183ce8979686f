"""Sliced order statistics against plain Python, with one key holding a third of the rows."""

import random
import statistics
from datetime import datetime, timedelta

import pytest

from tallyhouse.operators.ordering import grouped_percentiles, medians, prefix_sums, rank_and_group_total, running_totals, top_rows


@pytest.fixture(scope="module")
def ledger(spark):
    """One key holds a third of the rows, one key is NULL, instants repeat."""
    rng = random.Random(5)
    start = datetime(2026, 1, 5, 8)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, start + timedelta(minutes=rng.randrange(0, 3000, 20)), float(rng.randrange(-9, 10))))
    return rows, spark.createDataFrame(rows, "id int, k string, at timestamp_ntz, v double")


def test_running_totals_equal_brute_force(ledger):
    rows, frame = ledger
    cut = frame.selectExpr("*", "to_date(at) as _day", "hour(at) as _hour")
    got = running_totals(cut, ["k"], ["_day", "_hour"], "at, id", {"s": "v"}).select("id", "s").collect()
    expected, sums = {}, {}
    for i, key, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        sums[key] = sums.get(key, 0.0) + value
        expected[i] = sums[key]
    assert {r.id: r.s for r in got} == expected


def test_running_totals_without_keys_or_slices(ledger):
    rows, frame = ledger
    cut = frame.selectExpr("*", "to_date(at) as _day")
    sliced = running_totals(cut, [], ["_day"], "at, id", {"s": "v"}).select("id", "s").collect()
    plain = running_totals(cut, [], [], "at, id", {"s": "v"}).select("id", "s").collect()
    assert sorted(sliced) == sorted(plain) and len(sliced) == len(rows)


def test_sliced_rank_equals_the_window(spark):
    rng = random.Random(6)
    rows = [(i, "hot" if i % 3 else rng.choice(["x", None]), rng.choice([None, rng.randrange(40)])) for i in range(600)]
    frame = spark.createDataFrame(rows, "id int, g string, v int")
    sliced = rank_and_group_total(frame, "g", "v", "r", "t", slice_values=5)
    plain = frame.selectExpr("*", "rank() over (partition by g order by v desc nulls last) as r", "sum(v) over (partition by g) as t")
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [5.0] * 7 + [1.0, 9.0], [float(i) for i in range(501)], [2, 2, 7, 9]])
def test_bracketed_median_is_exact(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = spark.range(1).select(medians(frame, ["v"])["v"].alias("m")).first().m
    assert got == statistics.median(values)


def test_median_of_nothing_is_null(spark):
    frame = spark.createDataFrame([], "v double")
    assert spark.range(1).select(medians(frame, ["v"])["v"].alias("m")).first().m is None


def test_top_rows_puts_nulls_last(spark):
    frame = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 5)], "id int, v int")
    assert [r.id for r in top_rows(frame, "v desc, id", 4).collect()] == [3, 2, 4, 1]
    assert [r.id for r in top_rows(frame, "v, id", 3).collect()] == [2, 4, 3]


@pytest.mark.parametrize("slice_values", [3, 100_000], ids=["many slices", "one slice"])
def test_grouped_percentiles_equal_brute_force(spark, slice_values):
    """A hot group, a NULL group, ties, NULL values, a group of NULLs alone and one of a single value."""
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i % 2, None if i % 11 == 0 else rng.randrange(40) / 8) for i in range(800)]
    rows += [("none", 0, None), ("one", 0, 2.5)]
    frame = spark.createDataFrame(rows, "k string, h int, v double")
    found = grouped_percentiles(frame, ["k", "h"], "v", {"low": 0.0, "mid": 0.5, "high": 0.9, "top": 1.0}, slice_values)

    def percentile(values, p):
        at = p * (len(values) - 1)
        low = int(at)
        return values[low] if at == low else (low + 1 - at) * values[low] + (at - low) * values[low + 1]

    want = {}
    for k, h, v in rows:
        want.setdefault((k, h), []).extend([] if v is None else [v])
    want = {g: tuple(percentile(sorted(v), p) for p in (0.0, 0.5, 0.9, 1.0)) if v else (None,) * 4 for g, v in want.items()}
    assert {(r.k, r.h): (r.low, r.mid, r.high, r.top) for r in found.collect()} == want
    whole = grouped_percentiles(frame, [], "v", {"mid": 0.5}, slice_values).first().mid
    assert whole == statistics.median(v for _, _, v in rows if v is not None)


def test_prefix_sums_equal_brute_force(ledger):
    rows, frame = ledger
    expected, sums = {}, {}
    for i, key, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        expected[i] = sums[key] = sums.get(key, 0.0) + value
    got = prefix_sums(frame, ["k"], ["at", "id"], {"s": "v"}).select("id", "s").collect()
    assert len(got) == len(rows) and {r.id: r.s for r in got} == expected


def test_prefix_sums_of_one_key_and_one_instant(spark):
    """Everything at one instant of one key: the ranges hold shares of it, and the sum runs on over them."""
    frame = spark.range(4000).selectExpr("id", "'k' as k", "timestamp_ntz '2026-01-05 08:00:00' as at", "id % 7 as v").repartition(3)
    got = prefix_sums(frame, ["k"], ["at", "id"], {"s": "v"})
    total, expected = 0, []
    for i in range(4000):
        total += i % 7
        expected.append((i, total))
    assert [(r.id, r.s) for r in got.orderBy("id").collect()] == expected
    assert prefix_sums(frame.limit(0), [], ["id"], {"s": "v"}).count() == 0


def test_prefix_sums_spread_one_instant(spark, monkeypatch):
    from tallyhouse.operators import ordering

    kept = []
    plain = ordering.settle
    monkeypatch.setattr(ordering, "settle", lambda frame, label: kept.append(plain(frame, label)) or kept[-1])
    frame = spark.range(4000).selectExpr("id", "'k' as k", "timestamp_ntz '2026-01-05 08:00:00' as at", "1L as v")
    prefix_sums(frame, ["k"], ["at", "id"], {"s": "v"}).count()
    shares = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(shares) >= 3 and max(shares) < 2000
