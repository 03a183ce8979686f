"""Order-dependent aggregates that never sort one whole key in one task.

A window ``partitionBy(key).orderBy(...)`` puts every row of a key into one task.  Where a key
may hold a large share of a table that task decides the run time, so the functions here cut each
key into ordered slices, work inside the slices, and add what the earlier slices contribute.  The
results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate
from tallyhouse.operators.keys import attach
from tallyhouse.sources.workdir import settle

# Rank error of the approximate percentiles that place cut points, as one part in ACCURACY.
ACCURACY = 10_000
# Distinct values of a group that one task may sort, and the most slices a group is cut into.
SLICE_VALUES = 100_000
MOST_SLICES = 4096


def running_totals(
    rows: DataFrame,
    keys: Sequence[str],
    slices: Sequence[str],
    order_by: str,
    totals: dict[str, str],
) -> DataFrame:
    """Adds running sums per key, first row to current row in the given order.

    ``slices`` names columns that cut a key's rows into ordered pieces, coarse to fine, each a
    non-decreasing function of the order (an hour, then a second).  Rows are sorted only inside
    the finest slice.  What the earlier slices add up to enters a slice as one extra row ahead of
    its own.  The rows are read twice: once for the sums of the finest slices, which are combined on
    the map side and written (eager), and once for the result; coarser slices run over those sums.
    ``totals`` maps output column to input column.  ``order_by`` must order rows totally for the
    result to be determined.
    """
    return _running_totals(rows, keys, slices, order_by, totals, lambda sums: settle(sums, "slice-sums"))


def prefix_sums(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], totals: dict[str, str]) -> DataFrame:
    """Adds running sums per key in the order of columns, whatever the key or a value of the order holds.

    Rows are dealt to ranges of (key, order), sorted and written with the number of their range (eager).  A range's sum per
    key is carried to the ranges behind it, which is a running sum over as many rows as there are ranges; inside a range the
    sum runs on from there.  Where the order is total, as with an id at its end, even a key with one instant is spread
    over the ranges.  ``totals`` maps output column to input column.
    """
    spark, part = rows.sparkSession, "_range"
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order_by)
    dealt = settle(dealt.withColumn(part, F.spark_partition_id()), "ranges")
    sums = aggregate(dealt, [*keys, part], *[f"coalesce(sum({source}), 0) as {out}" for out, source in totals.items()])
    by_key = f"partition by {', '.join(keys)}" if keys else ""
    carried = sums.selectExpr(
        *keys, part, "0 as _own",
        *[f"sum({out}) over ({by_key} order by {part} rows unbounded preceding) - {out} as _add_{out}" for out in totals],
    )
    own = dealt.selectExpr("*", "1 as _own", *[f"{source} as _add_{out}" for out, source in totals.items()])
    window = f"over (partition by {', '.join([*keys, part])} order by _own, {', '.join(order_by)} rows unbounded preceding)"
    summed = own.unionByName(carried, allowMissingColumns=True).selectExpr("*", *[f"sum(_add_{out}) {window} as {out}" for out in totals])
    return summed.where("_own = 1").select(*rows.columns, *totals)


def _running_totals(rows, keys, slices, order_by, totals, keep) -> DataFrame:
    cut = [*keys, *slices]
    partition = f"partition by {', '.join(cut)}" if cut else ""
    if not slices:
        window = f"over ({partition} order by {order_by} rows between unbounded preceding and current row)"
        return rows.selectExpr("*", *[f"sum({source}) {window} as {out}" for out, source in totals.items()])
    sums = keep(aggregate(rows, cut, *[f"coalesce(sum({source}), 0) as {out}" for out, source in totals.items()]))
    upto = {f"_upto_{out}": out for out in totals}
    carried = _running_totals(sums, keys, slices[:-1], slices[-1], upto, lambda coarser: coarser).selectExpr(
        *cut, "0 as _own", *[f"_upto_{out} - {out} as _add_{out}" for out in totals]
    )
    own = rows.selectExpr("*", "1 as _own", *[f"{source} as _add_{out}" for out, source in totals.items()])
    window = f"over ({partition} order by _own, {order_by} rows between unbounded preceding and current row)"
    summed = own.unionByName(carried, allowMissingColumns=True).selectExpr(
        *rows.columns, "_own", *[f"sum(_add_{out}) {window} as {out}" for out in totals]
    )
    return summed.where("_own = 1").drop("_own")


def rank_and_group_total(
    rows: DataFrame, group: str, value: str, rank: str, total: str, slice_values: int = SLICE_VALUES
) -> DataFrame:
    """Adds ``rank()`` by descending value within a group, NULLs last, and the group's sum.

    Rows are counted per distinct value first, so ties, NULLs among them, are one row.  Percentiles of
    each group cut its values into slices, whose number follows the largest group; ranks are taken
    inside a slice and the rows of higher slices are added.
    """
    counted = settle(aggregate(rows, [group, value], "count(*) as _copies", f"sum({value}) as _sum"), "ranked-values")
    largest = aggregate(aggregate(counted, [group], "count(*) as _n"), [], "max(_n)").first()[0] or 0
    slices = max(1, min(MOST_SLICES, -(-largest // slice_values)))
    fractions = ", ".join(str(i / slices) for i in range(1, slices))
    cuts = f"percentile_approx({value}, array({fractions}), {ACCURACY})" if slices > 1 else f"filter(array(max({value})), c -> false)"
    per_group = aggregate(counted, [group], f"{cuts} as _cuts", f"sum(_sum) as {total}")
    sliced = attach(counted, per_group, [group]).selectExpr(
        group, value, "_copies", total,
        f"if({value} is null, {slices}, size(filter(_cuts, cut -> cut > {value}))) as _slice",
    )
    ahead = aggregate(sliced, [group, "_slice"], "sum(_copies) as _rows").selectExpr(
        group, "_slice", f"sum(_rows) over (partition by {group} order by _slice rows unbounded preceding) - _rows as _ahead"
    )
    above = f"sum(_copies) over (partition by {group}, _slice order by {value} desc rows unbounded preceding) - _copies"
    ranked = attach(sliced.selectExpr("*", f"{above} as _above"), ahead, [group, "_slice"])
    ranked = ranked.selectExpr(group, value, f"int(1 + _ahead + _above) as {rank}", total)
    return attach(rows, ranked, [group, value])


def grouped_percentiles(
    rows: DataFrame, group: Sequence[str], value: str, fractions: dict[str, float], slice_values: int = SLICE_VALUES
) -> DataFrame:
    """Exact interpolated percentiles of a value per group, several at once, as columns named by ``fractions``.

    Rows are counted per distinct value first, combined on the map side and written (eager).  Percentile cut points of each
    group deal its values to ordered slices, whose number follows the largest group; the copies of lower slices are added
    to the running counts inside a slice, and a group's percentile takes the one or two values that hold its place.  No task
    sorts more than a slice.  NULLs have no place; a group of NULLs alone has NULL percentiles.
    """
    if not group:
        return grouped_percentiles(rows.withColumn("_all", F.lit(0)), ["_all"], value, fractions, slice_values).drop("_all")
    group = list(group)
    counted = aggregate(rows.withColumn("_value", F.expr(f"double({value})")), [*group, "_value"], "count(_value) as _copies")
    counted = settle(counted, "counted-values")  # a NULL counts nothing and keeps its group
    largest = aggregate(aggregate(counted, group, "count(*) as _n"), [], "max(_n)").first()[0] or 0
    slices = max(1, min(MOST_SLICES, -(-largest // slice_values)))
    by_group = f"partition by {', '.join(group)}"
    if slices == 1:
        upto = f"sum(_copies) over ({by_group} order by _value rows unbounded preceding) as _upto"
        running = counted.selectExpr("*", upto, f"sum(_copies) over ({by_group}) as _n")
    else:
        inner = ", ".join(str(i / slices) for i in range(1, slices))
        per_group = aggregate(counted, group, "sum(_copies) as _n", f"percentile_approx(_value, array({inner}), {ACCURACY}) as _cuts")
        sliced = attach(counted, per_group, group).selectExpr(
            *group, "_value", "_copies", "_n", "coalesce(size(filter(_cuts, cut -> cut < _value)), 0) as _slice"
        )
        upto = f"sum(_copies) over ({by_group}, _slice order by _value rows unbounded preceding) as _upto"
        ahead = aggregate(sliced, [*group, "_slice"], "sum(_copies) as _rows").selectExpr(
            *group, "_slice", f"sum(_rows) over ({by_group} order by _slice rows unbounded preceding) - _rows as _ahead"
        )
        running = attach(sliced.selectExpr("*", upto), ahead, [*group, "_slice"]).withColumn("_upto", F.expr("_upto + _ahead"))
    at = {name: f"({p}D * (_n - 1))" for name, p in fractions.items()}
    holds = "{0} >= _upto - _copies and {0} < _upto"
    ends = {f"_{end}_{name}": f"{f}({x})" for name, x in at.items() for end, f in (("low", "floor"), ("high", "ceil"))}
    placed = running.where(" or ".join(["_value is null", *[holds.format(x) for x in ends.values()]]))
    found = aggregate(placed, group, "max(_n) as _n", *[f"max(_value) filter (where {holds.format(x)}) as {k}" for k, x in ends.items()])
    return found.selectExpr(
        *group,
        *[f"if(_low_{k} = _high_{k}, _low_{k}, (ceil({x}) - {x}) * _low_{k} + ({x} - floor({x})) * _high_{k}) as {k}" for k, x in at.items()],
    )


def medians(rows: DataFrame, values: Sequence[str]) -> dict[str, Column]:
    """Exact medians of whole columns, as literals to use in a later expression.  Eager: four aggregates.

    Approximate percentiles bracket the middle of every column at once, with a proven rank error.  The rows below the
    bracket and in it are counted, a second bracket is taken inside the first, and only the values in that one, about one in
    six million of the distinct values, are brought to the driver with their counts.
    """
    margin = 2 / ACCURACY
    names = {f"v{i}": f"double({v})" for i, v in enumerate(values)}
    middle = f"array({0.5 - margin}, {0.5 + margin})"
    first = aggregate(rows, [], *[f"struct(count({x}) as n, percentile_approx({x}, {middle}, {ACCURACY}) as b) as {k}" for k, x in names.items()]).first()
    size = {k: first[k].n for k in names if first[k].n}
    bracket = {k: tuple(first[k].b) for k in size}

    def bounds(k: str) -> str:
        low, high = bracket[k]
        return f"double('{low!r}') and double('{high!r}')"

    if size:
        held = aggregate(rows, [], *[
            f"struct(count_if({names[k]} < double('{bracket[k][0]!r}')) as below, count_if({names[k]} between {bounds(k)}) as inside) as {k}" for k in size
        ]).first()
        asked, inner = [], {}
        for k, n in size.items():
            low = ((n + 1) // 2 - held[k].below) / held[k].inside - margin
            high = ((n + 2) // 2 - held[k].below) / held[k].inside + margin
            fractions = f"array({max(low, 0)}, {min(high, 1)})"
            asked.append(f"percentile_approx({names[k]}, {fractions}, {ACCURACY}) filter (where {names[k]} between {bounds(k)}) as {k}")
            inner[k] = (low > 0, high < 1)
        second = aggregate(rows, [], *asked).first()
        # where the middle lies at an end of the bracket, that end stays the bound
        bracket = {k: tuple(second[k][i] if inner[k][i] else bracket[k][i] for i in (0, 1)) for k in size}
    found: dict[str, Column] = {}
    parts = None
    for k in size:
        x, (low, high) = names[k], bracket[k]
        cut = rows.where(f"{x} <= double('{high!r}')").selectExpr(f"'{k}' as name", f"if({x} < double('{low!r}'), null, {x}) as value")
        parts = cut if parts is None else parts.unionByName(cut)
    near = sorted(aggregate(parts, ["name", "value"], "count(*) as n").collect(), key=lambda r: (r.value is not None, r.value or 0)) if size else []
    for (k, _), value in zip(names.items(), values, strict=True):
        if k not in size:
            found[value] = F.lit(None).cast("double")
            continue
        wanted, seen, at = ((size[k] + 1) // 2, (size[k] + 2) // 2), 0, []
        for r in near:
            if r.name == k:
                at += [r.value for w in wanted if seen < w <= seen + r.n]
                seen += r.n
        found[value] = F.lit((at[0] + at[1]) / 2)
    return found


def top_rows(rows: DataFrame, order_by: str, k: int) -> DataFrame:
    """First k rows in an order, NULLs last; Spark keeps k per task and merges, no full sort.

    ``order_by`` is a list of columns, each with ``desc`` for descending.
    """
    order = []
    for item in order_by.split(","):
        name, _, way = item.strip().partition(" ")
        order.append(F.col(name).desc_nulls_last() if way == "desc" else F.col(name).asc_nulls_last())
    return rows.orderBy(*order).limit(k)
