"""Ordered operators: running sums without one big partition, fills, as-of look-ups, dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..stable import settled


def prefix_sum(df: DataFrame, order: list[Column], value: str, out: str, parts: int | None = None) -> DataFrame:
    """Running sum of value over a total order, in two steps.

    Rows are dealt by ranges of the order and numbered by range; the sums of the ranges
    before (one small row a range) are joined to a running sum inside each range. The
    order must have no ties.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    placed = settled(ranged.withColumn("__range", F.spark_partition_id()))
    totals = placed.groupBy("__range").agg(F.sum(value).alias("__total"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("__inside", F.sum(value).over(inside)).join(F.broadcast(offsets), "__range")
    return running.withColumn(out, F.col("__before") + F.col("__inside")).drop("__range", "__inside", "__before")


def keep_last(df: DataFrame, keys: list[str], arrival: Column) -> DataFrame:
    """Of each key the row that arrived last."""
    place = Window.partitionBy(*keys).orderBy(arrival.desc())
    return df.withColumn("__n", F.row_number().over(place)).where("__n = 1").drop("__n")


def ffill(value: str, order: str, *by: str) -> Column:
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def bfill(value: str, order: str, *by: str) -> Column:
    return F.first(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(0, Window.unboundedFollowing))


def rolling_mean(value: str, n: int, order: str, *by: str) -> Column:
    """Trailing mean of n rows; null unless all n hold a value."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def fill_spread(df: DataFrame, key: str, order: list[str], value: str, out: str, forward: bool = False) -> DataFrame:
    """out: the last value that is not null at or before each row of its key (or the first at or after it), for hot keys.

    Rows are dealt by ranges of key and order, so a key of any size is spread. Within a range a window fills; what a key
    that goes on over ranges brings from the others is one row a range: only the keys at the ranges' edges can.
    """
    placed = settled(df.repartitionByRange(key, *order).withColumn("__range", F.spark_partition_id()))
    edges = placed.groupBy("__range").agg(F.min(F.struct(key)).alias("__low"), F.max(F.struct(key)).alias("__high"))
    by_range = Window.orderBy("__range")  # one row a range
    hot = edges.withColumn("__next", F.lead("__low").over(by_range)).where(F.col("__high") == F.col("__next"))
    hot = hot.select(F.col(f"__high.{key}").alias("__hot")).distinct()
    mine = placed.join(F.broadcast(hot), placed[key].eqNullSafe(F.col("__hot")), "left_semi")
    at = F.struct(*order)
    best = (F.min_by if forward else F.max_by)(value, at)
    ends = mine.where(F.col(value).isNotNull()).groupBy(key, "__range").agg(best.alias("__v"))
    ends = mine.select(key, "__range").distinct().join(ends.withColumnsRenamed({key: "__hot", "__range": "__at"}), F.col(key).eqNullSafe(F.col("__hot")) & (F.col("__range") == F.col("__at")), "left")
    others = Window.partitionBy(key).orderBy("__range")
    carried = F.first("__v", True).over(others.rowsBetween(1, Window.unboundedFollowing)) if forward else F.last("__v", True).over(others.rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(F.col(key).alias("__hot"), F.col("__range").alias("__at"), carried.alias("__carry"))
    inside = Window.partitionBy("__range", key).orderBy(*order)
    found = F.first(value, True).over(inside.rowsBetween(0, Window.unboundedFollowing)) if forward else F.last(value, True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = placed.withColumn("__in", found).join(F.broadcast(carry), F.col(key).eqNullSafe(F.col("__hot")) & (F.col("__range") == F.col("__at")), "left")
    return rows.withColumn(out, F.coalesce("__in", "__carry")).drop("__range", "__in", "__hot", "__at", "__carry")


def as_of(facts: DataFrame, events: DataFrame, key: str, at: str, event_at: str, values: list[str], forward: bool = False, spread: bool = False) -> DataFrame:
    """Each fact with the last event of its key at or before it (or the first at or after it).

    Facts and events are put in one stream by key and time, so both are shuffled once and
    no pair is formed. ``event_at`` and values come back null where there is no event. With spread, for tables of which
    one key may hold a large share, no key is sorted in one task: see ``fill_spread``.
    """
    held = F.struct(F.col(event_at), *values)
    a = facts.select(F.col(key), F.col(at).alias("__t"), F.lit(1).alias("__k"), F.struct(*facts.columns).alias("__f"))
    b = events.select(F.col(key), F.col(event_at).alias("__t"), F.lit(2 if forward else 0).alias("__k"), held.alias("__e"))
    both = a.unionByName(b, allowMissingColumns=True)
    if spread:
        out = fill_spread(both, key, ["__t", "__k"], "__e", "__found", forward).where("__f is not null")
        return out.select("__f.*", *[F.col("__found").getField(v).alias(v) for v in [event_at, *values]])
    w = Window.partitionBy(key).orderBy("__t", "__k")
    found = (
        F.first("__e", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
        if forward
        else F.last("__e", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    out = both.withColumn("__e", found).where("__f is not null")
    return out.select("__f.*", *[F.col("__e").getField(v).alias(v) for v in [event_at, *values]])
