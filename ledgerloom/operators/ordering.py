"""Total orders that later steps can see, and running values within keys of any size, without one task for all rows or for a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.scratch import written

_PLACE = (1 << 33) - 1


def in_order(rows: DataFrame, order: Sequence[Column], partitions: int | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """``rows`` range-sorted and written, without the columns ``drop``, with __part (the partition, in order) and __at (the place within it)."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The generated id holds the partition above 33 bits of the place within it.
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop(*drop).withColumn("__id", F.monotonically_increasing_id())
    dealt = written(dealt, "ordered")
    return dealt.withColumns({"__part": F.shiftright("__id", 33), "__at": F.col("__id").bitwiseAND(F.lit(_PLACE))}).drop("__id")


def with_ordinal(rows: DataFrame, order: Sequence[Column], name: str = "ordinal", first: int = 1, partitions: int | None = None) -> DataFrame:
    """``rows`` with ``name``, counted from ``first`` in the order given; rows that it leaves equal follow each other in any way. ``rows`` are looked at twice: pass a written table.

    A range sort puts the rows into partitions by sampled bounds; they are written with their place in the partition, and the sizes of the
    partitions before (one number each, all that reaches the driver) are added. The order should tell rows apart: equal ones share a partition.
    """
    dealt = in_order(rows, order, partitions)
    before, offsets = first, []
    for part, size in sorted(map(tuple, dealt.groupBy("__part").agg(F.count(F.lit(1))).collect())):
        offsets.append((part, before))
        before += size
    starts = rows.sparkSession.createDataFrame(offsets, "__part long, __before long")
    return dealt.join(F.broadcast(starts), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str, how: str = "sum", kind: str = "long", partitions: int | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum, or the maximum, of ``value`` (as ``kind``) over the rows of the same ``keys`` up to and including each, in ``order``. ``rows`` are looked at twice.

    Nulls count nothing; nothing but nulls makes null. Rows are range-sorted by keys and order, so that a hot key spans several partitions. What it has in earlier
    ones is carried over: a key spans two partitions only where one ends, so there are fewer such keys than partitions. Without keys, all rows are one run.
    """
    return running_all(rows, keys, order, {name: (value, how, kind)}, partitions)


def running_all(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, tuple[Column, str, str]], partitions: int | None = None) -> DataFrame:
    """As running(), for several values (value, how, kind) by name, with one sort."""
    if wrong := [how for _, how, _ in values.values() if how not in ("sum", "max")]:
        raise ValueError(f"no running {wrong[0]}")
    gather = {n: F.sum if how == "sum" else F.max for n, (_, how, _) in values.items()}
    dealt = in_order(rows.withColumns({f"__value_{n}": v.cast(kind) for n, (v, _, kind) in values.items()}), [*map(F.col, keys), *order], partitions)
    here = Window.partitionBy("__part", *keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumns({f"__own_{n}": gather[n](f"__value_{n}").over(here) for n in values})
    parts = dealt.groupBy("__part", *keys).agg(*(gather[n](f"__value_{n}").alias(f"__total_{n}") for n in values))
    if keys:
        spans = parts.groupBy(*keys).agg(F.min("__part").alias("__span_first"), F.max("__part").alias("__span_last")).filter("__span_first < __span_last")
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
        parts = parts.alias("p").join(F.broadcast(spans.alias("s")), same).select("p.*")
    carried, sums = [], {}
    for r in sorted(parts.collect(), key=lambda r: r["__part"]):
        key = tuple(r[k] for k in keys)
        before = sums.get(key, dict.fromkeys(values))
        carried.append((r["__part"], *key, *before.values()))
        some = {n: [x for x in (before[n], r[f"__total_{n}"]) if x is not None] for n in values}
        sums[key] = {n: (sum(x) if values[n][1] == "sum" else max(x)) if x else None for n, x in some.items()}
    types = dict(rows.dtypes)
    carry = rows.sparkSession.createDataFrame(carried, ", ".join(["__part long", *(f"`{k}` {types[k]}" for k in keys), *(f"`__carry_{n}` {kind}" for n, (_, _, kind) in values.items())]))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"d.{k}")) for k in ("__part", *keys)]
    joined = dealt.alias("d").join(F.broadcast(carry.alias("c")), same, "left").select("d.*", *(f"c.__carry_{n}" for n in values))
    both = {n: F.coalesce(F.col(f"__carry_{n}") + F.col(f"__own_{n}"), f"__own_{n}", f"__carry_{n}") if how == "sum" else F.greatest(f"__carry_{n}", f"__own_{n}") for n, (_, how, _) in values.items()}
    return joined.select(*rows.columns, *(c.alias(n) for n, c in both.items()))


def rank_within(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``rows`` with their place, from 1, among the rows of the same ``keys``, however many these are."""
    return running(rows, keys, order, F.lit(1), name, partitions=partitions)
