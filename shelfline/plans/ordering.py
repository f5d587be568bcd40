"""Global ranks, row numbers and exact percentiles without a one-task window.

``rank() OVER (ORDER BY x)`` and ``percentile(x)`` pull a whole column through one task. Here rows are first counted per
distinct value. Splitters, the approximate quantiles of these distinct values, cut them into ``SPLITS`` ranges of about
equally many, whatever their distribution; only the ranges' totals meet in a single window. The counted values are
used several times (for splitters, totals and places), each time with all their columns, so that Spark shuffles them
once and reuses that exchange; nothing runs before the result is used. Row numbers place and write keys, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.plans.reports import beside
from shelfline.session import ensure_checkpoint_dir

SPLITS = 1024  # ranges of values; a power of two
DEALT_ROWS = 50_000  # rows a task is dealt before they multiply
_NULL_RANGE = -1


def reads_all(df: DataFrame) -> Column:
    """Zero, worked out from every column of ``df``.

    Two uses of one aggregated frame share its exchange only if both need the same columns of it. An aggregate
    that adds this zero needs them all.
    """
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseAND(F.lit(0).cast("long"))


def count_below(sorted_values: str | Column, value: Column, size: int) -> Column:
    """How many of the sorted array's first ``size`` - 1 values are at most ``value``: binary search, ``size`` a power of two."""
    marks = F.col(sorted_values) if isinstance(sorted_values, str) else sorted_values
    steps = F.array(*[F.lit(1 << k) for k in range(size.bit_length() - 2, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(marks, at + step - 1) <= value, at + step).otherwise(at))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many tasks as the session shuffles to, and to more where these would get over ``DEALT_ROWS`` rows.

    For small rows that are about to become many: a small file is one task, and what is made of its rows
    would be aggregated there. The number is given, as adaptive execution would merge partitions by their size before the rows multiply,
    so the rows are counted when the plan is made; the count decides nothing but the number of tasks.
    """
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffled, -(-df.count() // DEALT_ROWS)), *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a reduced intermediate that several consumers share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _value_counts(df: DataFrame, value: str, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    rows = F.sum(F.lit(1) + reads_all(df)) if weight is None else F.sum(weight)
    return df.groupBy(*keys, F.col(value).alias("_v")).agg(rows.alias("_n"))


def _in_ranges(counts: DataFrame) -> DataFrame:
    """``counts`` with the number ``_b`` of each value's range; the order of ranges is that of values. Null has one of its own."""
    present = F.when(F.col("_n") > 0, F.col("_v").cast("double"))
    quantiles = F.lit([i / SPLITS for i in range(1, SPLITS)])
    marks = counts.agg(F.percentile_approx(present, quantiles, 4 * SPLITS)).scalar()
    marked = counts.withColumn("_marks", marks)
    place = F.when(F.col("_v").isNotNull(), count_below("_marks", F.col("_v").cast("double"), SPLITS)).otherwise(_NULL_RANGE)
    return marked.withColumn("_b", place).drop("_marks")


def _range_totals(placed: DataFrame, keys: Sequence[str], descending: bool) -> DataFrame:
    """Rows before each range (``_offset``), in it (``_bn``) and in all (``_total``): at most ``SPLITS`` + 1 rows a key."""
    order = F.col("_b").desc() if descending else F.col("_b").asc()
    across = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
    return totals.select(*keys, "_b", "_bn", F.coalesce(F.sum("_bn").over(across), F.lit(0)).alias("_offset"), F.sum("_bn").over(Window.partitionBy(*keys)).alias("_total"))


def _before_each(placed: DataFrame, ranges: DataFrame, keys: Sequence[str], descending: bool) -> DataFrame:
    """Rows before each distinct value (``_before``), for the values of the given ranges; a window holds one range."""
    order = F.col("_v").desc() if descending else F.col("_v").asc()
    inside = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("p._b") == F.col("r._b")]
    joined = placed.alias("p").join(ranges.alias("r"), same).select("p.*", "r._offset", "r._total")
    return joined.withColumn("_before", F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))


def with_rank(df: DataFrame, value: str, name: str = "rank", total: str | None = None) -> DataFrame:
    """SQL RANK by ``value`` descending, nulls last; optionally the row total beside it.

    Lazy: nothing runs before the result is used, so a view built on it follows its tables. ``df`` is used twice, with the
    same columns: what it aggregates or joins is computed once. The ranks, one row per distinct value, are joined
    back to the rows, so a value that very many rows share is split like any hot join key.
    """
    placed = _in_ranges(_value_counts(df, value, []))
    ranks = _before_each(placed, _range_totals(placed, [], True), [], True).select(
        "_v", (F.col("_before") + 1).alias(name), *([F.col("_total").alias(total)] if total else [])
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def percentiles(
    df: DataFrame, value: str, points: dict[str, float], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact interpolated percentiles (PERCENTILE_CONT), one output column per point.

    The totals of the ranges tell which ranges hold a wanted place; only their values, at most two ranges
    a point, are put in order. With ``weight`` a row stands for that many equal values.
    """
    keys = list(keys)
    counts = _value_counts(df.filter(F.col(value).isNotNull()), value, keys, weight)
    placed = _in_ranges(counts)
    position = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in points.items()}
    places = [f(x) for x in position.values() for f in (F.floor, F.ceil)]

    def within(first: Column, n: Column, place: Column) -> Column:
        return (first <= place) & (place < first + n)

    wanted = F.array(*[within(F.col("_offset"), F.col("_bn"), place) for place in places])
    held = _range_totals(placed, keys, False).filter(F.array_contains(wanted, True))
    near = _before_each(placed, held, keys, False)

    def holding(place: Column) -> Column:
        return F.max(F.when(within(F.col("_before"), F.col("_n"), place), F.col("_v").cast("double")))

    parts = []
    for name, x in position.items():
        parts += [holding(F.floor(x)).alias(f"_lo_{name}"), holding(F.ceil(x)).alias(f"_hi_{name}"), F.max(x - F.floor(x)).alias(f"_f_{name}")]
    found = near.groupBy(*keys).agg(*parts)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in points
        ],
    )


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str, start: int | Column = 1, key: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Consecutive numbers in a total order, one range-partitioned sort and no single task.

    The placed rows are checkpointed: range bounds are sampled, so a recomputed
    stage could otherwise hand a row a different slot than the one counted. With ``key``,
    column names that tell the rows apart and are never null, only the columns of key and
    order (names, then) are placed and written, and the numbers are joined back to the rows. With ``weight``
    a row takes as many numbers as that column says, and ``name`` is the first of them.
    """
    if key:
        narrow = df.select(*dict.fromkeys([*order, *key, *([weight] if weight else [])]))
        numbers = number_rows(narrow, order, name, start, weight=weight).select(*key, name)
        return df.join(numbers, list(key)).select(*df.columns, name)
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_slot", 33))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per partition, so the window and the broadcast are bounded by their number
        placed.groupBy("_part")
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    first = start if isinstance(start, Column) else F.lit(start)
    if weight:  # a window holds one range of the sort
        inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        local = F.coalesce(F.sum(weight).over(inside), F.lit(0))
    else:
        local = F.col("_slot") - F.shiftleft("_part", 33)
    return (
        placed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, first + F.col("_offset") + F.col("_local"))
        .drop("_slot", "_part", "_offset", "_local")
    )


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows per distinct non-null value as ``value`` and ``n``; uses that need both columns share one pass over ``df``."""
    rows = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("value"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


def profile(counts: DataFrame, points: dict[str, float], sample: bool = True) -> DataFrame:
    """Count, mean, deviation, min, max and percentiles from ``value_counts``, in one row."""
    x, n = F.col("value").cast("double"), F.col("n")
    total = F.sum(n).cast("double")
    mean = counts.agg(F.sum(x * n) / total).scalar()
    spread = F.sqrt(F.try_divide(F.sum(n * (x - mean) * (x - mean)), total - (1 if sample else 0)))
    moments = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"), F.max(mean).alias("mean"), spread.alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    return beside(moments, percentiles(counts, "value", points, weight="n"))
