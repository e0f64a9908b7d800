"""Running values over long ordered groups, without sorting a whole group in one task.

A window over (keys) puts all rows of a key into one task, and cutting a key at fixed times helps only as far as its
rows are spread evenly over time. Here the rows are cut where they lie: Spark samples (keys, order) and cuts it into
ranges of about equal depth, however the rows are spread over keys or along the order. A narrow pass reads off each
range's lower bound and reduces every (keys, range) to one value; a window over those few values gives each range the
value carried in from the ranges before it. A row finds its range among the bounds, which are a constant of the plan, by
binary search; rows and carries are then dealt one range to a task and meet in a window over (keys, range). The rows are
shuffled once, whole keys and parts of keys alike, and because the bounds are fixed a lost task is computed again alike.

Rows equal in (keys, order) are in one range, so the order should tell rows apart. Null sorts first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from fleetpulse.session import written

_RANGE, _VALUE, _IS_ROW, _AT, _TOTAL = "__range", "__value", "__is_row", "__at", "__total"
_JSON = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timeZone": "UTC"}


def _range_of(at: Column, bounds: Column, count: int) -> Column:
    """How many of the ascending bounds are at most `at`, less one: by halving steps."""
    steps = [1 << i for i in reversed(range(max(count, 1).bit_length()))]

    def further(found: Column, step: Column) -> Column:
        return F.when(F.get(bounds, found + step - 1) <= at, found + step).otherwise(found)

    return F.greatest(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further) - 1, F.lit(0))


def _cut(
    marked: DataFrame, keys: Sequence[str], order: Sequence[str], total: Column, ranges: int | None
) -> tuple[Column, DataFrame, int]:
    """The range of a row, the total of each (keys, range) as a written table, and the number of ranges: the one given, or
    as many as adaptive execution makes of the narrow rows by their size, shuffle partitions at most."""
    narrow = marked.select(F.struct(*keys, *order).alias(_AT), *keys, _VALUE)
    dealt = narrow.repartitionByRange(ranges, _AT) if ranges else narrow.repartitionByRange(_AT)
    parts = dealt.groupBy(F.spark_partition_id().alias("__part"), *keys)
    cells = written(parts.agg(F.min(_AT).alias(_AT), total.alias(_TOTAL)), "ranges")
    # One bound per range reaches the driver, as text, and comes back as a constant.
    lows = cells.groupBy("__part").agg(F.min(_AT).alias(_AT))
    text, count = lows.agg(F.to_json(F.sort_array(F.collect_list(_AT)), _JSON), F.count(F.lit(1))).first()
    bounds = F.from_json(F.lit(text), ArrayType(narrow.schema[_AT].dataType), _JSON)
    cells = cells.withColumn(_RANGE, _range_of(F.col(_AT), bounds, count))
    return _range_of(F.struct(*keys, *order), bounds, count), cells, max(count, 1)


def in_ranges(
    df: DataFrame,
    *,
    name: str,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    combine: Callable[[str], Column],
    initial: DataFrame | None = None,
    ranges: int | None = None,
) -> tuple[DataFrame, str]:
    """running_before, dealt to one task per range, and the column that holds the number of the range: rows of the same
    keys and range are in the same task, so grouping by them moves nothing."""
    order = [c for c in order if c not in keys]
    marked = df.withColumn(_VALUE, value)
    range_of, cells, count = _cut(marked, keys, order, combine(_VALUE), ranges)
    totals = cells.select(*keys, _RANGE, _TOTAL)
    if initial is not None:
        # NULL sorts before all ranges.
        totals = totals.unionByName(initial.toDF(*keys, _TOTAL).withColumn(_RANGE, F.lit(None).cast("int")))
    earlier_ranges = W.partitionBy(*keys).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    carries = totals.select(
        *keys, _RANGE, combine(_TOTAL).over(earlier_ranges).alias(_VALUE), F.lit(0).alias(_IS_ROW)
    ).filter(F.col(_VALUE).isNotNull() & F.col(_RANGE).isNotNull())
    rows = marked.withColumns({_RANGE: range_of, _IS_ROW: F.lit(1)})
    dealt = rows.unionByName(carries, allowMissingColumns=True).repartitionById(count, F.col(_RANGE))
    earlier_rows = W.partitionBy(*keys, _RANGE).orderBy(_IS_ROW, *order).rowsBetween(W.unboundedPreceding, -1)
    running = (
        dealt.withColumn(name, combine(_VALUE).over(earlier_rows)).filter(F.col(_IS_ROW) == 1).drop(_VALUE, _IS_ROW)
    )
    return running, _RANGE


def running_before(df: DataFrame, **options) -> DataFrame:
    """Adds column `name`: `combine` of `value` over all earlier rows of the same keys, NULL for the first.

    Options are those of in_ranges. `combine` has to be associative and commutative, as max and sum are. `initial` holds
    one row (keys, value) per key for what came before all rows. `ranges` defaults to what suits the size of keys and order.
    The keys, the order and the value of df are read once more than its rows, when this function is called.
    """
    running, number = in_ranges(df, **options)
    return running.drop(number)


def numbered_in_ranges(
    df: DataFrame,
    *,
    name: str,
    keys: Sequence[str],
    order: Sequence[str],
    initial: DataFrame | None = None,
    ranges: int | None = None,
) -> tuple[DataFrame, str]:
    """position_in_order, and the column of the range as in in_ranges. initial: (keys, number of rows) that went before."""
    numbered, number = in_ranges(
        df, name=name, keys=keys, order=order, value=F.lit(1).cast("bigint"), combine=F.sum, initial=initial, ranges=ranges
    )
    return numbered.withColumn(name, F.coalesce(name, F.lit(0))), number


def position_in_order(
    df: DataFrame, *, name: str, keys: Sequence[str], order: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Adds column `name`: the zero-based place of each row among the rows of the same keys."""
    numbered, number = numbered_in_ranges(df, name=name, keys=keys, order=order, ranges=ranges)
    return numbered.drop(number)
