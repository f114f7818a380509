"""Order-dependent values over rows that no single task could sort.

Rows are range-partitioned by an order, so that every row of one part comes before every row of the
next. What a part needs of the parts before it is a summary per part and key, which is small: a
running total, or the last row. One key's history may thus span many parts and tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.sources.workdir import new_workdir

PART = "_part"


def in_parts(
    df: DataFrame, order: Sequence[Column | str], purpose: str, parts: int | None = None
) -> DataFrame:
    """The rows stored with `_part`, the number of their range of the order.

    Rows equal in the whole order share a part, so the order should end in something that tells
    apart rows of which there may be very many. Storing them keeps a row's part the same when a
    lost task runs again.
    """
    path = new_workdir(df.sparkSession, purpose)
    dealt = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
    dealt = dealt.withColumn(PART, F.spark_partition_id())
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def _with_carried(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with `_carried` of their part and key, null where there is none; nulls are a key."""
    names = [PART, *keys]
    renamed = carried.select(*[F.col(k).alias(f"_of_{k}") for k in names], "_carried")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in names]
    return rows.join(renamed, reduce(lambda a, b: a & b, same), "left")


def running_total(
    parted: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, name: str
) -> DataFrame:
    """The rows of `in_parts` with `name`: the sum of `value` over the key's rows up to this one.

    Only one sum per part and key meets in a window of the key; each part is then summed by itself.
    The order must be the one of the parts, or one that agrees with it within a key.
    """
    rows = parted.withColumn("_value", value)
    sums = rows.groupBy(PART, *keys).agg(F.sum("_value").alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carried = sums.withColumn("_carried", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    carried = carried.filter("_carried <> 0")
    here = W.partitionBy(PART, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_here", F.sum("_value").over(here))
    joined = _with_carried(rows, carried, keys)
    total = F.col("_here") + F.coalesce("_carried", F.lit(0))
    return joined.select(*parted.columns, total.alias(name))


def previous_row(
    parted: DataFrame, keys: Sequence[str], order: Sequence[Column | str], row: Column, name: str
) -> DataFrame:
    """The rows of `in_parts` with `name`: the value of `row`, a struct, in the key's row before.

    Inside a part that is a plain lag. A key's first row of a part takes the last row of the latest
    earlier part that holds the key; those last rows, one per part and key, are all that meets in
    a window of the key.
    """
    rows = parted.withColumn("_row", row).withColumn(
        "_rank", F.row_number().over(W.partitionBy(PART, *keys).orderBy(*order))
    )
    lagged = F.lag("_row").over(W.partitionBy(PART, *keys).orderBy("_rank"))
    rows = rows.withColumn("_lag", lagged)
    lasts = rows.groupBy(PART, *keys).agg(F.max_by("_row", "_rank").alias("_last"))
    carried = lasts.withColumn(
        "_carried", F.lag("_last").over(W.partitionBy(*keys).orderBy(PART))
    ).filter("_carried is not null")
    joined = _with_carried(rows, carried, keys)
    before = F.when(F.col("_rank") == 1, F.col("_carried")).otherwise(F.col("_lag"))
    return joined.select(*parted.columns, before.alias(name))


def latest_value(
    parted: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, name: str
) -> DataFrame:
    """The rows of `in_parts` with `name`: the key's latest non-null `value` up to this row.

    What a part hands on is the last non-null value of each key, so later parts look back past parts
    without any.
    """
    rows = parted.withColumn("_value", value).withColumn(
        "_rank", F.row_number().over(W.partitionBy(PART, *keys).orderBy(*order))
    )
    here = W.partitionBy(PART, *keys).orderBy("_rank").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_here", F.last("_value", ignorenulls=True).over(here))
    known = F.when(F.col("_value").isNotNull(), F.col("_rank"))
    lasts = rows.groupBy(PART, *keys).agg(F.max_by("_value", known).alias("_last"))
    earlier = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carried = lasts.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
    joined = _with_carried(rows, carried.filter("_carried is not null"), keys)
    return joined.select(*parted.columns, F.coalesce("_here", "_carried").alias(name))
