"""As-of join: each row meets the latest version of its key that is not later than itself.

Two physical forms with the same result:

* the versions fit the broadcast budget: each key's versions are one sorted array in a broadcast
  table, and the rows are not moved;
* they do not: rows and versions are merged in one order of key and time, cut into ranges, and the
  last version seen is carried along, over the borders of ranges too. A key that holds a third of all
  rows spans many ranges by its times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.lookup import BroadcastBudget
from tripmill.operators.sequence import in_parts, latest_value
from tripmill.operators.survivors import greatest_first, pick_survivor


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    since: str,
    name: str,
    budget: BroadcastBudget = BroadcastBudget(),
) -> DataFrame:
    """The rows with `name`: a struct of `since` and the other columns of the version that holds.

    Rows and versions share the column `key`; `at` and `since` are compared as timestamps. A version
    holds from `since` on, until the key's next one. Of versions of one key and time the greatest by
    the other columns, in their order, counts. Rows without key or time, and rows before their key's
    first version, get null; versions without key or time hold for none. Every row stays, once.
    """
    others = [c for c in versions.columns if c not in (key, since)]
    dated = versions.withColumn(since, F.col(since).cast("timestamp"))
    dated = dated.filter(F.col(key).isNotNull() & F.col(since).isNotNull())
    dated = pick_survivor(dated, [key, since], greatest_first(others))
    held = F.struct(since, *others)
    fits = budget.admits(dated)
    form = _by_broadcast if fits else _by_merging
    return form(rows, dated, held, key, at, since, name)


def _by_broadcast(
    rows: DataFrame, dated: DataFrame, held: Column, key: str, at: str, since: str, name: str
) -> DataFrame:
    history = dated.groupBy(F.col(key).alias("_key")).agg(
        F.array_sort(F.collect_list(held)).alias("_history")
    )
    time = F.col(at).cast("timestamp")
    joined = rows.join(F.broadcast(history), F.col(key) == F.col("_key"), "left")
    until = F.filter("_history", lambda version: version[since] <= time)
    match = F.when(time.isNotNull(), F.try_element_at(until, F.lit(-1)))
    return joined.select(*rows.columns, match.alias(name))


def _by_merging(
    rows: DataFrame, dated: DataFrame, held: Column, key: str, at: str, since: str, name: str
) -> DataFrame:
    kind = rows.select(F.struct(*rows.columns).alias("row")).schema["row"].dataType
    version = dated.select(held.alias("v")).schema["v"].dataType
    left = rows.select(
        F.col(key).alias("_key"),
        F.col(at).cast("timestamp").alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*rows.columns).alias("_row"),
        F.lit(None).cast(version).alias("_version"),
    )
    right = dated.select(
        F.col(key).alias("_key"),
        F.col(since).alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(kind).alias("_row"),
        held.alias("_version"),
    )
    # Versions come before rows of their time; equal rows are told apart, so none fill one range.
    merged = left.unionByName(right).withColumn("_tie", F.monotonically_increasing_id())
    order = [F.asc(c) for c in ("_key", "_at", "_side", "_tie")]
    parted = in_parts(merged, order, "as-of")
    known = latest_value(parted, ["_key"], order[1:], F.col("_version"), "_known")
    match = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.col("_known"))
    return known.filter("_side = 1").select("_row.*", match.alias(name))
