"""Writing the marts: as a whole or for the dates with new loads, audited before they are seen."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.checks import non_null_audit, unique_audit
from tripmill.plans.marts import Mart, marts_tagged
from tripmill.sources.tables import (
    ConnectorTable,
    PartitionedTable,
    SnapshotTable,
    date_texts,
    delete_path,
    directories,
    partition_name,
    rebalanced,
)
from tripmill.streaming.sink import LOAD_BATCH, load_table

MART_PARTITION = ("trip_date",)
GRAIN = {"mart_station_daily_activity": ("trip_date", "station_id")}


class AuditFailed(Exception):
    """Blocking violations; the marts that have them kept their old rows."""


def partitioned_marts(root: str) -> Callable[[Mart], PartitionedTable]:
    """Marts as directories by date: the one layout of full and of incremental refreshes."""
    return lambda mart: PartitionedTable(f"{root}/{mart.name}", mart.schema, MART_PARTITION)


def refresh_logs(root: str) -> Callable[[Mart], SnapshotTable]:
    """For each mart the loads it has seen; a refresh adds those it has seen first."""
    return lambda mart: SnapshotTable(f"{root}/_refresh_log/{mart.name}")


def catalog_marts(schema: str) -> Callable[[Mart], ConnectorTable]:
    return lambda mart: ConnectorTable(f"{schema}.{mart.name}", partition_by=MART_PARTITION)


def connector_marts(source: str, options: Mapping[str, str]) -> Callable[[Mart], ConnectorTable]:
    """Marts behind a data source; `{mart}` in an option stands for the mart's name."""

    def target(mart: Mart) -> ConnectorTable:
        named = {key: text.replace("{mart}", mart.name) for key, text in options.items()}
        return ConnectorTable(format=source, options=named)

    return target


def audit_mart(mart: Mart, table: DataFrame) -> DataFrame:
    """Nulls in the declared columns, and repeated keys where the grain is not the group itself.

    Nulls block the mart. A repeated key does not: it tells that a station was renamed within a
    date, whose rows are right for either name.
    """
    audit = non_null_audit(table, mart.name, mart.non_null)
    if mart.name in GRAIN:
        audit = audit.unionByName(unique_audit(table, mart.name, GRAIN[mart.name]))
    return audit


def audit_fact(facts: DataFrame) -> DataFrame:
    """Trip ids that occur more than once in the stored fact, which a single writer never leaves."""
    return unique_audit(facts, "fact_trip", ("trip_id",))


def store_audit(lines: DataFrame, target: ConnectorTable) -> None:
    target.append(lines.withColumn("run_dt", F.current_timestamp()))


class _Audits:
    """Audit lines of a run; stored whatever they say."""

    def __init__(self, target: ConnectorTable | None):
        self.target, self.lines, self.failed = target, [], []

    def passes(self, mart: Mart, table: DataFrame) -> bool:
        """Audits a mart that no reader sees yet."""
        rows = audit_mart(mart, table).collect()
        lines = table.sparkSession.createDataFrame(
            rows, "check_name STRING, column_name STRING, violations BIGINT"
        )
        self.lines.append(lines)
        if self.target is not None:
            store_audit(lines, self.target)
        nulls = [
            f"{row['check_name']}.{row['column_name']}: {row['violations']} nulls"
            for row in rows
            if row["column_name"] in mart.non_null and row["violations"]
        ]
        self.failed += nulls
        return not nulls

    def result(self) -> DataFrame:
        if self.failed:
            raise AuditFailed("; ".join(self.failed))
        return reduce(DataFrame.unionByName, self.lines)


def publish(
    spark: SparkSession,
    mart: Mart,
    rows: DataFrame,
    target: PartitionedTable | ConnectorTable,
    audits: _Audits,
    dates: list[str | None] | None = None,
) -> bool:
    """Rows of a mart into its table if they pass the audit: all dates, or just the given ones.

    They are computed once, into a staging directory beside the table (or, for a connector's table,
    into memory and disk), audited there, and then take the place of the dates' old rows.
    """
    if isinstance(target, ConnectorTable):
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            passed = audits.passes(mart, rows)
            if passed:
                target.replace(rebalanced(rows, *MART_PARTITION))
            return passed
        finally:
            rows.unpersist()
    name = f"{target.path}_staged/{uuid.uuid4().hex}"
    staged = PartitionedTable(name, target.schema, target.partition_by)
    staged.replace_partitions(rebalanced(rows, *MART_PARTITION))
    try:
        table = staged.read(spark)
        if not audits.passes(mart, table):
            return False
        # Every staged file is of one date and of a good size, so the rows need no second exchange.
        target.replace_partitions(table)
        written = {n for n in directories(spark, staged.path) if n.startswith("trip_date=")}
        present = {n for n in directories(spark, target.path) if n.startswith("trip_date=")}
        if dates is not None:
            present &= {partition_name("trip_date", date) for date in dates}
        target.drop_slices(spark, sorted(present - written))
        return True
    finally:
        staged.drop(spark)


def tagged_or_raise(tags: Iterable[str]) -> list[Mart]:
    marts = marts_tagged(tags)
    if not marts:
        raise LookupError(f"no mart carries any of the tags {sorted(set(tags))}")
    return marts


def build_marts(
    facts: DataFrame,
    target_of: Callable[[Mart], PartitionedTable | ConnectorTable],
    tags: Iterable[str] = ("gold",),
    audit_target: ConnectorTable | None = None,
) -> DataFrame:
    """Refresh the tagged marts as a whole. Returns the audit lines.

    The lines are appended to `audit_target` when one is given. A mart with blocking violations
    keeps its old rows; the others are written, and then `AuditFailed` is raised.
    """
    audits = _Audits(audit_target)
    for mart in tagged_or_raise(tags):
        publish(facts.sparkSession, mart, mart.build(facts), target_of(mart), audits)
    return audits.result()


def refresh_touched_dates(
    spark: SparkSession,
    fact: PartitionedTable,
    log_of: Callable[[Mart], SnapshotTable],
    target_of: Callable[[Mart], PartitionedTable],
    tags: Iterable[str] = ("gold",),
    audit_target: ConnectorTable | None = None,
    everything: bool = False,
) -> list[str | None]:
    """Recompute only the dates that received a load since each mart's last refresh.

    Distinct counts do not add up, so the unit is a whole date. What is new is found from the small
    table of loads and each mart's own log of what it has seen, so the fact is read for the touched
    dates alone, and marts of different tags may be refreshed at different times. A log becomes
    visible only after its mart: a failed refresh repeats its dates, and a load that lands meanwhile
    is taken by the next one. With `everything`, all dates are recomputed and logged. Returns the
    dates that some mart has recomputed.
    """
    audits, refreshed = _Audits(audit_target), set()
    loads = load_table(fact).read(spark).select("trip_date", "attempt", LOAD_BATCH)
    for mart in tagged_or_raise(tags):
        log = log_of(mart)
        seen = log.published(spark)
        before = spark.read.schema(loads.schema).parquet(*seen) if seen else loads.limit(0)
        unseen = loads.alias("now").join(
            before.alias("before"),
            F.expr(
                "now.trip_date <=> before.trip_date and now.attempt = before.attempt"
                " and now.load_batch = before.load_batch"
            ),
            "left_anti",
        )
        version = log.stage(unseen)
        new = spark.read.schema(loads.schema).parquet(version)
        dates = date_texts((loads if everything else new).select("trip_date"))
        if not dates:
            delete_path(spark, version)
            continue
        touched = fact.read(spark) if everything else fact.read_slices(spark, dates)
        if touched is not None:
            rows = mart.build(touched)
            if not publish(
                spark, mart, rows, target_of(mart), audits, None if everything else dates
            ):
                continue
            refreshed.update(dates)
        log.publish(spark, version)
    if audits.failed:
        audits.result()
    return sorted(refreshed, key=str)
