"""The gold marts from the trip fact: as a whole, or only the dates with new loads."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripmill.jobs.arguments import add_table_argument, parts, table_argument
from tripmill.plans.refresh import (
    AuditFailed,
    build_marts,
    catalog_marts,
    connector_marts,
    partitioned_marts,
    refresh_logs,
    refresh_touched_dates,
)
from tripmill.session import job_session
from tripmill.sources.tables import ConnectorTable, SnapshotTable, declare
from tripmill.streaming.sink import fact_table


def gold_targets(args: argparse.Namespace):
    kind, text, options = parts(args, "gold")
    if kind == "table":
        return catalog_marts(text)
    if kind == "format":
        return connector_marts(text, options)
    return partitioned_marts(text)


def audit_table(args: argparse.Namespace) -> ConnectorTable | None:
    if args.audit is None:
        return None
    table = table_argument(args, "audit")
    if isinstance(table, SnapshotTable):
        return ConnectorTable(format="parquet", options={"path": table.path})
    return table


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_table_argument(parser, "fact-trip", "trip fact to read")
    add_table_argument(
        parser, "gold", "where the marts go: a directory, table:<schema>, or format:<data source>"
    )
    add_table_argument(parser, "audit", "table to append audit lines to", required=False)
    parser.add_argument("--tag", action="append", help="marts to build; default gold")
    parser.add_argument(
        "--incremental", action="store_true", help="only dates loaded since the last run"
    )
    args = parser.parse_args(argv)
    tags = args.tag or ["gold"]
    source, gold_kind = table_argument(args, "fact-trip"), parts(args, "gold")[0]
    if args.incremental and (isinstance(source, ConnectorTable) or gold_kind != "path"):
        parser.error("--incremental needs the fact and the marts as directories")
    spark = job_session("build-marts")
    if isinstance(source, SnapshotTable):
        source = fact_table(source.path)
    try:
        if isinstance(source, ConnectorTable) or gold_kind != "path":
            declare(spark, "fact_trip", source.read(spark))
            facts = spark.table("fact_trip")
            build_marts(facts, gold_targets(args), tags, audit_table(args)).show(truncate=False)
            return
        dates = refresh_touched_dates(
            spark,
            source,
            refresh_logs(args.gold),
            gold_targets(args),
            tags,
            audit_table(args),
            everything=not args.incremental,
        )
        print(f"{len(dates)} dates refreshed")
    except AuditFailed as failed:
        raise SystemExit(f"audit failed, old rows kept: {failed}") from failed


if __name__ == "__main__":
    main()
