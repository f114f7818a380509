"""Landed trip files to the trip fact, continuously or until all of them are loaded."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripmill.jobs.arguments import add_table_argument, table_argument
from tripmill.session import job_session
from tripmill.sources.tables import ConnectorTable
from tripmill.streaming.job import start_trip_stream
from tripmill.streaming.sink import AppendSink, TripSink, fact_table, quarantine_table


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input-path", required=True, help="landing directory of trip files")
    parser.add_argument("--checkpoint-path", required=True)
    add_table_argument(parser, "fact-trip", "trip fact: a directory, or a table to append to")
    add_table_argument(parser, "quarantine", "rows without a trip id, in the same form")
    add_table_argument(parser, "dim-station", "station dimension to look up")
    parser.add_argument("--processing-time", default="30 seconds")
    parser.add_argument(
        "--trigger-once",
        action="store_true",
        help="load what has landed, in bounded batches, and end",
    )
    limit = parser.add_mutually_exclusive_group()
    limit.add_argument("--max-files", type=int, default=1000, help="files per micro-batch")
    limit.add_argument("--max-bytes", type=int, help="bytes per micro-batch")
    parser.add_argument(
        "--watermark-delay",
        help="de-duplicate within this delay in the stream instead of against the fact",
    )
    parser.add_argument(
        "--match-any-date",
        action="store_true",
        help="look up known trip ids in the whole fact, for re-sent trips that change their date",
    )
    parser.add_argument("--file-glob", help="names of landed files to read; default all")
    parser.add_argument("--preview", type=int, default=0, help="rows to show after each batch")
    args = parser.parse_args(argv)
    fact, quarantine = (table_argument(args, name) for name in ("fact-trip", "quarantine"))
    stations = table_argument(args, "dim-station").read
    if isinstance(fact, ConnectorTable) != isinstance(quarantine, ConnectorTable):
        parser.error("--fact-trip and --quarantine must both be directories or both be tables")
    if isinstance(fact, ConnectorTable):
        if args.match_any_date:
            parser.error("--match-any-date has no effect on tables that are only appended to")
        sink = AppendSink(fact, quarantine, stations, preview_rows=args.preview)
    else:
        sink = TripSink(
            fact_table(fact.path),
            quarantine_table(quarantine.path),
            stations,
            skip_known=args.watermark_delay is None,
            match_dates=not args.match_any_date,
            preview_rows=args.preview,
        )
    spark = job_session("stream-trips")
    start_trip_stream(
        spark,
        args.input_path,
        args.checkpoint_path,
        sink,
        processing_time=None if args.trigger_once else args.processing_time,
        watermark_delay=args.watermark_delay,
        max_files=args.max_files,
        max_bytes=args.max_bytes,
        **({"pathGlobFilter": args.file_glob} if args.file_glob else {}),
    ).awaitTermination()


if __name__ == "__main__":
    main()
