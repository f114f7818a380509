"""Station CSV to the station dimension."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripmill.jobs.arguments import add_table_argument, table_argument
from tripmill.plans.dim_station import load_dim_station
from tripmill.session import job_session


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--station-path", required=True, help="station CSV file or directory")
    add_table_argument(parser, "dim-station", "dimension table to replace")
    parser.add_argument("--preview", type=int, default=0, help="rows to show after the load")
    args = parser.parse_args(argv)
    spark = job_session("load-stations")
    target = table_argument(args, "dim-station")
    load = load_dim_station(spark, args.station_path, target, args.preview)
    print(f"{load.raw_rows} station rows read, {load.stations} stations written")


if __name__ == "__main__":
    main()
