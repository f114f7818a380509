"""Command-line forms of tables: a directory, `table:<catalog name>`, or `format:<data source>`."""

from __future__ import annotations

import argparse

from tripmill.sources.tables import ConnectorTable, SnapshotTable


def add_table_argument(
    parser: argparse.ArgumentParser, name: str, help_text: str, required: bool = True
) -> None:
    parser.add_argument(f"--{name}", required=required, help=help_text)
    parser.add_argument(
        f"--{name}-option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help=f"option of the data source when --{name} is format:<data source>",
    )


def parts(args: argparse.Namespace, name: str) -> tuple[str, str, dict[str, str]]:
    """Kind (`path`, `table` or `format`), text and options of a table argument."""
    key = name.replace("-", "_")
    value = getattr(args, key)
    pairs = (option.partition("=") for option in getattr(args, f"{key}_option"))
    options = {option: text for option, _, text in pairs}
    kind, _, rest = value.partition(":")
    return (kind, rest, options) if kind in ("table", "format") else ("path", value, options)


def table_argument(args: argparse.Namespace, name: str) -> SnapshotTable | ConnectorTable:
    kind, text, options = parts(args, name)
    if kind == "table":
        return ConnectorTable(name=text)
    if kind == "format":
        return ConnectorTable(format=text, options=options)
    return SnapshotTable(text)
