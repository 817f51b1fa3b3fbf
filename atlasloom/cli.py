"""python -m atlasloom.cli COMMAND ...: one sub-command per dataflow. Exit status 2 for what the operator can mend, 1 for the rest."""

from __future__ import annotations

import argparse
import json
import sys

from .plans import dataflows, imports, statistics
from .session import local_session

_LOGIN = {"token": str, "user": str, "password": str, "retries": int}
_ITEMS = {"indicators": list, "data_elements": list, "data_sets": list}
COMMANDS = {
    "transform": (dataflows.transform, {"snapshot": str, "out": str}, {"country": str, "row_group_size": int, "partition_by": str, "keep_without_geometry": bool}),
    "inspect": (dataflows.inspect, {"out": str}, {}),
    "extract": (dataflows.extract, {"server": str, "snapshot": str}, {"full": bool, "since": str, "token": str, "concurrency": int, "retries": int, "max_failures": int, "cache_dir": str, "refresh": bool}),
    "export": (dataflows.export, {"server": str, "types": list, "out": str}, {"token": str}),
    "diff": (dataflows.diff, {"snapshot": str, "given": str, "out": str}, {}),
    "load": (dataflows.load, {"given": str}, {"server": str, "dry_run": bool, "batch_size": int, "concurrency": int, "token": str, "retries": int}),
    "index": (dataflows.index, {"snapshot": str, "cells": list, "out": str}, {"refresh": bool}),
    "population": (dataflows.population, {"snapshot": str, "raster_path": str, "level": int, "year": int, "out": str}, {"source": str}),
    "run": (imports.run, {"server": str, "snapshot": str, "out": str}, {"country": str, "row_group_size": int, "partition_by": str, "keep_without_geometry": bool, "full": bool, "since": str, "token": str, "concurrency": int, "retries": int, "max_failures": int, "cache_dir": str, "refresh": bool}),
    "bake": (imports.bake, {"given": str, "country": str, "levels": list, "out": str}, {"alias": list, "system": str, "dissolve": bool}),
    "bake-points": (imports.bake_points, {"given": str, "admins": str, "kind": str, "out": str}, {"id_col": str, "name_col": str, "lat_col": str, "lon_col": str, "parent": list, "identifier": list, "where": list, "cells": list, "types": list, "paired": bool}),
    "units": (statistics.units, {"server": str, "instance": str, "out": str}, {"facility_level": int, "prefix": str, "root": str, **_LOGIN}),
    "measures": (statistics.measures, {"server": str, "instance": str, "out": str}, {**_ITEMS, "indicator_groups": list, "data_element_groups": list, **_LOGIN}),
    "reports": (statistics.reports, {"server": str, "instance": str, "locations": str, "out": str, "levels": [int]}, {"periods_": list, "ranges": list, "source": str, **_ITEMS, "breakdowns": list, "root": str, "campaign": str, "chunk": int, "max_rows": int, "updated_since": str, "previous": str, "changed": str, "removed": str, "checkpoint": str, **_LOGIN}),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="atlasloom")
    below = top.add_subparsers(dest="command", required=True)
    for name, (_, needed, more) in COMMANDS.items():
        own = below.add_parser(name)
        for fields, required in ((needed, True), (more, False)):
            for field, kind in fields.items():
                flag = f"--{field.strip('_').replace('_', '-')}"
                if kind is bool:
                    own.add_argument(flag, action="store_true", default=argparse.SUPPRESS)
                elif kind is list or isinstance(kind, list):
                    more = {} if required else {"default": argparse.SUPPRESS}
                    own.add_argument(flag, dest=field, action="append", required=required, type=str if kind is list else kind[0], **more)
                else:
                    own.add_argument(flag, type=kind, required=required, default=argparse.SUPPRESS)
        own.add_argument("--report")
    return top


def main(argv: list[str] | None = None) -> int:
    args = vars(parser().parse_args(argv))
    command, report = args.pop("command"), args.pop("report")
    spark = local_session()
    try:
        found = COMMANDS[command][0](spark, **args)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    text = json.dumps(found, ensure_ascii=False, indent=2, default=str)
    if report:
        with open(report, "w") as f:
            f.write(text)
    else:
        print(text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
