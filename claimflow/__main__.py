"""Month-end run: both reports for one period, to one or more destinations.

    python -m claimflow --extracts /shared/claims/extracts \\
        --reports /shared/claims/reports --reports /shared/claims/synced \\
        --rep-start 2022-01-01 [--rep-end 2026-02-28]

``--rep-end`` defaults to the last day of the previous month.  Each report is
written once per ``--reports`` folder under its period file name; the stage
audit gathered during the writes is printed as JSON lines.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .plans.acr import run_acr
from .plans.ocr import run_ocr
from .session import get_session
from .sources.entities import read_entities
from .sources.sinks import acr_file_name, ocr_file_name


def previous_month_end(today: dt.date) -> dt.date:
    return today.replace(day=1) - dt.timedelta(days=1)


def main(argv: list[str] | None = None) -> list[tuple[str, str, int]]:
    ap = argparse.ArgumentParser(prog="claimflow", description=__doc__.splitlines()[0])
    ap.add_argument("--extracts", required=True, help="folder with one sub-folder per object")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--reports", required=True, action="append", help="destination folder")
    ap.add_argument("--rep-start", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--rep-end", type=dt.date.fromisoformat, default=None)
    args = ap.parse_args(argv)
    rep_end = args.rep_end or previous_month_end(dt.date.today())
    spark = get_session()
    tables = read_entities(spark, args.extracts, args.format)
    folders = [f.rstrip("/") for f in args.reports]
    audit = run_ocr(tables, rep_end, [f"{f}/{ocr_file_name(rep_end)}" for f in folders])
    audit += run_acr(tables, args.rep_start, rep_end,
                     [f"{f}/{acr_file_name(args.rep_start, rep_end)}" for f in folders])
    for stage, metric, value in audit:
        print(json.dumps({"stage": stage, "metric": metric, "value": value}))
    return audit


if __name__ == "__main__":
    main(sys.argv[1:])
