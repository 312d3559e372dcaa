"""Runs a query of the small language over files: python -m quern PATH QUERY [--compat] [--limit N]; rows as JSON lines."""

from __future__ import annotations

import argparse

from quern.plans import query as Q
from quern.session import local_session
from quern.sources import readers


def main(args: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quern", description=__doc__)
    ap.add_argument("path", help="Parquet or JSON lines")
    ap.add_argument("query")
    ap.add_argument("--compat", action="store_true", help="aggregates as the older engine gave them")
    ap.add_argument("--limit", type=int, default=1000, help="rows that are printed at most")
    given = ap.parse_args(args)
    spark = local_session("*")
    kind = readers.format_of(given.path.rstrip("/"))
    found = Q.execute(given.query, spark.read.json(given.path) if kind == "jsonl" else spark.read.parquet(given.path), compat=given.compat)
    for part in (found.groups, found.aggregations, found.records):
        if part is not None:
            for line in part.limit(given.limit).toJSON().toLocalIterator():
                print(line)
            return 0
    return 1


if __name__ == "__main__":
    raise SystemExit(main())
