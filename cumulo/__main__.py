"""Run registered queries as batch jobs.

    python -m cumulo list
    python -m cumulo run <query> --input DIR --output PATH [--format parquet] [--partition-by COL ...]
    spark-submit cumulo/__main__.py run <query> ...

The result is written with dynamic partition overwrite, so re-running a
job replaces only the partitions it produces.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cumulo")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one query and write its result")
    run.add_argument("query")
    run.add_argument("--input", required=True, help="directory with the input parquet tables")
    run.add_argument("--output", required=True, help="output path (shared storage on a cluster)")
    run.add_argument("--format", default="parquet")
    run.add_argument("--partition-by", nargs="*", default=[])
    run.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    a = ap.parse_args(argv)

    from cumulo.plans import registry
    registry.load_all()
    if a.cmd == "list":
        for name, fn in sorted(registry.QUERIES.items()):
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:28s} {doc[0] if doc else ''}")
        return 0

    from cumulo.session import build_session
    if a.query not in registry.QUERIES:
        print(f"unknown query {a.query!r}; see `python -m cumulo list`", file=sys.stderr)
        return 2
    spark = build_session(a.master, app=f"cumulo-{a.query}")
    df = registry.QUERIES[a.query](spark, a.input)
    w = df.write.mode("overwrite").format(a.format).option("partitionOverwriteMode", "dynamic")
    if a.partition_by:
        w = w.partitionBy(*a.partition_by)
    w.save(a.output)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
