"""python -m tidewell COMMAND: whole tasks from the command line."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tidewell import api
from tidewell.operators import audit, layout
from tidewell.session import SETTINGS


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidewell", description="Converts, merges, audits and reports on archives of JSON records.")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert", help="archives to sorted wide tables")
    c.add_argument("source")
    c.add_argument("out")
    c.add_argument("--only")
    c.add_argument("--force", action="store_true")
    c.add_argument("--first-lines", type=int, help="a test run of so many lines of each archive")
    m = sub.add_parser("merge", help="tables of one kind to one")
    m.add_argument("kind", choices=["rc", "rs"])
    m.add_argument("out")
    m.add_argument("paths", nargs="+")
    v = sub.add_parser("verify", help="tables against the master columns and their manifests")
    v.add_argument("folder")
    v.add_argument("--offset", type=int, default=0)
    v.add_argument("--limit", type=int)
    g = sub.add_parser("manifests", help="manifests from footers")
    g.add_argument("folder")
    g.add_argument("--full", action="store_true")
    r = sub.add_parser("report", help="progress and throughput")
    r.add_argument("folder")
    d = sub.add_parser("drift", help="columns and types over files")
    d.add_argument("paths", nargs="+")
    d.add_argument("--out", help="also write a JSON file, the rarest first")
    f = sub.add_parser("config", help="settings in layers, secrets hidden")
    f.add_argument("paths", nargs="+")
    f.add_argument("--validate", action="store_true")
    sub.add_parser("precheck", help="whether Spark and the shared folder work")
    a = p.parse_args(argv)
    if a.command == "convert" and a.force and not a.only:
        p.error("--force needs --only")

    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("tidewell")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if a.command == "convert":
        print(json.dumps(api.convert(spark, a.source, a.out, only=a.only, force=a.force, first_lines=a.first_lines), indent=1))
    elif a.command == "merge":
        print(json.dumps(layout.merge(spark, a.paths, a.kind, a.out)))
    elif a.command == "verify":
        got = api.verify(spark, a.folder, offset=a.offset, limit=a.limit).cache()
        got.show(1000, truncate=False)
        audit.tally(got).show()
        return int(not got.filter("status = 'failed'").isEmpty())
    elif a.command == "manifests":
        for row in api.manifests(spark, a.folder, full=a.full).toJSON().toLocalIterator():
            print(row)
    elif a.command == "report":
        for name, df in api.report(spark, a.folder, dt.datetime.now(dt.UTC).replace(tzinfo=None)).items():
            print(name)
            df.show(1000, truncate=False)
    elif a.command == "drift":
        api.drift(spark, a.paths, out=a.out).show(1000, truncate=False)
    elif a.command == "config":
        found = api.settings(*a.paths)
        api.shown(spark, found).show(1000, truncate=False)
        wrong = api.problems_of(found) if a.validate else []
        for problem in wrong:
            print(problem)
        return int(bool(wrong))
    else:
        from tidewell.session import cut

        print("Spark", spark.version, "rows", cut(spark.range(3).toDF("x")).count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
