"""python -m lotgraph extract PAGES OUT | query NAME DIR OUT | list"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import api
from .operators.keys import CATEGORIES
from .plans import catalog


def names(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lotgraph")
    commands = parser.add_subparsers(dest="command", required=True)
    extract = commands.add_parser("extract", help="pages to merged records")
    extract.add_argument("pages")
    extract.add_argument("out")
    extract.add_argument("--include", type=names)
    extract.add_argument("--exclude", type=names)
    query = commands.add_parser("query", help="run a registered query over a folder of tables")
    query.add_argument("name", choices=sorted(catalog.queries()))
    query.add_argument("folder")
    query.add_argument("out")
    commands.add_parser("list", help="names of the registered queries")
    given = parser.parse_args(argv)
    if given.command == "list":
        print("\n".join(sorted(catalog.queries())))
        return 0
    spark = SparkSession.builder.appName("lotgraph").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "query":
        catalog.queries()[given.name](spark, given.folder).write.mode("overwrite").parquet(given.out)
        return 0
    wanted = api.selected(given.include, given.exclude) if given.include or given.exclude else CATEGORIES
    api.process(api.load_documents(spark, given.pages), wanted).write.mode("overwrite").parquet(given.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
