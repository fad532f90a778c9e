"""A service's paged queue as a data source: one partition for each page, pages that a filter excludes are never asked for."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "page int, item string, stopped boolean"
TESTS = {
    EqualTo: lambda page, v: page == v, In: lambda page, v: page in v, LessThan: lambda page, v: page < v, LessThanOrEqual: lambda page, v: page <= v,
    GreaterThan: lambda page, v: page > v, GreaterThanOrEqual: lambda page, v: page >= v,
}


class Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class QueueReader(DataSourceReader):
    """Options: fetch (``module:function``, from run id and page number to a dict with items, total and pageSize, or None if the page can't be had), run_id."""

    def __init__(self, options: dict):
        module, _, name = options["fetch"].partition(":")
        self.target, self.run_id = (module, name), options["run_id"]
        self.filters: list[Filter] = []

    def fetch(self, page: int) -> dict | None:
        return getattr(importlib.import_module(self.target[0]), self.target[1])(self.run_id, page)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if type(f) in TESTS and f.attribute == ("page",):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Page]:
        """The first page tells how many there are; without it there are none. Only that answer reaches the driver."""
        first = self.fetch(1)
        if first is None or not isinstance(first.get("items"), list):
            return [Page(0)]
        total, size = int(first.get("total") or len(first["items"])), max(1, int(first.get("pageSize") or 100))
        wanted = [p for p in range(1, max(1, -(-total // size)) + 1) if all(TESTS[type(f)](p, f.value) for f in self.filters)]
        return [Page(p) for p in wanted] or [Page(0)]

    def read(self, partition: Page) -> Iterator[tuple]:
        """Rows of a page; one marked row if the page can't be had or is empty, as reading ends there."""
        if partition.number == 0:
            return
        data = self.fetch(partition.number)
        items = data.get("items") if data is not None else None
        if not isinstance(items, list) or not items:
            yield partition.number, None, True
            return
        for item in items:
            if isinstance(item, dict):
                yield partition.number, json.dumps(item, ensure_ascii=False), False


class RunQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "run_queue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> QueueReader:
        return QueueReader(self.options)


def read_queue(spark: SparkSession, fetch: str, run_id: str, pages: tuple[int, int] | None = None) -> DataFrame:
    """(page, item): the queue's rows in JSON, up to the first page that is missing or empty; if asked, of the pages from one number to another only.

    Pages are read side by side; those after the first that stops are dropped, as if one had been read after the other.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RunQueue)
    rows = spark.read.format("run_queue").option("fetch", fetch).option("run_id", run_id).load()
    if pages is not None:
        rows = rows.where(F.col("page").between(*pages))
    stop = rows.where("stopped").agg(F.min("page")).first()[0]
    rows = rows.where("not stopped")
    return (rows if stop is None else rows.where(F.col("page") < stop)).select("page", "item")
