"""Pages of files as a data source: partitions by file and range of pages, filters read only what they ask for.

What opens a file is given (there is no one library for all kinds): a reader with `files(path)`, names of the files
under a path; `count(path, name)`, pages of one; and `pages(path, name, first, last)`, its pages from first up to but
not with last, one after another. It goes to tasks with the source, so it must pickle.

    register(spark, reader)
    spark.read.format("pages").option("path", folder).load().filter("page_id < 3 and name = 'a.pdf'")

Spark hands filters over where spark.sql.python.filterPushdown.enabled is true; comparisons of page_id, and equality
of name, then narrow the ranges and are done. Files are counted on the driver as the scan is planned, after the
filter on names: a number each, as with any folder of files."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Pages of a partition at most.
RANGE = 64
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class PageReader(Protocol):
    def files(self, path: str) -> list[str]: ...

    def count(self, path: str, name: str) -> int: ...

    def pages(self, path: str, name: str, first: int, last: int) -> Iterator[bytes]: ...


@dataclass
class PageRange(InputPartition):
    name: str
    first: int
    last: int


class _Reader(DataSourceReader):
    def __init__(self, pages: PageReader, path: str, size: int):
        self.pages, self.path, self.size = pages, path, size
        self.low, self.high, self.names = 0, math.inf, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows the ranges; gives back what Spark has to look at itself."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("page_id",) and value is not None and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            elif column == ("name",) and value is not None and isinstance(f, (EqualTo, In)):
                asked = set(value) if isinstance(f, In) else {value}
                self.names = asked if self.names is None else self.names & asked
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        if self.low < self.high:
            for name in self.pages.files(self.path):
                if self.names is None or name in self.names:
                    last = int(min(self.high, self.pages.count(self.path, name)))
                    out += [PageRange(name, a, min(a + self.size, last)) for a in range(self.low, last, self.size)]
        return out or [PageRange("", 0, 0)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        if partition.first < partition.last:
            for k, content in enumerate(self.pages.pages(self.path, partition.name, partition.first, partition.last)):
                yield partition.name, partition.first + k, content


def register(spark: SparkSession, reader: PageReader, name: str = "pages") -> None:
    """Makes `name` a format of this session: (name, page_id, content) of the files under option `path`, in partitions of
    option `range` pages at most."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "name string, page_id int, content binary"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(reader, self.options["path"], max(1, int(self.options.get("range", RANGE))))

    spark.dataSource.register(Pages)
