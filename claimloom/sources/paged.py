"""A paged record store as a data source: pages are read in parallel, one partition for a range of pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def paged_source(name: str, ddl: str, fetch: Callable[[int, int], list[tuple]], pages: int, page_size: int = 100, per_partition: int = 5) -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``.

    ``fetch(page, size)`` returns the rows of a page, fewer than ``size`` on the last one; ``pages`` is the
    number of pages to share out; a store that has more is an error, not a shorter result.  Only columns of ``ddl`` are asked for, so a one-field scan stays a one-field scan.  An error in
    ``fetch`` fails the task, which Spark retries; rows are never silently missing.
    """

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [PageRange(i, min(i + per_partition, pages)) for i in range(0, pages, per_partition)]

        def read(self, partition: PageRange) -> Iterator[tuple]:
            for page in range(partition.first, partition.last):
                rows = fetch(page, page_size)
                yield from rows
                if len(rows) < page_size:
                    return
                if page == pages - 1 and fetch(pages, page_size):
                    raise RuntimeError(f"the store has more than {pages} pages; rows would be missing")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ddl

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    return Source
