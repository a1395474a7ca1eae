"""A paginated search source as a Python data source; a directory of JSON pages stands for the service."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Page(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PagedReader(DataSourceReader):
    """A partition for each page, up to the cap of all rows; column cuts are up to the caller."""

    def __init__(self, options: dict):
        self.root, self.most = Path(options["path"]), int(options.get("max_rows", 1_000_000))
        self.page_size = int(options.get("page_size", 100))

    def partitions(self) -> list[Page]:
        pages = sorted(self.root.glob("*.json"))
        return [Page(str(p)) for p in pages[: -(-self.most // self.page_size)]]

    def read(self, partition: Page) -> Iterator[tuple]:
        for row in json.loads(Path(partition.path).read_text())["results"][: self.page_size]:
            yield (row.get("id"), json.dumps(row, sort_keys=True, ensure_ascii=False))


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string, body string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)
