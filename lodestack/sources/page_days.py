"""Pages of a list saved by the day of their crawl: a sink for pages as they come, and a stream over what is saved."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .paged import PageRun, _items, _opened, runs

PATTERN = "page_{:05d}.json"


class PageDays(DataSourceStreamReader):
    """The offset is the day and the number of the last page read. Days are folders below the path, in order; a day's pages
    end at the first that is missing. A batch is what lies between two offsets, so that a batch that failed, or a run that
    was stopped, reads the same pages again. Pages that are added to a day before that of the offset aren't read."""

    def __init__(self, options: dict):
        self.folder, self.options = options["path"], dict(options)

    def _saved(self, since: tuple[str, int] = ("", 0)) -> list[tuple[str, int, str]]:
        store, folder = _opened(self.folder)
        days = sorted(f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.type == fs.FileType.Directory)
        found = []
        for path in days:
            day = path.rsplit("/", 1)[1].removeprefix("day=")
            if day < since[0]:
                continue
            there, n = {f.path for f in store.get_file_info(fs.FileSelector(path))}, 1
            while (page := f"{path}/{PATTERN.format(n)}") in there:
                found.append((day, n, page))
                n += 1
        return found

    def initialOffset(self) -> dict:
        return {"day": "", "page": 0}

    def latestOffset(self) -> dict:
        saved = self._saved()
        return {"day": saved[-1][0], "page": saved[-1][1]} if saved else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, last = (start["day"], start["page"]), (end["day"], end["page"])
        return runs([p for p in self._saved(after) if after < p[:2] <= last], self.options)

    def read(self, partition: PageRun) -> Iterator[tuple]:
        store, _ = _opened(self.folder)
        for day, number, path in partition.pages:
            for place, key, item, total in _items(store, path):
                yield day, number, place, key, item, total


class PageWriter(DataSourceWriter):
    """Rows (day, page, body), in any order of columns; a page appears whole, by its renaming. A page that is written
    again, as by a task that is tried again, replaces itself. A page without a day lies in the path itself."""

    def __init__(self, options: dict, schema):
        self.folder = options["path"]
        self.columns = [schema.fieldNames().index(c) for c in ("day", "page", "body")]

    def write(self, iterator) -> WriterCommitMessage:
        store, folder = _opened(self.folder)
        for row in iterator:
            day, page, body = (row[k] for k in self.columns)
            if day and not re.fullmatch(r"[\w.-]+", day):
                raise ValueError(f"no day to name a folder by: {day!r}")
            into = f"{folder}/day={day}" if day else folder
            store.create_dir(into, recursive=True)
            own = f"{into}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own, compression=None) as out:
                out.write((body or "[]").encode())
            store.move(own, f"{into}/{PATTERN.format(page)}")
        return WriterCommitMessage()


class PageDaysSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "saved_page_days"

    def schema(self) -> str:
        return "day string, page int, place int, id string, item string, total int"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageDays(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return PageWriter(self.options, schema)


def save(pages: DataFrame, path: str) -> None:
    """Saves pages (day, page, body: the JSON text of a page) below path, a file each."""
    spark = pages.sparkSession
    spark.dataSource.register(PageDaysSource)
    pages.select("day", F.col("page").cast("int").alias("page"), "body").write.format("saved_page_days").mode("append").option("path", path).save()


def stream(spark: SparkSession, path: str, pages_per_task: int = 64) -> DataFrame:
    """day, page, place, id, item, total of the items of all pages that are saved below path and that will be."""
    spark.dataSource.register(PageDaysSource)
    return spark.readStream.format("saved_page_days").option("path", path).option("pagesPerTask", pages_per_task).load()
