"""A paged list service as a Spark data source, replayed from saved pages; some pages to a task."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith(("/", "file:")) else (fs.LocalFileSystem(), folder)
    return store, path.rstrip("/")


def _items(store: fs.FileSystem, path: str) -> Iterator[tuple]:
    """place, id, item and total of the items of a page; entries that are no objects are none."""
    with store.open_input_stream(path) as f:
        page = json.loads(f.read().decode("utf-8-sig"))
    total = page.get("total") if isinstance(page, dict) else None
    total = int(total) if isinstance(total, (int, float)) or isinstance(total, str) and total.isdecimal() else None
    for place, item in enumerate(page.get("items", []) if isinstance(page, dict) else page):
        if isinstance(item, dict):
            yield place, str(item.get("id") or ""), json.dumps(item, ensure_ascii=False), total


class PageRun(InputPartition):
    """Some pages, which one task reads: (day, number, path); no day where there are no folders of days."""

    def __init__(self, pages: list[tuple[str, int, str]]):
        super().__init__(pages[0][1] if pages else 0)
        self.pages = pages


def runs(pages: list[tuple[str, int, str]], options: dict) -> list[InputPartition]:
    """Pages dealt to tasks, `pagesPerTask` to each (64 if not said)."""
    most = int(options.get("pagesPerTask", 64))
    return [PageRun(pages[i : i + most]) for i in range(0, len(pages), most)]


class PagedReader(DataSourceReader):
    """Pages end at the first one that is missing; items come with the number of their page and their place on it."""

    def __init__(self, options: dict):
        self.options = dict(options)
        self.folder, self.pattern = options["path"], options.get("pattern", "page_{:05d}.json")

    def partitions(self) -> list[InputPartition]:
        store, folder = _opened(self.folder)
        there = {f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))}
        found, n = [], 1
        while (path := f"{folder}/{self.pattern.format(n)}") in there:
            found.append(("", n, path))
            n += 1
        return runs(found, self.options) or [PageRun([])]

    def read(self, partition: PageRun) -> Iterator[tuple]:
        store, _ = _opened(self.folder)
        for _, number, path in partition.pages:
            for place, i, item, total in _items(store, path):
                yield number, place, i, item, total


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "page int, place int, id string, item string, total int"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)


def listed(items: DataFrame, limit: int | None = None, old: Column | None = None, early_stop: bool = True, least_size: int = 5, most_size: int = 50) -> DataFrame:
    """Items as a listing would give them: the first of each id, none that is blank or `old`, and `limit` at most.

    Pages end where the total says so, for pages of as many items as were asked for (the limit, within the two sizes),
    and after a page all of whose items are old. That stop can miss an old document that was updated late;
    early_stop=False reads on. Only numbers of pages meet in one place.
    """
    size = min(max(limit or most_size, least_size), most_size)
    is_old = F.coalesce(old, F.lit(False)) if old is not None else F.lit(False)
    i = items.where(F.trim("id") != "").withColumn("is_old", is_old)
    pages = i.groupBy("page").agg(F.bool_and("is_old").alias("all_old"), F.max("total").alias("total"))
    ends = F.col("total").isNotNull() & (F.col("page") * size >= F.col("total"))
    stops = pages.where(ends | (F.col("all_old") if early_stop and old is not None else F.lit(False))).agg(F.min("page").alias("last"))
    kept = i.join(F.broadcast(stops)).where(F.col("last").isNull() | (F.col("page") <= F.col("last"))).where("NOT is_old")  # one row
    first = kept.groupBy("id").agg(F.min(F.struct("page", "place", "item")).alias("f")).select("f.page", "f.place", "id", "f.item")
    return first.orderBy("page", "place").limit(limit) if limit is not None else first
