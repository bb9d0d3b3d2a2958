"""Several tables committed at once: tasks write files, one manifest names them, and readers see what manifests name."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .paged import _opened


@dataclass
class Written(WriterCommitMessage):
    """table -> file and rows of one task"""

    files: dict[str, tuple[str, int]]


class TablesWriter(DataSourceWriter):
    """Rows (table, line). A task writes a file for each table it has rows of, below the folder of this run; commit() renames
    a manifest of the files of tasks that succeeded into place, abort() deletes the run's folder. A task that is tried
    again writes files of other names. Those of a failed attempt, or of tasks that still ran when the run was aborted, are
    named by nobody; swept() deletes their folders."""

    def __init__(self, options: dict):
        self.root, self.batch = options["path"], options["batch"]
        if not re.fullmatch(r"[\w-][\w.-]*", self.batch):
            raise ValueError(f"no batch to name a file by: {self.batch!r}")
        self.run = f"{self.batch}/{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, root = _opened(self.root)
        folder, own = f"{root}/_files/{self.run}", uuid.uuid4().hex
        streams, names, rows = {}, {}, {}
        try:
            for table, line in iterator:
                if table not in streams:
                    store.create_dir(folder, recursive=True)
                    names[table] = f"{self.run}/{table}-{own}.jsonl.gz"
                    streams[table] = store.open_output_stream(f"{root}/_files/{names[table]}")  # compressed, by its suffix
                    rows[table] = 0
                streams[table].write(line.encode() + b"\n")
                rows[table] += 1
        finally:
            for s in streams.values():
                s.close()
        return Written({table: (names[table], rows[table]) for table in names})

    def commit(self, messages: list) -> None:
        store, root = _opened(self.root)
        tables: dict[str, list] = {}
        for m in messages:
            for table, file in (m.files if m else {}).items():
                tables.setdefault(table, []).append(file)
        manifest = {"batch": self.batch, "run": self.run, "files": [{"table": t, "file": f, "rows": n} for t in sorted(tables) for f, n in sorted(tables[t])]}
        store.create_dir(f"{root}/_batches", recursive=True)
        own = f"{root}/_batches/.{uuid.uuid4().hex}"
        with store.open_output_stream(own, compression=None) as out:
            out.write(json.dumps(manifest).encode())
        store.move(own, f"{root}/_batches/{self.batch}.json")

    def abort(self, messages: list) -> None:
        store, root = _opened(self.root)
        folder = f"{root}/_files/{self.run}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class TablesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_tables"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TablesWriter(self.options)


def commit(spark: SparkSession, root: str, batch: str, **tables: DataFrame) -> None:
    """Writes a batch of several tables below root in one job; all of it appears at once, or nothing if any task fails for
    good. A batch that is committed again replaces itself, in all tables. Nulls are written."""
    if any(name.startswith(("_", ".")) for name in tables):
        raise ValueError("scans skip files whose names start with _ or .")
    lines = [df.select(F.lit(name).alias("table"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line")) for name, df in tables.items()]
    spark.dataSource.register(TablesSource)
    reduce(DataFrame.unionByName, lines).write.format("committed_tables").mode("append").option("path", root).option("batch", batch).save()


def _manifests(root: str) -> list[dict]:
    store, folder = _opened(root)
    named = [f.path for f in store.get_file_info(fs.FileSelector(f"{folder}/_batches", allow_not_found=True)) if f.path.endswith(".json")]
    found = []
    for path in sorted(named):
        with store.open_input_stream(path) as f:
            found.append(json.loads(f.read()))
    return found


def committed(spark: SparkSession, root: str, **schemas: str) -> dict[str, DataFrame]:
    """The tables, with a column `batch`, all by one reading of the manifests: a batch is in all of them or in none. What
    is committed later isn't seen. Only names of files come to the driver, as in any scan."""
    files = [f for m in _manifests(root) for f in m["files"]]
    out = {}
    for table, schema in schemas.items():
        paths = [f"{root}/_files/{f['file']}" for f in files if f["table"] == table]
        rows = spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)
        place = F.col("_metadata.file_path") if paths else F.lit("")
        out[table] = rows.select("*", F.regexp_extract(place, r"/_files/([^/]+)/[^/]+/[^/]+$", 1).alias("batch"))
    return out


def swept(root: str) -> int:
    """Deletes the folders of runs that no manifest names (replaced batches, drivers that died), and says how many. Not
    while a commit is under way."""
    store, folder = _opened(root)
    kept = {m["run"] for m in _manifests(root)}
    runs = [f.path for f in store.get_file_info(fs.FileSelector(f"{folder}/_files", recursive=True, allow_not_found=True)) if f.type == fs.FileType.Directory]
    runs = [r for r in runs if r.count("/") == folder.count("/") + 3 and r.removeprefix(f"{folder}/_files/") not in kept]
    for r in runs:
        store.delete_dir(r)
    return len(runs)
