"""Pages of an interface that is read with a cursor, as a stream.

A page is a folder `page=<number>` of files with one JSON object a line; its last line
says that the page is whole (`{"end": <rows>}`). Pages come in the order of their numbers, but
one may be missing for a while or torn: the cursor stops before it until it is whole, so that
no row is skipped. The cursor is the stream's offset; the checkpoint keeps it, and a run that
was stopped goes on behind the last page that it has committed.

The driver looks at the ends of pages only; the pages are read by tasks, each its own ones.
Rows may come again, in the same or in a later version: see `payloads.dedupe_pages`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tradewind.sources.payloads import dedupe_pages, next_cursor
from tradewind.streaming.run import drain_append

TAIL = 256  # bytes in which the last line of a page is looked for


def _files(path: str, page: int) -> tuple[fs.FileSystem, list[str]]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found = system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/page={page}", allow_not_found=True))
    return system, sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def is_whole(path: str, page: int) -> bool:
    """The last line of the page's last file tells its end."""
    system, files = _files(path, page)
    if not files:
        return False
    with system.open_input_file(files[-1]) as file:
        size = file.size()
        tail = file.read_at(min(size, TAIL), max(size - TAIL, 0))
    last = tail.rstrip(b"\n").rsplit(b"\n", 1)[-1]
    try:
        return "end" in json.loads(last)
    except ValueError:
        return False


class _Pages(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        super().__init__(first)
        self.first, self.last = first, last


class _PageReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.path = schema, options["path"]
        self.per_task, self.per_batch = int(options.get("pagespertask", 8)), int(options.get("pagesperbatch", 512))
        self.first = self.cursor = int(options.get("cursor", 0))

    def initialOffset(self) -> dict:
        return {"cursor": self.first}

    def latestOffset(self) -> dict:
        """The first page from the cursor on that is missing or torn."""
        for _ in range(self.per_batch):
            if not is_whole(self.path, self.cursor):
                break
            self.cursor += 1
        return {"cursor": self.cursor}

    def partitions(self, start: dict, end: dict) -> list[_Pages]:
        self.cursor = max(self.cursor, end["cursor"])
        return [_Pages(at, min(at + self.per_task, end["cursor"])) for at in range(start["cursor"], end["cursor"], self.per_task)]

    def commit(self, end: dict) -> None:
        self.cursor = max(self.cursor, end["cursor"])

    def read(self, partition: _Pages) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        for page in range(partition.first, partition.last):
            system, files = _files(self.path, page)
            for k, path in enumerate(files, 1):
                with system.open_input_stream(path) as file:
                    lines = [line for line in file.read().decode("utf-8", "replace").split("\n") if line.strip()]
                lines = lines[:-1] if k == len(files) else lines
                yield pa.RecordBatch.from_arrays([pa.array([page] * len(lines), pa.int64()), pa.array(lines, pa.string())], schema=schema)


class PageSource(DataSource):
    """Format `pages`: the lines of all pages. Options: path, cursor (first page), pagesPerTask, pagesPerBatch."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "page bigint, line string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _PageReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_pages(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """A stream over the pages; `ddl` names the fields of a row, and `page` is added. A line that is no JSON object has nulls only."""
    spark.dataSource.register(PageSource)
    lines = spark.readStream.format("pages").options(path=path, **options).load()
    return lines.select(F.from_json("line", ddl).alias("row"), "page").select("row.*", "page")


def ingest_pages(spark: SparkSession, path: str, target: str, ddl: str, key: list[str], version: list[str], **options: str) -> tuple[DataFrame, DataFrame]:
    """Read all whole pages behind the cursor; returns (latest version of each key so far, the cursor to go on from)."""
    rows = drain_append(read_pages(spark, path, ddl, **options), target)
    return dedupe_pages(rows.drop("page"), key, version), next_cursor(rows, "page", F.lit(0).cast("bigint"))


def write_pages(rows: DataFrame, path: str, page: str) -> None:
    """Write rows as pages by their column `page`, each with its last line; what stands for the interface in tests and queries."""
    body = rows.select(F.col(page).alias("page"), F.lit(0).alias("__last"), F.to_json(F.struct(*[c for c in rows.columns if c != page])).alias("value"))
    ends = rows.groupBy(F.col(page).alias("page")).agg(F.count("*").alias("end")).select("page", F.lit(1).alias("__last"), F.to_json(F.struct("end")).alias("value"))
    lines = body.unionByName(ends).repartition("page").sortWithinPartitions("page", "__last")
    lines.select("page", "value").write.mode("append").partitionBy("page").text(path)


def tear_page(path: str, page: int) -> bytes:
    """Leave half of a page, as a response that breaks off; returns what it held."""
    system, files = _files(path, page)
    with system.open_input_stream(files[-1]) as file:
        raw = file.read()
    with system.open_output_stream(files[-1]) as file:
        file.write(raw[: len(raw) // 2])
    return raw


def mend_page(path: str, page: int, raw: bytes) -> None:
    system, files = _files(path, page)
    with system.open_output_stream(files[-1]) as file:
        file.write(raw)
