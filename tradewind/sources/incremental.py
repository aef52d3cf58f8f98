"""Incremental extracts with a stored high-water mark that is committed together with the extract.

A store is a folder of commits, numbered without gaps, and a folder of extracts. A run

1. reads the newest commit and takes the source rows after its mark, and those of a stretch before it
   (`overlap`) that no earlier extract holds: rows that became visible late;
2. writes them into a folder of its own, which no commit names yet, and learns their newest value on the way;
3. commits folder and new mark in one step: it creates the commit with the next number, which
   only one run can. A run that finds the number taken has lost: what it wrote stays unseen.

So a run that dies before the third step leaves the mark and the table as they were, and the next
one extracts the same rows again. A run without new rows commits nothing.

The key and the marking column together say whether a row is known, so a row that changes, and with that
gets a newer value, comes again. A row without value cannot be placed and is taken once. Rows that
become visible later than by `overlap` are not found; choose it by the longest transaction.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tradewind.operators.history import high_water_mark, incremental_extract


class LostRace(RuntimeError):
    """Another run has committed the extract that this one was to follow."""


@dataclass(frozen=True)
class Commit:
    version: int
    folder: str
    mark: str | None
    rows: int


class ExtractStore:
    """Extracts of one source table below `root`."""

    def __init__(self, spark: SparkSession, root: str, column: str, keys: Sequence[str]) -> None:
        self.spark, self.root, self.column, self.keys = spark, root.rstrip("/"), column, list(keys)

    def commits(self) -> list[Commit]:
        """All commits, oldest first: one small file each."""
        folder, files = self._path("commits"), self._files()
        if not files.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith("."))
        return [Commit(**json.loads(row.value)) for row in self._read_text(names)]

    def _read_text(self, names: list[str]) -> list:
        if not names:
            return []
        paths = [os.path.join(self.root, "commits", n) for n in names]
        return sorted(self.spark.read.text(paths).collect(), key=lambda row: json.loads(row.value)["version"])

    def extract(self, source: DataFrame, overlap: str | int = 0, before_commit: Callable[[], None] | None = None) -> Commit | None:
        """One run; None if there is nothing new. `overlap`: an interval for times and dates, else a number.

        `before_commit` runs between write and commit, for a check that may refuse the extract by raising.
        """
        history = self.commits()
        last = history[-1] if history else None
        kind = source.schema[self.column].dataType
        mark = F.lit(last.mark if last else None).cast(kind)
        fresh = source
        if last is not None:
            low = self._less(mark, overlap, kind.typeName())
            later = incremental_extract(source, self.column, low) if last.mark is not None else source.where(F.col(self.column).isNotNull())
            # without a value a row has no place before or after the mark
            candidates = later.unionByName(source.where(F.col(self.column).isNull()))
            known = self.read(history)
            known = known.where(F.col(self.column).isNull() | (F.col(self.column) > low) | low.isNull()).select(*[F.col(c).alias(f"__{c}") for c in (*self.keys, self.column)])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*self.keys, self.column)])
            fresh = candidates.join(known, same, "left_anti").select(*source.columns)
        folder = f"data/{uuid.uuid4().hex}"
        seen = Observation()
        text = high_water_mark(self.column, mark).cast("string")
        fresh.observe(seen, F.count("*").alias("rows"), text.alias("mark")).write.parquet(os.path.join(self.root, folder))
        found = seen.get
        if not found.get("rows"):
            return None
        if before_commit is not None:
            before_commit()
        commit = Commit(last.version + 1 if last else 1, folder, found["mark"], found["rows"])
        self._commit(commit)
        return commit

    def read(self, history: Sequence[Commit] | None = None) -> DataFrame:
        """All committed rows, with the `version` that brought them."""
        history = self.commits() if history is None else history
        if not history:
            raise FileNotFoundError(f"nothing has been committed to {self.root}")
        folders = {c.folder.rsplit("/", 1)[1]: c.version for c in history}
        rows = self.spark.read.parquet(*[os.path.join(self.root, c.folder) for c in history])
        # the folder's name stands in the path of each file
        versions = self.spark.createDataFrame(list(folders.items()), "__folder string, version int")
        named = rows.withColumn("__folder", F.regexp_extract("_metadata.file_path", r"/data/([0-9a-f]{32})/", 1))
        return named.join(versions, "__folder").drop("__folder")

    def remove_uncommitted(self) -> int:
        """Remove extracts that no commit names; to be run while no extract is under way. Returns their number."""
        folder, files = self._path("data"), self._files()
        named = {c.folder.rsplit("/", 1)[1] for c in self.commits()}
        left = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() not in named] if files.exists(folder) else []
        for path in left:
            files.delete(path, True)
        return len(left)

    def _less(self, mark: Column, overlap: str | int, kind: str) -> Column:
        if not overlap:
            return mark
        less = mark - F.expr(f"INTERVAL {overlap}") if isinstance(overlap, str) else mark - F.lit(overlap)
        return less.cast(kind) if kind == "date" else less

    def _commit(self, commit: Commit) -> None:
        """Create the commit's file under its number: written aside and renamed, which fails if the name is taken."""
        jvm = self.spark.sparkContext._jvm
        aside, final = self._path(f"commits/.{uuid.uuid4().hex}.tmp"), self._path(f"commits/{commit.version:010d}.json")
        files = self._files()
        files.mkdirs(self._path("commits"))
        out = files.create(aside, False)
        out.write(bytearray(json.dumps(commit.__dict__).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            # fails if the target exists; the check tells of a loss before anything is moved
            if files.exists(final):
                raise LostRace(f"commit {commit.version} of {self.root} exists")
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._configuration()).rename(aside, final, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise LostRace(f"commit {commit.version} of {self.root} exists") from error
            raise
        finally:
            files.delete(aside, False)

    def _configuration(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self._configuration())
