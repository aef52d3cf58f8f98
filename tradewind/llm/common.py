"""What the operators share: Arrow tasks over columns, fixed-size statistics, labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Columns = Mapping[str, pa.Array]


def utf8_bytes() -> Column:
    """The bytes of `text`; a null text has none."""
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


def map_columns(df: DataFrame, ddl: str, task: Callable[[Iterator[Columns]], Iterable[Mapping]]) -> DataFrame:
    """Run `task` once per partition: batches of columns in, batches of columns (arrays or lists) out."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (dict(zip(b.schema.names, b.columns)) for b in batches)
        for out in task(columns):
            arrays = [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, ddl)


def id_and_bytes(docs: DataFrame, *more: Column) -> DataFrame:
    """`doc_id`, the UTF-8 bytes of the text (null: empty) as `text`, and further columns."""
    return docs.select("doc_id", utf8_bytes().alias("text"), *more)


def id_remainder(divisor: int) -> Column:
    """crc32 of the id's digits, modulo `divisor`: what splits labels into learning and held-out rows."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """At most `rows` labelled documents (`doc_id`, `text`, `label`), the first in the order of the ids' hashes.

    The ids are few by `rows`, so they are broadcast and the documents never move.
    Labels of one id that contradict each other count as the larger one.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return id_and_bytes(docs).join(F.broadcast(chosen), "doc_id")


BROADCAST_KEYS = 2_000_000


def rows_in(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose `on` is among `keys`, a written table without repetitions.

    Up to `BROADCAST_KEYS` keys go to the rows; more are joined by key, with the same result.
    """
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys.hint("shuffle_hash"), on, "left_semi")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
