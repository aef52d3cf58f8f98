"""Event envelope, contract check, duplicates, dead letters and late data."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewind.operators.commerce import first_failure
from tradewind.streaming.run import drain_batches

# fixed values: the envelope of every event
ENVELOPE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("value", T.DecimalType(18, 2)),
        T.StructField("schema_version", T.IntegerType()),
    ]
)
KNOWN_VERSIONS = (1,)
KNOWN_TYPES = ("click", "error", "purchase", "signup", "view")


def parse_envelope(messages: DataFrame, column: str = "value") -> DataFrame:
    """Typed events from JSON messages, with the contract rule a message breaks."""
    wide = T.StructType([*ENVELOPE.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    reason = first_failure(
        (F.col("_corrupt").isNotNull(), "malformed"),
        (F.col("event_id").isNull() | F.col("event_time").isNull(), "incomplete"),
        (~F.coalesce(F.col("schema_version").isin(*KNOWN_VERSIONS), F.lit(False)), "unknown_version"),
        (~F.coalesce(F.col("event_type").isin(*KNOWN_TYPES), F.lit(False)), "unknown_type"),
    )
    flat = messages.select(F.col(column).alias("message"), parsed.alias("e")).select("message", "e.*")
    return flat.select("message", *ENVELOPE.names, reason.alias("reject_reason"))


def split_dead_letters(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Run a stream of checked messages; returns (good events, dead letters) as written."""
    good, dead = os.path.join(path, "good"), os.path.join(path, "dead")

    def write(batch: DataFrame, batch_id: int) -> None:
        # one pass over the batch: the verdict is a partition column, and each batch owns its folder
        target = os.path.join(path, "checked", f"batch_id={batch_id}")
        batch.withColumn("is_dead", F.col("reject_reason").isNotNull()).write.mode("overwrite").partitionBy("is_dead").parquet(target)

    drain_batches(checked, path, write)
    schema = T.StructType([*checked.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("is_dead", T.BooleanType())])
    rows = checked.sparkSession.read.schema(schema).parquet(os.path.join(path, "checked"))
    return rows.where("NOT is_dead").drop("is_dead", "reject_reason"), rows.where("is_dead").select("message", "reject_reason")


def route_late(events: DataFrame, path: str, delay: Column) -> DataFrame:
    """Run a stream and mark each event late that is older than the newest one of the batches before, less `delay`.

    The newest time is kept as one small row per batch in the shared folder, so
    a repeated batch sees the same mark.
    """
    spark = events.sparkSession
    marks, rows = os.path.join(path, "marks"), os.path.join(path, "rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _mark_before(spark, marks, batch_id)
        late = F.lit(False) if before is None else F.coalesce(F.col("event_time") < F.lit(before) - delay, F.lit(False))
        batch.withColumn("is_late", late).write.mode("overwrite").parquet(os.path.join(rows, f"batch_id={batch_id}"))
        newest = batch.agg(F.greatest(F.max("event_time"), F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(os.path.join(marks, f"b{batch_id}"))

    drain_batches(events, path, write)
    schema = T.StructType(
        [*events.schema.fields, T.StructField("is_late", T.BooleanType()), T.StructField("batch_id", T.LongType())]
    )
    return spark.read.schema(schema).parquet(rows)


def _mark_before(spark: SparkSession, marks: str, batch_id: int):
    """Newest event time of the earlier batches: the one row that the batch before has left."""
    if batch_id == 0:
        return None
    return spark.read.schema("newest timestamp").parquet(os.path.join(marks, f"b{batch_id - 1}")).first()[0]
