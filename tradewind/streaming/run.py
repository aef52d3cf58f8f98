"""Starting bounded stream runs and their sinks; all state lives in the shared folder."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.session import remove_staged, scratch_path, setting
from tradewind.sources.tables import latest_per_key


# a batch takes at most so many files, so that a table of any size arrives in bounded steps
FILES_PER_BATCH = 64


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream over the Parquet files at `path`, a folder, a file or a pattern."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files or FILES_PER_BATCH).parquet(path)


def drain_append(stream: DataFrame, path: str) -> DataFrame:
    """Process what is available, append to Parquet exactly once, and return what was written so far."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", os.path.join(path, "rows"))
        .option("checkpointLocation", os.path.join(path, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(os.path.join(path, "rows"))


def drain_batches(stream: DataFrame, path: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Process what is available, batch by batch, with a handler that must be repeatable for a batch id."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", os.path.join(path, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_updates(stream: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Process what is available of an aggregate in update mode; returns the latest row per key.

    Each batch writes only the groups it changed, into a folder of its own, so a
    repeated batch replaces itself and no batch rewrites the whole state.
    """
    rows = os.path.join(path, "rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(rows, f"batch_id={batch_id}"))

    drain_batches(stream, path, write, "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    written = stream.sparkSession.read.schema(schema).parquet(rows)
    return latest_per_key(written, keys, [F.col("batch_id")]).drop("batch_id")


def drain_parts(stream: DataFrame, path: str, part: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Process what is available; `part` reduces each batch on its own, and what all batches wrote is returned.

    For results that can be put together from parts (sums, counts, sessions): no
    row is too late for its part, and a repeated batch replaces itself.
    """
    rows = os.path.join(path, "parts")

    def write(batch: DataFrame, batch_id: int) -> None:
        part(batch).write.mode("overwrite").parquet(os.path.join(rows, f"batch_id={batch_id}"))

    drain_batches(stream, path, write)
    return stream.sparkSession.read.parquet(rows).drop("batch_id")


@dataclass
class Drained:
    """What a stateful run wrote: its rows, its late input rows by input, and the progress of its batches."""

    rows: DataFrame
    late: dict[str, DataFrame]
    marks: DataFrame
    progress: list

    def watermark_ms(self) -> int:
        """The last watermark, in milliseconds."""
        return self.marks.agg(F.max("watermark")).first()[0] or 0

    def state_rows(self) -> list[int]:
        """Rows of state after each batch."""
        return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in self.progress]


def state_in_rocksdb(spark: SparkSession) -> AbstractContextManager[None]:
    """State outside the heap, with changes in the checkpoint: what large state and the state API need."""
    return setting(spark, "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def on_time(rows: DataFrame, time: str) -> DataFrame:
    """Rows that have an event time; the others are late at once."""
    return rows.where(F.col(time).isNotNull())


def _is_late(time: Column, watermark: int) -> Column:
    """As the engine tells late rows: not after the watermark, which has milliseconds."""
    return F.coalesce(F.unix_micros(time) <= F.lit(watermark * 1000), F.lit(True))


def drain_beside(result: DataFrame, inputs: Mapping[str, tuple[DataFrame, str, str]], path: str) -> Drained:
    """Process what is available of a stateful `result`, and write its late input rows aside.

    `inputs`: name to (stream, time column, delay), as `result` uses them. Results and input
    rows run as one stream, so a batch holds both, and the watermark of a batch is known: it is that of
    the input rows of the batches before, of which one row is kept per batch. The engine removes state by that
    watermark and tells late rows by the one that the batch before used. A repeated batch replaces what it wrote.
    """
    spark = result.sparkSession
    written, marks = os.path.join(path, "batches"), os.path.join(path, "marks")
    both = result.select(F.struct(*result.columns).alias("result"))
    for name, (stream, _, _) in inputs.items():
        both = both.unionByName(stream.select(F.struct(*stream.columns).alias(name)), allowMissingColumns=True)
    newest_ddl = ", ".join(f"{name} bigint" for name in inputs) + ", watermark bigint, used bigint"
    delays = {name: _delay_ms(spark, delay) for name, (_, _, delay) in inputs.items()}
    times = {name: F.col(f"{name}.{time}") for name, (_, time, _) in inputs.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = dict.fromkeys([*inputs, "watermark", "used"], None)
        if batch_id > 0:
            before = session.read.schema(newest_ddl).parquet(os.path.join(marks, f"b{batch_id - 1}")).first().asDict()
        kept = F.col("result").isNotNull()
        for name, time in times.items():
            kept = kept | (F.col(name).isNotNull() & _is_late(time, before["used"] or 0))
        # one job: a second one would run the batch, and its state, again
        seen = Observation()
        watched = batch.observe(seen, *[F.max(F.unix_millis(time)).alias(name) for name, time in times.items()])
        watched.where(kept).write.mode("overwrite").parquet(os.path.join(written, f"batch_id={batch_id}"))
        newest = {name: max((x for x in (before[name], seen.get[name]) if x is not None), default=None) for name in inputs}
        reached = [newest[name] - delays[name] for name in inputs if newest[name] is not None]
        after = max(min(reached), before["watermark"] or 0, 0) if len(reached) == len(inputs) else before["watermark"]
        session.createDataFrame([(*newest.values(), after, before["watermark"])], newest_ddl).coalesce(1).write.mode("overwrite").parquet(os.path.join(marks, f"b{batch_id}"))

    with state_in_rocksdb(spark):
        query = drain_batches(both, path, write)
    rows = spark.read.schema(both.schema).parquet(written)
    kept_rows = {name: rows.where(F.col(name).isNotNull()).select(f"{name}.*") for name in ("result", *inputs)}
    found = kept_rows.pop("result")
    return Drained(found, kept_rows, spark.read.schema(newest_ddl).parquet(os.path.join(marks, "b*")), [_plain(p) for p in query.recentProgress])


def drain_with_state(
    stream: DataFrame, path: str, time: str, delay: str,
    step: Callable[[DataFrame, DataFrame | None, int], DataFrame], state_ddl: str, result_ddl: str, expired: Callable[[DataFrame, int], DataFrame],
) -> Drained:
    """Process what is available with a state that is a table, written anew by each batch beside its rows.

    `step` takes a batch's rows that are not late, the state before (None: none yet) and the watermark, and gives rows
    of `found`, an array of results, and `state`, a row of the state after or NULL. `expired` gives the results of
    state that the watermark has passed; they belong to the result once the input is drained. Late rows and watermarks are
    those of `drain_beside`. A batch reads the state that the one before wrote and a repeated batch replaces
    what it wrote; older states are removed, so the rows of a run are read before the next run goes on from it.
    """
    spark = stream.sparkSession
    written, marks = os.path.join(path, "batches"), os.path.join(path, "marks")
    marks_ddl = "newest bigint, watermark bigint, used bigint, batch bigint, held bigint"
    late_ddl = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in stream.schema)
    rows_ddl = f"result struct<{_struct(result_ddl)}>, state struct<{_struct(state_ddl)}>, late struct<{late_ddl}>, part string"
    delay_ms = _delay_ms(spark, delay)
    rows_of = lambda of, number: of.read.schema(rows_ddl).option("basePath", written).parquet(os.path.join(written, f"batch_id={number}"))

    def mark(of: SparkSession, number: int) -> dict:
        return of.read.schema(marks_ddl).parquet(os.path.join(marks, f"b{number}")).first().asDict()

    def set_mark(of: SparkSession, number: int, values: dict) -> None:
        row = of.createDataFrame([tuple(values[f.split()[0]] for f in marks_ddl.split(", "))], marks_ddl)
        row.coalesce(1).write.mode("overwrite").parquet(os.path.join(marks, f"b{number}"))

    def state_of(of: SparkSession, number: int) -> DataFrame:
        return rows_of(of, number).where("part = 'state'").select("state.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = mark(session, batch_id - 1) if batch_id > 0 else {"newest": None, "watermark": None, "used": None}
        seen, held = Observation(), Observation()
        watched = batch.observe(seen, F.max(F.unix_millis(time)).alias("newest"))
        is_late = _is_late(F.col(time), before["used"] or 0)
        state = state_of(session, batch_id - 1) if batch_id > 0 else None
        # the same shape for results, state and late rows, so that one job writes them all
        shape = lambda part, **given: F.struct(
            *[given.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in _kinds(rows_ddl).items() if n != "part"], F.lit(part).alias("part")
        )
        stepped = step(watched.where(~is_late), state, before["watermark"] or 0)
        results = F.transform("found", lambda r: shape("result", result=r))
        kept = F.array_compact(F.array(F.when(F.col("state").isNotNull(), shape("state", state=F.col("state")))))
        rows = stepped.select(F.explode(F.concat(results, kept)).alias("r")).select("r.*")
        aside = watched.where(is_late).select(shape("late", late=F.struct(*stream.columns)).alias("r")).select("r.*")
        both = rows.unionByName(aside).observe(held, F.count_if(F.col("part") == "state").alias("held"))
        both.write.mode("overwrite").partitionBy("part").parquet(os.path.join(written, f"batch_id={batch_id}"))
        newest = max((x for x in (before["newest"], seen.get["newest"]) if x is not None), default=None)
        after = before["watermark"] if newest is None else max(newest - delay_ms, before["watermark"] or 0, 0)
        set_mark(session, batch_id, {"newest": newest, "watermark": after, "used": before["watermark"], "batch": batch_id, "held": held.get["held"]})
        if batch_id > 1:
            remove_staged(session, os.path.join(written, f"batch_id={batch_id - 2}", "part=state"))

    drain_batches(stream, path, write)
    log = spark.read.schema(marks_ddl).parquet(os.path.join(marks, "b*"))
    all_marks = log.orderBy("batch").collect()
    rows = spark.read.schema(rows_ddl).option("basePath", path).parquet(os.path.join(written, "batch_id=*"))
    found = rows.where("part = 'result'").select("result.*")
    sizes = [m.held for m in all_marks]
    if all_marks:
        end = all_marks[-1].asDict()
        # the input has been taken in whole, so what comes later is measured by its watermark
        set_mark(spark, end["batch"], end | {"used": end["watermark"]})
        last = state_of(spark, end["batch"])
        ended = expired(last, end["watermark"] or 0)
        found = found.unionByName(ended)
        sizes.append(end["held"] - ended.count())
    progress = [{"stateOperators": [{"numRowsTotal": n}]} for n in sizes]
    return Drained(found, {"moves": rows.where("part = 'late'").select("late.*")}, log, progress)


def _kinds(ddl: str) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in T.StructType.fromDDL(ddl).fields}


def _struct(ddl: str) -> str:
    return ", ".join(f"`{name}`: {kind.simpleString()}" for name, kind in _kinds(ddl).items())


def _delay_ms(spark: SparkSession, delay: str) -> int:
    return spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]


def _plain(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)


def new_run(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"stream-{label}")
