"""Reading, writing and keyed maintenance of tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A literal row set. Its size is known to the optimizer, so joins broadcast it by themselves."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [
        pa.array(list(values), type=field.type)
        for values, field in zip(columns, to_arrow_schema(schema))
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet scan with an explicit column list."""
    return spark.read.parquet(path).select(*columns)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """JDBC scan with an explicit column list, split over `partition_column` when given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load().select(*columns)


def describe_table(df: DataFrame, name: str) -> DataFrame:
    """Ordered column list of a table: position, name, type, not-null flag."""
    rows = [
        (name, position, field.name, field.dataType.simpleString(), not field.nullable)
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType(), False),
            T.StructField("position", T.IntegerType(), False),
            T.StructField("column_name", T.StringType(), False),
            T.StructField("data_type", T.StringType(), False),
            T.StructField("not_null", T.BooleanType(), False),
        ]
    )
    return inline_values(df.sparkSession, rows, schema)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full overwrite by all executors, with the codec that makes the smaller files."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Target plus those new rows whose key it does not hold; a key offered twice is added once.

    With `tasks`, keys are dealt over that many tasks.
    """
    keys = list(keys)
    fresh = deal(new_rows, tasks, keys).dropDuplicates(keys).join(deal(target.select(*keys), tasks, keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def deal(rows: DataFrame, tasks: int | None, keys: Sequence[str]) -> DataFrame:
    """The rows dealt by key over `tasks` tasks, or as they are; what groups or joins them by the key then runs in these tasks."""
    return rows if tasks is None else rows.repartition(tasks, *keys)


def update_from(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the columns that `changes` carries, for keys it holds; other rows stay as they are."""
    keys = list(keys)
    names = [c for c in changes.columns if c not in keys]
    incoming = changes.select(
        *keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in names]
    )
    joined = target.join(incoming, keys, "left")
    kinds = {f.name: f.dataType for f in target.schema.fields}

    def pick(name: str) -> Column:
        if name not in names:
            return F.col(name)
        return F.when(F.col("__hit"), F.col(f"__new_{name}")).otherwise(F.col(name)).cast(kinds[name]).alias(name)

    return joined.select(*[pick(c) for c in target.columns])


def stamp_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], stamp: Column, stamp_column: str = "updated_at"
) -> DataFrame:
    """New version of a table whose stamp moves only on rows that really changed or are new."""
    keys = list(keys)
    compared = [c for c in new.columns if c not in keys and c != stamp_column]
    before = old.select(
        *keys,
        F.struct(*compared).alias("__before"),
        F.col(stamp_column).alias("__stamp"),
    )
    joined = new.join(before, keys, "left")
    same = F.struct(*compared).eqNullSafe(F.col("__before"))
    return joined.select(
        *[c for c in new.columns if c != stamp_column],
        F.when(same, F.col("__stamp")).otherwise(stamp).alias(stamp_column),
    )


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the one that is largest by `newest`.

    An aggregate, not a window: a hot key is reduced on the map side, so no task holds its versions.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(newest)])
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*rows.columns)


def record_run(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Run log with one row per pipeline: the latest of the old and new rows."""
    both = log.unionByName(runs.select(*log.columns))
    newest = [F.col("completed_at"), *[F.col(c) for c in log.columns if c not in ("pipeline_name", "completed_at")]]
    return latest_per_key(both, ["pipeline_name"], newest)


def latest_run(log: DataFrame) -> DataFrame:
    """The newest row of the run log."""
    return log.orderBy(F.col("completed_at").desc(), F.col("pipeline_name")).limit(1)


def date_series(bounds: DataFrame, first: str, last: str, name: str = "date_key") -> DataFrame:
    """One row per day between two dates held by a one-row table; none when there is no first date."""
    days = F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))
    return bounds.where(F.col(first).isNotNull()).select(F.explode(days).alias(name))


def schema_drift(actual: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """Columns missing from, unknown to, or typed differently than a contract."""
    spark = actual.sparkSession
    seen = describe_table(actual, name).select("column_name", F.col("data_type").alias("actual_type"))
    wanted = describe_table(spark.createDataFrame([], expected), name).select(
        "column_name", F.col("data_type").alias("expected_type")
    )
    status = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "unexpected")
        .when(F.col("actual_type") != F.col("expected_type"), "type_changed")
    )
    return (
        wanted.join(seen, "column_name", "full")
        .select(F.lit(name).alias("table_name"), "column_name", "expected_type", "actual_type", status.alias("drift"))
        .where(F.col("drift").isNotNull())
    )
