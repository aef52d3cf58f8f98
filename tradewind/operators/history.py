"""Incremental loads and history: watermarks, change merge, partition refresh, versions, point-in-time join."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.session import discard, remove_staged, stage_table
from tradewind.sources.tables import latest_per_key


def incremental_extract(source: DataFrame, column: str, after: Column, up_to: Column | None = None) -> DataFrame:
    """Rows after a stored high-water mark; the filter reaches the scan. A bounded run repeats exactly."""
    rows = source.where(F.col(column) > after)
    return rows if up_to is None else rows.where(F.col(column) <= up_to)


def high_water_mark(column: str, old: Column) -> Column:
    """The mark to store after a run, as an aggregate over its rows; the old one when the run found none that is newer."""
    return F.greatest(F.max(column), old)


def apply_cdc(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: str, op: str = "op"
) -> DataFrame:
    """Target after its changes ('I', 'U', 'D'), ordered by `sequence`.

    Only the latest change of a key counts. A change not newer than the stored
    row is late or repeated and is ignored, so applying a batch twice is safe.
    """
    keys = list(keys)
    last = latest_per_key(changes, keys, [F.col(sequence)])
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("__old"))
    new = last.select(*keys, F.col(op).alias("__op"), F.struct(*values).alias("__new"))
    merged = old.join(new, keys, "full")
    newer = F.col("__new").isNotNull() & (
        F.col("__old").isNull() | (F.col(f"__new.{sequence}") > F.col(f"__old.{sequence}"))
    )
    row = F.when(newer, F.col("__new")).otherwise(F.col("__old"))
    kept = merged.where(~(newer & (F.col("__op") == "D")) & row.isNotNull()).select(*keys, row.alias("__row"))
    return kept.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in values]).select(*target.columns)


def refresh_groups(
    stored: DataFrame, facts: DataFrame, changed: DataFrame, keys: Sequence[str], build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Stored mart with only the groups named by `changed` built anew from the facts."""
    keys = list(keys)
    touched = changed.select(*keys).distinct()
    rebuilt = build(facts.join(touched, keys, "left_semi"))
    return stored.join(touched, keys, "left_anti").unionByName(rebuilt.select(*stored.columns))


def overwrite_groups(rebuilt: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write rebuilt partitions over the stored ones; partitions not in `rebuilt` stay."""
    rebuilt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def refresh_partitions(
    path: str, facts: DataFrame, changed: DataFrame, partition: Callable[[DataFrame], DataFrame], by: str,
    build: Callable[[DataFrame], DataFrame],
) -> list:
    """Build the partitions anew that `changed` facts touch, and overwrite these only; returns the touched values of `by`.

    `partition` adds the column `by` to facts and to the mart. The mart's partitions must be
    made of whole groups of `build`. Facts of other partitions are not read when the facts are stored by `by`, and no file of
    other partitions is written. A partition whose facts are all gone is removed.
    """
    touched = [r[0] for r in partition(changed).select(by).distinct().collect()]  # one value per partition
    if not touched:
        return []
    within = F.col(by).isin([t for t in touched if t is not None])
    if None in touched:
        within = within | F.col(by).isNull()
    rebuilt = stage_table(partition(build(partition(facts).where(F.coalesce(within, F.lit(False))).drop(by))), "rebuilt")
    overwrite_groups(rebuilt.hint("rebalance", by), path, [by])
    left = {r[0] for r in rebuilt.select(by).distinct().collect()}
    for value in touched:
        if value not in left:
            remove_staged(facts.sparkSession, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    discard(rebuilt)
    return touched


def scd2_build(changes: DataFrame, key: str, day: str, sequence: str, attributes: Sequence[str]) -> DataFrame:
    """Versions with valid_from, valid_to (exclusive, NULL while current), is_current and a surrogate key.

    The last change of a day counts, and a change that repeats the attributes
    opens no version. One row per key and day is left before the windows, so a
    window holds at most one row per calendar day however often a key changes.
    """
    attributes = list(attributes)
    daily = changes.groupBy(key, F.col(day).alias("valid_from")).agg(
        F.max_by(F.struct(*attributes), F.col(sequence)).alias("__now")
    )
    history = Window.partitionBy(key).orderBy("valid_from")
    opened = daily.withColumn("__before", F.lag("__now").over(history)).where(
        ~F.col("__now").eqNullSafe(F.col("__before"))
    )
    until = F.lead("valid_from").over(history)
    return opened.withColumn("valid_to", until).select(
        F.xxhash64(key, "valid_from").alias("version_key"),
        key,
        *[F.col(f"__now.{a}").alias(a) for a in attributes],
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )


def scd1_build(changes: DataFrame, key: str, newest: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Only the latest attributes per key."""
    return latest_per_key(changes.select(key, *newest, *attributes), [key], [F.col(c) for c in newest]).select(key, *attributes)


def point_in_time_join(facts: DataFrame, versions: DataFrame, key: str, day: str, attributes: Sequence[str]) -> DataFrame:
    """Facts with the attributes valid on their day; NULL before the first version.

    A version is repeated for each month it touches and the join is on (key,
    month), so a fact meets only the versions of its month and a hot key is
    spread over its months. The exact days are the residual condition.
    """
    month = F.trunc(F.col(day), "MM")
    last = facts.agg(F.max(day).alias("last")).select(F.trunc("last", "MM")).scalar()
    until = F.least(F.coalesce(F.trunc(F.date_sub("valid_to", 1), "MM"), last), last)
    start = F.trunc("valid_from", "MM")
    spans = F.when(start <= until, F.sequence(start, until, F.expr("INTERVAL 1 MONTH")))
    spread = versions.select(
        F.col(key).alias("__key"), *[F.col(a).alias(f"__{a}") for a in attributes], "valid_from", "valid_to",
        F.explode(spans).alias("__month"),
    )
    valid = (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    joined = facts.withColumn("__at", month).join(
        spread, (F.col(key) == F.col("__key")) & (F.col("__at") == F.col("__month")) & valid, "left"
    )
    return joined.select(*facts.columns, *[F.col(f"__{a}").alias(a) for a in attributes])
