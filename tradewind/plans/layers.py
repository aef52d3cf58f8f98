"""Raw, staging and curated layers with replay by run."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.sources.tables import latest_per_key


def land_raw(rows: DataFrame, root: str, source: str, run_id: str, ingest_date: str) -> None:
    """Write rows as they came, with ingestion metadata, under source / date / run. A repeated run replaces itself."""
    path = os.path.join(root, "raw", f"source={source}", f"ingest_date={ingest_date}", f"run_id={run_id}")
    rows.withColumn("ingested_at", F.current_timestamp()).write.mode("overwrite").parquet(path)


def read_raw(spark: SparkSession, root: str, source: str, run_id: str | None = None) -> DataFrame:
    """All raw rows of a source, or those of one run for a replay; source, date and run prune folders."""
    rows = spark.read.option("basePath", os.path.join(root, "raw")).parquet(os.path.join(root, "raw", f"source={source}"))
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def to_staging(raw: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """The latest raw version of each key."""
    return latest_per_key(raw, keys, newest)


def write_curated(rows: DataFrame, root: str, name: str) -> DataFrame:
    path = os.path.join(root, "curated", name)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)
