"""CSV and JSON files: tolerant reading, manifests, and differences between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"


def read_files(spark: SparkSession, path: str, schema: T.StructType, kind: str = "csv", **options: str) -> DataFrame:
    """Rows with a declared schema, their file, and the raw text of a row that does not fit it."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if kind == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    rows = reader.options(**options).format(kind).load(path)
    # The verdict on a row must come from all its columns. The reader prunes columns a query does not
    # name, so the raw text is tied to a hash over every one of them; the comparison always holds.
    # Folder names do not belong to the content.
    row_hash = F.xxhash64(*wide.names)
    return rows.select(
        *schema.names,
        F.when(row_hash >= F.lit(-(2**63)), F.col(CORRUPT)).alias(CORRUPT),
        row_hash.alias("row_hash"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_version"),
    )


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows)."""
    return rows.where(f"{CORRUPT} IS NULL").drop(CORRUPT), rows.where(f"{CORRUPT} IS NOT NULL")


def file_manifest(rows: DataFrame) -> DataFrame:
    """Per file: rows, malformed rows and a fingerprint of its content that does not depend on row order."""
    return rows.groupBy("file_path").agg(
        F.count("*").alias("rows"),
        F.count(CORRUPT).alias("malformed_rows"),
        F.sum(F.col("row_hash").cast("decimal(20,0)")).alias("fingerprint"),
    )


def duplicate_files(manifest: DataFrame) -> DataFrame:
    """Files whose content an earlier path already has; only the first path is to be loaded."""
    first = manifest.groupBy("fingerprint", "rows").agg(F.min("file_path").alias("first_path"))
    return manifest.join(first, ["fingerprint", "rows"]).where("file_path <> first_path").select("file_path", "first_path")


def manifest_diff(before: DataFrame, after: DataFrame, key: str = "file_path", content: str = "fingerprint") -> DataFrame:
    """new / changed / deleted entries between two snapshots."""
    old = before.select(key, F.col(content).alias("old_content"))
    new = after.select(key, F.col(content).alias("new_content"))
    change = (
        F.when(F.col("old_content").isNull(), "new")
        .when(F.col("new_content").isNull(), "deleted")
        .when(F.col("old_content") != F.col("new_content"), "changed")
    )
    return old.join(new, key, "full").select(key, "old_content", "new_content", change.alias("change")).where("change IS NOT NULL")
