"""Payloads of several systems brought into one model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tradewind.sources.tables import latest_per_key

# fixed values: columns every canonical record carries
ENVELOPE = ("source_system", "business_key", "source_key", "event_time", "ingested_at", "schema_version")


def canonical_rows(
    source: DataFrame, system: str, mapping: Mapping[str, Column], ingested_at: Column, version: int
) -> DataFrame:
    """One source in canonical columns; `mapping` names business_key, source_key, event_time and the payload columns."""
    missing = {"business_key", "source_key", "event_time"} - set(mapping)
    if missing:
        raise ValueError(f"mapping of {system} lacks {sorted(missing)}")
    return source.select(
        F.lit(system).alias("source_system"),
        *[expr.alias(name) for name, expr in mapping.items()],
        ingested_at.alias("ingested_at"),
        F.lit(version).alias("schema_version"),
    )


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources together; a column that a source does not have is NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def parse_documents(rows: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """JSON text as typed columns plus the raw text of what does not parse; unknown fields are ignored."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rest = [c for c in rows.columns if c != column]
    return rows.select(*rest, parsed.alias("__doc")).select(*rest, "__doc.*")


# fixed values: the names that a variant gives to the types of its values, by the kind of declared type that takes them
_TAKES = {
    T.IntegralType: "BIGINT|DECIMAL\\([0-9]+,0\\)", T.FractionalType: "BIGINT|DECIMAL.*|DOUBLE|FLOAT", T.BooleanType: "BOOLEAN",
    T.ArrayType: "ARRAY<.*", T.StructType: "OBJECT<.*", T.MapType: "OBJECT<.*",
}


def _fits(value: Column, kind: T.DataType) -> Column:
    """A null, or a value of the declared kind; what is declared as text, date or time comes as text."""
    pattern = next((names for base, names in _TAKES.items() if isinstance(kind, base)), "STRING")
    return F.schema_of_variant(value).rlike(f"^(VOID|{pattern})$")


def _fields_of(rows: DataFrame, column: str) -> DataFrame:
    """Rows with `__doc`, the parsed document, and `__fields`, its fields by name; both NULL where the text is no JSON object."""
    parsed = rows.withColumn("__doc", F.try_parse_json(column))
    whole = F.schema_of_variant("__doc").startswith("OBJECT<")
    return parsed.withColumn("__doc", F.when(whole, F.col("__doc"))).withColumn("__fields", F.expr("try_cast(__doc AS map<string, variant>)"))


def open_documents(rows: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """JSON text as typed columns that loses nothing.

    `unknown_fields`: fields that the schema does not name; `mismatched`: named fields whose value is of
    another kind; both JSON objects, NULL if there are none. `_corrupt_record`: text that is no JSON object. A named
    value of another kind still counts if it can be read as the declared type, as "5" can for a number.
    """
    rest = [c for c in rows.columns if c != column]
    opened = _fields_of(rows, column)
    names = F.array(*[F.lit(f.name) for f in schema])
    unknown = F.map_filter("__fields", lambda name, _: ~F.array_contains(names, name))
    odd = F.map_filter("__fields", lambda name, value: _any([(name == f.name) & ~_fits(value, f.dataType) for f in schema]))
    as_text = lambda m: F.when(F.size(m) > 0, F.to_json(m))
    typed = [F.try_variant_get("__doc", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema]
    return opened.select(
        *rest, *typed, as_text(unknown).alias("unknown_fields"), as_text(odd).alias("mismatched"),
        F.when(F.col("__doc").isNull(), F.col(column)).alias("_corrupt_record"),
    )


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def document_drift(rows: DataFrame, column: str, schema: T.StructType, by: Sequence[str]) -> DataFrame:
    """Per value of `by` (source, version): fields that the schema does not name, and named ones that hold another kind of value.

    Each with the type observed, of nested values in full, and the number of documents.
    """
    fields = _fields_of(rows, column).select(*by, F.explode("__fields").alias("field", "__value"))
    known = [(F.col("field") == f.name) & _fits(F.col("__value"), f.dataType) for f in schema]
    named = F.col("field").isin(*[f.name for f in schema])
    drift = F.when(~named, "new_field").when(~_any(known), "type_changed")
    found = fields.select(*by, "field", drift.alias("kind"), F.schema_of_variant("__value").alias("observed_type")).where("kind IS NOT NULL")
    return found.groupBy(*by, "field", "kind", "observed_type").agg(F.count("*").alias("documents"))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested struct fields as top-level columns; arrays stay."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        columns = []
        for field in df.schema.fields:
            if isinstance(field.dataType, T.StructType):
                columns += [F.col(f"`{field.name}`.`{n}`").alias(f"{field.name}{separator}{n}") for n in field.dataType.names]
            else:
                columns.append(F.col(f"`{field.name}`"))
        df = df.select(*columns)
    return df


def dedupe_pages(rows: DataFrame, idempotency_key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Repeated and late responses reduced to the latest version of each key."""
    return latest_per_key(rows, idempotency_key, [F.col(v) for v in version])


def next_cursor(rows: DataFrame, cursor: str, stored: Column) -> DataFrame:
    """The cursor to continue from after these rows: behind the last page that they come from."""
    return rows.agg(F.greatest(F.max(cursor) + 1, stored).alias("cursor"))
