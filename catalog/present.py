"""One shape for results, so that both engines show the same values.

Decimals as doubles, whole numbers as BIGINT, dates and times as text: what the
serving layer does to a response, done to every registered query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def present(df: DataFrame, columns: str) -> DataFrame:
    """`columns` is 'name:kind ...' with kinds n(umber), i(nteger), d(ate or time), s(tring), b(oolean)."""
    kinds = {"n": "double", "i": "bigint", "d": "string", "s": "string", "b": "boolean"}
    parts = [item.split(":") for item in columns.split()]
    return df.select(*[F.col(name).cast(kinds[kind]).alias(name) for name, kind in parts])
