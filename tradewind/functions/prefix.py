"""Running totals, row numbers and neighbours that do not put a hot key into one task.

A window over (key, order) sorts all rows of a key in one task. Here the rows are
first cut into chunks: ranges of (key, order) of about equal size, whatever the
key, written once. Then

* inside a chunk a window adds up the rows of a key before the current one;
* only the first and the last key of a chunk can lie in other chunks too. Their totals per
  chunk are two rows a chunk, and a second, small window over them gives what a chunk starts
  from; it is sent to the tasks, so the rows are not moved again.

The result is exact for any distribution: a key, a day or a single moment with a
third of all rows is spread over many chunks. NULL keys form a group of their
own, NULLs in the order come first, and every row is kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.session import stage_table

CHUNK = "__chunk"

# fixed values: a key of more rows is cut into chunks by `totals_by_key`; so many groups of keys are counted to find such keys
LARGE_KEY = 1_000_000
KEY_GROUPS = 65_536


def in_chunks(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, written in ranges of `order`, with the number of their range; read back as often as needed."""
    return stage_table(rows.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__r_{k}"]) for k in columns])


def _spread(chunked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of keys that lie in more than one chunk; `chunked` was cut by the keys first.

    Chunks are ranges, so such a key is the first or the last one of each of its chunks: two keys a chunk
    are all that is looked for, which is small enough to be sent to the tasks.
    """
    ends = chunked.groupBy(CHUNK).agg(F.min(F.struct(*keys)).alias("__first"), F.max(F.struct(*keys)).alias("__last"))
    edges = ends.select(CHUNK, F.explode(F.array_distinct(F.array("__first", "__last"))).alias("__key")).select(CHUNK, "__key.*")
    several = edges.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    return chunked.join(F.broadcast(several), _same(chunked, several, keys), "left_semi")


def _join_chunks(rows: DataFrame, per_chunk: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their key's chunk, NULL where there are none; NULL keys meet. At most two rows a chunk are joined."""
    renamed = per_chunk.withColumnsRenamed({k: f"__r_{k}" for k in [*keys, CHUNK]})
    same = _same(rows, renamed, [*keys, CHUNK])
    return rows.join(F.broadcast(renamed), same, "left").drop(*[f"__r_{k}" for k in [*keys, CHUNK]])


def totals_in_chunks(chunked: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """`totals_before` for rows that `in_chunks` has written by (keys, order); the chunk number stays."""
    keys, names = list(keys), list(totals)
    value = {n: F.coalesce(v, F.lit(0)) for n, v in totals.items()}
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    near = chunked.select("*", *[v.alias(f"__v_{n}") for n, v in value.items()]).select(
        *chunked.columns, *[F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)).alias(f"__near_{n}") for n in names]
    )
    chunks = _spread(chunked, keys).groupBy(*keys, CHUNK).agg(*[F.sum(v).alias(f"__t_{n}") for n, v in value.items()])
    starts = chunks.select(
        *keys, CHUNK, *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__far_{n}") for n in names]
    )
    return _join_chunks(near, starts, keys).select(
        *chunked.columns, *[(F.col(f"__near_{n}") + F.coalesce(f"__far_{n}", F.lit(0))).alias(n) for n in names]
    )


def maxima_in_chunks(chunked: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add `name`: the largest `value` of the earlier rows of the same key, by the same chunked method; NULL for the first."""
    keys = list(keys)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    near = chunked.withColumn("__near", F.max(value).over(inside))
    tops = _spread(chunked, keys).groupBy(*keys, CHUNK).agg(F.max(value).alias("__top"))
    starts = tops.select(*keys, CHUNK, F.max("__top").over(earlier).alias("__far"))
    return _join_chunks(near, starts, keys).select(*chunked.columns, F.greatest("__near", "__far").alias(name))


def totals_before(
    rows: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add, per entry of `totals`, the sum of that expression over the earlier rows of the same key.

    Rows of a key are ordered by `levels`, then `order`; together they should be
    unique within a key, or ties come in any order. A NULL value counts as 0.
    """
    chunked = in_chunks(rows, [*keys, *levels, *order])
    return totals_in_chunks(chunked, keys, [*levels, *order], totals).drop(CHUNK)


def totals_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """As `totals_before`, where most keys are small: rows move once, by key, and a join by the same keys does not move them again.

    The rows are written, and counted in `KEY_GROUPS` groups by a hash of their key. Groups of more than `LARGE_KEY` rows, which
    a larger key must lie in, are cut into chunks.
    """
    written = stage_table(rows, "by-key")
    group = F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))
    counted = written.groupBy(group.alias("__group")).agg(F.count("*").alias("__n"))
    large = [r[0] for r in counted.where(F.col("__n") > LARGE_KEY).select("__group").collect()]
    small = written.where(~group.isin(large)) if large else written
    earlier = Window.partitionBy(*keys).orderBy(*levels, *order).rowsBetween(Window.unboundedPreceding, -1)
    found = small.select("*", *[F.coalesce(v, F.lit(0)).alias(f"__v_{n}") for n, v in totals.items()]).select(
        *rows.columns, *[F.coalesce(F.sum(f"__v_{n}").over(earlier), F.lit(0)).alias(n) for n in totals]
    )
    return found.unionByName(totals_before(written.where(group.isin(large)), keys, levels, order, totals)) if large else found


def occurrence_number(
    rows: DataFrame, keys: Sequence[str], levels: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """1-based position of each row within its key, by the same chunked method."""
    counted = totals_before(rows, keys, levels, order, {name: F.lit(1).cast("bigint")})
    return counted.withColumn(name, F.col(name) + 1)


def neighbour_values(
    rows: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    side: str = "previous",
) -> DataFrame:
    """Add `previous_<c>` or `next_<c>`: the values of the neighbouring row of the same key.

    Inside a chunk this is lag or lead; the first (last) row of a chunk takes the
    last (first) row of the key's nearest other chunk, found over one row per chunk.
    """
    if side not in ("previous", "next"):
        raise ValueError("side is 'previous' or 'next'")
    keys, order, columns = list(keys), [*levels, *order], list(columns)
    step, edge = (F.lag, F.max_by) if side == "previous" else (F.lead, F.min_by)
    chunked = in_chunks(rows, [*keys, *order])
    values = F.struct(*columns)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(CHUNK)

    edges = _spread(chunked, keys).groupBy(*keys, CHUNK).agg(edge(values, F.struct(*order)).alias("__edge"))
    carried = edges.select(*keys, CHUNK, step("__edge").over(across).alias("__carry"))
    near = chunked.select("*", step(values).over(inside).alias("__near"))
    found = F.coalesce("__near", "__carry")
    return _join_chunks(near, carried, keys).select(*rows.columns, *[found[c].alias(f"{side}_{c}") for c in columns])
