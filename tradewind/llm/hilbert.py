"""Sharding along a Hilbert curve, with built-in functions only.

Several metadata columns are cut into 2^bits cells each, every row gets the index
of its cell along the Hilbert curve, rows are sorted by that index, and the order
is cut into shards whose row counts differ by one at most. Neighbours on the
curve are neighbours in every dimension, so each shard (and each file in it)
covers a small box of the metadata and readers can skip files by any of them.

* One pass finds the smallest and largest value per dimension (one row).
* One range exchange sorts; ids break ties, so a cell with a third of all rows is
  still dealt over many tasks. The sorted rows are written once.
* The place of a row is its place in its written run plus the rows of the runs
  before, one number per run. No task sees more than one run.

Nulls lie in the first cell of their dimension. A dimension with one value, an
empty table, equal rows and ties are all allowed; equal rows take neighbouring places.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StringType

from tradewind.session import stage_table

_ADDED = ("shard", "slot")
_RUN_BITS = 33  # monotonically_increasing_id keeps the place in the partition in the lower 33 bits


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Step tables of the curve: for state * 2^dims + corner, the corner's number on the curve and the next state.

    A state is where the curve enters the cube (a corner) and the axis along which it leaves.
    """
    corners = 1 << dims

    def rotate(value: int, by: int) -> int:
        by %= dims
        return ((value >> by) | (value << (dims - by))) & (corners - 1)

    def trailing_ones(value: int) -> int:
        count = 0
        while value & 1:
            value, count = value >> 1, count + 1
        return count

    number, following = [], []
    for entry in range(corners):
        for axis in range(dims):
            for corner in range(corners):
                gray = rotate(corner ^ entry, axis + 1)
                place = 0
                for shift in range(dims):
                    place ^= gray >> shift
                start = 0 if place == 0 else (half := 2 * ((place - 1) // 2)) ^ (half >> 1)
                turn = 0 if place == 0 else trailing_ones(place - 1 if place % 2 == 0 else place) % dims
                number.append(place)
                following.append((entry ^ rotate(start, dims - (axis + 1) % dims)) * dims + (axis + turn + 1) % dims)
    return number, following


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Index along the curve of a cell given by its integer coordinates below 2^bits."""
    dims = len(cells)
    number, following = curve_tables(dims)
    numbers, states = F.array(*map(F.lit, number)), F.array(*map(F.lit, following))

    def step(acc: Column, level: Column) -> Column:
        corner = F.lit(0)
        for axis, cell in enumerate(cells):
            corner = corner.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", cell, level).bitwiseAND(F.lit(1)), F.lit(axis)))
        at = acc["state"] * F.lit(1 << dims) + corner
        return F.struct(
            (acc["index"] * F.lit(1 << dims) + F.get(numbers, at)).cast("long").alias("index"),
            F.get(states, at).cast("int").alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["index"])


def _as_number(value: Column, text: bool, shared: int) -> Column:
    """A number in the order of the values; of a text, the 7 bytes after the prefix that all values share."""
    if not text:
        return value.cast("double")
    hexed = F.hex(F.substring(value.cast("binary"), shared + 1, 7))
    return F.conv(F.rpad(hexed, 14, "0"), 16, 10).cast("double")


def _cells(df: DataFrame, dims: Mapping[str, Column], bits: int) -> list[Column]:
    values = df.select(*[v.alias(k) for k, v in dims.items()])
    text = {f.name: isinstance(f.dataType, (StringType, BinaryType)) for f in values.schema}
    ends = values.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in dims for f in (F.min, F.max)]).first()
    cells = []
    for k, v in dims.items():
        low, high = ends[f"min_{k}"], ends[f"max_{k}"]
        shared = 0
        if text[k] and low is not None:
            as_bytes = [x.encode() if isinstance(x, str) else bytes(x) for x in (low, high)]
            shared = len(commonprefix(as_bytes))
            low, high = (int.from_bytes(x[shared:shared + 7].ljust(7, b"\0"), "big") for x in as_bytes)
        low, high = float(low or 0), float(high or 0)
        scale = (1 << bits) / (high - low) if high > low else 0.0
        cell = F.floor((_as_number(v, text[k], shared) - F.lit(low)) * F.lit(scale)).cast("int")
        cells.append(F.coalesce(F.least(F.greatest(cell, F.lit(0)), F.lit((1 << bits) - 1)), F.lit(0)))
    return cells


def hilbert_shards(df: DataFrame, dims: Mapping[str, Column], shards: int, ties: Sequence[Column] = (), bits: int = 8) -> DataFrame:
    """Every row of `df` with its `shard` (0 to shards - 1) and `slot` (gapless from 0) along the curve.

    `ties` order the rows of a cell. Samples of them reach the driver, which cuts the ranges, so give
    ids and hashes and no whole texts. Shards hold consecutive runs of the curve and differ by one row at most. The
    result is read back from files sorted by the curve in the shared folder.
    """
    df = df.drop(*_ADDED, "__curve", "__place")
    placed = df.withColumn("__curve", hilbert_index(_cells(df, dims, bits), bits))
    placed = placed.withColumns({f"__tie_{k}": tie for k, tie in enumerate(ties)}) if ties else placed
    order = ["__curve", *[f"__tie_{k}" for k in range(len(ties))]]
    runs = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    runs = stage_table(runs.drop(*order), "hilbert")

    run = F.call_function("shiftright", "__place", F.lit(_RUN_BITS))
    counts = runs.groupBy(run.alias("__run")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    starts = counts.select(  # one row per written run: small by the number of tasks
        "__run",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(every).alias("__all"),
    )
    rank = F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    shard = F.call_function("div", rank * shards, F.col("__all"))
    return (
        runs.withColumn("__run", run).join(F.broadcast(starts), "__run")
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", rank - F.call_function("div", F.col("shard") * F.col("__all") + (shards - 1), F.lit(shards)))
        .drop("__run", "__place", "__before", "__all")
    )


def document_dims() -> dict[str, Column]:
    """The metadata by which readers of documents select: origin, language, length, and id as the order of arrival."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    return {"source": F.col("source"), "lang": F.col("lang"), "size": F.log2(size.cast("double")), "doc_id": F.col("doc_id")}
