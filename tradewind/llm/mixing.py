"""Mixing sources to target weights by Poisson replication, with built-in functions only.

A source with target share w and size s out of a mixture of size T repeats each of
its documents w * T / s times on average. Each document draws its own count from
the Poisson distribution with that mean, by inverting the distribution at a
number hashed from seed and id: no state, no order, and the same counts on every
run. Copies are then dealt out and sorted by a hash of (seed, id, copy), which is
a uniform shuffle of the whole mixture.

Totals per source combine in the scan. Rates join by broadcast only while the
number of sources is at most `BROADCAST_SOURCES`, and otherwise by key; the rows
are the same.

A null source is a source of its own, named null; a null id hashes as the text
`null`; rows that share an id draw the same count. Sources without a given weight
have weight 0 and vanish; if nothing has weight, the result is empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_SOURCES = 10_000
_STEP = 64.0  # larger means are drawn as a sum, since exp(-mean) would vanish
_ADDED = ("copy", "shuffle_key")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the parts' text."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _distribution(mean: Column) -> Column:
    """Values of the Poisson distribution function at 0, 1, 2, ... until what is left is below the 52 bits of a draw."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("values"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["values"], F.array(F.element_at(acc["values"], -1) + p)).alias("values"))

    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc["values"])


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None, epochs: float, temperature: float) -> DataFrame:
    """Mean repetitions per source: `__source`, `rate`. Without weights, shares follow size ** temperature."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8  # the frame counts, so no source has size 0
    totals = docs.groupBy(F.col("source").alias("__source")).agg(F.sum(size.cast("double")).alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("__source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighted = totals.withColumn("weight", weight)
    whole = weighted.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights")).first()
    if not whole["weights"]:
        return weighted.select("__source", F.lit(0.0).alias("rate"))
    return weighted.select("__source", (F.col("weight") / whole["weights"] * (whole["all"] * epochs) / F.col("size")).alias("rate"))


def poisson_mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = 1.0, temperature: float = 0.5, seed: str = "mix",
) -> DataFrame:
    """The documents, each repeated by its Poisson count, shuffled; adds `copy` (from 1) and `shuffle_key`."""
    docs = docs.drop(*_ADDED)
    rates = source_rates(docs, weights, epochs, temperature)
    draws = F.greatest(F.ceil(F.col("rate") / _STEP), F.lit(1)).cast("int")
    rates = rates.select("__source", draws.alias("__draws"), _distribution(F.col("rate") / draws).alias("__values"))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)

    def drawn(acc: Column, k: Column) -> Column:
        u = _uniform(F.lit(seed), F.col("doc_id"), k)
        return acc + F.size(F.filter("__values", lambda value: value <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), drawn)
    counted = docs.join(rates, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__n", count)
    copies = counted.where("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string")).cast("binary"))
    return (
        copies.drop("__source", "__draws", "__values", "__n").withColumn("shuffle_key", key)
        .repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    )
