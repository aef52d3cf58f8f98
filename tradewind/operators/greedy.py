"""First come, first served against a limit, where a refused item uses nothing up.

A running sum alone is wrong after the first refusal. Both operators below
bound what an item finds used up: at least the earlier items already accepted,
at most the earlier items not yet refused. An item that fits under the upper
bound is accepted, one that fails under the lower bound is refused, and the
earliest undecided item always meets one of the two, so the rounds end. Rows
are cut into chunks once and every round adds up inside them
(`totals_in_chunks`), so a hot key is spread over many tasks. Where an item draws
on one key only, keys of few items need no rounds: they are walked item by item
in a window.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tradewind.functions import in_chunks, totals_in_chunks
from tradewind.session import cut_lineage, discard

log = logging.getLogger(__name__)

# fixed value: a key of more items goes through the rounds; each item of a smaller one walks over those before it
FEW_ITEMS = 100


def _bounds(items: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    verdict, amount = F.col("__verdict"), F.col("__amount")
    return totals_in_chunks(
        items, keys, order,
        {"__low": F.when(verdict, amount), "__high": F.when(F.coalesce(verdict, F.lit(True)), amount)},
    )


def _fits_high() -> Column:
    return F.col("__high") + F.col("__amount") <= F.col("__limit")


def _fails_low() -> Column:
    return F.col("__low") + F.col("__amount") > F.col("__limit")


def _known(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def accept_in_order(
    items: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    amount: Column,
    limit: Column,
) -> DataFrame:
    """Add `accepted` to items that each draw on one key; `limit` is the same on all rows of a key.

    Amounts must be positive. An item whose key, place in the order, amount or
    limit is NULL is refused and uses nothing up. Items of keys with at most
    `FEW_ITEMS` are moved once and walked in order. Of the larger keys, those whose total
    fits need no ordering at all; the others go through rounds until all is decided.
    """
    keys, order = list(keys), [*levels, *order]
    valued = items.withColumn("__amount", amount).withColumn("__limit", limit)
    known = _known(*keys, *order, "__amount", "__limit")
    unknown = valued.where(~known).select(*items.columns, F.lit(False).alias("accepted"))
    # keys are counted by a hash, which is shorter; two keys of one hash only make a small key count as a large one
    valued = valued.where(known).withColumn("__hash", F.xxhash64(*keys))
    many = cut_lineage(valued.groupBy("__hash").agg(F.count("*").alias("__n")).where(F.col("__n") > FEW_ITEMS).select("__hash"))
    if many.isEmpty():
        return _walked(valued, keys, order).select(*items.columns, "accepted").unionByName(unknown)
    small = _walked(valued.join(many, "__hash", "left_anti"), keys, order).select(*items.columns, "accepted")
    large = _in_rounds(valued.join(many, "__hash", "left_semi"), keys, order).select(*items.columns, "accepted")
    return small.unionByName(large).unionByName(unknown)


def _walked(valued: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add `accepted` to items of keys with few items: each adds up what the earlier ones used, one by one."""
    kind = valued.schema["__amount"].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    elif isinstance(kind, T.IntegralType):
        kind = T.LongType()
    earlier = Window.partitionBy("__hash", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def use(used: Column, item: Column) -> Column:
        after = used + item["__amount"]
        return F.when(after <= item["__limit"], after).otherwise(used).cast(kind)

    used = F.aggregate("__before", F.lit(0).cast(kind), use)
    seen = valued.withColumn("__before", F.collect_list(F.struct("__amount", "__limit")).over(earlier))
    return seen.withColumn("accepted", used + F.col("__amount") <= F.col("__limit"))


def _in_rounds(valued: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add `accepted` to items of keys of any size."""
    over = (
        valued.groupBy(*keys)
        .agg(F.sum("__amount").alias("__sum"), F.max("__limit").alias("__cap"))
        .where("__sum > __cap")
        .select(*keys)
    )
    easy = valued.join(over, keys, "left_anti").withColumn("accepted", F.lit(True))
    hard = valued.join(over, keys, "left_semi").withColumn("__verdict", F.lit(None).cast("boolean"))

    state, rounds = in_chunks(hard, [*keys, *order]), 0
    while not state.where("__verdict IS NULL").isEmpty():
        rounds += 1
        decided = F.coalesce("__verdict", F.when(_fits_high(), True).when(_fails_low(), False))
        before, state = state, cut_lineage(
            _bounds(state, keys, order).withColumn("__verdict", decided).drop("__low", "__high")
        )
        discard(before)
    log.info("accept_in_order: %d round(s)", rounds)
    return easy.unionByName(state.withColumn("accepted", F.col("__verdict")).select(*easy.columns))


def accept_groups_in_order(
    demand: DataFrame,
    group_id: str,
    keys: Sequence[str],
    levels: Sequence[str],
    amount: str,
    limit: str,
) -> DataFrame:
    """(group_id, accepted) for groups that draw on several keys and are served whole or not at all.

    `demand` holds one row per (group, key) with the amount asked and the limit
    of the key (NULL: unknown key, the group is refused). Groups are served in
    the order of `levels`, then `group_id`; a group without a place in it, or
    without an amount, is refused.
    """
    keys, order = list(keys), [*levels, group_id]
    # read four times below: written once
    rows = cut_lineage(
        demand.select(group_id, *keys, *levels, F.col(amount).alias("__amount"), F.col(limit).alias("__limit"))
    )
    totals = rows.groupBy(*keys).agg(F.sum("__amount").alias("__sum"), F.max("__limit").alias("__cap"))
    contested = totals.where("__cap IS NULL OR __sum > __cap").select(*keys)
    # a group that asks for an unknown key is refused before any round
    refused = [rows.where(~_known(*keys, *levels, "__amount", "__limit")).select(group_id).distinct()]
    hard = rows.join(contested, keys, "left_semi").select(group_id, *keys, *levels, "__amount", "__limit")
    state = in_chunks(
        hard.join(refused[0], group_id, "left_anti").withColumn("__verdict", F.lit(None).cast("boolean")), [*keys, *order]
    )
    rounds = 0
    while not state.where("__verdict IS NULL").isEmpty():
        rounds += 1
        tests = (
            _bounds(state, keys, order)
            .where("__verdict IS NULL")
            .groupBy(group_id)
            .agg(F.bool_and(_fits_high()).alias("__all"), F.bool_or(_fails_low()).alias("__any"))
        )
        new = F.when(F.col("__any"), False).when(F.col("__all"), True)
        verdicts = cut_lineage(tests.select(group_id, new.alias("__new")).where("__new IS NOT NULL"))
        refused.append(verdicts.where(~F.col("__new")).select(group_id))
        # refused rows use nothing, and accepted rows matter only on keys that still have open ones,
        # so each round works on less
        updated = (
            state.join(verdicts, group_id, "left")
            .withColumn("__verdict", F.coalesce("__verdict", "__new"))
            .drop("__new")
            .where("__verdict IS NULL OR __verdict")
        )
        open_keys = updated.where("__verdict IS NULL").select(*keys).distinct()
        before, state = state, cut_lineage(updated.join(open_keys, keys, "left_semi"))
        discard(before)
    log.info("accept_groups_in_order: %d round(s)", rounds)

    none = refused[0]
    for part in refused[1:]:
        none = none.unionByName(part)
    groups = rows.select(group_id).distinct()
    marked = none.distinct().withColumn("__refused", F.lit(True))
    return groups.join(marked, group_id, "left").select(group_id, F.col("__refused").isNull().alias("accepted"))
