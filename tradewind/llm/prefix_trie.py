"""The prefix trie of conversations, by hashes of fixed-length blocks of turns.

A node of depth d stands for one sequence of d turns, and its members are the
conversations that start with it. What is learned about a node (members, children,
leaves, saved characters) costs no walk along the tree:

1. Each turn gets two 64-bit hashes of its place, role and text (from a SHA-256 of
   role and text). Hashes are added up, so a sequence of turns has the sum of its
   turns' hashes, a block of `BLOCK` turns has a digest that any task can add up,
   and a prefix has the running total of a conversation's blocks. Running totals are
   chunked, so one conversation with a third of all turns is dealt over many tasks.
2. Conversations are grouped by the digests before and in a block. A group is kept
   as its smallest member and its count, and only that member's turns go on.
3. Where all conversations behind a common prefix share the next block, the nodes in
   it are the turns of that block. Where siblings diverge, the turns of the block are
   added up one by one, and equal prefixes are put together.
4. A node is known by its smallest member and its depth. From some depth on, a
   conversation is the smallest member of all nodes on its path (it owns them), so
   the sum over a subtree is what the node's owner owns from that depth on, plus all
   that the other members own. Members' sums combine by block like their counts.

Two prefixes are equal if their depth and both sums agree (128 bits). Ids of
conversations that end at one node are joined to texts of bounded length by ranges of
(node, id), and a hash runs over these texts in order, so a node at which a third of
all conversations end needs the memory of one such text.

Turns stand by `turn` (null first); turns that share a number by a hash of role and text.
A null role or text is empty. Rows without a conversation id belong to no conversation
and are left out. Equal rows are equal turns. An empty table has no nodes, also no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.prefix import occurrence_number, totals_before
from tradewind.llm.common import Columns, map_columns
from tradewind.session import stage_table

BLOCK = 4
IDS = 1 << 16  # characters of ids in one text
_SUMS = ["k1", "k2"]  # what a prefix is known by, besides its depth
_WIDE = "decimal(30,0)"


def _lanes(place: Column) -> list[Column]:
    """Two hashes of a turn at a place."""
    return [F.xxhash64(F.lit(lane), place, F.col("content")).cast("decimal(20,0)") for lane in (1, 2)]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """`conv_id`, `pos` (from 1), `content` (128 bits of role and text) and `chars` (code points of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    small = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        content.alias("content"), F.length(text).cast("bigint").alias("chars"),
    )
    return occurrence_number(stage_table(small, "turns"), ["conv_id"], ["turn"], ["content"], "pos").drop("turn")


def replace_heads(turns: DataFrame, owner: Column, count: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns in which each conversation starts with the first `count` (at most `most`) turns of the conversation `owner`.

    Also returns the conversations (`conv_id`), those that are left without a turn included.
    """
    turns = stage_table(turns, "numbered")
    convs = stage_table(turns.groupBy("conv_id").agg(F.lit(True).alias("own")).select("conv_id", owner.alias("owner"), count.alias("taken")), "conversations")
    first = turns.where(F.col("pos") <= most).select(F.col("conv_id").alias("owner"), "pos", "content", "chars")
    heads = stage_table(convs.join(first, "owner").where("pos <= taken").select("conv_id", "pos", "content", "chars"), "heads")
    had = heads.groupBy("conv_id").agg(F.count("*").alias("had"))
    lacking = convs.join(had, "conv_id", "left").select("conv_id", (F.col("taken") - F.coalesce("had", F.lit(0))).alias("lack")).where("lack > 0")
    tails = (
        turns.where(F.col("pos") > count).join(stage_table(lacking, "lacking"), "conv_id", "left")
        .select("conv_id", (F.col("pos") - F.coalesce("lack", F.lit(0))).alias("pos"), "content", "chars")
    )
    return heads.unionByName(tails), convs.select("conv_id")


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """Per conversation and block: its sums `s1`, `s2`, the sums of the blocks before `q1`, `q2`, and its turns `n`."""
    lanes = _lanes(F.col("pos"))
    sums = turns.groupBy("conv_id", F.expr(f"CAST((pos - 1) div {block} AS BIGINT)").alias("block")).agg(
        *[F.sum(lane).cast(_WIDE).alias(f"s{k}") for k, lane in enumerate(lanes, 1)], F.count("*").alias("n")
    )
    before = {f"q{k}": F.col(f"s{k}") for k in (1, 2)}
    found = totals_before(stage_table(sums, "blocks"), ["conv_id"], [], ["block"], before)
    return stage_table(found.select("conv_id", "block", "n", "s1", "s2", *[F.col(q).cast(_WIDE).alias(q) for q in before]), "prefixes")


_KIND = ["block", "q1", "q2", "s1", "s2"]


def _turns_of_kinds(turns: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """Per kind of block (equal prefix and equal turns) the turns of its smallest member, with the prefix that each ends.

    `members`: conversations that have the block; `alone`: no sibling diverges in it.
    """
    kinds = stage_table(blocks.groupBy(*_KIND).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("members")), "kinds")
    # one row per common prefix; the next block of all conversations behind it is the same if it is one kind only
    alone = kinds.groupBy("block", "q1", "q2").agg(F.count("*").alias("kinds"), F.min("conv_id").alias("conv_id"))
    alone = stage_table(alone.where("kinds = 1").select("conv_id", "block", F.lit(True).alias("alone")), "alone")
    marked = kinds.join(alone, ["conv_id", "block"], "left").select("conv_id", "block", "q1", "q2", "members", F.coalesce("alone", F.lit(False)).alias("alone"))
    placed = turns.withColumn("block", F.expr(f"CAST((pos - 1) div {block} AS BIGINT)"))
    joined = placed.join(marked, ["conv_id", "block"])
    # a window holds one block at most
    so_far = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lanes = _lanes(F.col("pos"))
    keys = [(F.col(f"q{k}") + F.sum(lane).over(so_far)).cast(_WIDE).alias(f"k{k}") for k, lane in enumerate(lanes, 1)]
    summed = joined.select("conv_id", "block", F.col("pos").alias("depth"), "chars", "members", "alone", *keys, *[v.alias(f"h{k}") for k, v in enumerate(lanes, 1)])
    parents = [(F.col(f"k{k}") - F.col(f"h{k}")).cast(_WIDE).alias(f"p{k}") for k in (1, 2)]
    return stage_table(summed.select("conv_id", "block", "depth", "chars", "members", "alone", *_SUMS, *parents), "kind-turns")


def _put_together(rows: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Rows of kinds as rows of nodes: only where siblings diverge are equal prefixes put together."""
    key = ["depth", *_SUMS]
    settled = rows.where("alone").select(*key, *[v.alias(n) for n, v in values.items()])
    merged = rows.where("NOT alone").select(*key, *[v.alias(n) for n, v in values.items()])
    ways = {n: F.min if n in ("conv_id", "chars", "p1", "p2") else F.sum for n in values}
    return settled.unionByName(merged.groupBy(*key).agg(*[way(n).cast(settled.schema[n].dataType).alias(n) for n, way in ways.items()]))


def _ids_digest(ends: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per node the SHA-256 of the ascending, comma-joined ids of the conversations that end there."""
    kinds = {f.name: f.dataType.simpleString() for f in ends.schema.fields}
    ddl = ", ".join(f"{k} {kinds[k]}" for k in key)

    def join(batches: Iterator[Columns]) -> Iterator[dict]:
        names, ready, now, ids, size = (*key, "first", "ids"), [], None, [], 0
        for batch in batches:
            columns = [batch[k].to_pylist() for k in (*key, "conv_id")]
            for *at, conv in zip(*columns):
                if ids and (at != now or size > IDS):
                    ready.append((*now, int(ids[0]), ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    now = at
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if ready:
                yield dict(zip(names, zip(*ready)))
                ready = []
        if ids:
            yield dict(zip(names, zip((*now, int(ids[0]), ",".join(ids)))))

    def digest(batches: Iterator[Columns]) -> Iterator[dict]:
        names, ready, now, running = (*key, "ends_sha256"), [], None, None
        for batch in batches:
            columns = [batch[k].to_pylist() for k in (*key, "ids")]
            for *at, ids in zip(*columns):
                if running is not None and at == now:
                    running.update(b",")
                else:
                    if running is not None:
                        ready.append((*now, running.hexdigest()))
                    now, running = at, hashlib.sha256()
                running.update(ids.encode())
            if ready:
                yield dict(zip(names, zip(*ready)))
                ready = []
        if running is not None:
            yield dict(zip(names, zip((*now, running.hexdigest()))))

    order = [*key, "conv_id"]
    texts = map_columns(ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), f"{ddl}, first bigint, ids string", join)
    together = texts.repartition(*key).sortWithinPartitions(*key, "first")
    return map_columns(together, f"{ddl}, ends_sha256 string", digest)


def trie_nodes(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of `turns` (`conv_id`, `pos` from 1 without gaps, `content`, `chars`) and `convs`.

    `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`
    (code points that a cache of the subtree need not read again) and `ends_sha256`. `convs` names every
    conversation, also those without turns, which end at the root.
    """
    turns, key = stage_table(turns, "trie-turns"), ["depth", *_SUMS]
    blocks = _blocks(turns, block)
    kinds = _turns_of_kinds(turns, blocks, block)
    sums = ["n_convs", "n_children", "n_leaves", "owned"]

    nodes = stage_table(_put_together(kinds, {
        "conv_id": F.col("conv_id"), "n_convs": F.col("members"), "chars": F.col("chars"), "p1": F.col("p1"), "p2": F.col("p2"),
    }), "nodes")
    children = stage_table(
        nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children")), "children"
    )

    # the node at which each conversation ends, and one conversation per end without children
    last = blocks.groupBy("conv_id").agg(F.sum("n").alias("depth"), *[F.sum(f"s{k}").cast(_WIDE).alias(f"k{k}") for k in (1, 2)])
    none = F.lit(0).cast(_WIDE)
    turnless = convs.join(last.select("conv_id"), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("bigint").alias("depth"), none.alias("k1"), none.alias("k2"))
    ends = stage_table(last.unionByName(turnless), "ends")
    leaves = ends.groupBy(*key).agg(F.min("conv_id").alias("conv_id")).join(children, key, "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaf"), F.lit(0).cast("bigint").alias("owned"))
    weight = (F.col("n_convs") - 1) * F.col("chars")
    shared = stage_table(nodes.where("n_convs > 1").select("conv_id", "depth", weight.alias("weight"), (-F.col("depth")).alias("up")), "shared-nodes")
    owned = shared.groupBy("conv_id").agg(F.sum("weight").alias("owned")).select("conv_id", F.lit(0).cast("bigint").alias("leaf"), "owned")
    per_conv = stage_table(leaves.unionByName(owned).groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("owned").alias("owned")), "per-conversation")

    # what all members own, by kind of block and then by node
    carried = blocks.join(per_conv, "conv_id", "left").groupBy(*_KIND).agg(
        F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("leaf"), F.sum("owned").alias("owned")
    ).select("conv_id", "block", "leaf", "owned")
    below = _put_together(kinds.join(carried, ["conv_id", "block"]), {"n_leaves": F.col("leaf"), "owned": F.col("owned")})

    # a node's owner: what it owns from there on, in place of all that it owns
    deeper = totals_before(shared, ["conv_id"], [], ["up"], {"deeper": F.col("weight")})
    own = deeper.join(owned.select("conv_id", F.col("owned").alias("all")), "conv_id").select(
        "conv_id", "depth", (F.col("deeper") + F.col("weight") - F.col("all")).alias("correction")
    )

    facts = ["conv_id", "n_convs", "n_children", "n_leaves", "owned", "p1", "p2", "ends_sha256"]
    totals = nodes.select(*key, "conv_id", "n_convs", "p1", "p2")
    for part in (children, below, _ids_digest(ends, key)):
        totals = totals.unionByName(part, allowMissingColumns=True)
    ways = [(F.sum if c in sums else F.max)(c).alias(c) for c in facts]
    found = stage_table(totals.where("depth > 0").groupBy(*key).agg(*ways), "node-facts")

    # the root has no turn: its members are all conversations, its sums are those of all members
    first = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    first = stage_table(first, "root")
    root = first.unionByName(totals.where("depth = 0").select("n_children", "ends_sha256"), allowMissingColumns=True)
    root = root.unionByName(per_conv.select(F.col("leaf").alias("n_leaves"), "owned"), allowMissingColumns=True)
    root = root.agg(*[(F.sum if c in sums else F.max)(c).alias(c) for c in root.columns]).where("n_convs > 0")
    root = root.withColumns({"depth": F.lit(0).cast("bigint"), "parent_conv_id": F.lit(None).cast("bigint")})

    parent = found.select((F.col("depth") + 1).alias("__d"), F.col("k1").alias("__p1"), F.col("k2").alias("__p2"), F.col("conv_id").alias("__above"))
    roots = first.select(F.lit(1).cast("bigint").alias("__d"), none.alias("__p1"), none.alias("__p2"), F.col("conv_id").alias("__above"))
    inner = (
        found.join(parent.unionByName(roots), (F.col("depth") == F.col("__d")) & (F.col("p1") == F.col("__p1")) & (F.col("p2") == F.col("__p2")))
        .join(own, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", F.col("__above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            F.when(F.col("n_convs") > 1, F.coalesce("owned", F.lit(0)) + F.col("correction")).alias("owned"), "ends_sha256",
        )
    )
    nobody = hashlib.sha256(b"").hexdigest()
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return inner.unionByName(root).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", whole("n_children").alias("n_children"), whole("n_leaves").alias("n_leaves"),
        whole("owned").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
