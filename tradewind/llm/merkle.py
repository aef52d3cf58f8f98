"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups, and a proof per row.

A leaf is the SHA-256 of a row's fields. Leaves of a group stand in one order; runs
of `fanout` consecutive nodes are hashed together, level by level, until one node,
the subroot, is left. The subroots, in the order of their groups, form the same kind
of tree, whose top is the root.

* Leaves are hashed where they are read; texts never move. Rows are numbered by
  chunked running totals, so a group with most of the rows is dealt over many tasks.
* Every level joins its nodes with the nodes at the computed sibling indices: index
  XOR 1 with a fanout of two, one join per slot offset otherwise. Join keys are
  (group, index), which no group makes hot. Each node then knows the digests
  before and after it in its run, and the nodes in slot zero emit the parents.
* Proofs go the other way: each node takes its parent's path and puts its own step
  in front, so a level costs one join over its nodes. Levels halve, so all levels
  together cost about twice the lowest one.

A node without siblings at index zero is alone in its group: it is the subroot, and
no further hash is taken. Digests are lowercase hex text, and hashes are taken over
that text. A null group or order value comes first; rows with equal order values
stand in the order of their leaves, so repeated rows have neighbouring leaves and
equal folded roots, and may change places. An empty table has no nodes and no root.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.prefix import totals_before
from tradewind.session import stage_table

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STAGED_EVERY = 6  # levels of a path that one plan works out
_TOP = -1  # parent index of a node that is alone in its group


def field(value: Column) -> Column:
    """A field as it enters the hash: its length in UTF-8 bytes, a colon, the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(changed: Mapping[str, Column] | None = None) -> Column:
    """The leaf of a row of documents; `changed` replaces fields, as somebody who tampers with the row would."""
    changed = changed or {}
    return digest(*[field(changed.get(name, F.col(name))) for name in LEAF_FIELDS])


@dataclass
class Manifest:
    """The levels of a forest, lowest first: `group`, `idx`, `node`, and the digests `before` and `after` it in its run."""

    levels: list[DataFrame]
    fanout: int

    @property
    def tops(self) -> DataFrame:
        """`group`, `node`: what remains of each group."""
        found = [level.where(_alone()).select("group", "node") for level in self.levels]
        out = found[0]
        for part in found[1:]:
            out = out.unionByName(part)
        return out


def _alone() -> Column:
    return (F.col("idx") == 0) & (F.col("before") == "") & (F.col("after") == "")


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes with the digests of the other nodes of their run, joined by sibling index."""
    others = nodes.select(F.col("group").alias("__group"), F.col("idx").alias("__idx"), F.col("node").alias("__sibling"))
    slot = F.col("idx") % fanout
    joined = nodes
    for offset in range(1, fanout):
        at = F.col("idx").bitwiseXOR(F.lit(1).cast("bigint")) if fanout == 2 else F.col("idx") - slot + (slot + offset) % fanout
        joined = (
            joined.withColumn("__at", at)
            .join(others, (F.col("group") == F.col("__group")) & (F.col("__at") == F.col("__idx")), "left")
            .withColumn(f"__s{offset}", F.coalesce("__sibling", F.lit("")))
            .drop("__at", "__group", "__idx", "__sibling")
        )
    # by ascending slot: behind slot s come the offsets 1 to fanout - s - 1, before it the remaining ones
    after = F.concat(*[F.when(slot + o < fanout, F.col(f"__s{o}")).otherwise("") for o in range(1, fanout)])
    before = F.concat(*[F.when(slot + o >= fanout, F.col(f"__s{o}")).otherwise("") for o in range(1, fanout)])
    return joined.select(*nodes.columns, before.alias("before"), after.alias("after"))


def _tree(nodes: DataFrame, fanout: int) -> Manifest:
    """All levels above numbered nodes (`group`, `idx`, `node`; more columns stay on the lowest level)."""
    count = nodes.agg(F.max("idx")).first()[0]  # the size of the largest group decides the number of levels
    width, levels = 0 if count is None else count + 1, []
    while True:
        levels.append(stage_table(_with_siblings(nodes, fanout), f"manifest-{len(levels)}"))
        if width <= 1:
            return Manifest(levels, fanout)
        width = -(-width // fanout)
        first = levels[-1].where((F.col("idx") % fanout == 0) & ~_alone())
        nodes = first.select("group", F.expr(f"idx div {fanout}").alias("idx"), digest(F.col("node"), F.col("after")).alias("node"))


def build_manifest(leaves: DataFrame, group: str, order: Sequence[str], fanout: int = 2) -> tuple[Manifest, Manifest]:
    """The trees of all groups of `leaves` (`node` and further columns), and the tree over their subroots."""
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    # a text in the order of the groups' UTF-8 bytes, null first
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    written = stage_table(leaves.withColumn("group", key), "leaves")
    numbered = totals_before(written, ["group"], [], [*order, "node"], {"idx": F.lit(1).cast("bigint")})
    forest = _tree(numbered, fanout)
    tops = stage_table(forest.tops.select(F.col("group").alias("member"), "node", F.lit("").alias("group")), "subroots")
    crown = _tree(totals_before(tops, ["group"], [], ["member"], {"idx": F.lit(1).cast("bigint")}), fanout)
    return forest, crown


def _paths(manifest: Manifest, tops: DataFrame) -> DataFrame:
    """The lowest level with `path` (steps upwards, each the digests before and after the node) and the columns of `tops`.

    `tops` has one row per group: `group`, `path` from there on, and what every node of the group shall know.
    """
    fanout, known = manifest.fanout, [c for c in tops.columns if c not in ("group", "path")]
    above = None
    for k in reversed(range(len(manifest.levels))):
        level, roof = manifest.levels[k], tops.withColumn("idx", F.lit(_TOP).cast("bigint"))
        above = roof if above is None else above.unionByName(roof)
        parents = above.select(
            F.col("group").alias("__group"), F.col("idx").alias("__idx"), F.col("path").alias("__path"), *known
        )
        up = F.when(_alone(), F.lit(_TOP).cast("bigint")).otherwise(F.expr(f"idx div {fanout}"))
        joined = level.withColumn("__up", up).join(parents, (F.col("group") == F.col("__group")) & (F.col("__up") == F.col("__idx")))
        step = F.array(F.struct("before", "after"))
        path = F.when(_alone(), F.col("__path")).otherwise(F.concat(step, F.col("__path")))
        own = ["group", "idx"] if k else [c for c in level.columns if c not in ("before", "after")]
        above = joined.select(*own, path.alias("path"), *known)
        if k and k % STAGED_EVERY == 0:
            above = stage_table(above, "paths")
    return above


def proofs(forest: Manifest, crown: Manifest) -> DataFrame:
    """Every leaf with its columns, its `path` to the root, its `subroot` and the `root`."""
    kind = "array<struct<before:string,after:string>>"
    root = crown.tops.select("group", F.array().cast(kind).alias("path"), F.col("node").alias("root"))
    subroots = _paths(crown, root).select(
        F.col("member").alias("group"), "path", F.col("node").alias("subroot"), "root"
    )
    return _paths(forest, stage_table(subroots, "subroot-paths"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def document_manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = 2) -> DataFrame:
    """Per row of documents: `doc_id`, `leaf`, `subroot`, `root`, `path`, `folded_root` and `verified`.

    Rows chosen by `tampered` are folded from a leaf with one more in `n_chars`; their siblings stay as they are.
    """
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = F.lit(False) if tampered is None else tampered
    leaves = docs.select(
        "doc_id", "lang", leaf_digest().alias("node"), F.when(hit, leaf_digest(more)).alias("tampered")
    )
    proved = proofs(*build_manifest(leaves, "lang", ["doc_id"], fanout))
    folded = fold(F.coalesce("tampered", "node"), F.col("path"))
    return proved.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
