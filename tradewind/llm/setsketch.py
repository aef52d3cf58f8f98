"""Near duplicates by SetSketch registers, banding, a joint likelihood, and exact confirmation.

A document is the set of its word shingles. Its sketch has `REGISTERS` registers:
register i is the smallest of exponential draws, one per shingle, on an
exponentially spaced scale (base `BASE`) cut to 16 bits. The sketch of a union is
the register-wise maximum, and two sets agree in a register about as often as
they share shingles.

1. Equal sets become one class (grouped by size and a 128-bit sum of the set).
2. Classes that agree in all registers of a band are candidates. A bucket is not
   paired up: its members are compared with its smallest member.
3. From the registers and the sizes of two sets the Jaccard similarity is estimated
   by maximum likelihood; a pair for which the asked similarity is out of the
   question is dropped, and the others are confirmed on the full sets.
4. Confirmed links merge into components. A bucket that still holds several
   components is then searched to the end. First each member's shingles are counted
   that only its own component has: they bound its similarity to all others from
   above, and most members drop out without a comparison. What is left of a small
   bucket is paired up. In large ones, the members outside the component of the
   smallest member are dealt into blocks; each block meets all members, a part of
   them at a time, through a list of its shingles, so overlaps are exact and no
   pair is ever written that is no link. So no link between two members of a bucket
   is lost, and buckets whose members all ended up together cost nothing more.

Two sets with similarity 0.8 share none of the 32 bands of 5 registers with
probability 3e-6.

Null and empty texts have an empty set and link with nothing. Rows that share an
id count as one document and so as linked. A null id links with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.common import Columns, id_and_bytes, map_columns, rows_in
from tradewind.session import stage_table

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
BASE, TOP = 1.001, 65534
SMALL_BUCKET = 32
BLOCK_SHINGLES = 200_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEEDS = np.random.default_rng(6).integers(1, 1 << 63, REGISTERS, np.uint64) | np.uint64(1)
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _FACTOR
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; fewer words than `width` are one shingle."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * _FACTOR + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def registers(items: np.ndarray) -> np.ndarray:
    """The sketch of a set: per register 1 - log_b of the smallest draw, cut to [0, TOP + 1]."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 256):
        least = np.minimum(least, _draws(items[at:at + 256]).min(0))
    # the smallest of uniform draws u gives the smallest of exponential draws -log(1 - u)
    uniform = (least >> np.uint64(11)).astype(np.float64) / (1 << 53)
    smallest = np.maximum(-np.log1p(-np.minimum(uniform, 1 - 2.0 ** -53)), 1e-300)
    # the scale's origin lies where sets of up to 10^13 shingles still fit under TOP
    return np.clip(np.floor(1 - np.log(smallest / 16) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def _draws(items: np.ndarray) -> np.ndarray:
    x = (items[:, None] ^ _SEEDS[None, :]) * _FACTOR
    return (x ^ (x >> np.uint64(31))) * _MIX


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard similarity per pair, and by how much more likely it is than the asked one (in logs)."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    limit = np.minimum(u / v, v / u)  # no larger similarity is possible with these sizes

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, fewer = chance(u - v * j), chance(v - u * j)
        logs = (np.log(np.maximum(p, 1e-12)) for p in (more, fewer, 1 - more - fewer))
        return sum(n * p for n, p in zip((above, below, equal), logs))

    grid = np.linspace(0, 1, 101)
    table = np.stack([likelihood(np.minimum(limit, j)) for j in grid])
    best = table.argmax(0)
    asked = table[min(percent, 100):].max(0)
    return np.minimum(grid[best], limit), table.max(0) - asked


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """`doc_id`, `n` (shingles), `low` and `high` (sums that stand for the set) and the registers as bytes."""

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            texts = batch["text"]
            for at in range(0, len(texts), 500):
                out: dict[str, list] = {"n": [], "low": [], "high": [], "registers": []}
                for text in texts.slice(at, 500).to_pylist():
                    items = shingles(text, width)
                    out["n"].append(len(items))
                    out["low"].append(int(mixed(items).sum(dtype=np.uint64).view(np.int64)))
                    out["high"].append(int(mixed(items ^ _FACTOR).sum(dtype=np.uint64).view(np.int64)))
                    out["registers"].append(registers(items).tobytes() if len(items) else None)
                yield {"doc_id": batch["doc_id"].slice(at, 500), **out}

    return map_columns(id_and_bytes(docs), "doc_id bigint, n bigint, low bigint, high bigint, registers binary", task)


def _texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of the documents in `pairs`, written once: all joins after this one move only these."""
    needed = stage_table(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")
    return stage_table(rows_in(id_and_bytes(docs), needed, ["doc_id"]), "needed-texts")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (`a`, `b`) of representatives whose full sets are similar enough."""
    rows = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    )

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["a"]), 200):
                part = {k: v.slice(at, 200) for k, v in batch.items()}
                keep, last, items = [], None, None
                for x, y in zip(part["text_a"].to_pylist(), part["text_b"].to_pylist()):
                    if y != last:  # rows come sorted by b
                        last, items = y, shingles(y, width)
                    other = shingles(x, width)
                    common = len(np.intersect1d(items, other, assume_unique=True))
                    keep.append(common > 0 and 100 * common >= percent * (len(items) + len(other) - common))
                mask = pa.array(keep, pa.bool_())
                yield {"a": part["a"].filter(mask), "b": part["b"].filter(mask)}

    return map_columns(rows.select("a", "b", "text_a", "text_b"), "a bigint, b bigint", task)


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose registers do not rule the asked similarity out (a likelihood ratio of e^-14), with the estimate."""
    side = lambda x: sketches.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["a"]), 1000):
                part = {k: v.slice(at, 1000) for k, v in batch.items()}
                r_a, r_b = (np.frombuffer(b"".join(part[k].to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in ("r_a", "r_b"))
                n_a, n_b = (part[k].to_numpy().astype(float) for k in ("n_a", "n_b"))
                similar, gap = estimate(r_a, r_b, n_a, n_b, percent)
                mask = pa.array((gap < 14) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)))
                yield {"a": part["a"].filter(mask), "b": part["b"].filter(mask), "similar": pa.array(similar).filter(mask)}

    return map_columns(rows, "a bigint, b bigint, similar double", task)


def components(links: DataFrame) -> DataFrame:
    """`rep` and `component`, the smallest node reachable, for the nodes of `links` (`a`, `b`).

    Every node repeatedly hands its smallest neighbour to its larger ones, and its
    larger neighbours to the smallest (large star, small star), until nothing changes.
    Smallest neighbours are aggregates, so a hub is no hot task.
    """
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")

    def settled() -> bool:
        """Every node is either above once and never below, or only below: each edge leads to its component."""
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()

    while not settled():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stage_table(small, "links")
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("rep"), F.col("v").alias("component")).distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document row `doc_id`, `n_shingles`, `component_id` (the smallest linked id, itself included) and `kept`."""
    rows = stage_table(sketch(docs, width), "sketches")
    sets = ["n", "low", "high"]
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.min("registers").alias("registers"))
    classes = stage_table(classes, "classes")

    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 1 + 2 * ROWS * i, 2 * ROWS)) for i in range(BANDS)])
    buckets = classes.select("rep", F.explode(bands).alias("bucket")).distinct()
    shared = buckets.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    buckets = stage_table(buckets.join(shared, "bucket").select("bucket", "rep", "least"), "buckets")

    # rows of one id with different sets are one document
    same_id = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", *sets).distinct().join(classes.select(*sets, "rep"), sets)
    links = stage_table(same_id.where("doc_id <> rep").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"), F.collect_set("rep").alias("reps")).where("a <> b").select(F.explode("reps").alias("a"), "b").where("a <> b"), "same-id")

    tried = buckets.where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    tried = stage_table(tried, "tried")
    plausible = stage_table(_plausible(tried, classes, percent), "plausible")
    texts = _texts_of(plausible, docs)
    links = stage_table(links.union(_confirm(plausible.select("a", "b"), texts, width, percent)), "links-1")
    merged = stage_table(components(links), "merged")

    alive, sets_of = _undecided(buckets, classes, merged, docs, width, percent)
    if not alive.isEmpty():
        found = _pairs_of_small(alive, classes, tried, docs, width, percent).union(_links_of_large(alive, sets_of, percent))
        links = stage_table(links.union(found), "links-2")
        merged = stage_table(components(links), "merged")

    where = classes.join(merged, "rep", "left").select(*sets, F.coalesce("component", "rep").alias("component_id"))
    out = rows.drop("registers").join(where, sets, "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def _placed(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Bucket members with their component, and that of the bucket's smallest member as `main`."""
    placed = rows.join(merged, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    main = merged.select(F.col("rep").alias("least"), F.col("component").alias("main"))
    return placed.join(main, "least", "left").withColumn("main", F.coalesce("main", "least"))


def _undecided(buckets: DataFrame, classes: DataFrame, merged: DataFrame, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with several components that may yet be linked there, and the sets of their shingles.

    `bucket`, `rep`, `component`, `main`, `n`, `members` (such members of the bucket) and `common`, the
    most shingles that the set can share with a member of another component. An id with `several` sets is not bounded.
    """
    placed = _placed(buckets, merged)
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    rows = stage_table(placed.join(several, "bucket", "left_semi"), "open")
    needed = stage_table(rows.groupBy(F.col("rep").alias("doc_id")).agg(F.min("component").alias("component")), "open-ids")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["text"]), 200):
                sets = [shingles(t, width).view(np.int64) for t in batch["text"].slice(at, 200).to_pylist()]
                yield {"rep": batch["doc_id"].slice(at, 200), "shingles": sets}

    sets = map_columns(rows_in(id_and_bytes(docs), needed.select("doc_id"), ["doc_id"]), "rep bigint, shingles array<bigint>", task)
    # rows of one id with equal sets are one set, so each shingle of it counts once
    sets = sets.where(F.size("shingles") > 0).distinct()
    sets = stage_table(sets.join(needed.withColumnRenamed("doc_id", "rep"), "rep"), "open-sets")
    owners = sets.select("rep", "component", F.explode("shingles").alias("shingle"))
    own = owners.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x = y").select("shingle")
    alone = owners.join(own, "shingle", "left_semi").groupBy("rep").agg(F.count("*").alias("__alone"))
    # an id with several sets is not judged by them, whether they are classes of its own or of another id
    read = sets.groupBy("rep").agg((F.count("*") > 1).alias("several"))
    sizes = classes.groupBy("rep").agg(F.min("n").alias("n")).join(read, "rep").join(alone, "rep", "left")
    common = F.when(F.col("several"), F.col("n")).otherwise(F.col("n") - F.coalesce("__alone", F.lit(0)))
    sized = rows.join(sizes.select("rep", "n", common.alias("common"), "several"), "rep")
    smallest = sized.groupBy("bucket").agg(F.min("n").alias("__smallest"))
    partner = F.greatest("__smallest", "common")
    may = (100 * F.col("common") >= percent * (partner + F.col("n") - F.col("common"))) | F.col("several")
    kept = stage_table(sized.join(smallest, "bucket").where(may).select("bucket", "rep", "component", "main", "n", "common", "several"), "undecided")
    left = kept.groupBy("bucket").agg(F.count("*").alias("members"), F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return stage_table(kept.join(left.select("bucket", "members"), "bucket"), "undecided"), sets


def _pairs_of_small(alive: DataFrame, classes: DataFrame, tried: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between members of buckets with at most `SMALL_BUCKET` undecided members: all their pairs that the bounds allow."""
    rows = alive.where(F.col("members") <= SMALL_BUCKET)
    side = lambda x: rows.select("bucket", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "component", "n", "common", "several")])
    common = F.least("common_a", "common_b")
    near = (100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)) | F.col("several_a") | F.col("several_b")
    possible = (F.col("component_a") != F.col("component_b")) & near
    pairs = side("a").join(side("b"), "bucket").where((F.col("rep_a") > F.col("rep_b")) & possible)
    pairs = pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    pairs = stage_table(_plausible(pairs, classes, percent).select("a", "b"), "plausible")
    return _confirm(pairs, _texts_of(pairs, docs), width, percent)


def _links_of_large(alive: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members of the other buckets: one for each member, block and component that it is linked with there."""
    rows = alive.where(F.col("members") > SMALL_BUCKET)
    waits = F.bool_or(F.col("component") != F.col("main"))
    members = stage_table(sets.join(rows.groupBy("rep").agg(waits.alias("waits"), F.max("n").alias("n")), "rep"), "members")
    size = members.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("waits"), F.col("n"))).alias("waiting")).first()
    blocks, parts = (max(-(-(x or 0) // BLOCK_SHINGLES), 1) for x in (size["waiting"], size["all"]))
    deal = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(n)).cast("int")
    columns = ["block", "part", "member", "rep", "component", "shingles"]
    centres = members.where("waits").withColumns({"block": deal(blocks, 1), "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "member": F.lit(0)})
    others = members.withColumns({"part": deal(parts, 2), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "member": F.lit(1)})
    met = centres.select(*columns).union(others.select(*columns)).repartition("block", "part").sortWithinPartitions("block", "part", "member", "rep")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        group, block = None, None
        for batch in batches:
            for at in range(0, len(batch["rep"]), 500):
                part = [batch[k].slice(at, 500) for k in columns]
                out: dict[str, list] = {"a": [], "b": []}
                heads = zip(*(x.to_pylist() for x in part[:5]))
                for (b, p, is_member, rep, component), items in zip(heads, part[5]):
                    if (b, p) != group:
                        group, block = (b, p), _Block()
                    items = items.values.to_numpy().view(np.uint64)
                    if not is_member:
                        block.add(rep, component, items)
                        continue
                    for other in block.linked(rep, component, items, percent):
                        out["a"].append(max(rep, other))
                        out["b"].append(min(rep, other))
                if out["a"]:
                    yield out

    return map_columns(met, "a bigint, b bigint", task)


class _Block:
    """Centres of one block with a list of all their shingles."""

    def __init__(self) -> None:
        self.reps: list[int] = []
        self.components: list[int] = []
        self.sets: list[np.ndarray] = []
        self.index: tuple[np.ndarray, np.ndarray] | None = None

    def add(self, rep: int, component: int, items: np.ndarray) -> None:
        self.reps.append(rep), self.components.append(component), self.sets.append(items)

    def linked(self, rep: int, component: int, items: np.ndarray, percent: int) -> list[int]:
        """One centre of each other component that is similar enough."""
        if not self.sets:
            return []
        if self.index is None:
            shingle = np.concatenate(self.sets)
            order = np.argsort(shingle, kind="stable")
            owner = np.repeat(np.arange(len(self.sets)), [len(x) for x in self.sets])
            self.index = shingle[order], owner[order]
            self.sizes = np.array([len(x) for x in self.sets])
        shingle, owner = self.index
        low, high = np.searchsorted(shingle, items, "left"), np.searchsorted(shingle, items, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
        common = np.bincount(owner[at], minlength=len(self.sizes))
        similar = np.flatnonzero((common > 0) & (100 * common >= percent * (self.sizes + len(items) - common)))
        found = {self.components[i]: self.reps[i] for i in similar.tolist() if self.components[i] != component and self.reps[i] != rep}
        return sorted(found.values())


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, and all rows without an id; columns as they are.

    Of rows that share the kept id, the one with the smallest hash of its text stays.
    """
    judged = near_duplicates(docs, width, percent)
    dropped = stage_table(judged.where("NOT kept").select(F.col("doc_id").alias("__id")).distinct(), "dropped")
    repeated = judged.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).count().where("count > 1")
    repeated = stage_table(repeated.select("__id"), "repeated")
    rest = docs.join(dropped, docs["doc_id"] == dropped["__id"], "left_anti")
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, rest["doc_id"] == repeated["__id"], "left_anti")
    others = [c for c in docs.columns if c != "doc_id"]
    first = rest.join(repeated, rest["doc_id"] == repeated["__id"], "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*others), F.struct(F.xxhash64("text"), F.coalesce("text", F.lit("")))).alias("__row")
    )
    return once.unionByName(first.select("doc_id", *[F.col("__row")[c].alias(c) for c in others]))
