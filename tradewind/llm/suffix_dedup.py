"""Removal of repeated byte strings, with suffix arrays built by two-stage sorting.

Every byte goes that is covered by a string of `LENGTH` bytes which also starts
somewhere else, in the same document or another one.

1. Candidates. Of all stretches of `ANCHOR` bytes in a string of `LENGTH` bytes, the
   one with the smallest hash is its anchor, so equal strings have equal anchors.
   Neighbouring strings mostly share an anchor: each task lists the anchors of its
   documents (about one byte in 85) with the range of strings that each stands for
   and a hash of all bytes of these strings. Only anchors that occur twice go on.
2. Where all bytes around an anchor agree, all its strings are repeats.
3. Where anchors agree and the bytes around them differ, one representative of each
   neighbourhood is fetched, and blocks of whole anchor groups are sorted: the type
   of a suffix says whether it is smaller than its successor; only those suffixes
   are sorted directly, and the others follow by one scan over the buckets of the
   first byte. Neighbours in the suffix array with a common prefix of `LENGTH` bytes
   are repeats.
4. A group with more than `GROUP` different neighbourhoods does not enter one task:
   its strings are compared by hash, in ranges of their distance from the anchor. Where the
   bytes that all strings of a range share stand nowhere else, the range drops out; where the
   bytes around all of them stand elsewhere too, all are repeats; only ranges in between are
   halved, so the rows follow the ends of repeated passages and not the number of strings.

Sets of at most `BROADCAST_KEYS` hashes are broadcast to the rows that they select;
larger ones are joined by key, with the same result.

Hashes have 64 bits, and two strings are taken for equal only if the hashes of
their anchor and of their whole neighbourhood or string agree as well.

Null and empty texts have no bytes and no repeats, as have texts shorter than
`LENGTH`. Equal rows repeat each other. A text of one long run repeats itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.common import BROADCAST_KEYS, Columns, map_columns, rows_in, utf8_bytes
from tradewind.session import stage_table

LENGTH = 200
ANCHOR = 32
GROUP = 2_000
WIDTH = 64  # distances from the anchor that are tested together at first in a large group, a power of two
BLOCK = 1_000  # neighbourhoods of a block, at least, and fewer than that plus GROUP
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(9).integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        size = max(size, 1 << 16)
        _powers[:] = [np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, b, _U))]) for b in (_BASE, _INVERSE)]
    return _powers


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every stretch of `size` bytes."""
    up, down = (t[:len(data)] for t in _power_tables(len(data)))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[data] * up)])
    h = (sums[size:] - sums[:-size]) * down[:len(data) - size + 1]
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours: running minima inside blocks, from the left and from the right."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def anchors(data: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor its position, its hash, and the first and last start of the strings that have it; the ranges tile all starts."""
    h = rolling(data, size)
    placed = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=_U)  # of equal ones the leftmost
    at = (_sliding_min(placed, length - size + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.append(0, np.flatnonzero(np.diff(at)) + 1)
    last = np.append(first[1:] - 1, len(at) - 1)
    return at[first], h[at[first]], first, last


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `data` in the order of their first `depth` bytes, by two-stage sorting."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    # a suffix is smaller than its successor if the first byte that differs from its own is larger
    runs = np.append(np.flatnonzero(np.diff(data)), n - 1)
    rises = np.append(data[runs[:-1] + 1] > data[runs[:-1]], False)
    smaller = np.repeat(rises, np.diff(runs, prepend=-1))
    direct = np.flatnonzero(smaller)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    prefixes = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))
    direct = direct[np.argsort(np.ascontiguousarray(prefixes[direct]).view(f"S{depth}").ravel(), kind="stable")] if len(direct) else direct
    starts = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[n - 1]].append(np.array([n - 1]))  # its successor, the empty suffix, is the smallest of all
    out = []
    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(data[before] == byte) & ~smaller[before]]
        bucket.append(direct[starts[byte]:starts[byte + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[data[before] > byte]
        before = before[~smaller[before]]
        heads = data[before]
        order = np.argsort(heads, kind="stable")
        cuts = np.searchsorted(heads[order], np.arange(257))
        for head in np.unique(heads).tolist():
            waiting[head].append(before[order[cuts[head]:cuts[head + 1]]])
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int, exact: bool = True) -> np.ndarray:
    """Bytes that each suffix of `order` shares with the one before it, up to `depth`; not `exact`: 0 where they are fewer."""
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    shared = np.zeros(len(order), np.int64)
    whole = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, depth), (1, 1))
    for at in range(1, len(order), 1 << 18):  # bounds the copies
        part = np.ascontiguousarray(whole[order[at - 1:at + (1 << 18)]]).view(f"S{depth}").ravel()
        shared[at:at + (1 << 18)] = np.where(part[1:] == part[:-1], depth, 0)
    if not exact:
        return shared
    left = np.flatnonzero(shared == 0)
    left = left[left > 0]
    end = len(data) - np.maximum(order[left], order[left - 1])  # a suffix ends with the data
    shared[left] = np.minimum(end, depth)
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    for word in range(-(-depth // 8)):
        a, b = (np.ascontiguousarray(words[np.minimum(order[x] + 8 * word, len(data))]).view("<u8").ravel() for x in (left, left - 1))
        differ = a ^ b
        lowest = differ & (~differ + _U(1))
        found = differ != 0
        shared[left[found]] = np.minimum(shared[left[found]], 8 * word + (np.log2(lowest[found].astype(np.float64)) // 8).astype(np.int64))
        left = left[~found]
    ends = len(data) - np.maximum(order[1:], order[:-1])
    shared[1:] = np.minimum(shared[1:], ends)
    return shared


def repeated_starts(contexts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """Per context the offsets whose string of `length` bytes also starts in another one, or in one that counts more than once."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order = suffix_array(data, length)
    last_start = np.repeat(begins + sizes - length, sizes + 1)
    order = order[order <= last_start[order]]  # whole strings only
    if not len(order):
        return [np.zeros(0, np.int64) for _ in contexts]
    first = common_prefixes(data, order, length, exact=False) < length
    first[0] = True
    heads = np.flatnonzero(first)
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)[order]
    several = np.diff(np.append(heads, len(order))) > 1
    several |= np.maximum.reduceat(counts[owner], heads) > 1
    marked = np.sort(order[several[np.cumsum(first) - 1]])
    cuts = np.searchsorted(marked, np.append(begins, len(data)))
    return [marked[a:b] - start for a, b, start in zip(cuts[:-1], cuts[1:], begins)]


def _ranges(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.append(0, cuts + 1)], starts[np.append(cuts, len(starts) - 1)]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _row_key() -> Column:
    """Stands for a row, in 128 bits; rows that share it have the same id and text, so each repeats the other's strings."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).cast("binary"), F.lit(b"\0"), utf8_bytes())))


def _occurrences(docs: DataFrame, length: int, size: int) -> DataFrame:
    """One row per anchor, neighbourhood and document row: `hash`, `context`, `key`, `n` and the starts `pos` to `last`.

    Neighbourhoods that repeat inside a document are settled there: rows without `hash` are ranges of repeated starts.
    """

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            texts, keys = batch["text"], batch["key"]
            for at in range(0, len(texts), 200):
                out: dict[str, list] = {k: [] for k in ("key", "hash", "context", "n", "pos", "last")}
                settled: dict[str, list] = {k: [] for k in out}
                for row, text in enumerate(texts.slice(at, 200).to_pylist(), at):
                    if len(text) < length:
                        continue
                    pos, h, first, last = anchors(np.frombuffer(text, np.uint8), length, size)
                    context = np.fromiter(
                        map(xxhash.xxh3_64_intdigest, [text[a:b] for a, b in zip(first.tolist(), (last + length).tolist())], (pos - first).tolist()), _U, len(pos)
                    )
                    both = h * _U(_BASE) ^ context
                    n = np.ones(len(pos), np.int64)
                    if len(set(both.tolist())) < len(both):
                        _, one, group, n = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
                        again = n[group] > 1
                        for a, b in zip(*_ranges(_covered(first[again], last[again]))):
                            for k, v in zip(settled, (row, None, None, 2, int(a), int(b))):
                                settled[k].append(v)
                        h, context, first, last = h[one], context[one], first[one], last[one]
                    for k, v in zip(out, (np.full(len(h), row), _signed(h), _signed(context), n, first, last)):
                        out[k].append(v)
                if out["key"]:
                    whole = {k: np.concatenate(v) for k, v in out.items()}
                    yield whole | {"key": keys.take(pa.array(whole["key"]))}
                if settled["key"]:
                    yield settled | {"key": keys.take(pa.array(settled["key"]))}

    rows = docs.select(_row_key().alias("key"), utf8_bytes().alias("text"))
    return map_columns(rows, "key binary, hash bigint, context bigint, n int, pos int, last int", task)


def _covered(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    depth = np.zeros(int(last.max()) + 2, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last + 1, -1)
    return np.flatnonzero(np.cumsum(depth) > 0)


def _contexts(picked: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of all strings of the picked anchors: `key`, `hash`, `n`, `pos`, `bytes`."""
    wanted = picked.groupBy("key").agg(F.collect_list(F.struct("hash", "pos", "last", "n")).alias("at"))
    keys = stage_table(picked.select("key").distinct(), "context-keys")
    texts = rows_in(docs.select(_row_key().alias("key"), utf8_bytes().alias("text")), keys, ["key"])
    joined = texts.dropDuplicates(["key"]).join(wanted.hint("merge"), "key")  # rows that share a key have one text

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["key"]), 200):
                out: dict[str, list] = {k: [] for k in ("key", "hash", "n", "pos", "bytes")}
                lists = batch["at"].slice(at, 200)
                inner = [x.to_numpy().tolist() for x in (lists.flatten().field(k) for k in ("hash", "pos", "last", "n"))]
                lengths = np.diff(lists.offsets.to_numpy()).tolist()
                places = iter(zip(*inner))
                for key, text, size in zip(batch["key"].slice(at, 200).to_pylist(), batch["text"].slice(at, 200).to_pylist(), lengths):
                    for h, pos, last, n in islice(places, size):
                        for k, v in zip(out, (key, h, n, pos, text[pos:last + length])):
                            out[k].append(v)
                yield out

    return map_columns(joined, "key binary, hash bigint, n bigint, pos int, bytes binary", task)


def _sorted_blocks(contexts: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated starts (`key`, `pos`, `last`) found by suffix arrays over blocks of whole groups."""

    def solve(block: list[tuple]) -> dict:
        keys, lows, counts, data = zip(*block)
        out: dict[str, list] = {"key": [], "pos": [], "last": []}
        for key, low, n, starts in zip(keys, lows, counts, repeated_starts(list(data), np.array(counts), length)):
            if n == 1 and len(starts):  # one that stands for several is known to repeat throughout
                for a, b in zip(*_ranges(starts)):
                    out["key"].append(key), out["pos"].append(low + int(a)), out["last"].append(low + int(b))
        return out

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        block, group = [], None
        for batch in batches:
            columns = [batch[k].to_pylist() for k in ("hash", "key", "pos", "n", "bytes")]
            for h, *row in zip(*columns):
                if h != group and len(block) >= BLOCK:
                    yield solve(block)
                    block = []
                group = h
                block.append(tuple(row))
        if block:
            yield solve(block)

    together = contexts.repartition("hash").sortWithinPartitions("hash", "key", "pos")
    return map_columns(together.select("hash", "key", "pos", "n", "bytes"), "key binary, pos int, last int", task)


_CELL = "key binary, hash bigint, n bigint, pos int, at int, cell int, witness boolean, inner bigint, outer bigint, bytes binary"


def _cells(rows: DataFrame, width: int, reach: int, length: int, first: Callable[[bytes], int] | None = None) -> DataFrame:
    """Each row's strings in cells of `width` distances from the anchor.

    `pos`, `at`: where the row's bytes start in the text, and the anchor in the bytes. `inner`: hash of the bytes that all
    strings of a whole cell share; `outer`: hash of all bytes of a whole cell, null if the row has only a part of it.
    """

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        names = [part.split()[0] for part in _CELL.split(", ")]
        for batch in batches:
            for begin in range(0, len(batch["key"]), 500):
                part = {k: batch[k].slice(begin, 500).to_pylist() for k in batch}
                witnesses = part.get("witness") or [False] * len(part["key"])
                anchors_at = part.get("at") or [first(data) for data in part["bytes"]]
                out: dict[str, list] = {k: [] for k in names}
                for key, h, n, pos, data, at, witness in zip(*(part[k] for k in ("key", "hash", "n", "pos", "bytes")), anchors_at, witnesses):
                    low, high = at - (len(data) - length), at  # distances of the last and the first string
                    for cell in range(low // width, high // width + 1):
                        near, far = cell * width, min((cell + 1) * width - 1, reach)
                        inner = data[at - near:at - far + length]
                        whole = low <= near and far <= high
                        a, b = at - min(far, high), at - max(near, low) + length
                        outer = xxhash.xxh3_64_intdigest(data[a:b], cell) - (1 << 63) if whole else None
                        values = (key, h, n, pos + a, at - a, cell, witness, xxhash.xxh3_64_intdigest(inner, cell) - (1 << 63), outer, data[a:b])
                        for k, v in zip(names, values):
                            out[k].append(v)
                yield out

    wanted = [c for c in ("key", "hash", "n", "pos", "at", "witness", "bytes") if c in rows.columns]
    return map_columns(rows.select(*wanted), _CELL, task)


def _halved(contexts: DataFrame, length: int, size: int) -> DataFrame:
    """The same for groups too large for a block: strings are compared by anchor, distance and hash, in cells that are halved."""
    reach = length - size  # the largest distance of a string from its anchor

    def first(data: bytes) -> int:
        return int(anchors(np.frombuffer(data[:length], np.uint8), length, size)[0][0])

    width, rows, found = WIDTH, _cells(contexts, WIDTH, reach, length, first), []
    while True:
        rows = stage_table(rows, f"cells-{width}")
        alive = stage_table(rows.groupBy("hash", "cell", "inner").agg(F.sum("n").alias("all")).where("all > 1").select("hash", "cell", "inner"), "alive")
        open_rows = rows_in(rows, alive, ["hash", "cell", "inner"])
        often = open_rows.where("outer IS NOT NULL").groupBy("hash", "cell", "outer").agg(F.sum("n").alias("all"), F.min("key").alias("first")).where("all > 1")
        often = stage_table(often.select("hash", "cell", "outer", "first"), "settled")
        marked = open_rows.join(often.hint("merge"), ["hash", "cell", "outer"], "left")
        marked = stage_table(marked.withColumn("settled", F.col("first").isNotNull()), "marked")
        # a witness and a row that stands for several are known to repeat
        repeated = marked.where("settled AND NOT witness AND n = 1")
        found.append(repeated.select("key", "pos", (F.col("pos") + F.octet_length("bytes") - length).cast("int").alias("last")))
        if width == 1:
            break
        undecided = stage_table(marked.where("NOT settled").select("hash", "cell", "inner").distinct(), "undecided")
        # of those that are settled one goes on, for the others to be compared with
        going = marked.where("NOT settled OR key = first").withColumn("witness", F.col("witness") | F.col("settled"))
        going = rows_in(going, undecided, ["hash", "cell", "inner"])
        if going.isEmpty():
            break
        width //= 2
        rows = _cells(going, width, reach, length)
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def repeated_ranges(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """`key` (of a row) and ranges of starts, `pos` to `last`, of strings that also start elsewhere."""
    found = stage_table(_occurrences(docs, length, size), "anchors")
    often = found.where("hash IS NOT NULL").groupBy("hash").agg(F.sum("n").alias("__all")).where("__all > 1").select("hash")
    again = stage_table(rows_in(found, stage_table(often, "repeated-hashes"), ["hash"]), "repeated-anchors")
    kinds = again.groupBy("hash", "context").agg(F.sum("n").alias("n"), F.min(F.struct("key", "pos", "last")).alias("at"))
    kinds = stage_table(kinds, "neighbourhoods")
    whole = rows_in(again, stage_table(kinds.where("n > 1").select("hash", "context"), "repeated-neighbourhoods"), ["hash", "context"])

    mixed = kinds.groupBy("hash").agg(F.count("*").alias("kinds")).where("kinds > 1")
    picked = kinds.join(mixed, "hash").select("hash", "at.key", "at.pos", "at.last", "n", "kinds")
    picked = stage_table(picked, "mixed-neighbourhoods")
    parts = found.where("hash IS NULL").select("key", "pos", "last").union(whole.select("key", "pos", "last"))
    parts = parts.union(_sorted_blocks(_contexts(picked.where(F.col("kinds") <= group), docs, length), length))
    large = picked.where(F.col("kinds") > group)
    return parts if large.isEmpty() else parts.union(_halved(_contexts(large, docs, length), length, size))


def remove_repeats(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """Per document row: `doc_id`, `n_bytes`, the removed `spans` (first and last byte, maximal, ascending) and the `kept` bytes."""
    # rows that share a key have the same ranges, so each range is kept once
    parts = stage_table(repeated_ranges(docs, length, size, group).distinct(), "repeats")
    ranges = parts.groupBy("key").agg(F.collect_list(F.struct("pos", "last")).alias("ranges"))
    rows = docs.select("doc_id", _row_key().alias("key"), utf8_bytes().alias("text"))
    keys = stage_table(parts.select("key").distinct(), "repeat-keys")
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        # documents without repeats need no exchange
        touched = rows.join(F.broadcast(keys), "key", "left_semi").join(ranges.hint("merge"), "key")
        others = rows.join(F.broadcast(keys), "key", "left_anti").withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType))
        rows = touched.unionByName(others)
    else:
        rows = rows.join(ranges.hint("merge"), "key", "left")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["text"]), 500):
                texts = batch["text"].slice(at, 500).to_pylist()
                lists = batch["ranges"].slice(at, 500)
                out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": []}
                for i, text in enumerate(texts):
                    spans: list[dict] = []
                    kept = text
                    if lists[i].is_valid:
                        inner = lists[i].values
                        first = inner.field("pos").to_numpy()
                        last = inner.field("last").to_numpy() + length - 1
                        a, b = _ranges(_covered(first, last))
                        spans = [{"first": x, "last": y} for x, y in zip(a.tolist(), b.tolist())]
                        cuts = [0, *(x for s in spans for x in (s["first"], s["last"] + 1)), len(text)]
                        kept = b"".join(text[x:y] for x, y in zip(cuts[::2], cuts[1::2]))
                    for k, v in zip(out, (len(text), spans, kept)):
                        out[k].append(v)
                yield {"doc_id": batch["doc_id"].slice(at, 500), **out}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(rows.select("doc_id", "text", "ranges"), f"doc_id {kind}, n_bytes bigint, spans array<struct<first:int,last:int>>, kept binary", task)
