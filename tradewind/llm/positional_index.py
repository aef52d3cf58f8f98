"""Benchmark decontamination with a distributed positional inverted index.

The documents are cut into segments of bounded size, and each segment stores its
postings: the hashes of its terms in order, and per term the ascending list of the
positions where it stands. Segments are written once to the shared folder, so
every later question reads postings and not texts.

A question is a list of phrases. It is answered segment by segment: a phrase with
a term that the segment lacks is dropped at once; for the others the list of the
rarest term, moved back by the term's offset in the phrase, gives the possible
starts, and the lists of the other terms, rarer ones first, are intersected with
it, each moved back by its own offset. What is left are exact matches. For
proximity the same lists are searched for all terms inside a short span.

The questions travel in blocks of at most `BLOCK_TERMS` terms, whatever their
number, and each block is put to all segments. A block holds its words once, and its
windows as runs over them; a segment looks its own terms up in the block, and only
the windows that it has all terms of are written out, some thousands at a time. So a
worker holds a few bytes for each word of a block. No posting list leaves its segment,
so a term that stands in every document is no hot key.

Words are maximal runs of digits, ASCII letters (A-Z lowered) and characters beyond
ASCII. Null and empty texts have no words; an item without words asks nothing.
Rows that share an id are matched one by one and reported under that id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.common import Columns, id_and_bytes, map_columns
from tradewind.session import setting, stage_table

WINDOW = 13
SEGMENT_WORDS = 200_000
BLOCK_TERMS = 2_000_000
SLICE = 16_384  # windows that are written out at a time
BATCH_BYTES = str(8 << 20)  # of texts, or of segments, that a worker is sent at a time
CANDIDATES = 1_000_000  # possible starts that are looked at at a time, or those of one window
_TO_WORDS = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def build_index(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """The stored index: one row per segment.

    `rows` (the number `row` of a document row, by default one of its own), `doc_ids`, `n_words`; `terms` (sorted hashes), `ends`
    (where a term's list ends) and `positions` (in the segment, documents one after the other).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def segment(rows: list, ids: list, sizes: list[int], words: list[np.ndarray]) -> dict:
        stream = np.concatenate(words) if words else np.zeros(0, np.uint64)
        order = np.argsort(stream, kind="stable")
        terms, counts = np.unique(stream, return_counts=True)
        return {
            "rows": [rows], "doc_ids": [ids], "n_words": [sizes],
            "terms": [terms.view(np.int64)], "ends": [np.cumsum(counts).astype(np.int32)], "positions": [order.astype(np.int32)],
        }

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        rows, ids, sizes, words, held = [], [], [], [], 0
        for batch in batches:
            for at in range(0, len(batch["text"]), 500):
                part = {k: v.slice(at, 500).to_pylist() for k, v in batch.items()}
                for row, doc_id, text in zip(part["row"], part["doc_id"], part["text"]):
                    found = hashes_of(words_of(text))
                    rows.append(row), ids.append(doc_id), sizes.append(len(found)), words.append(found)
                    held += len(found)
                    # a document is never cut; many without words also fill a segment
                    if held >= SEGMENT_WORDS or len(rows) >= SEGMENT_WORDS:
                        yield segment(rows, ids, sizes, words)
                        rows, ids, sizes, words, held = [], [], [], [], 0
        if rows:
            yield segment(rows, ids, sizes, words)

    numbered = id_and_bytes(docs, (F.monotonically_increasing_id() if row is None else row).alias("row"))
    ddl = f"rows array<bigint>, doc_ids array<{kind}>, n_words array<int>, terms array<bigint>, ends array<int>, positions array<int>"
    # a row is a megabyte: pages and row groups of many rows would be held whole by whoever writes or reads them
    small = {"parquet__block__size": str(16 << 20), "parquet__page__size__row__check__min": "1", "parquet__block__size__row__check__min": "1"}
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        return stage_table(map_columns(numbered, ddl, task), "positional-index", **small)


class Segment:
    """Posting lists of one segment as one sorted array of (term, position)."""

    def __init__(self, n_words: np.ndarray, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> None:
        self.doc_ends = np.cumsum(n_words.astype(np.int64))
        self.size = int(self.doc_ends[-1]) if len(self.doc_ends) else 0
        self.terms = terms.view(np.uint64)
        self.ends = ends.astype(np.int64)
        self.starts = np.append(0, self.ends[:-1]).astype(np.int64)
        self.positions = positions.astype(np.int64)
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), self.ends - self.starts) * max(self.size, 1) + self.positions

    def find_terms(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the term list, or -1."""
        at = np.minimum(np.searchsorted(self.terms, hashes), max(len(self.terms) - 1, 0))
        return np.where(self.terms[at] == hashes, at, -1) if len(self.terms) else np.full(len(hashes), -1)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """As `find_terms`, for sorted distinct hashes: the segment's terms are looked up among them."""
        out = np.full(len(hashes), -1, np.int32)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, self.terms), len(hashes) - 1)
            here = np.flatnonzero(hashes[at] == self.terms)
            out[at[here]] = here
        return out

    def phrases(self, places: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every exact match; a phrase is a run of `places`, the place in the term list of each word, or -1."""
        none = np.zeros(0, np.int64)
        if not self.size or not len(places):
            return none, none
        known = np.append(0, np.cumsum(places >= 0, dtype=np.int32))
        alive = np.flatnonzero((known[starts + lengths] - known[starts] == lengths) & (lengths > 0))
        found = [part for at in range(0, len(alive), SLICE) for part in self._matches(places, starts, lengths, alive[at:at + SLICE])]
        return (np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])) if found else (none, none)

    def _matches(self, places: np.ndarray, starts: np.ndarray, lengths: np.ndarray, alive: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The matches of the phrases `alive`, in parts of at most `CANDIDATES` possible starts or of one phrase."""
        offset = np.arange(lengths[alive].max())
        size = lengths[alive].astype(np.int64)
        at = places[np.minimum(starts[alive].astype(np.int64)[:, None] + offset, len(places) - 1)].astype(np.int64)
        at[offset >= size[:, None]] = -2  # beyond the end of a phrase
        counts = np.where(at >= 0, (self.ends - self.starts)[np.maximum(at, 0)], np.iinfo(np.int64).max)
        rarest_first = np.argsort(counts, axis=1, kind="stable")
        n = counts[np.arange(len(alive)), rarest_first[:, 0]]
        part = (np.cumsum(n) - 1) // CANDIDATES
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(alive))
        for a, b in zip(cuts[:-1], cuts[1:]):
            phrase, start = self._starts(at[a:b], rarest_first[a:b], n[a:b], size[a:b])
            if len(phrase):
                yield alive[a:b][phrase], start

    def _starts(self, at: np.ndarray, rarest_first: np.ndarray, n: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lead = at[np.arange(len(at)), rarest_first[:, 0]]
        phrase = np.repeat(np.arange(len(at)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.positions[np.repeat(self.starts[lead], n) + inside] - rarest_first[phrase, 0]
        ok = (start >= 0) & (start + size[phrase] <= self.size)
        phrase, start = phrase[ok], start[ok]
        for turn in range(1, at.shape[1]):
            offset = rarest_first[phrase, turn]
            term = at[phrase, offset]
            key = term * self.size + start + offset
            near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (term < 0) | (self.keys[near] == key)
            phrase, start = phrase[ok], start[ok]
            if not len(phrase):
                break
        first = np.searchsorted(self.doc_ends, start, "right")
        last = np.searchsorted(self.doc_ends, start + size[phrase] - 1, "right")
        return phrase[first == last], start[first == last]

    def spans(self, term_places: np.ndarray, within: int) -> list[tuple[int, int]]:
        """Shortest stretches of at most `within` words, one per occurrence of the rarest term, that hold all terms."""
        lists = sorted((self.positions[self.starts[t]:self.ends[t]] for t in term_places), key=len)
        found = set()
        for p in lists[0].tolist():
            doc = np.searchsorted(self.doc_ends, p, "right")
            low = max(p - within + 1, int(self.doc_ends[doc - 1]) if doc else 0)
            high = min(p + within - 1, int(self.doc_ends[doc]) - 1)
            near = sorted((x, i) for i, xs in enumerate(lists[1:], 1) for x in xs[np.searchsorted(xs, low):np.searchsorted(xs, high, "right")].tolist())
            near = sorted([*near, (p, 0)])
            best, seen, left = None, {}, 0
            for x, i in near:
                seen[i] = seen.get(i, 0) + 1
                while seen[near[left][1]] > 1:
                    seen[near[left][1]] -= 1
                    left += 1
                if len(seen) == len(lists) and x - near[left][0] < within and (best is None or x - near[left][0] < best[1] - best[0]):
                    best = (near[left][0], x)
            if best:
                found.add(best)
        return sorted(found)


def _segments(batch: Columns) -> Iterator[tuple[list, list, np.ndarray, "Segment"]]:
    for i in range(len(batch["rows"])):
        n_words, terms, ends, positions = (batch[k][i].values.to_numpy(zero_copy_only=False) for k in ("n_words", "terms", "ends", "positions"))
        yield batch["rows"][i].values.to_numpy(zero_copy_only=False), batch["doc_ids"][i].values, n_words, Segment(n_words, terms, ends, positions)


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, np.ndarray]]]:
    """The items with words, as (id as text, word hashes), in blocks of at most `BLOCK_TERMS` words or of one item."""
    block, held = [], 0
    for row in items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).toLocalIterator():
        hashes = hashes_of(words_of(bytes(row["text"])))
        if not len(hashes):
            continue
        if block and held + len(hashes) > BLOCK_TERMS:
            yield block
            block, held = [], 0
        block.append((row["item_id"], hashes))
        held += len(hashes)
    if block:
        yield block


@dataclass(frozen=True)
class Questions:
    """The windows of a block of items: all runs of so many words, or the whole item if it has fewer.

    The words of the block's different texts stand one after the other in `stream`, as places in the sorted `hashes`. Window i
    has the words from `starts[i]` on, `lengths[i]` of them, and stands in the texts `texts[ends[i - 1]:ends[i]]`; each window is
    asked once. `items` are the ids that have a text.
    """

    hashes: np.ndarray
    stream: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    texts: np.ndarray
    ends: np.ndarray
    items: list[list[str | None]]

    def items_of(self, windows: np.ndarray) -> list[str | None]:
        """The ids of the items that have one of these windows, null last."""
        texts = {t for w in windows for t in self.texts[self.ends[w - 1] if w else 0:self.ends[w]].tolist()}
        return sorted({item for t in texts for item in self.items[t]}, key=lambda x: (x is None, x))


def questions(block: list[tuple[str, np.ndarray]], window: int = WINDOW) -> Questions:
    ids: dict[bytes, list[str | None]] = {}
    for item, words in block:
        ids.setdefault(words.tobytes(), []).append(item)
    texts = [np.frombuffer(t, np.uint64) for t in ids]
    hashes, stream = np.unique(np.concatenate(texts), return_inverse=True)
    stream = stream.astype(np.int32)
    sizes = np.array([len(t) for t in texts])
    n = np.maximum(sizes - window + 1, 1)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    starts = np.arange(n.sum()) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n)
    lengths = np.minimum(sizes, window)[text]
    # windows of equal words are found by a hash of the words, and then compared
    key = lengths.astype(np.uint64)
    for k in range(window):
        inside = lengths > k
        key[inside] = key[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[stream[starts[inside] + k]]
    _, first, group = np.unique(key, return_index=True, return_inverse=True)
    first = first[group]
    equal = lengths == lengths[first]
    for k in range(window):
        inside = np.flatnonzero(equal & (lengths > k))
        equal[inside] = stream[starts[inside] + k] == stream[starts[first[inside]] + k]
    kept, group = np.unique(np.where(equal, first, np.arange(len(first))), return_inverse=True)
    return Questions(
        hashes, stream, starts[kept].astype(np.int32), lengths[kept].astype(np.int32),
        text[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group)).astype(np.int32), list(ids.values()),
    )


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty if not frames else frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def window_hits(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact matches of the items' windows, per document row with any: `row`, `doc_id`, merged `spans` of
    hit words (first and last, from 0) and the `items` (ids as text, null as null) whose windows occur.

    One row per document row and block of items.
    """
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = f"row bigint, doc_id {kind}, spans array<struct<first:int,last:int>>, items array<string>"

    def asked(block: list[tuple[str, np.ndarray]]) -> DataFrame:
        shipped = index.sparkSession.sparkContext.broadcast(questions(block, window))  # bounded by the block

        def task(batches: Iterator[Columns]) -> Iterator[dict]:
            asks = shipped.value
            for batch in batches:
                for rows, ids, n_words, segment in _segments(batch):
                    phrase, start = segment.phrases(segment.places(asks.hashes)[asks.stream], asks.starts, asks.lengths)
                    if not len(phrase):
                        continue
                    doc = np.searchsorted(segment.doc_ends, start, "right")
                    order = np.lexsort((start, doc))
                    phrase, start, doc = phrase[order], start[order], doc[order]
                    out = {"row": [], "doc_id": [], "spans": [], "items": []}
                    cuts = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        d = int(doc[a])
                        base = int(segment.doc_ends[d] - n_words[d])
                        spans = merge_spans((start[a:b] - base).tolist(), (start[a:b] - base + asks.lengths[phrase[a:b]] - 1).tolist())
                        out["row"].append(int(rows[d]))
                        out["doc_id"].append(ids[d].as_py())
                        out["spans"].append([{"first": x, "last": y} for x, y in spans])
                        out["items"].append(asks.items_of(np.unique(phrase[a:b])))
                    yield out

        # written before the next block is read, so that neither the driver nor a worker holds several blocks
        with setting(index.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
            hits = stage_table(map_columns(index, ddl, task), "window-hits")
        shipped.destroy()
        return hits

    return _union([asked(block) for block in _blocks(items)], index.sparkSession.createDataFrame([], ddl))


def merge_spans(firsts: Iterable[int], lasts: Iterable[int]) -> list[tuple[int, int]]:
    """Stretches that overlap or touch, joined; `firsts` ascend."""
    out: list[tuple[int, int]] = []
    for a, b in zip(firsts, lasts):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def phrase_matches(index: DataFrame, items: DataFrame) -> DataFrame:
    """Every place where the whole text of an item stands: `row`, `doc_id`, `item_id` (as text), `first`, `last`."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = f"row bigint, doc_id {kind}, item_id string, first int, last int"

    def asked(block: list[tuple[str, np.ndarray]]) -> DataFrame:
        shipped = index.sparkSession.sparkContext.broadcast(block)

        def task(batches: Iterator[Columns]) -> Iterator[dict]:
            for batch in batches:
                for rows, ids, n_words, segment in _segments(batch):
                    for item, hashes in shipped.value:
                        length = len(hashes)
                        _, start = segment.phrases(segment.find_terms(hashes), np.zeros(1, np.int64), np.array([length]))
                        doc = np.searchsorted(segment.doc_ends, start, "right")
                        first = start - (segment.doc_ends[doc] - n_words[doc])
                        yield {"row": rows[doc], "doc_id": ids.take(pa.array(doc)), "item_id": [item] * len(doc), "first": first.astype(np.int32), "last": (first + length - 1).astype(np.int32)}

        return map_columns(index, ddl, task)

    return _union([asked(block) for block in _blocks(items)], index.sparkSession.createDataFrame([], ddl))


def proximity_matches(index: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """Stretches of at most `within` words that hold all distinct terms of an item in any order."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = f"row bigint, doc_id {kind}, item_id string, first int, last int"

    def asked(block: list[tuple[str, np.ndarray]]) -> DataFrame:
        shipped = index.sparkSession.sparkContext.broadcast(block)

        def task(batches: Iterator[Columns]) -> Iterator[dict]:
            for batch in batches:
                for rows, ids, n_words, segment in _segments(batch):
                    out = {"row": [], "doc_id": [], "item_id": [], "first": [], "last": []}
                    for item, hashes in shipped.value:
                        places = segment.find_terms(np.unique(hashes))
                        if (places < 0).any():
                            continue
                        for a, b in segment.spans(places, within):
                            doc = int(np.searchsorted(segment.doc_ends, a, "right"))
                            base = int(segment.doc_ends[doc] - n_words[doc])
                            for k, v in zip(out, (int(rows[doc]), ids[doc].as_py(), item, a - base, b - base)):
                                out[k].append(v)
                    yield out

        return map_columns(index, ddl, task)

    return _union([asked(block) for block in _blocks(items)], index.sparkSession.createDataFrame([], ddl))


def _judged(index: DataFrame, items: DataFrame, window: int) -> DataFrame:
    hits = window_hits(index, items, window)
    stretch: Column = F.transform("spans", lambda s: F.sequence(s["first"], s["last"]))
    hits = hits.groupBy("row", "doc_id").agg(
        # spans of one block are disjoint, so only several blocks can count a word twice
        F.size(F.array_distinct(F.flatten(F.flatten(F.collect_list(stretch))))).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    sizes = index.select(F.explode(F.arrays_zip("rows", "doc_ids", "n_words")).alias("d"))
    sizes = sizes.select(F.col("d.rows").alias("__row"), F.col("d.doc_ids").alias("__id"), F.col("d.n_words").cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return sizes.join(hits, (F.col("__row") == F.col("row")) & F.col("__id").eqNullSafe(F.col("doc_id")), "left").select(
        "__row", F.col("__id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: `doc_id`, `n_words`, `n_hit` (words inside a matched window), `items` and `contaminated`.

    Contaminated: some word is hit, and the hit words are a twentieth of all words or more.
    """
    return _judged(build_index(docs), items, window).drop("__row")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their columns. Rows with the same id and text go together."""
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    judged = _judged(build_index(docs, content), items, window)
    # written first, so that the join knows how few these are
    bad = stage_table(judged.where("contaminated").select("__row", F.col("doc_id").alias("__id")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (content == bad["__row"]), "left_anti")
