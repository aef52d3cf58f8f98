"""Token ids in ORC: integer run-length coding, row indexes, Bloom filters on the ids.

Texts move once, by ranges of `doc_id`; each task encodes its range and writes one
ORC file in ascending order. Stripes are the unit of a parallel read, row indexes
hold the smallest and largest `doc_id` of every 10,000 rows, and a Bloom filter on
`doc_id` lets `read_documents` skip stripes and row groups without reading ids.

Equal white-space chunks have equal ids: the tokenizer looks for its added tokens,
which have no white space and keep their case, drops white space and case, and then
cuts between a letter and a following punctuation mark. So chunks that may hold an
added token stay as they are written, the others are lowered, and a worker encodes
each distinct core of a chunk once, many in one call, and keeps a bounded number of
chunks and cores; a full store is emptied, which costs time and changes nothing. The
chunks of a batch are cut and made distinct as columns, looked up once each, and the
ids of the batch are put together in one gather.

A null or empty text is the end id alone. A null id sorts first. Rows that share
an id stand in the order of their texts, and are dealt over several files if they are
many. Extra columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewind.llm.common import Columns, id_and_bytes, map_columns
from tradewind.session import stage_table

KEPT_CHUNKS, KEPT_CORES = 1_000_000, 700_000
SLICE = 8 << 20
_MARK = "\x01"  # stands between cores of one call; chunks that hold it are encoded alone
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ENCODERS: dict[str, "ChunkEncoder"] = {}


class ChunkEncoder:
    """Ids of white-space chunks, kept one after the other in one array; a chunk is known by its place in the list of stretches."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self._empty()
        self.mark = self._ids(_MARK)
        assert len(self.mark) == 1
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _empty(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.cores: dict[str, int] = {"": 0}
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 1  # the first one is empty

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Keep stretches that follow each other in `ids`; returns the place of the first."""
        for name, more, have in (("flat", len(ids), self.used), ("starts", len(sizes), self.count), ("sizes", len(sizes), self.count)):
            held = getattr(self, name)
            if have + more > len(held):
                grown = np.zeros(max(2 * len(held), have + more), held.dtype)
                grown[:have] = held[:have]
                setattr(self, name, grown)
        first, at = self.count, self.used
        self.flat[at:at + len(ids)] = ids
        self.sizes[first:first + len(sizes)] = sizes
        self.starts[first:first + len(sizes)] = at + np.cumsum(sizes) - sizes
        self.used, self.count = at + len(ids), first + len(sizes)
        return first

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known stretches, one after the other, and their numbers."""
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[places] - ends + sizes, sizes) + np.arange(total)], sizes

    def _learn_cores(self, cores: pa.Array) -> np.ndarray:
        """The places of cores (texts, all different), which are encoded if they are new."""
        texts = cores.to_pylist()
        places = np.array([self.cores.get(text, -1) for text in texts], np.int64)
        new = np.flatnonzero(places < 0)
        if len(new):
            fresh = cores.take(pa.array(new))
            # a special token is one only as a whole
            single = pc.match_substring_regex(fresh, r"<\||\x01").to_numpy(zero_copy_only=False)
            letters = pc.utf8_is_alpha(fresh).to_numpy(zero_copy_only=False) & ~single
            words, others = new[letters], new[~letters & ~single]
            for i in new[single].tolist():
                ids = self._ids(texts[i])
                places[i] = self._append(ids, np.array([len(ids)]))
            if len(words):
                # letters alone make one word, which ends with a token that says so
                ids = self._ids(" ".join([texts[i] for i in words.tolist()]))
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) == len(words):
                    places[words] = self._append(ids, np.diff(cuts, prepend=0)) + np.arange(len(words))
                else:
                    others = np.concatenate([others, words])
            if len(others):
                ids = self._ids(f" {_MARK} ".join([texts[i] for i in others.tolist()]))
                marks = ids == self.mark[0]
                cuts = np.append(np.flatnonzero(marks), len(ids))
                assert len(cuts) == len(others)
                places[others] = self._append(ids[~marks], np.diff(cuts, prepend=-1) - 1) + np.arange(len(others))
            self.cores.update(zip([texts[i] for i in new.tolist()], places[new].tolist()))
        return places

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """The places of new chunks (texts); chunks of one call share the encoding of their new cores."""
        # core and trailing punctuation; the cut is safe only behind an ASCII letter or digit
        trimmed = pc.ascii_rtrim(chunks, characters=_PUNCTUATION)
        safe = pc.and_(pc.match_substring_regex(trimmed, "[0-9A-Za-z]$"), pc.invert(pc.match_substring(chunks, "<|")))
        cores = pc.if_else(safe, trimmed, chunks)
        sizes = pc.binary_length(cores).to_numpy()
        cut = np.flatnonzero(sizes < pc.binary_length(chunks).to_numpy())
        tails = [chunk[size:] for chunk, size in zip(chunks.take(pa.array(cut)).view(pa.binary()).to_pylist(), sizes[cut].tolist())]
        coded = pa.concat_arrays([cores, pa.array(tails, pa.binary()).view(pa.string())]).dictionary_encode()
        found = self._learn_cores(coded.dictionary)[coded.indices.to_numpy()]
        places, ends = found[:len(chunks)].copy(), found[len(chunks):]
        if len(cut):
            ids, sizes = self.gather(np.column_stack([places[cut], ends]).ravel())
            places[cut] = self._append(ids, sizes.reshape(-1, 2).sum(axis=1)) + np.arange(len(cut))
        return places

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (binary) in a row, and how many each text has; equal chunks of a batch are looked up once."""
        if len(self.known) > KEPT_CHUNKS or len(self.cores) > KEPT_CORES:
            self._empty()
        texts = texts.cast(pa.binary()).view(pa.string())
        lowered = pc.ascii_lower(texts)
        marked = pc.match_substring(texts, "<|")
        if pc.any(marked).as_py():
            # added tokens are matched in the text as it is written
            own = [b" ".join(c if b"<|" in c else c.lower() for c in text.split()) for text in texts.filter(marked).view(pa.binary()).to_pylist()]
            lowered = pc.replace_with_mask(lowered, marked, pa.array(own, pa.binary()).view(pa.string()))
        split = pc.ascii_split_whitespace(lowered)
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        places = np.array([self.known.get(chunk, -1) for chunk in chunks], np.int64)
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self._learn(coded.dictionary.take(pa.array(new)))
            self.known.update(zip([chunks[i] for i in new.tolist()], places[new].tolist()))
        ids, sizes = self.gather(places[coded.indices.to_numpy()])
        ends = np.append(0, np.cumsum(sizes))
        borders = split.offsets.to_numpy()
        return ids, np.diff(ends[borders - borders[0]])

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_batch(pa.array(texts, pa.binary()))
        ends = np.cumsum(counts)
        return [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]


def encoder(tokenizer_json: str) -> ChunkEncoder:
    """One per worker process, so that chunks stay known from task to task."""
    key = f"{len(tokenizer_json)}:{zlib.crc32(tokenizer_json.encode())}"
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(tokenizer_json)
    return _ENCODERS[key]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and length of runs of texts of about `SLICE` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(int(np.searchsorted(ends, before + SLICE, "right")), at + 1)
        yield at, stop - at
        at = stop


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int) -> None:
    """Write (`doc_id`, `place` in the file, `ids`) as ORC files in ascending `doc_id`; each document ends with `end_id`."""

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        coder, place = encoder(tokenizer_json), 0
        for batch in batches:
            texts = batch["text"]
            for at, rows in _slices(texts):
                ids, counts = coder.encode_batch(texts.slice(at, rows))
                ends = np.cumsum(counts)
                closed = np.insert(ids, ends, end_id).view("<i4")
                offsets = np.append(0, ends + np.arange(1, len(ends) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(closed, pa.int32()))
                yield {"doc_id": batch["doc_id"].slice(at, rows), "place": np.arange(place, place + len(ends)), "ids": lists}
                place += len(ends)

    # rows of one id may be very many: they are dealt by the beginnings of their texts
    ordered = id_and_bytes(docs).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    (
        map_columns(ordered, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, place bigint, ids array<int>", task)
        .write.mode("overwrite")
        .option("orc.compress", "ZSTD").option("orc.row.index.stride", "10000").option("orc.stripe.size", str(64 << 20))
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The ids of a few documents: the filter reaches the row indexes and Bloom filters of the files."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(list(doc_ids)))


def token_layout(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: `start` (ids before it), `n_tokens` and `ids_crc32`.

    Files are numbered in the order of their ranges, so a start is the
    ids of the files before (one number per file) plus a running sum inside the file.
    """

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            lists = batch["ids"]
            offsets = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy().astype("<u4", copy=False))).cast("B")
            crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield {"file": batch["file"], "place": batch["place"], "doc_id": batch["doc_id"], "n_tokens": np.diff(offsets).astype(np.int64), "ids_crc32": crcs}

    files = read_tokens(spark, path).select(F.col("_metadata.file_name").alias("file"), "place", "doc_id", "ids")
    kind = files.schema["doc_id"].dataType.simpleString()
    rows = stage_table(map_columns(files, f"file string, place bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint", task), "orc-layout")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("__inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "file")  # one row per file
        .select("doc_id", (F.col("__before") + F.col("__inside")).alias("start"), "n_tokens", "ids_crc32")
    )
