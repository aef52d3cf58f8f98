"""Quality rules: fixed rules on words and lines, then a hashed n-gram log-likelihood ratio.

Words and word pairs fall into a fixed number of hash buckets. Two multinomials
over the buckets are counted, one over trusted documents and one over the whole
corpus; every task adds up its own buckets, so only bucket sums move. A document's
score is the mean over its n-grams of the log ratio of the two, and it is kept
when the score reaches a fixed threshold: the same text always gets the same
verdict from the same corpus. Up to 2 million trusted ids go to the documents, and
texts do not move; more are joined by id.

A null or empty text has no words, score 0, and fails the rule on few words.
Without trusted documents the ratio is 0 throughout and only the rules decide.
An id that is trusted by any of its labels is trusted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tradewind.llm import common
from tradewind.llm.common import Columns, id_and_bytes, map_columns, utf8_bytes
from tradewind.session import stage_table

BUCKETS = 1 << 16  # bounds the model and what each task sends, whatever the corpus
PRIOR = 10.0  # n-grams that each bucket is given in advance, so that a rare one says little
MIN_SCORE = -0.15
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"


def ngram_buckets(words: list[bytes]) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbours."""
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([h ^ (h >> np.uint64(16)), pairs >> np.uint64(40)]).astype(np.int64) & (BUCKETS - 1)


def n_repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words which occurs twice or more."""
    windows = list(zip(*[words[k:] for k in range(WINDOW)]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = end = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + WINDOW - max(end, at)
            end = at + WINDOW
    return covered


def n_duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per bucket the n-grams of all documents and of the trusted ones: `bucket`, `raw_n`, `trusted_n`."""
    marked = stage_table(trusted.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("trusted", F.lit(True)), "trusted-ids")
    texts = docs.select("doc_id", utf8_bytes().alias("text"))
    if marked.limit(common.BROADCAST_KEYS + 1).count() <= common.BROADCAST_KEYS:
        rows = texts.join(F.broadcast(marked), "doc_id", "left").select("text", "trusted")
    else:
        # rows without an id are trusted by nobody and stay where they are
        known = texts.where("doc_id IS NOT NULL").join(marked.hint("merge"), "doc_id", "left").select("text", "trusted")
        rows = known.unionByName(texts.where("doc_id IS NULL").select("text", F.lit(None).cast("boolean").alias("trusted")))

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts, flags = batch["text"], batch["trusted"].to_pylist()
            for at in range(0, len(texts), 500):
                found = [ngram_buckets(t.split()) for t in texts.slice(at, 500).to_pylist()]
                good = [x for x, flag in zip(found, flags[at:at + 500]) if flag]
                raw += np.bincount(np.concatenate(found), minlength=BUCKETS)
                if good:
                    target += np.bincount(np.concatenate(good), minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield {"bucket": some.astype(np.int32), "raw_n": raw[some], "trusted_n": target[some]}

    counted = map_columns(rows, "bucket int, raw_n bigint, trusted_n bigint", task)
    return counted.groupBy("bucket").agg(F.sum("raw_n").alias("raw_n"), F.sum("trusted_n").alias("trusted_n"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Per bucket log P(bucket | trusted) - log P(bucket | corpus); at most `BUCKETS` rows reach the driver.

    The corpus is scaled to the size of the trusted part before the prior is added
    to both, so a bucket with few n-grams has a ratio near 0 in a corpus of any size.
    """
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw_n"], row["trusted_n"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log(target + PRIOR) - np.log(raw * (target.sum() / raw.sum()) + PRIOR)


def judge_quality(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Per document the rules' figures, `base_failed`, the `score` and `kept`."""
    ratios = log_ratios(bucket_counts(docs, trusted))

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            texts = batch["text"]
            for at in range(0, len(texts), 500):
                out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")}
                for text in texts.slice(at, 500).to_pylist():
                    words = text.split()
                    n = len(words)
                    repeated = n_repeat_words(words)
                    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
                    score = float(ratios[ngram_buckets(words)].mean()) if n else 0.0
                    chars = len(text.decode("utf-8", "replace")) - len(text) + len(text.translate(None, SPACES))
                    for k, v in zip(out, (n, chars, len(text) - len(text.translate(None, SYMBOLS)), n_duplicate_lines(text), repeated, failed, score, not failed and score >= min_score)):
                        out[k].append(v)
                yield {"doc_id": batch["doc_id"].slice(at, 500), **out}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(
        id_and_bytes(docs),
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, score double, kept boolean",
        task,
    )
