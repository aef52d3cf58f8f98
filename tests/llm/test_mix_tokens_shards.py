"""Poisson mixing, ORC token files and Hilbert shards."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import cases
from tradewind.llm import hilbert, mixing, orc_tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def poisson_count(mean, seed, doc_id):
    """Inverts the distribution with exact sums."""
    draws = max(math.ceil(mean / 64), 1)
    total = 0
    for k in range(1, draws + 1):
        text = f"{seed}:{'null' if doc_id is None else doc_id}:{k}"
        u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
        n, part = 0, mean / draws
        p = below = math.exp(-part)
        while below <= u and n < 1000:
            n += 1
            p *= part / n
            below += p
        total += n
    return total


@pytest.mark.parametrize("weights, epochs", [(None, 1.0), (None, 3.0), ({"a": 0.5, "b": 0.2, None: 0.3}, 1.0), ({"b": 1.0}, 150.0)])
def test_copies_equal_a_plain_inversion(spark, weights, epochs):
    rows = cases.awkward_rows()
    docs = cases.with_clashes(cases.awkward(spark))
    got = mixing.poisson_mix(docs, weights, epochs)
    assert got.columns == [*[c for c in docs.columns if c != "copy"], "copy", "shuffle_key"]
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += len((text or "").encode()) + 8
    w = {s: size[s] ** 0.5 if weights is None else weights.get(s, 0.0) for s in size}
    rate = {s: w[s] / sum(w.values()) * sum(size.values()) * epochs / size[s] for s in size}
    want = Counter((i, source, k) for i, _, _, source, _ in rows for k in range(1, poisson_count(rate[source], "mix", i) + 1))
    assert Counter((r.doc_id, r.source, r["copy"]) for r in got.collect()) == want


def test_rates_hold_and_order_is_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rates = {r["__source"]: r["rate"] for r in mixing.source_rates(docs, None, 4.0, 0.5).collect()}
    got = mixing.poisson_mix(docs, epochs=4.0).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    for r in got:
        want = rates[r.source] * n[r.source]
        assert abs(r["count"] - want) < 5 * want ** 0.5
    keys = [r.shuffle_key for r in mixing.poisson_mix(docs).coalesce(1).collect()]
    assert len(set(keys)) == len(keys)


def test_mix_without_rows_or_weight(spark):
    assert mixing.poisson_mix(cases.empty(spark)).count() == 0
    assert mixing.poisson_mix(cases.awkward(spark), {}).count() == 0


def test_many_sources_join_by_key(spark, monkeypatch):
    docs = cases.awkward(spark)
    want = sorted(map(str, mixing.poisson_mix(docs, epochs=2.0).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(map(str, mixing.poisson_mix(docs, epochs=2.0).collect())) == want


def token_layout(spark, docs, path):
    orc_tokens.write_tokens(docs, path, open(TOKENIZER, encoding="utf-8").read(), 2)
    return orc_tokens.token_layout(spark, path)


def check_tokens(spark, docs, path):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want, start = [], 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_layout(spark, docs, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    return tokenizer


def test_tokens_round_trip(spark, tmp_path):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet").repartition(5)
    path = str(tmp_path / "tokens")
    tokenizer = check_tokens(spark, docs, path)
    one = orc_tokens.read_documents(spark, path, [17, 10 ** 9])
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString()
    text = docs.where("doc_id = 17").first().text
    assert one.first().ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2] and one.count() == 1


def test_tokens_of_awkward_rows(spark, tmp_path):
    odd = [(50, "a <|startoftext|> b<|endoftext|>c", "en", "a", 1), (51, "\x01 \x01\x01 x\x01y", "en", "a", 1), (52, "’s 'll It'S Ǆ İ ΑΣ ́x", "en", "a", 1)]
    docs = cases.awkward(spark).union(spark.createDataFrame(odd, cases.SCHEMA))
    check_tokens(spark, cases.with_clashes(docs), str(tmp_path / "awkward"))
    assert token_layout(spark, cases.empty(spark), str(tmp_path / "none")).count() == 0


def test_a_full_store_changes_nothing(monkeypatch):
    coder = orc_tokens.ChunkEncoder(open(TOKENIZER, encoding="utf-8").read())
    text = " ".join(f"word{k} tail.{k} end{'.' * (k % 3)}" for k in range(300)).encode()
    want = coder.encode([text])
    monkeypatch.setattr(orc_tokens, "KEPT_CHUNKS", 50)
    monkeypatch.setattr(orc_tokens, "KEPT_CORES", 50)
    assert coder.encode([b"other words"])[0] and coder.encode([b"more", text])[1:] == want


def test_chunks_of_all_kinds_equal_whole_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    coder = orc_tokens.ChunkEncoder(open(TOKENIZER, encoding="utf-8").read())
    rng = random.Random(8)
    signs = list("abzAZ019.,!?'’-_%$#<>|\"()[]éÉñßçœ漢字ΣσςİıǅŉﬁÅÅ़क़́€½²٣\u00a0\u2003\u0085\x1c\x0b\x01") + ["'s", "'LL", "n't", "<|endoftext|>", "<|", "|>", " ", " ", "  \n"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 25)))
        assert np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_keep_their_case():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    coder = orc_tokens.ChunkEncoder(open(TOKENIZER, encoding="utf-8").read())
    rng = random.Random(9)
    signs = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>", "<|", "|>", "A", "a", "É", ".", "It'S", " ", "\n"]
    texts = ["<|ENDOFTEXT|>", "End <|EndOfText|> END<|endoftext|>End", "<|endoftext|> <|ENDOFTEXT|>."]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(1000)]
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(spark, dims, bits):
    cells = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{k} int" for k in range(dims)))
    rows = df.select("*", hilbert.hilbert_index([F.col(f"c{k}") for k in range(dims)], bits).alias("at")).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[k] - b[k]) for k in range(dims)) == 1


@pytest.mark.parametrize("shards", [1, 7, 24, 60])
def test_shards_are_even_and_whole(spark, shards):
    docs = cases.with_clashes(cases.awkward(spark))
    got = hilbert.hilbert_shards(docs, hilbert.document_dims(), shards, [F.col("doc_id"), F.xxhash64("text")])
    plain = [c for c in docs.columns if c not in ("shard", "slot")]
    assert got.columns == [*plain, "shard", "slot"]
    rows = got.collect()
    assert sorted(str(tuple(r)[:len(plain)]) for r in rows) == sorted(str(tuple(r)) for r in docs.select(*plain).collect())
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    n = [len(slots.get(k, [])) for k in range(shards)]
    assert max(n) - min(n) <= 1 and set(slots) <= set(range(shards))
    assert hilbert.hilbert_shards(docs.limit(0), hilbert.document_dims(), shards).count() == 0


def test_shards_narrow_every_dimension(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = hilbert.hilbert_shards(docs, hilbert.document_dims(), 24, [F.col("doc_id")])
    seen = got.groupBy("shard").agg(F.countDistinct("source").alias("s"), F.countDistinct("lang").alias("l"), (F.max("doc_id") - F.min("doc_id")).alias("d")).collect()
    assert np.mean([r.s for r in seen]) < 16 and np.mean([r.l for r in seen]) < 3 and np.mean([r.d for r in seen]) < 900
