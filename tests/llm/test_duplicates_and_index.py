"""Near duplicates, repeated strings, benchmark matches, and the pipeline, against brute force."""

import hashlib
import pickle
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tradewind.llm import positional_index, queries, setsketch, suffix_dedup


def near_rows(seed, groups=12, size=9):
    """Groups of texts at all distances around the limit, some in chains whose ends are far apart."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        w = cases.words(rng, rng.randrange(3, 120), 5000)
        for _ in range(size):
            rows.append(" ".join(w))
            w = list(w)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_all_pairs(spark, width):
    rows = near_rows(width)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in setsketch.near_duplicates(docs, width, 80).collect()}
    want = cases.near_components(rows, width, 80)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(cases.shingle_set(t, width)) and got[i].kept == (want[i] == i) for i, t in rows)


@pytest.mark.parametrize("small", [32, 2])
def test_every_bucket_is_searched_to_the_end(spark, monkeypatch, small):
    """With bands of one register many sets share buckets with strangers; variants of one text come in all distances."""
    rng = random.Random(11)
    base = cases.words(rng, 60, 5000)
    spots = [(rng.randrange(60), f"m{k}") for k in range(12)]
    texts = [t for _, t in near_rows(11, groups=4, size=6)]
    for _ in range(70):
        w = list(base)
        for at, word in rng.sample(spots, rng.randrange(0, 7)):
            w[at] = word
        texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(setsketch, "SMALL_BUCKET", small)
    monkeypatch.setattr(setsketch, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(setsketch, "BANDS", 32)
    monkeypatch.setattr(setsketch, "ROWS", 1)
    assert {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, 4, 80).collect()} == cases.near_components(rows, 4, 80)


@pytest.mark.parametrize("small", [32, 2])
def test_rows_of_one_id_lose_no_link(spark, monkeypatch, small):
    """Two similar texts meet only in buckets whose smallest member is a stranger, and their ids stand on several rows."""
    rng = random.Random(13)
    kinds = {"equal": lambda t: [t, t], "capitals": lambda t: [t.upper(), t], "other": lambda t: ["taken text of another id"], "short": lambda t: [" ".join(cases.words(rng, 12, 10 ** 6))], "long": lambda t: [" ".join(cases.words(rng, 300, 10 ** 6))]}
    table, pairs = [(0, "taken text of another id")], []
    for g, (kind, more) in enumerate(kinds.items()):
        main, first = cases.words(rng, 97, 10 ** 6), 1000 * g + 1
        strange = lambda w, name, a, b: [f"{name}_{i}" if a <= i < b else x for i, x in enumerate(w)]
        for k in range(9):
            table.append((first + k, " ".join(strange(strange(main, f"g{g}s{k}", 10 * k, 10 * k + 10), f"g{g}s{k}", 89, 97))))
        for i, text in ((first + 20, " ".join(main)), (first + 21, " ".join(strange(main, f"g{g}", 89, 97)))):
            table += [(i, t) for t in [text, *(more(text) if kind != "short" or i == first + 20 else [])]]
        pairs.append((first + 21, first + 20 if kind != "other" else 0))
    docs = spark.createDataFrame([*table, (3, ""), (4, None)], "doc_id bigint, text string")
    monkeypatch.setattr(setsketch, "SMALL_BUCKET", small)
    monkeypatch.setattr(setsketch, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(setsketch, "BANDS", 32)
    monkeypatch.setattr(setsketch, "ROWS", 1)
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, 4, 80).collect()}
    want = cases.near_components(table, 4, 80)
    assert [want[a] for a, _ in pairs] == [b for _, b in pairs]
    assert got == want


def test_near_duplicates_of_given_documents(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    got = {r.doc_id: r.component_id for r in queries.op6_setsketch(spark, cases.SF).collect()}
    assert got == cases.near_components([(r.doc_id, r.text) for r in docs.collect()], 4, 80)


def test_near_duplicates_of_awkward_rows(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    got = setsketch.near_duplicates(docs, 4, 80).collect()
    assert len(got) == len(cases.awkward_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].component_id is None and by_id[None].kept
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id) == (0, i)
    assert by_id[7].component_id == by_id[12].component_id == by_id[8].component_id == 6
    assert by_id[15].component_id == 14 and by_id[14].n_shingles == 1
    kept = setsketch.keep_one(docs, 4, 80)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == sorted({r.component_id for r in got if r.doc_id is not None}) and kept.where("doc_id IS NULL").count() == 2
    assert setsketch.near_duplicates(docs.limit(0)).count() == 0 and setsketch.keep_one(docs.limit(0)).count() == 0


def test_one_id_with_two_texts_is_one_document(spark):
    rng = random.Random(5)
    a, b = (" ".join(cases.words(rng, 60, 9000)) for _ in range(2))
    docs = spark.createDataFrame([(3, a), (3, b), (4, b), (5, a), (9, "else entirely other words")], "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id) for r in setsketch.near_duplicates(docs, 5, 80).collect()}
    assert got == {(3, 3), (4, 3), (5, 3), (9, 9)}
    assert sorted(r.doc_id for r in setsketch.keep_one(docs).collect()) == [3, 9]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 1 << 63, 800, np.uint64) for _ in range(2))
    both = np.union1d(a, b)
    assert (setsketch.registers(both) == np.maximum(setsketch.registers(a), setsketch.registers(b))).all()
    for shared in (0, 200, 500, 720, 800):
        c = np.concatenate([a[:shared], b[:800 - shared]])
        true = shared / (1600 - shared)
        r, s = setsketch.registers(a)[None, :], setsketch.registers(c)[None, :]
        found, gap = setsketch.estimate(r, s, np.array([800.0]), np.array([800.0]), 80)
        assert abs(found[0] - true) < 0.13
        assert (gap[0] < 14) == (true > 0.6)


def test_suffix_array_and_common_prefixes():
    rng = random.Random(4)
    for alphabet in (b"ab", b"abcd", bytes(range(256))):
        for n in (0, 1, 2, 7, 300, 1500):
            data = bytes(rng.choice(alphabet) for _ in range(n))
            order = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), max(n, 1) + 1)
            assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
            if n > 1 and alphabet != bytes(range(256)):
                shared = suffix_dedup.common_prefixes(np.frombuffer(data, np.uint8), order, 40)
                for i in range(1, n):
                    x, y = data[order[i - 1]:][:40], data[order[i]:][:40]
                    k = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
                    assert shared[i] == k


def check_removed(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    length = options.get("length", 200)
    flags = cases.removed_bytes([r.text for r in rows], length)
    want = sorted(
        (str(r.doc_id), len(f), hashlib.sha256(bytes(b for b, gone in zip((r.text or "").encode(), f) if not gone)).hexdigest(),
         sum(gone and (k == 0 or not f[k - 1]) for k, gone in enumerate(f)))
        for r, f in zip(rows, flags)
    )
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    assert sorted((str(r.doc_id), r.n_bytes, hashlib.sha256(r.kept).hexdigest(), len(r.spans)) for r in got) == want
    assert all(r.n_bytes - len(r.kept) == sum(s.last - s.first + 1 for s in r.spans) for r in got)


def passages(spark, seed, n=60):
    """Texts that share passages of several lengths at several places, also inside one text."""
    rng = random.Random(seed)
    shared = [" ".join(cases.words(rng, k, 300)) for k in (5, 12, 14, 16, 40, 90)]
    rows = []
    for i in range(n):
        parts = [" ".join(cases.words(rng, rng.randrange(0, 40), 300)) for _ in range(3)]
        parts[1:1] = [rng.choice(shared) for _ in range(rng.randrange(0, 4))]
        rows.append((i, " ".join(parts)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("length, size, group", [(60, 12, 2000), (60, 12, 2), (60, 50, 2000), (200, 32, 2000), (200, 32, 3)])
def test_removed_bytes_equal_brute_force(spark, length, size, group):
    check_removed(passages(spark, length + group), length=length, size=size, group=group)


def test_removed_bytes_of_given_and_awkward_rows(spark):
    check_removed(spark.read.parquet(f"{cases.SF}/documents.parquet"))
    check_removed(cases.with_clashes(cases.awkward(spark)))
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0


def plain_matches(texts, items, window=13):
    owners = {}
    for item, text in items:
        w = cases.item_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    lengths = {len(w) for w in owners}
    out = []
    for text in texts:
        w = cases.item_words(text)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[tuple(w[k:k + n])]
        out.append((len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def check_contamination(docs, items):
    rows = docs.select("doc_id", "text").collect()
    want = plain_matches([r.text for r in rows], [(r.item_id, r.text) for r in items.collect()])
    got = positional_index.contamination(docs, items).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want))


@pytest.mark.parametrize("block", [2_000_000, 50])
def test_matches_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(positional_index, "BLOCK_TERMS", block)
    monkeypatch.setattr(positional_index, "SEGMENT_WORDS", 2_000)
    rng = random.Random(7)
    vocabulary = 6  # few words, so windows overlap and repeat
    texts = [(i, " ".join(cases.words(rng, rng.randrange(0, 300), vocabulary))) for i in range(40)]
    items = [(k, " ".join(cases.words(rng, n, vocabulary))) for k, n in enumerate((1, 2, 4, 5, 6, 0))]
    items += [(10 + k, " ".join(texts[k][1].split()[5:5 + n]).upper()) for k, n in enumerate((13, 14, 30, 12, 40))] + [(99, None), (98, "..."), (10, items[1][1])]
    check_contamination(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))


def test_matches_of_given_and_awkward_rows(spark):
    items = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    check_contamination(spark.read.parquet(f"{cases.SF}/documents.parquet"), items)
    docs = cases.with_clashes(cases.awkward(spark))
    some = spark.createDataFrame([(1, "one"), (2, cases.awkward_rows()[0][1][:90])], "item_id bigint, text string")
    check_contamination(docs, some)
    clean = positional_index.drop_contaminated(docs, some)
    bad = {r.doc_id for r in positional_index.contamination(docs, some).where("contaminated").collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r[0] for r in cases.awkward_rows()} - (bad - {None})
    assert clean.where("doc_id IS NULL").count() == 1
    assert positional_index.contamination(docs.limit(0), some).count() == 0
    assert positional_index.contamination(docs, some.limit(0)).where("contaminated").count() == 0


def test_workers_hold_a_few_bytes_for_each_word_asked(spark, monkeypatch):
    """What is sent to the workers: a block's words once, and not every window written out; one block at a time."""
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: (sent.append(len(pickle.dumps(value))), send(self, value))[1])
    monkeypatch.setattr(positional_index, "BLOCK_TERMS", 40_000)
    rng = random.Random(3)
    texts = [" ".join(cases.words(rng, 400, 10 ** 6)) for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:20])], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:50]])], "item_id bigint, text string")
    found = positional_index.contamination(docs, items).collect()
    assert {(r.doc_id, tuple(r["items"])) for r in found} == {(i, tuple(sorted((str(i), str(150 + i))))) for i in range(20)}
    assert len(sent) == 2 and max(sent) < 40 * 40_000


def test_phrases_and_proximity(spark):
    texts = ["a b c d e", "x a b y a b", "b a", "a z z b", "", "c b a c a z b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    index = positional_index.build_index(docs)
    items = spark.createDataFrame([(1, "a b"), (2, "c c c"), (3, "Q")], "item_id bigint, text string")
    phrases = positional_index.phrase_matches(index, items).collect()
    assert sorted((r.doc_id, r.item_id, r["first"], r["last"]) for r in phrases) == [(0, "1", 0, 1), (1, "1", 1, 2), (1, "1", 4, 5)]
    near = positional_index.proximity_matches(index, items, 3).where("item_id = '1'").collect()
    got = {(r.doc_id, r["first"], r["last"]) for r in near}
    assert {(0, 0, 1), (1, 1, 2), (2, 0, 1), (5, 1, 2)} <= got and not any(i == 3 for i, _, _ in got)
    for i, first, last in got:
        part = texts[i].split()[first:last + 1]
        assert {"a", "b"} <= set(part) and len(part) <= 3


def test_pipeline_keeps_its_promises(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    held, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before, held = held, stage(spark, held, cases.SF).cache()
        seen[name] = (before, held)
        if name != "shard":
            assert held.columns == docs.columns
    before, after = seen["near_duplicates"]
    want = cases.near_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(want.values()))
    before, after = seen["decontaminate"]
    rows = before.collect()
    flags = plain_matches([r.text for r in rows], [(r.item_id, r.text) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r, f in zip(rows, flags) if not f[3])
    before, after = seen["quality"]
    gone = before.join(after, "doc_id", "left_anti").join(spark.read.parquet(f"{cases.SF}/labels.parquet"), "doc_id")
    assert gone.where("quality = 1").count() == 0 and gone.count() > 0
    final = corpus_pipeline.run(spark, cases.SF)
    assert sorted(map(str, final.collect())) == sorted(map(str, seen["shard"][1].collect()))


def test_pipeline_of_awkward_rows(spark, tmp_path):
    cases.with_clashes(cases.awkward(spark)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 0, 0), (5, 1, 0), (7, 1, 0), (9, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "stop the press")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).where("shard BETWEEN 0 AND 23").count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    cases.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_large_group_of_near_copies(spark):
    """An anchor with many different neighbourhoods: edits at any place, also two at once, and copies cut at either end."""
    rng = random.Random(12)
    base = " ".join(cases.words(rng, 150, 500))
    rows = []
    for i in range(240):
        text = list(base)
        for _ in range(i % 3):
            text[rng.randrange(len(text))] = rng.choice("XYZ")
        rows.append((i, "".join(text)[rng.randrange(0, 90) if i % 4 == 0 else 0:][: rng.randrange(250, 900) if i % 5 == 0 else 2000]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for options in ({"group": 10}, {"group": 60}, {"length": 90, "size": 16, "group": 5}, {"length": 33, "size": 32, "group": 5}):
        check_removed(docs, **options)


def test_many_equal_rows(spark):
    text = " ".join(cases.words(random.Random(3), 500))
    docs = spark.range(20_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit(text).alias("text")).unionByName(
        spark.createDataFrame([(8, "alone " * 3 + "x" * 10), (9, text[:1000])], "doc_id bigint, text string")
    ).repartition(6)
    found = suffix_dedup.remove_repeats(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.octet_length("kept")).alias("kept"), F.max(F.size("spans")).alias("spans"))
    assert {r.doc_id: (r.n, r.kept, r.spans) for r in found.collect()} == {7: (20_000, 0, 1), 8: (1, 28, 0), 9: (1, 0, 1)}
