"""Token counts, quality rules, toxicity and the quality ranking."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tradewind.llm import bradley_terry, quality_rules, token_counts, toxicity

PIECES = ["▁the", "▁a", "he", "t", "h", "e", "a", "▁", "ab", "aba", "b", "cab", "c", "▁caba", "é"]


def best_split(word, scores, byte_score):
    """Tokens of the best split, by trying all splits; ties take fewer tokens."""
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        spelled = len(word[end - 1].encode())
        options = [(best[end - 1][0] + spelled * byte_score, -(best[end - 1][1] + spelled))]
        for start in range(end):
            if word[start:end] in scores:
                options.append((best[start][0] + scores[word[start:end]], -(best[start][1] + 1)))
        top = max(options)
        best[end] = (top[0], -top[1])
    return best[len(word)][1]


def test_trie_counts_equal_plain_splits():
    scores = token_counts.zipf_scores(PIECES)
    trie = token_counts.PrefixTrie(scores, -12.0)
    rng = random.Random(3)
    for _ in range(500):
        word = "▁" + "".join(rng.choice("thecabé漢x") for _ in range(rng.randrange(0, 12)))
        assert trie.count(word) == best_split(word, scores, -12.0), word
    long = "▁" + "cab" * 200
    assert trie.count(long) == best_split(long, scores, -12.0)


def test_prefixes_are_shared():
    trie = token_counts.PrefixTrie(token_counts.zipf_scores(PIECES), -12.0)
    trie.count("▁thecab")
    nodes = len(trie.best)
    trie.count("▁theca")
    assert len(trie.best) == nodes
    trie.count("▁thecat")
    assert len(trie.best) == nodes + 1


def test_token_counts_of_awkward_rows(spark):
    rows = cases.awkward_rows()
    got = token_counts.count_tokens(cases.with_clashes(cases.awkward(spark)), PIECES).collect()
    scores = token_counts.zipf_scores(PIECES)
    byte_score = min(scores.values()) - math.log(256)
    want = []
    for i, text, *_ in rows:
        w = cases.ascii_words(text)
        cache = {x: best_split("▁" + x, scores, byte_score) for x in set(w) if len(x) < 1000}
        want.append((i, len(text or ""), len(w), None if any(len(x) >= 1000 for x in w) else sum(cache[x] for x in w)))
    assert sorted((str(r.doc_id), r.n_chars, r.n_words) for r in got) == sorted((str(a), b, c) for a, b, c, _ in want)
    by_id = {r.doc_id: r.n_tokens for r in got if r.doc_id is not None}
    assert all(by_id[a] == d for a, _, _, d in want if a is not None and d is not None)
    assert token_counts.count_tokens(cases.empty(spark), PIECES).count() == 0


def base_figures(text):
    w = cases.ascii_words(text)
    covered = set()
    seen = {}
    for k in range(len(w) - 4):
        seen.setdefault(tuple(w[k:k + 5]), []).append(k)
    for starts in seen.values():
        if len(starts) > 1:
            for k in starts:
                covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if cases.ascii_words(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def test_base_rules_equal_a_plain_reading(spark):
    docs = cases.with_clashes(cases.awkward(spark)).unionByName(spark.read.parquet(f"{cases.SF}/documents.parquet"), allowMissingColumns=True)
    got = quality_rules.judge_quality(docs, spark.read.parquet(f"{cases.SF}/labels.parquet").where("quality = 1")).collect()
    want = sorted((str(r.doc_id), *base_figures(r.text)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert all(r.kept == (not r.base_failed and r.score >= quality_rules.MIN_SCORE) for r in got)


def test_log_ratios_equal_plain_counts(spark):
    rows = [(1, "good words here good", True), (2, "bad %% words", False), (3, None, True), (None, "null id words", False)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(i,) for i, _, ok in rows if ok] + [(1,), (None,)], "doc_id bigint")
    ratios = quality_rules.log_ratios(quality_rules.bucket_counts(docs, trusted))
    raw, target = (np.zeros(quality_rules.BUCKETS) for _ in range(2))
    for _, text, ok in rows:
        np.add.at(raw, quality_rules.ngram_buckets((text or "").encode().split()), 1)
        if ok:
            np.add.at(target, quality_rules.ngram_buckets((text or "").encode().split()), 1)
    want = np.log(target + 10) - np.log(raw * target.sum() / raw.sum() + 10)
    assert np.allclose(ratios, want)
    assert not quality_rules.log_ratios(quality_rules.bucket_counts(docs, trusted.limit(0))).any()
    assert quality_rules.judge_quality(docs.limit(0), trusted).count() == 0


def test_quality_rules_tell_junk_from_text(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    judged = quality_rules.judge_quality(spark.read.parquet(f"{d}/documents.parquet"), labels.where("quality = 1"))
    rows = judged.join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) == 0 and n[0, False] > 3 * n.get((0, True), 0)


def test_scores_equal_a_plain_reading(spark, monkeypatch):
    """Scores from the definition, with trusted ids broadcast and joined, null and repeated ids included."""
    rng = random.Random(5)
    rows = [(i if i % 7 else None, " ".join(cases.words(rng, rng.randrange(0, 60), 40))) for i in range(120)] + [(3, "same id other text w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("trusted", F.lit("clash"))
    trusted = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 5, None, 999)], "doc_id bigint")
    raw, good = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    for i, text in rows:
        found = np.bincount(quality_rules.ngram_buckets(text.encode().split()), minlength=quality_rules.BUCKETS)
        raw += found
        good += found * (i in (1, 2, 3, 5))
    ratio = np.log(good + quality_rules.PRIOR) - np.log(raw * (good.sum() / raw.sum()) + quality_rules.PRIOR)
    want = sorted((str(i), float(ratio[quality_rules.ngram_buckets(t.encode().split())].mean()) if t.split() else 0.0) for i, t in rows)
    for limit in (2_000_000, 1):
        monkeypatch.setattr(quality_rules.common, "BROADCAST_KEYS", limit)
        got = sorted((str(r.doc_id), r.score) for r in quality_rules.judge_quality(docs, trusted).collect())
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])


def test_ranking_recovers_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    good = (x[:, 0] - 2 * x[:, 1] > 0.3).astype(int)
    ranking = bradley_terry.fit_ranking(x, good, pairs=4000)
    assert ((ranking.score(x) >= bradley_terry.ACCEPT) == (good == 1)).mean() > 0.97
    assert abs((ranking.score(x) < bradley_terry.ACCEPT).mean() - (good == 0).mean()) < 0.01
    flat = bradley_terry.fit_ranking(x, np.ones(400, int))
    assert np.allclose(flat.score(x), bradley_terry.ACCEPT)


@pytest.mark.parametrize("seed", [0])
def test_quality_on_held_out_labels(spark, seed):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    ranking = bradley_terry.learn_quality(docs, labels, ~held)
    rows = bradley_terry.score_quality(docs, ranking).where(held).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows) > 50
    assert all(0 <= r.score <= 1 for r in rows)


def plain_features(text):
    """The features of a text, one by one, from its words and lines."""
    words = [w for w in re.split(rb"[ \t\n\r\x0b\x0c]+", text) if w]
    if not words:
        return [1.0] + [0.0] * 19
    n, size = len(words), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    signs = b"#*$%&|<>"
    windows = [tuple(words[k:k + 5]) for k in range(n - 4)]
    return [
        0.0, float(n < 10), math.log(1 + n) / 10, min(size / n / 10, 3), sum(len(w) > 30 for w in words) / n, min(5 * sum(b in signs for b in text) / size, 1),
        sum(w[0] in signs or w[-1] in signs for w in words) / n, min(sum(b == 33 for b in text) / n, 2),
        min(sum(b < 128 and not chr(b).isalnum() and chr(b) not in "_ \t\n\r\x0b\x0c" for b in text) / n, 3), sum(65 <= b <= 90 for b in text) / size,
        sum(48 <= b <= 57 for b in text) / size, sum(a == b for a, b in zip(words, words[1:])) / n, min(len(set(words)) / n ** 0.9, 1.5),
        max(max(words.count(w) for w in set(words)) / n - 0.2, 0), 1 - len(set(windows)) / len(windows) if windows else 0.0, 1 - len(set(lines)) / len(lines),
        min(text.count(b" | ") / n, 1), min(sum(b in b"{;" for b in text) / n, 1), min(5 * (text.count(b"http") + text.count(b"www.")) / n, 1),
        sum(len(x.split()) < 4 for x in lines) / len(lines),
    ]


def test_quality_scores_equal_a_plain_reading(spark):
    odd = ["# a | b | c ** $$ <x>", "Read http://x.y www.z.w now! now! now!", "if (a) { b; } else { c; }\nif (a) { b; }", "x " * 40, "\n\n a \n", "é漢 ü" * 9, "w" * 50 + " _ 12 A"]
    texts = odd + [r.text for r in spark.read.parquet(f"{cases.SF}/documents.parquet").limit(60).collect()] + [t for _, t, *_ in cases.awkward_rows() if t and len(t) < 9000]
    for text in texts:
        assert np.allclose(bradley_terry.features(text.encode()), plain_features(text.encode())), text[:80]
    rng = np.random.default_rng(4)
    x, good = np.array([plain_features(t.encode()) for t in texts]), rng.integers(0, 2, len(texts))
    ranking = bradley_terry.fit_ranking(x, good, pairs=500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in bradley_terry.score_quality(docs, ranking).collect()}
    for k, row in enumerate(x):
        raw = sum(w * (v - c) / s for w, v, c, s in zip(ranking.weights, row, ranking.centre, ranking.scale))
        odds = bradley_terry.ACCEPT / (1 - bradley_terry.ACCEPT) * math.exp((raw - ranking.threshold) / ranking.spread)
        assert got[k] == pytest.approx(odds / (1 + odds), abs=1e-6)


def test_preferences_are_fitted_to_the_end():
    """At the fitted weights no small step makes the pairs likelier, by the plain sum of logarithms over all pairs."""
    x = np.array([[0.0, 1.0], [1.0, 0.2], [0.4, 0.9], [2.0, 0.1], [1.5, 1.1]])
    good = np.array([1, 0, 1, 0, 1])
    ranking = bradley_terry.fit_ranking(x, good, pairs=6)
    rng = np.random.default_rng(8)
    i, j = np.resize(rng.permutation(3), 6), np.resize(rng.permutation(2), 6)[rng.permutation(6)]
    pairs = [(x[good == 1][a] - x[good == 0][b]) / ranking.scale for a, b in zip(i, j)]

    def likelihood(w):
        return sum(-math.log(1 + math.exp(-float(d @ w))) for d in pairs) - 0.5 * float(w @ w)

    best = likelihood(ranking.weights)
    assert all(likelihood(ranking.weights + 0.01 * np.array(step)) < best for step in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, 1)))


def test_quality_of_awkward_rows(spark):
    docs = cases.with_clashes(cases.awkward(spark))
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (7, 1, 1), (9, 0, 1), (7, None, None), (None, 1, 1), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    ranking = bradley_terry.learn_quality(docs, labels, F.lit(True))
    got = bradley_terry.score_quality(docs, ranking).collect()
    assert len(got) == len(cases.awkward_rows()) and all(0 <= r.score <= 1 for r in got)
    kept = bradley_terry.accept_documents(docs, ranking)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    none = bradley_terry.learn_quality(docs, labels.limit(0), F.lit(True))
    assert bradley_terry.accept_documents(docs, none).count() == len(got)
    assert bradley_terry.accept_documents(docs.limit(0), ranking).count() == 0


@pytest.fixture(scope="module")
def toxic_model(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return toxicity.learn_toxicity(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def test_hidden_words_are_restored(toxic_model):
    for hidden, plain in {"1d10t": "idiot", "l0oos3r": "loser", "m.o.r.o.n": "moron", "$cum": "scum", "tra$h": "trash", "cl-own": "clown", "the.id1ot": "idiot"}.items():
        assert toxic_model.hits(hidden) and any(plain.startswith(t.rstrip("*")) for t in toxic_model.hits(hidden)), hidden
    assert toxic_model.score("what an i d i o t they are")[0] > 0.7
    assert toxic_model.score("y o u s c u m ok")[0] > 0.7
    for clean in ("a a a a a b c", "10 0 1 2 3", "", "the lo se of", "id iota", "$$$ !!! ***"):
        assert toxic_model.score(clean)[0] < 0.7, clean


def test_no_lattice_that_spells_a_term_is_skipped(toxic_model):
    for sign in "!|#=+$@(\u200b_.":
        for word in ("stupid", "idiot"):
            token = sign.join(word)
            assert toxic_model._may_spell(token) and toxic_model._may_spell(f"so-{token}"), token
    for token in ("s#t#u#p#i#d", "s=t=u=p=i=d", "s\u200bt\u200bu\u200bp\u200bi\u200bd", "s!t!u!p!i!d", "s|t|u|p|i|d"):
        assert any("stupid".startswith(t.rstrip("*")) for t in toxic_model.hits(token)), token
    doubled = toxicity.Toxicity({"kill*": 0.95, "fool*": 0.95}, 0.1, toxic_model.logs)
    assert doubled.hits("killing") == ("kill*",) and doubled.hits("fools") == ("fool*",) and doubled.hits("x9killer") == ("kill*",)
    assert not any(doubled._may_spell(x) for x in ("skill", "oof", "12", "", "f-", "k#"))


def test_spaced_words_beside_punctuation(toxic_model):
    for text in ("you are s c u m.", '"i d i o t" they said', "a (l o s e r) here", "l oo s e r", "l o s e rrr!!", "'m o r o n', ok", "c l o w n?", "- i - d - i - o - t -", "[s] [c] [u] [m]"):
        assert toxic_model.score(text)[0] > 0.7, text
    assert toxicity.single("(oo.") == "(oo." and toxicity.single("...") == "." and not toxicity.single("ab") and not toxicity.single("a1.")
    for clean in ("a. b. c. d.", "1) 2) 3) 4)", "x + y = z ...", "( ) [ ] !! ??"):
        assert toxic_model.score(clean)[0] < 0.7, clean


def test_any_number_of_separators_between_letters(toxic_model):
    for word in ("stupid", "idiot", "scum"):
        for between in (*range(12), 50):
            for sign in "-*.":
                text = (" " + f"{sign} " * between).join(word)
                assert toxic_model.score(f"they are {text} all")[0] > 0.7, (word, between)
    assert toxic_model.score("s s s s t u u u p - - - p i i i i d")[0] > 0.7


def test_words_end_before_single_letter_words(toxic_model):
    flat = np.full(28 ** 3, math.log(1 / 28))
    short = toxicity.Toxicity({"ass": 0.95, "aab": 0.95}, 0.1, flat)
    for text in ("you a s s i say", "you a s s a", "a s s", "i a s s", "a a s s b c", "a a b", "c a a b c"):
        assert short.score(text)[0] > 0.7, text
    for text in ("a s", "s s a", "a b s s", "a 2 s b s", "b a b a", "a s o s"):
        assert short.score(text)[0] == 0.1, text


def test_long_runs_are_quick(toxic_model):
    began = time.process_time()
    for run in ("a " * 100_000, "a - " * 50_000, "s c s c " * 25_000, "i d i " * 33_000, "a s - s - " * 30_000):
        toxic_model.score(run)
    assert time.process_time() - began < 20
    assert toxic_model.score("x z " * 30_000 + "i d i o t " + "x z " * 30_000)[0] > 0.7


def test_stretches_that_spell_a_term(toxic_model):
    """Against every stretch of short runs, letter by letter."""
    model = toxicity.Toxicity({"abc": 0.9, "bb": 0.9, "cab*": 0.9}, 0.1, toxic_model.logs)
    rng = random.Random(2)

    def spells(units):
        words = {""}
        for sign in "".join(units):
            letter = toxicity.skeleton(sign)
            longer = {w if w.endswith(letter) else w + letter for w in words} if letter.isalpha() else set()
            words = longer if letter.isalpha() and sign.isalnum() else words | longer
        return words & model._heads

    for _ in range(400):
        run = [rng.choice(["a", "b", "c", "(", "8", "-", "d", "@", "bb"]) for _ in range(rng.randrange(1, 8))]
        want = {(i, j) for i in range(len(run)) for j in range(i, len(run)) if spells(run[i:j + 1])}
        got = set(model.spelled(run))
        assert got <= want
        heads = lambda spans: {h for i, j in spans for h in spells(run[i:j + 1])}
        assert heads(got) == heads(want), run


def test_viterbi_finds_the_best_path(toxic_model):
    """Against all readings of a token without separators or repetitions."""
    def readings(token):
        if not token:
            yield "", 0.0
            return
        for rest, cost in readings(token[1:]):
            if token[0].isalpha():
                yield token[0] + rest, cost
            for x in toxicity.LEET.get(token[0], ""):
                yield x + rest, cost - 1.0

    def score(text, cost):
        c = [0, 0, *map(toxicity._class, text), 0]
        return cost + sum(toxic_model.logs[(a * 28 + b) * 28 + d] for a, b, d in zip(c, c[1:], c[2:]))

    for token in ("1d107", "1n7o", "4b1e", "p1a8"):
        best = max(readings(token), key=lambda x: score(*x))
        assert score(toxic_model.restore(token), best[1]) == pytest.approx(score(*best)), token


def test_toxicity_on_held_out_labels(spark, toxic_model):
    d = "/root/testdata/sf0.01"
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rows = toxicity.score_toxicity(spark.read.parquet(f"{d}/documents.parquet"), toxic_model).where(held).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows) > 50
    assert sum(r.predicted and not r.toxic for r in rows) <= 0.02 * len(rows)


def test_terms_do_not_fade_in_a_larger_sample(spark):
    """40 of 1,500 toxic texts hold each term and no other text does; half of the words beside them say nothing."""
    rng = random.Random(6)
    names = ["".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(4)) for _ in range(500)]
    terms, plain = names[:37], names[37:]
    rows = [(i, " ".join([*rng.sample(plain, 6), *([terms[i // 40 % 37]] if i < 1480 else [])]), int(i < 1500)) for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.learn_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.lit(True))
    found = {t for t in model.terms if not t.endswith("*")}
    assert set(terms) <= found and found.isdisjoint(plain)
    assert all(model.score(f"well {t} then")[0] > 0.7 for t in terms)
    assert toxicity.evidence(5, 0, 50, 100) < toxicity.MIN_EVIDENCE < toxicity.evidence(5, 0, 51, 500) == toxicity.evidence(5, 0, 1530, 15000)


def test_toxicity_of_awkward_rows(spark, toxic_model):
    docs = cases.with_clashes(cases.awkward(spark))
    got = toxicity.score_toxicity(docs, toxic_model).collect()
    assert len(got) == len(cases.awkward_rows()) and all(0 <= r.score <= 1 and not r.predicted for r in got)
    nothing = toxicity.learn_toxicity(docs, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert not nothing.terms and toxicity.score_toxicity(docs, nothing).agg(F.countDistinct("score")).first()[0] == 1
    assert toxicity.score_toxicity(docs.limit(0), toxic_model).count() == 0
