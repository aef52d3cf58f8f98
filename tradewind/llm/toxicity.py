"""Toxicity of texts after noisy-channel deobfuscation.

Writers hide words by leetspeak (1d10t), spacing (i d i o t, i.d.i.o.t, "i d ii o t.") and
repetition (idiooot). Every hidden token is a lattice: each sign may stand for one
of a few letters, a repeated letter may be noise, a separator may be noise or a
real end of a word. Viterbi search finds the most probable path under a character
trigram model, and the restored words are scored.

* The trigram model counts all documents (a fixed table of 28^3 numbers), mixed
  half and half with the learned terms.
* The terms, words and word beginnings, are learned from labelled documents: those
  that stand in at least `MIN_TEXTS` toxic ones, hardly occur in others, and do so
  e^`MIN_EVIDENCE` times more likely by their own rate of toxic texts than by that of
  all texts. No bound rises with the sample. At most `SAMPLE_ROWS` labelled documents
  (the first by the hash of their id) are used, which also bounds the terms.
* The score is the probability that at least one of the terms found marks a toxic
  text; without any, the rate of toxic texts among learning texts without terms.

A token is decoded only if some path through its lattice, from its start or from any
sign that may end a word, begins with a term (letters that share a sign made one,
repetitions dropped): no path through any other lattice spells a term. Of a run of
single letters, however long, each stretch that can spell a term is decoded, so a word
may begin and end at any of its letters; any number of separators between two letters
counts as one, and three or more equal letters in a row as two. Each worker keeps a
bounded number of known tokens.

A null or empty text has no terms. Without labels of both kinds there are no
terms, and all scores are equal. Contradicting labels of one id count as toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.common import Columns, id_and_bytes, labelled_sample, map_columns
from tradewind.session import stage_table

SAMPLE_ROWS = 12_000
ACCEPT = 0.7
MIN_TEXTS, MIN_PRECISION, MIN_EVIDENCE = 5, 0.9, 8.0
BEGINNINGS = (4, 5, 6)
KEPT_TOKENS = 400_000
# What a sign may stand for, besides itself (fixed values of the channel).
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c"}
_SIZE = 28  # boundary, a to z, any other letter
_ALIKE = str.maketrans({**{k: v[0] for k, v in LEET.items()}, "l": "i"})
_REPEATED = re.compile(r"(.)\1+")
_PARTS = re.compile(r"[^\W_]+(?:[@$!|+(]+[^\W_]+)*")
_NO_SIGN = re.compile(r"(?:[^\w@$!|+(]|_)+")  # can stand for no letter
_SEPARATOR = "-"  # stands for any number of signs that can be no letter
_LETTERS = re.compile(r"[^\W\d_]+")
_CLASSES = np.array([b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else 27 if b > 127 else 0 for b in range(256)], np.int64)
_COST_LEET, _COST_SAME, _COST_DROP, _COST_END = -1.0, 0.0, -1.5, -3.0


def skeleton(token: str) -> str:
    return _REPEATED.sub(r"\1", token.translate(_ALIKE))


def single(chunk: str) -> str:
    """A chunk of one letter or sign, whatever punctuation or repetition stands with it, in short; else nothing."""
    if len(chunk) == 1:
        return chunk
    letters = {c for c in chunk if c.isalnum()}
    if len(letters) > 1 or not letters and len(set(_NO_SIGN.sub("", chunk))) > 1:
        return ""
    return _REPEATED.sub(r"\1\1", _NO_SIGN.sub(lambda m: m[0][0], chunk))


def folded(run: list[str]) -> list[str]:
    """A run with one separator at most between its letters, and two equal letters at most in a row, separators apart."""
    out: list[str] = []
    letter, times = "", 0
    for unit in run:
        if not any(sign.isalnum() or sign in LEET for sign in unit):
            if out and out[-1] != _SEPARATOR:
                out.append(_SEPARATOR)
            continue
        now = skeleton(unit)
        letter, times = (letter, times + 1) if now == letter else (now, 1)
        if times <= 2:
            out.append(unit)
    return out


def _class(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if char.isalpha() else 0


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all character trigrams of all texts; every task sends its own table."""

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        total = np.zeros(_SIZE ** 3, np.int64)
        for batch in batches:
            for at in range(0, len(batch["text"]), 500):
                stream = b"\n\n".join(batch["text"].slice(at, 500).to_pylist())
                c = _CLASSES[np.frombuffer(b"\n\n" + stream + b"\n", np.uint8)]
                total += np.bincount((c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:], minlength=_SIZE ** 3)
        some = np.flatnonzero(total)
        yield {"trigram": some.astype(np.int32), "n": total[some]}

    rows = map_columns(id_and_bytes(docs), "trigram int, n bigint", task).groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_SIZE ** 3)
    for row in rows:
        out[row["trigram"]] = row["n"]
    return out


def terms_of(text: str) -> set[str]:
    """The words of a text, lowered, and their beginnings (marked by a star)."""
    words = set(_LETTERS.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in BEGINNINGS if len(w) >= k}


@dataclass
class Toxicity:
    """Terms with their precision, the rate without terms, and log P(third letter | two before)."""

    terms: Mapping[str, float]
    rate: float
    logs: np.ndarray
    _heads: set[str] = field(default_factory=set)
    _prefixes: set[str] = field(default_factory=set)
    _known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._heads = {skeleton(t.rstrip("*")) for t in self.terms}
        self._prefixes = {h[:k] for h in self._heads for k in range(1, len(h))}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}

    def restore(self, token: str) -> str:
        """The most probable reading of a lowered token, words separated by blanks."""
        logs, size = self.logs, _SIZE
        # state: the last two letters and the last sign; value: log probability and what is written
        states: dict[tuple[int, int, str], tuple[float, str]] = {(0, 0, ""): (0.0, "")}
        for sign in token:
            after: dict[tuple[int, int, str], tuple[float, str]] = {}

            def put(state: tuple[int, int, str], score: float, text: str) -> None:
                if state not in after or after[state][0] < score:
                    after[state] = (score, text)

            letters = [(x, _COST_LEET) for x in LEET.get(sign, "")]
            if sign.isalpha():
                letters.append((sign, _COST_SAME))
            for (a, b, last), (score, text) in states.items():
                for letter, cost in letters:
                    c = _class(letter)
                    put((b, c, letter), score + cost + logs[(a * size + b) * size + c], text + letter)
                    if letter == last:
                        put((a, b, last), score + _COST_DROP, text)
                if not sign.isalnum():
                    put((a, b, last), score + _COST_DROP, text)
                    if text and b:
                        end = logs[(a * size + b) * size]
                        put((b, 0, ""), score + _COST_END + end, text + " ")
                elif not letters:
                    put((a, b, last), score + 2 * _COST_DROP, text)
            states = after or states
        return max(((score + logs[(a * size + b) * size], text) for (a, b, _), (score, text) in states.items()), key=lambda x: (x[0], x[1]))[1].strip()

    def _found(self, words: str) -> set[str]:
        return {t for t in terms_of(words) if t in self.terms}

    def _may_spell(self, token: str) -> bool:
        """Whether some reading of a token, from its start or behind a dropped sign, begins with a term's skeleton."""
        starts, plain = {""}, token.isalnum()
        for sign in token:
            letter = skeleton(sign)
            if not letter.isalpha():
                letter = ""
            if not sign.isalnum():
                after = starts | {""}
            else:
                after = set() if letter else starts
            if letter:
                for start in starts:
                    longer = start if start.endswith(letter) else start + letter
                    if longer in self._heads:
                        return True
                    if longer in self._prefixes:
                        after.add(longer)
            if not after and plain:
                return False
            starts = after
        return False

    def hits(self, token: str) -> tuple[str, ...]:
        """The terms in a token as it stands or as it is restored."""
        known = self._known.get(token)
        if known is None:
            if len(self._known) > KEPT_TOKENS:
                self._known.clear()
            found = self._found(token)
            if not found and self._may_spell(token):
                found = self._found(self.restore(token))
            parts = _PARTS.findall(token)
            if parts != [token]:
                for part in parts:
                    if self._may_spell(part):
                        found |= self._found(part) or self._found(self.restore(part))
            known = self._known[token] = tuple(sorted(found))
        return known

    def spelled(self, run: list[str]) -> Iterator[tuple[int, int]]:
        """First and last unit of the stretches of a run that can spell a term's skeleton, in one pass over the run.

        A word may begin at any unit and end behind any other. Of several beginnings that spell the same
        letters the last one counts.
        """
        states: dict[str, int] = {}
        for at, unit in enumerate(run):
            states[""] = at
            for sign in unit:
                letter = skeleton(sign)
                if not letter.isalpha():
                    letter = ""
                after = {} if letter and sign.isalnum() else dict(states)
                if letter:
                    for prefix, start in states.items():
                        longer = prefix if prefix.endswith(letter) else prefix + letter
                        if longer in self._heads:
                            yield start, at
                        if longer in self._heads or longer in self._prefixes:
                            after[longer] = max(after.get(longer, -1), start)
                states = after

    def tokens(self, text: str) -> Iterator[str]:
        """White-space chunks, and the stretches of runs of three or more single letters or signs that can spell a term."""
        chunks = text.lower().split()
        distinct = set(chunks)
        yield from distinct
        units = {chunk: unit for chunk in distinct if (unit := single(chunk))}
        if not units:
            return
        run: list[str] = []
        for chunk in [*chunks, ""]:
            if chunk in units:
                run.append(units[chunk])
                continue
            if len(run) > 2:
                short = folded(run)
                for first, last in self.spelled(short):
                    yield "".join(short[first:last + 1])
                    # a doubled first letter
                    before = next((k for k in (first - 1, first - 2) if k >= 0 and skeleton(short[k]) == skeleton(short[first])), None)
                    if before is not None:
                        yield "".join(short[before:last + 1])
            run = []

    def score(self, text: str) -> tuple[float, list[str]]:
        found = sorted({t for token in self.tokens(text) for t in self.hits(token)})
        miss = 1.0
        for term in found:
            miss *= 1 - self.terms[term]
        return (1 - miss if found else self.rate), found


def evidence(toxic: int, others: int, all_toxic: int, everything: int) -> float:
    """Log of how much likelier a term's labels are by its own rate of toxic texts than by that of all texts; 0 for a lower rate."""
    own, base = toxic / (toxic + others), all_toxic / everything
    if own <= base:
        return 0.0
    return toxic * math.log(own / base) + (others * math.log((1 - own) / (1 - base)) if others else 0.0)


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Toxicity:
    """Learn terms on at most `rows` labelled documents for which `learn` holds, letters on all documents."""
    sample = stage_table(labelled_sample(docs, labels, "toxic", learn, rows).select("doc_id", "text", "label"), "toxic-sample")

    def count(batches: Iterator[Columns]) -> Iterator[dict]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                seen[label > 0].update(terms_of(text.decode("utf-8", "replace")))
        terms = list(seen[0] | seen[1])
        yield {"term": terms, "others": [seen[0][t] for t in terms], "toxic": [seen[1][t] for t in terms]}

    whole = sample.agg(F.sum((F.col("label") > 0).cast("int")).alias("toxic"), F.count("*").alias("all")).first()
    toxic, everything = whole["toxic"] or 0, whole["all"]
    counted = map_columns(sample, "term string, others bigint, toxic bigint", count).groupBy("term").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))
    best = counted.where((F.col("toxic") >= MIN_TEXTS) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("others"))))
    picked = [r for r in best.collect() if evidence(r["toxic"], r["others"], toxic, everything) >= MIN_EVIDENCE] if 0 < toxic < everything else []
    # a beginning gives way to a longer one that finds as many toxic texts and fewer others
    longer = defaultdict(list)
    for r in picked:
        for k in BEGINNINGS:
            longer[r["term"][:k]].append(r)
    picked = [
        r for r in picked
        if not r["term"].endswith("*") or not any(
            o["term"] != r["term"] and o["toxic"] >= 0.97 * r["toxic"] and o["others"] < r["others"]
            for o in longer[r["term"][:-1]]
        )
    ]
    terms = {r["term"]: (r["toxic"] + 0.5) / (r["toxic"] + r["others"] + 1) for r in picked}

    def unmarked(batches: Iterator[Columns]) -> Iterator[dict]:
        n = [0, 0]
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                n[label > 0] += terms.keys().isdisjoint(terms_of(text.decode("utf-8", "replace")))
        yield {"others": [n[0]], "toxic": [n[1]]}

    rest = map_columns(sample, "others bigint, toxic bigint", unmarked).agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).first()
    rate = ((rest["toxic"] or 0) + 0.5) / ((rest["toxic"] or 0) + (rest["others"] or 0) + 1)

    letters = trigram_counts(docs)
    own = np.zeros(_SIZE ** 3)
    for term in terms:
        c = [0, 0, *map(_class, term.rstrip("*")), *([] if term.endswith("*") else [0])]
        for a, b, d in zip(c, c[1:], c[2:]):
            own[(a * _SIZE + b) * _SIZE + d] += 1

    def conditional(n: np.ndarray) -> np.ndarray:
        n = n.reshape(-1, _SIZE) + 0.01
        return n / n.sum(1, keepdims=True)

    logs = np.log(0.5 * conditional(letters) + 0.5 * conditional(own)).ravel()
    return Toxicity(terms, min(rate, 0.5), logs)


def score_toxicity(docs: DataFrame, model: Toxicity, *keep: Column) -> DataFrame:
    """Per document the `score`, `predicted`, and the `terms` found in the restored text; `keep` are columns to carry."""
    rows = id_and_bytes(docs, *keep)
    carried = [c for c in rows.columns if c != "text"]

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["text"]), 500):
                scored = [model.score(t.decode("utf-8", "replace")) for t in batch["text"].slice(at, 500).to_pylist()]
                yield {c: batch[c].slice(at, 500) for c in carried} | {
                    "score": [s for s, _ in scored], "predicted": [int(s >= ACCEPT) for s, _ in scored], "terms": [t for _, t in scored],
                }

    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    return map_columns(rows, f"{ddl}, score double, predicted int, terms array<string>", task)
