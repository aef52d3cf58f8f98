"""Token counts under a unigram model, by dynamic programming shared along a trie.

The best split of a pre-token into vocabulary pieces is found by forward scores:
the best score of a prefix is the best over its last piece of the score of what
precedes plus the piece's log probability. A prefix has one score whatever
follows, so distinct pre-tokens are inserted into a trie and a score is computed
once per trie node; the node where a pre-token ends keeps its token count.

Documents never move: each worker keeps a trie over the pre-tokens that it meets, and
the terminal counts, and adds up the counts of each text. A trie that reaches
`MAX_NODES` and a store that reaches `MAX_WORDS` are begun anew, which costs time
and changes no count; pre-tokens longer than `LONG_WORD` run the same recurrence
along a line of their own instead of filling the trie.

The vocabulary is a public one and is not trained: its pieces, best first, get
Zipf probabilities by rank. Characters without a piece are spelled in bytes.
Ties take fewer tokens. Null and empty texts have no pre-tokens and no tokens.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame

from tradewind.llm.common import Columns, id_and_bytes, map_columns

MAX_NODES = 600_000
MAX_WORDS = 1_000_000
LONG_WORD = 256
WORD_START = "▁"
_TRIES: dict[int, "PrefixTrie"] = {}


def zipf_scores(pieces: Sequence[str]) -> dict[str, float]:
    """Log probability of each piece, proportional to 1 / rank in the given order."""
    whole = math.log(sum(1 / (rank + 1) for rank in range(len(pieces)))) if pieces else 0.0
    return {piece: -math.log(rank + 1) - whole for rank, piece in enumerate(pieces)}


def sentencepiece_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a model file, best first: no control, byte, unknown or unused piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.get_score(i) < -1e8)]


class PrefixTrie:
    """Forward scores and token counts of all prefixes of the inserted words."""

    def __init__(self, scores: Mapping[str, float], byte_score: float) -> None:
        self.scores = scores
        self.byte_score = byte_score
        sizes: dict[str, set[int]] = {}
        for piece in scores:
            sizes.setdefault(piece[-1], set()).add(len(piece))
        self.sizes = {char: sorted(found) for char, found in sizes.items()}  # of pieces by their last character
        self.terminal: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best = [0.0]
        self.tokens = [0]

    def _extend(self, word: str, end: int, path: Sequence[int], best: Sequence[float], tokens: Sequence[int]) -> tuple[float, int]:
        """Score and count of word[:end]; path[k] is where `best` and `tokens` have those of word[:k]."""
        char, before = word[end - 1], path[end - 1]
        spelled = len(char.encode("utf-8", "surrogatepass"))
        top, count = best[before] + spelled * self.byte_score, tokens[before] + spelled
        scores = self.scores
        for size in self.sizes.get(char, ()):
            if size > end:
                break
            piece = scores.get(word[end - size:end])
            if piece is not None:
                before = path[end - size]
                score, n = best[before] + piece, tokens[before] + 1
                if score > top or (score == top and n < count):
                    top, count = score, n
        return top, count

    def count(self, word: str) -> int:
        """Tokens of the best split of `word`."""
        if len(word) > LONG_WORD:
            return self._count_line(word)
        node, child, path = 0, self.child, [0]
        for end, char in enumerate(word, 1):
            below = child.get((node, char))
            if below is None:
                score, n = self._extend(word, end, path, self.best, self.tokens)
                below = child[node, char] = len(self.best)
                self.best.append(score)
                self.tokens.append(n)
            path.append(node := below)
        return self.tokens[node]

    def count_all(self, words: Sequence[bytes]) -> int:
        """Tokens of all words, each counted as a pre-token that begins a word."""
        terminal = self.terminal
        missing = set(words).difference(terminal)
        if missing and len(terminal) > MAX_WORDS:
            terminal.clear()
            missing = set(words)
        for word in sorted(missing):  # neighbours share their prefixes
            if len(self.best) > MAX_NODES:
                self.clear()
            terminal[word] = self.count(WORD_START + word.decode("utf-8", "replace"))
        return sum(map(terminal.__getitem__, words))

    def _count_line(self, word: str) -> int:
        best, tokens, path = [0.0], [0], range(len(word) + 1)
        for end in range(1, len(word) + 1):
            score, n = self._extend(word, end, path, best, tokens)
            best.append(score)
            tokens.append(n)
        return tokens[-1]


def worker_trie(pieces: Sequence[str]) -> PrefixTrie:
    """The trie of this worker process for a vocabulary; it lasts from task to task."""
    key = zlib.crc32("\n".join(pieces).encode())
    if key not in _TRIES:
        scores = zipf_scores(pieces)
        # a byte is rarer than the rarest piece
        _TRIES[key] = PrefixTrie(scores, min(scores.values(), default=0.0) - math.log(256))
    return _TRIES[key]


def count_tokens(docs: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """Per document `n_chars`, `n_words` (pre-tokens between ASCII white space) and `n_tokens`."""
    pieces = list(pieces)

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        trie = worker_trie(pieces)
        for batch in batches:
            texts = batch["text"]
            for at in range(0, len(texts), 500):
                n_words, n_tokens, n_chars = [], [], []
                for text in texts.slice(at, 500).to_pylist():
                    words = text.split()
                    n_words.append(len(words))
                    n_tokens.append(trie.count_all(words))
                    n_chars.append(len(text.decode("utf-8", "replace")))
                yield {"doc_id": batch["doc_id"].slice(at, 500), "n_chars": n_chars, "n_words": n_words, "n_tokens": n_tokens}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_columns(id_and_bytes(docs), f"doc_id {kind}, n_chars bigint, n_words bigint, n_tokens bigint", task)
