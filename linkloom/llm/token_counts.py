"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A pre-token is a word (text between ASCII white space) with the word mark before it. Its count is the number of pieces
of its most probable segmentation; characters that no piece covers cost one token a UTF-8 byte. The distinct
pre-tokens of a batch are walked in order, which is a depth-first walk of their trie: the forward score of each prefix
is computed once, kept on the path, and shared by all words below; a word's count is stored at its end. Words met
before come from a table of bounded size. Nothing is shuffled.

Pieces come from a sentencepiece vocabulary file, whose order is their rank; a piece's log probability is Zipf's,
``-ln(rank) - ln(sum of 1/rank)``. Equal scores go to fewer tokens.

Defined cases: null and blank texts have 0 tokens; repeated rows are counted each; no rows give no rows; other columns are
kept as they are, but ``text`` goes and columns named ``n_pretokens`` and ``n_tokens`` are replaced.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK = "▁"
MOST = 800_000


class Unigram:
    """Pieces' scores, and the counts of words met so far."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.suffixes = {p[k:] for p in scores for k in range(len(p))}
        self.byte = min(scores.values(), default=-1.0) - 10.0
        self.path: list[tuple[float, int]] = [(0.0, 0)]
        self.word = ""
        self.known: dict[bytes, int] = {}
        self.counts, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @classmethod
    def from_file(cls, path: str) -> Unigram:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
        return cls({p: -math.log(r) - total for r, p in enumerate(pieces, 1)})

    def count(self, word: str) -> int:
        """Tokens of one pre-token; the part of the path that it shares with the one before stands."""
        keep, top = 0, min(len(self.word), len(word))
        while keep < top and self.word[keep] == word[keep]:
            keep += 1
        path = self.path
        del path[keep + 1 :]
        scores, suffixes = self.scores, self.suffixes
        for end in range(keep + 1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            before = path[end - 1]
            best, tokens = before[0] + self.byte * size, before[1] + size
            for start in range(end - 1, -1, -1):
                piece = word[start:end]
                if piece not in suffixes:
                    break
                if piece in scores:
                    got, n = path[start][0] + scores[piece], path[start][1] + 1
                    if got > best or (got == best and n < tokens):
                        best, tokens = got, n
            path.append((best, tokens))
        self.word = word
        return path[-1][1]

    def learn(self, words: list[bytes]) -> None:
        decoded = sorted((MARK + w.decode("utf-8", "replace"), k) for k, w in enumerate(words))
        got = np.zeros(len(words), np.int64)
        for w, k in decoded:
            got[k] = self.count(w)
        self.counts = np.concatenate([self.counts, got])

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text."""
        known, new, at = self.known, [], []
        sizes = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                words = t.split()
                sizes[i] = len(words)
                for w in set(words).difference(known):
                    known[w] = len(known)
                    new.append(w)
                at += map(known.__getitem__, words)
        self.learn(new)
        at = np.array(at, np.int64)
        uses = np.bincount(at, minlength=len(known))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        run = np.concatenate([[0], np.cumsum(self.counts[at])])
        ends = np.cumsum(sizes)
        tokens = run[ends] - run[ends - sizes]
        if len(known) > MOST:  # those met most often stay, half of the table at most
            least = 2
            while (kept := np.flatnonzero(self.uses >= least)).size > MOST // 2:
                least += 1
            stays = np.zeros(len(known), bool)
            stays[kept] = True
            self.known = {w: k for k, w in enumerate(compress(known, stays.tolist()))}
            self.counts, self.uses = self.counts[kept], self.uses[kept] // 2
        return sizes, tokens


_made: dict[str, Unigram] = {}


def model(path: str) -> Unigram:
    """One for each Python worker; it keeps its table from task to task."""
    if path not in _made:
        _made[path] = Unigram.from_file(path)
    return _made[path]


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``n_pretokens`` and ``n_tokens`` to ``docs``."""
    common.small_batches(docs.sparkSession)
    data = F.col("text").cast("binary")
    return common.with_added(docs, data, lambda texts: map(pa.array, model(vocabulary).of(texts)), "n_pretokens long, n_tokens long").drop("text")


def query(spark, sf_dir):
    """op1: every document's token count."""
    import public_tokenizers

    return counted(common.documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
