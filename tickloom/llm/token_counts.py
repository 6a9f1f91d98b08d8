"""Token counts by count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import binary, each_slice
from tickloom.llm.words import HashIndex, Words

#: How far below the lowest score of the vocabulary an unknown character lies.
UNKNOWN_PENALTY = 10.0
#: Stands for the blank in front of a word.
MARK = "▁"


def ranked_vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece file with log-rank scores, as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not any(f(k) for f in special)]
    return [(piece, -math.log(rank + 2)) for rank, piece in enumerate(pieces)]


class PieceCounter:
    """Number of pieces and score of the best segmentation of a word, without the pieces.

    The automaton yields all vocabulary pieces that end at a character; the best path to each character
    carries its score, its piece count and whether it ends in an unknown character. The rules are those
    of unigram tokenizers: scores are added from left to right, of equal scores the piece that starts
    earliest wins, a character that is no piece itself counts as unknown, and neighbouring unknowns are one
    token.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], most: int = 1_000_000):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.index, self.counts, self.scores = HashIndex(), np.zeros(0, np.int64), np.zeros(0)

    def word(self, text: str) -> tuple[int, float]:
        n = len(text)
        best, count, open_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ending: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(text) if len(self.automaton) else ():
            ending[end].append(found)
        for end in range(n):
            top, start, known = -math.inf, end, True
            single = False
            for length, score in ending[end]:
                single |= length == 1
                value = best[end + 1 - length] + score
                if value > top or (value == top and end + 1 - length < start):
                    top, start = value, end + 1 - length
            if not single and best[end] + self.unknown > top:
                top, start, known = best[end] + self.unknown, end, False
            best[end + 1], open_unknown[end + 1] = top, not known
            count[end + 1] = count[start] + (known or not open_unknown[start])
        return count[n], best[n]

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, pieces and score of each text."""
        if self.index.size > self.most:
            self.forget()
        words = Words(texts)
        hashes = words.hashes()
        places = self.index.find(hashes)
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            new, where = np.unique(hashes[unknown], return_index=True)
            found = [self.word(MARK + words.word(k).decode()) for k in unknown[where]]
            self.index.add(new)
            self.counts = np.append(self.counts, [c for c, _ in found])
            self.scores = np.append(self.scores, [s for _, s in found])
            places[unknown] = self.index.find(hashes[unknown])
        pieces = np.concatenate([[0], np.cumsum(self.counts[places])])
        exact = np.array([math.fsum(self.scores[places[a:b]]) for a, b in zip(words.at, words.at[1:])])
        return words.counts, pieces[words.at[1:]] - pieces[words.at[:-1]], exact


_COUNTERS: dict[str, PieceCounter] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_pieces and score (log of the best segmentation's probability) of every document.

    Words are what lies between ASCII white space, each with the mark of a leading blank. A null or empty
    text has no pieces and score 0; rows with equal or null doc_id are counted each; an empty table gives
    no rows.
    """

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        if path not in _COUNTERS:
            _COUNTERS[path] = PieceCounter(ranked_vocabulary(path))
        words, pieces, scores = _COUNTERS[path].of(binary(part.column("text")))
        columns = [part.column("doc_id"), pa.array(words), pa.array(pieces), pa.array(scores)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_pieces", "score"])

    return docs.select("doc_id", "text").mapInArrow(each_slice(make), "doc_id bigint, n_words bigint, n_pieces bigint, score double")
