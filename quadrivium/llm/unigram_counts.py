"""Token counts of a unigram tokenizer without tokens: Viterbi that carries the best score and the piece count.

An Aho-Corasick automaton lists all vocabulary matches of a word; for every end position the matches come in ascending
order of their start, as the tokenizer meets them, and only a strictly better score replaces an earlier one.  The
tokenizer is the unigram model over the pieces and scores of a vocabulary file, each word led by a word mark: a
character that is no piece costs the least score less 10 and counts as its bytes where the vocabulary has all byte
pieces, else a run of such characters counts as one unknown token.  Words are independent, so each distinct word is
solved once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.common import text_batches, whole_text
from quadrivium.session import ship_package

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 400_000
CACHED_CHARS = 64


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter(dict):
    """word (without its mark) -> (piece count, best score), in two bounded generations."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, value in {p: s for p, s in pieces if p}.items():
            self.automaton.add_word(piece, (len(piece), value))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        known = {p for p, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in known for b in range(256))
        self.old: dict[str, tuple[int, float]] = {}

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.old.get(word) or self.solve(MARK + word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def solve(self, word: str) -> tuple[int, float]:
        """(count, score) of one word with its mark."""
        n = len(word)
        score = [0.0] * (n + 1)
        count = [0] * (n + 1)
        unknown = [False] * (n + 1)  # whether the best path to here ends with an unknown character
        at = 0  # positions up to here are final
        lone = True

        def bridge(end: int) -> None:
            """The unknown character before ``end``, after all matches that end there."""
            value = score[end - 1] + self.unknown
            if not reached or value > score[end]:
                score[end], unknown[end] = value, True
                if self.bytes:
                    count[end] = count[end - 1] + len(word[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not unknown[end - 1])

        reached = False
        for last, (size, value) in self.automaton.iter(word):
            end = last + 1
            while at < end:  # the end moves on
                if at and lone:
                    bridge(at)
                at, reached, lone = at + 1, False, True
            value += score[end - size]
            if not reached or value > score[end]:
                score[end], count[end], unknown[end], reached = value, count[end - size] + 1, False, True
            if size == 1:
                lone = False
        while at <= n:
            if at and lone:
                bridge(at)
            at, reached, lone = at + 1, False, True
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        """(count, score) of a text; an empty one has no tokens."""
        if not text:
            return 0, 0.0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            words = words[1:]
        found = list(map(self.__getitem__, words))
        return sum(c for c, _ in found), sum(s for _, s in found)


_LOADED: dict[str, UnigramCounter] = {}


def loaded(path: str) -> UnigramCounter:
    if path not in _LOADED:
        _LOADED[path] = UnigramCounter(read_pieces(path))
    return _LOADED[path]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_tokens`` and the best path's ``score``.

    A null text is empty: 0 tokens, score 0.  Repeated rows are counted each.  Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = np.array([loaded(vocabulary).count(t) for t in batch.column(1).to_pylist()], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found[:, 0].astype(np.int64)), pa.array(found[:, 1])], ["_id", "n_tokens", "score"])

    return rows.mapInArrow(run, f"_id {kind}, n_tokens long, score double").withColumnRenamed("_id", id_col)
