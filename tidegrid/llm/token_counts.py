"""Token counts of a unigram vocabulary by dynamic programming over its matches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments up to this length are remembered, so many of them in a task at a time.
MEMO_CHARS = 48
MEMO_SEGMENTS = 200_000


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Number of pieces, and the score, of the best segmentation of a text.

    A path's score is the sum of its pieces' scores. At each end the best predecessor is the one
    of strictly larger score that comes first from the left, as the tokenizer has it, so that of
    two equal paths the one with the longer last piece wins. A character that is no piece of its
    own may be an unknown piece, ``UNKNOWN_PENALTY`` below the least score; it counts as its UTF-8
    bytes if the vocabulary has byte pieces, else each run of unknown ones counts as one.

    Spaces become marks, and one mark goes in front of a text that is not empty. If no piece has a mark
    after another character, no piece reaches over the start of a word, and words are solved one by one.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.vocabulary = vocabulary
        self.bytes = sum(bool(re.fullmatch(r"<0x[0-9A-F]{2}>", p)) for p, _ in vocabulary) == 256
        self.by_word = self.bytes and not any(MARK in p.lstrip(MARK) for p, _ in vocabulary)
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self._automaton = None
        self._memo: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None, "_memo": {}}

    def _ready(self):
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for piece, score in self.vocabulary:
                if piece:
                    automaton.add_word(piece, (len(piece), score))
            if len(automaton):
                automaton.make_automaton()
            self._automaton = automaton
        return self._automaton

    def solve(self, text: str) -> tuple[int, float]:
        """(pieces, score) of one stretch of text, marks in place."""
        automaton, n = self._ready(), len(text)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        open_run = [False] * (n + 1)  # whether the last piece is unknown and may go on
        end = 0

        def unknown(at: int) -> None:
            best[at] = best[at - 1] + self.unknown
            count[at] = count[at - 1] + (
                len(text[at - 1].encode()) if self.bytes else not open_run[at - 1]
            )
            open_run[at] = True

        def settle(at: int, matches: list[tuple[int, float]]) -> None:
            """Best way to ``at``; ``matches``, longest first, are the pieces that end there."""
            won, single = None, False
            for length, score in matches:
                single |= length == 1
                candidate = best[at - length] + score
                if won is None or candidate > won:
                    won = candidate
                    best[at], count[at], open_run[at] = candidate, count[at - length] + 1, False
            if not single and (won is None or best[at - 1] + self.unknown > won):
                unknown(at)

        found: list[tuple[int, float]] = []
        for last, match in automaton.iter(text) if len(automaton) else ():
            if last + 1 != end:
                if end:
                    settle(end, found)
                for at in range(end + 1, last + 1):
                    settle(at, [])
                end, found = last + 1, []
            found.append(match)
        if end:
            settle(end, found)
        for at in range(end + 1, n + 1):
            settle(at, [])
        return count[n], best[n]

    def _segment(self, segment: str) -> tuple[int, float]:
        known = self._memo.get(segment)
        if known is None:
            known = self.solve(segment)
            if len(segment) <= MEMO_CHARS:
                if len(self._memo) >= MEMO_SEGMENTS:
                    self._memo.clear()
                self._memo[segment] = known
        return known

    def count(self, text: str | None) -> tuple[int, float]:
        """(pieces, score) of a text; (0, 0.0) for a null or empty one."""
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.solve(marked)
        pieces, score = 0, 0.0
        for segment in re.findall(f"{MARK}+[^{MARK}]*", marked):
            n, s = self._memo.get(segment) or self._segment(segment)
            pieces += n
            score += s
        return pieces, score


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, score)`` for every row; null and empty texts have no tokens.

    Repeated rows are counted alike, null ids stay, other columns are ignored.
    """
    counter = UnigramCounter(vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [counter.count(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([n for n, _ in counted], pa.int64()), pa.array([s for _, s in counted], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_tokens", "score"])

    schema = rows.drop("text").schema.add("n_tokens", "long").add("score", "double")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
