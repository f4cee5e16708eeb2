"""Count-only Viterbi: how many tokens a unigram tokenizer makes of a text, without making them.

An Aho-Corasick automaton finds every vocabulary piece in a word; dynamic programming over end positions keeps
the best score and the number of pieces on the best path. The tie rules are those of the tokenizers library's
unigram model: of equal scores the earlier start, hence the longer last piece, wins; a character that is no
piece costs the least score less 10 and becomes one token for each of its UTF-8 bytes.

The vocabulary is a model file's pieces with its scores. Spaces become U+2581, one is put in front, and a word
never crosses one, so words are counted once per task and looked up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from trialmill.llm.words import slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a task remembers; reaching it starts the memory anew.
CACHE_WORDS = 400_000


def vocabulary(model: str | None = None) -> list[tuple[str, float]]:
    """Pieces and scores of a model file (a path; by default the public 32k pieces), by id."""
    import sentencepiece

    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Tokens and score of the best path through one word."""
        n = len(word)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        ends = self.automaton.iter(word)  # by end, longest first
        if self.single.issuperset(word):
            for last, (length, score) in ends:
                total = best[last + 1 - length] + score
                if total > best[last + 1]:
                    best[last + 1], count[last + 1] = total, count[last + 1 - length] + 1
            return count[n], best[n]
        done = 0  # positions up to here have all their candidates
        for last, (length, score) in ends:
            self._unknown(word, done, last, best, count)
            done = max(done, last)
            total = best[last + 1 - length] + score
            if total > best[last + 1]:
                best[last + 1], count[last + 1] = total, count[last + 1 - length] + 1
        self._unknown(word, done, n, best, count)
        return count[n], best[n]

    def _unknown(self, word: str, start: int, stop: int, best: list[float], count: list[int]) -> None:
        """Steps over characters that are no piece; each comes after all pieces that end where it ends."""
        for i in range(start, stop):
            if word[i] not in self.single and best[i] + self.unknown > best[i + 1]:
                best[i + 1] = best[i] + self.unknown
                count[i + 1] = count[i] + len(word[i].encode("utf-8", "replace"))

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        words = (text if text[0] == SPACE else SPACE + text).split(SPACE)[1:]
        known = self.known
        if len(known) > CACHE_WORDS:
            known = self.known = {}
        for w in set(words).difference(known):
            known[w] = self.word(SPACE + w)
        found = [known[w] for w in words]
        return sum(n for n, _ in found), sum(s for _, s in found)


_counters: dict[str | None, UnigramCounter] = {}


def counter_of(model: str | None) -> UnigramCounter:
    """The process's counter for a model: the next task of a worker finds the words of the last."""
    if model not in _counters:
        _counters[model] = UnigramCounter(vocabulary(model))
    return _counters[model]


def _count(model: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                found = [counter.text(t) for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                    names=["doc_id", "n_tokens", "score"],
                )

    return run


def token_counts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation of each row's whole text.

    A null or empty text has no tokens and score 0. Rows are counted each, also if they repeat; an empty table
    gives no rows; other columns are left out. ``model`` is a path that every executor can read.
    """
    return docs.select("doc_id", "text").mapInArrow(_count(model), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, score double")
