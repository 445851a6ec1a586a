"""Token counts of a unigram vocabulary by a count-only Viterbi pass.

An Aho-Corasick automaton lists the vocabulary's matches that end at each
character; dynamic programming carries only the best score and the number of
pieces of each prefix. Tie rules are those of the ``Unigram`` model in the public
``tokenizers`` library: a later candidate replaces the best only with a strictly
higher score, and candidates come in the order of their start; so of equal
scores the longest last piece wins. A character that is no piece by itself also
has a candidate with the lowest score of the vocabulary less 10; runs of such
characters count as their UTF-8 bytes with byte fallback, else as one unknown
piece.

Words (the space mark and what follows it) are scored alone, as that library's
``Metaspace`` splitting does, and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import configure

MARK = "▁"
#: What a character that is no piece loses against the lowest score (fixed value).
PENALTY = 10.0
#: Words that a worker remembers, and the longest that it remembers.
MEMORY, LONGEST = 150_000, 64
LOW = float("-inf")


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a public vocabulary file, in the order of ids."""
    lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(lib.id_to_piece(i), lib.get_score(i)) for i in range(lib.get_piece_size())]


class UnigramCounter:
    """Counts pieces of the best segmentation under a scored vocabulary."""

    def __init__(self, vocab: Sequence[tuple[str, float]], unknown: int = 0, byte_fallback: bool = True) -> None:
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocab):
            if piece:
                # Of repeated pieces the library keeps the last id, with that id's score.
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.automaton.make_automaton()
        self.lowest = min((s for _, s in vocab), default=0.0) - PENALTY
        self.names = {p for p, _ in vocab}
        self.single = {p for i, (p, _) in enumerate(vocab) if len(p) == 1 and i != unknown}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in self.names for b in range(256))
        self.known: dict[str, tuple[float, int]] = {}
        self.old: dict[str, tuple[float, int]] = {}

    def best(self, word: str) -> tuple[float, int]:
        """Best score and its number of pieces for one word."""
        return self._plain(word) if self.single.issuperset(word) else self._general(word)

    def _plain(self, word: str) -> tuple[float, int]:
        """Where every character is a piece. The automaton lists matches by their end, longest first."""
        score, count = [0.0] + [LOW] * len(word), [0] * (len(word) + 1)
        for last, (length, s, _) in self.automaton.iter(word):
            start = last + 1 - length
            s += score[start]
            if s > score[last + 1]:
                score[last + 1] = s
                count[last + 1] = count[start] + 1
        return score[-1], count[-1]

    def _general(self, word: str) -> tuple[float, int]:
        n = len(word)
        by_end: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        for last, found in self.automaton.iter(word):
            by_end[last + 1].append(found)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        run = list(range(n + 1))  # where the run of unknown characters before a place starts
        for end in range(1, n + 1):
            best, at, un, alone = LOW, -1, False, False
            # Longest first is by start; only a strictly higher score replaces.
            for length, s, is_unknown in sorted(by_end[end], reverse=True):
                alone = alone or length == 1
                if at < 0 or s + score[end - length] > best:
                    best, at, un = s + score[end - length], end - length, is_unknown
            if not alone and (at < 0 or self.lowest + score[end - 1] > best):
                best, at, un = self.lowest + score[end - 1], end - 1, True
            score[end] = best
            if not un:
                count[end] = count[at] + 1
            else:
                run[end] = run[at]
                piece = word[run[at] : end]
                spelled = self.bytes and piece not in self.names
                count[end] = count[run[at]] + (len(piece.encode("utf-8", "surrogatepass")) if spelled else 1)
        return score[n], count[n]

    def count(self, text: str | None) -> tuple[float, int]:
        """Score and number of pieces of a whole text."""
        if not text:
            return 0.0, 0
        marked = text.replace(" ", MARK)
        words = (marked if marked.startswith(MARK) else MARK + marked).split(MARK)[1:]
        known = self.known.get
        found = []
        for w in words:
            found.append(known(w) or self._remembered(w))
            known = self.known.get
        # Scores are added word by word, so that equal texts have equal sums.
        return sum([f[0] for f in found]), sum([f[1] for f in found])

    def forget(self) -> None:
        """Free the memory of words: workers are used again by other stages."""
        self.known, self.old = {}, {}

    def _remembered(self, word: str) -> tuple[float, int]:
        """``best`` from memory. Two generations: what was used of late survives a full memory."""
        found = self.old.get(word)
        if found is None:
            found = self.best(MARK + word)
        if len(word) <= LONGEST:
            if len(self.known) >= MEMORY:
                self.old, self.known = self.known, {}
            self.known[word] = found
        return found


@lru_cache(maxsize=4)
def counter(model_file: str) -> UnigramCounter:
    """One counter for each worker and file."""
    return UnigramCounter(vocabulary(model_file))


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_tokens`` (long) and ``score`` (double, of the best segmentation) of every row.

    The file's pieces and scores are taken as a unigram vocabulary. Null and empty
    texts have no tokens and score 0. Rows are handled alone: repeated rows stay,
    an empty table gives an empty table, other columns are not read.
    """
    configure(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_file)
        c.forget()
        for b in batches:
            scored = [c.count(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n in scored], pa.int64()), pa.array([s for s, _ in scored], pa.float64())],
                names=["id", "n_tokens", "score"],
            )
        c.forget()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, n_tokens long, score double").withColumnRenamed("id", id_col)
