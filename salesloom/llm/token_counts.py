"""Token counts of a unigram tokenizer without the tokens: Viterbi over Aho-Corasick matches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import map_arrow
from salesloom.llm.tokens import tokenizer_path

# Fixed value: an unknown character scores so much less than the worst piece.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


@dataclass(frozen=True)
class Settings:
    """``model``: a public sentencepiece file whose pieces and scores are the vocabulary.

    ``most``: words remembered by a Python process.
    """

    model: str = "piece_bpe_32k.model"
    most: int = 600_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a sentencepiece file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Piece count and score of the best segmentation of each word.

    Ties go the tokenizer's way: a segmentation replaces another one that ends
    at the same character only if it scores more, and longer last pieces come
    first.  A character that no piece matches alone may be unknown; it counts a
    token for each of its bytes if the vocabulary has all bytes, else a run of
    them counts one.
    """

    def __init__(self, pieces: list[tuple[str, float]], most: int = 600_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{value:02X}>" in names for value in range(256))
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}
        self.most = most

    def word(self, word: str) -> tuple[int, float]:
        """Count and score of one word."""
        scores, counts, open_run = [0.0], [0], [False]
        matches: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.automaton.iter(word):
            matches[end].append(match)
        for end, found in enumerate(matches):
            best = None
            single = False
            for length, score in sorted(found, reverse=True):
                start = end + 1 - length
                candidate = scores[start] + score
                single = single or length == 1
                if best is None or candidate > best:
                    best, count, run = candidate, counts[start] + 1, False
            if not single:
                candidate = scores[end] + self.unknown
                if best is None or candidate > best:
                    best, run = candidate, True
                    if self.bytes:
                        count = counts[end] + len(word[end].encode("utf-8", "surrogatepass"))
                    else:
                        count = counts[end] + (not open_run[end])
            scores.append(best)
            counts.append(count)
            open_run.append(run)
        return counts[-1], scores[-1]

    def __call__(self, text: str | None) -> tuple[int, float]:
        """Count and score of a text: each space starts a word and belongs to it, as one does before the first."""
        if not text:
            return 0, 0.0
        words = text.split(" ")
        if not words[0]:
            words = words[1:]
        total, score = 0, 0.0
        known = self.known
        for word in words:
            found = known.get(word)
            if found is None:
                found = self.word(SPACE + word.replace(" ", SPACE))
                if len(known) < self.most:
                    known[word] = found
            total += found[0]
            score += found[1]
        return total, score


_counters: dict[str, UnigramCounter] = {}


def counter(path: str, most: int) -> UnigramCounter:
    """The counter of this Python process."""
    if path not in _counters:
        _counters[path] = UnigramCounter(vocabulary(path), most)
    return _counters[path]


def _counted(settings: Settings):
    path = tokenizer_path(settings.model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, settings.most)
        for batch in batches:
            found = [count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([tokens for tokens, _ in found], pa.int64()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "n_tokens", "score"],
            )

    return of_batches


def token_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: its id, the tokens of its whole text, and the score of the best segmentation.

    Null and empty texts have no tokens.  Rows are counted one by one, so nulls
    and repeats among the ids do not matter; an empty table gives no rows;
    further columns are not read.  No shuffle.
    """
    return map_arrow(
        docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")),
        _counted(settings),
        "doc_id long, n_tokens long, score double",
    )
