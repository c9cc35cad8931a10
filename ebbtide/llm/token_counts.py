"""Token counts by a unigram vocabulary, without building any token.

An Aho-Corasick automaton gives all vocabulary pieces that end at each character. Dynamic programming over the ends
carries only the best score and the number of pieces of the best segmentation. Ties go as in the ``Unigram`` model of
``tokenizers``: of equally good pieces that end at one place, the one that begins first wins. A character that is no
piece costs the least score less 10, and counts as its UTF-8 bytes if the vocabulary has a piece for each byte (a run
of such characters counts as one otherwise).
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame

from .rows import map_texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct chunks whose counts a task keeps; beyond it they are gathered anew.
CHUNKS_KEPT = 500_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece file with their scores, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces of texts by the best segmentation."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {piece for piece, _ in pieces}
        self.single = {piece for piece in names if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.by_bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        # a piece never goes on past a space sign that follows another character: texts can be cut there
        self.cuts = not any(SPACE in piece.lstrip(SPACE) for piece in names)
        self.known: dict[str, tuple[int, float]] = {}

    def _best(self, chunk: str) -> tuple[int, float]:
        n = len(chunk)
        scores, counts, unknown_end = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(chunk):
            ends[end].append(found)
        for end in range(n):
            best, pieces, is_unknown = None, 0, False
            for length, score in sorted(ends[end], reverse=True):  # the longest begins first
                begin = end + 1 - length
                total = score + scores[begin]
                if best is None or total > best:
                    best, pieces = total, counts[begin] + 1
            if chunk[end] not in self.single:
                total = self.unknown + scores[end]
                if best is None or total > best:
                    best, is_unknown = total, True
                    more = len(chunk[end].encode()) if self.by_bytes else int(not unknown_end[end])
                    pieces = counts[end] + more
            scores[end + 1], counts[end + 1], unknown_end[end + 1] = best, pieces, is_unknown
        return counts[n], scores[n]

    def count(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of ``text``; spaces are signs, and one is put before the text."""
        if not text:
            return 0, 0.0
        if len(self.known) > CHUNKS_KEPT:
            self.known.clear()
        pieces, score, known = 0, 0.0, self.known
        for chunk in self._chunks(text):
            found = known.get(chunk)
            if found is None:
                found = known[chunk] = self._best(chunk)
            pieces += found[0]
            score += found[1]
        return pieces, score

    def _chunks(self, text: str) -> list[str]:
        marked = text.replace(" ", SPACE)
        if not marked.startswith(SPACE):
            marked = SPACE + marked
        if not self.cuts:
            return [marked]
        out: list[str] = []
        spaces = 0
        for part in marked.split(SPACE)[1:]:
            spaces += 1
            if part:
                out.append(SPACE * spaces + part)
                spaces = 0
        return out + [SPACE * spaces] * (spaces > 0)


@functools.lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens and score of the best segmentation of its whole text.

    ``docs`` needs doc_id and text; other columns play no part. A null or empty text has no tokens and score 0. A
    repeated row is counted as often, a null doc_id stays null, an empty table gives an empty one. A text is counted
    whole, at some 100 bytes of memory for each character of its longest stretch without a space.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(path).count
        found = [count(text or "") for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, [docs["doc_id"], docs["text"]], work, f"doc_id {kind}, n_tokens long, score double")
