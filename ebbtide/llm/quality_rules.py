"""Quality rules by repetition coverage: the share of a text's characters that lies in repeated n-grams and lines.

Rolling hashes give the n-grams of all lengths in numpy for a run of texts at once; nothing leaves the task, and no
text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import map_texts, slices
from .words import Texts, mix, repeated, sums, windows

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_U = np.uint64


@dataclass(frozen=True)
class Limits:
    """What a text may have. A share is of the characters in its words."""

    min_words: int = 50
    base_window: int = 3
    max_base_percent: int = 50
    #: for each n-gram length, the largest share of characters inside n-grams that the text has twice or more
    coverage: dict[int, float] = field(default_factory=lambda: {4: 0.35, 6: 0.30, 10: 0.25})
    #: the largest share of characters in lines equal to an earlier one
    line_characters: float = 0.30


LIMITS = Limits()


def measures(texts: Texts, limits: Limits = LIMITS) -> dict[str, np.ndarray]:
    """The counts of each text, its shares, and the two decisions."""
    n = len(texts.bounds) - 1
    begin, end, firsts = texts.words
    starts_character = (texts.bytes & 0xC0) != 0x80
    in_word = starts_character & ~texts.separator
    characters = np.zeros(len(texts.bytes) + 1, np.int64)
    np.cumsum(in_word, out=characters[1:])
    of_word = characters[end] - characters[begin]
    n_words, word_chars = np.diff(firsts), sums(of_word, firsts)
    text_of_word = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(n, dtype=_U))

    def covered(size: int) -> np.ndarray:
        at, keys = windows(texts.word_hashes, firsts, size)
        twice = at[repeated(mix(keys ^ salt[text_of_word[at]]))]
        edge = np.zeros(len(begin) + 1, np.int64)
        np.add.at(edge, twice, 1)
        np.subtract.at(edge, twice + size, 1)
        return np.cumsum(edge[:-1]) > 0

    # lines, cut at each \n and at the ends of texts
    breaks = np.flatnonzero(texts.bytes == 10)
    # (a break that ends a text begins an empty line of that text, at the place where the next text begins)
    begins = np.concatenate([texts.bounds[:-1], breaks + 1])
    owner = np.concatenate([np.arange(n), np.searchsorted(texts.bounds, breaks, side="right") - 1])
    order = np.lexsort((np.arange(len(begins)) >= n, begins, owner))
    line_begin, line_text = begins[order], owner[order]
    line_end = np.append(line_begin[1:], 1) - 1
    last = np.append(line_text[1:] != line_text[:-1], np.ones(min(1, n), bool))
    line_end = np.where(last, texts.bounds[1:][line_text], line_end[: len(line_text)])
    line_chars = characters[line_end] - characters[line_begin]
    worded = np.flatnonzero(line_chars > 0)
    keys = mix(texts.hashes(line_begin[worded], line_end[worded]) ^ salt[line_text[worded]])
    order = np.argsort(keys, kind="stable")  # the first of equal lines stays first
    again = np.zeros(len(worded), bool)
    again[order[1:]] = keys[order][1:] == keys[order][:-1]
    dup = worded[again]
    n_dup_lines = np.bincount(line_text[dup], minlength=n)
    dup_line_chars = np.bincount(line_text[dup], weights=line_chars[dup], minlength=n)

    whole = np.maximum(word_chars, 1)
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": texts.per_text(_SYMBOL[texts.bytes]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": sums(covered(limits.base_window), firsts),
    }
    base_failed = (n_words < limits.min_words) | (100 * out["n_repeat_words"] > limits.max_base_percent * n_words)
    passes = np.ones(n, bool)
    for size, most in limits.coverage.items():
        share = sums(np.where(covered(size), of_word, 0), firsts) / whole
        out[f"share_{size}_grams"] = share
        passes &= share <= most
    out["share_line_chars"] = dup_line_chars / whole
    passes &= out["share_line_chars"] <= limits.line_characters
    out["base_failed"] = base_failed
    out["kept"] = passes & ~base_failed
    return out


def judge(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the counts and shares of its whole text, base_failed and kept.

    ``docs`` needs ``doc_id`` and ``text``; other columns play no part. A null or empty text has no words: all counts
    are 0 and it fails. A repeated row gives a repeated row, a null ``doc_id`` stays null, an empty table gives none.
    A text is always looked at whole; one longer than a slice is taken alone, at some 80 bytes of memory a byte.
    """
    shares = [f"share_{k}_grams" for k in limits.coverage] + ["share_line_chars"]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measures(Texts.of(batch.column(1)), limits)
        columns = [pa.array(found[k], pa.int64()) for k in counts]
        columns += [pa.array(found[k], pa.bool_()) for k in ("base_failed", "kept")]
        columns += [pa.array(found[k], pa.float64()) for k in shares]
        names = ["doc_id", *counts, "base_failed", "kept", *shares]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{k} long" for k in counts) + ", base_failed boolean, kept boolean, "
    return map_texts(docs, [docs["doc_id"], docs["text"]], work, schema + ", ".join(f"{k} double" for k in shares))


def keeps(text: Column, limits: Limits = LIMITS) -> Column:
    """Whether a text is kept, as a column, for use in a filter."""

    @F.pandas_udf("boolean")
    def kept(column: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(column, pa.string())], ["text"])
        parts = [measures(Texts.of(part.column(0)), limits)["kept"] for part in slices(batch, 0)]
        return pd.Series(np.concatenate([np.zeros(0, bool), *parts]))

    return kept(text)


def filter_docs(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    return docs.filter(keeps(docs["text"], limits))
