"""Quality classifier: a regularised quadratic discriminant over transformed statistics of a document's whole text.

Each class has its own mean and covariance; the covariance is shrunk towards that of both classes together and towards
the mean variance. A score is the difference of the two log-densities, each a Mahalanobis distance by a Cholesky
factor that is computed once. The fit needs sums of products by class alone, so it covers every labelled row and is
of the same size for any number of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rows import map_texts, slices
from .words import Texts, mix, repeated, sums, windows

_U = np.uint64
#: Shares of the pooled covariance, and of its mean variance, in a class's covariance.
TO_POOLED, TO_SPHERE = 0.8, 0.02
FEATURES = (
    "words",
    "word_length",
    "symbols",
    "marks",
    "capitals",
    "digits",
    "other_signs",
    "beyond_ascii",
    "line_words",
    "distinct_words",
    "repeated_windows",
    "repeated_lines",
)


def _flags(signs: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in signs]] = True
    return out


_SYMBOLS, _MARKS, _STOPS = _flags("#*$%&|<>{}[]\\^~=_@"), _flags("!?"), _flags(".,;:'\"()-/+")
_CAPITALS, _DIGITS = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("0123456789")


def features(texts: Texts) -> np.ndarray:
    """A row for each text. Counts are taken as logarithms, shares as square roots, so that tails are short."""
    n = len(texts.bounds) - 1
    begin, end, firsts = texts.words
    n_words = np.diff(firsts)
    starts_character = (texts.bytes & 0xC0) != 0x80
    chars = np.maximum(texts.per_text(starts_character & ~texts.separator), 1)
    words = np.maximum(n_words, 1)
    owner = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(n, dtype=_U))
    keys = mix(texts.word_hashes ^ salt[owner])
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[order[1:]] = np.diff(keys[order]) != 0
    at, grams = windows(texts.word_hashes, firsts, 3)
    again = np.zeros(len(begin), bool)
    again[at] = repeated(mix(grams ^ salt[owner[at]]))
    lines = texts.per_text(texts.bytes == 10) + 1
    # a line's hash is that of the bytes from one break to the next
    breaks = np.flatnonzero(texts.bytes == 10)
    line_begin = np.unique(np.concatenate([texts.bounds[:-1], breaks + 1]))
    line_begin = line_begin[line_begin < len(texts.bytes)]
    line_owner = np.searchsorted(texts.bounds, line_begin, side="right") - 1
    line_end = np.minimum(np.append(line_begin[1:], len(texts.bytes)), texts.bounds[1:][line_owner])
    line_end = line_end - (texts.bytes[np.maximum(line_end, 1) - 1] == 10) if len(line_begin) else line_end
    long = line_end - line_begin > 1
    line_keys = mix(texts.hashes(line_begin[long], line_end[long]) ^ salt[line_owner[long]])
    repeated_lines = np.bincount(line_owner[long][repeated(line_keys)], minlength=n)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.sqrt(texts.per_text(flags[texts.bytes]) / chars)

    return np.stack(
        [
            np.log1p(n_words),
            np.log(chars / words + 1),
            share(_SYMBOLS),
            share(_MARKS),
            share(_CAPITALS),
            share(_DIGITS),
            share(_STOPS),
            np.sqrt(texts.per_text(starts_character & (texts.bytes >= 0x80)) / chars),
            np.log(n_words / lines + 1),
            np.sqrt(sums(new, firsts) / words),
            np.sqrt(sums(again, firsts) / words),
            np.sqrt(repeated_lines / lines),
        ],
        axis=1,
    )


@dataclass(frozen=True)
class Discriminant:
    """For each class (0, 1): mean, inverse of the Cholesky factor of the covariance, and log of prior over volume."""

    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, with the priors."""
        far = [((x - m) @ inverse.T) ** 2 for m, inverse in zip(self.means, self.inverses)]
        return self.offsets[1] - self.offsets[0] + (far[0].sum(axis=1) - far[1].sum(axis=1)) / 2

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; 0.5 where the log-odds are even. They are divided by the number of features, since densities
        of dependent features make for odds so large that all scores would be 0 or 1."""
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x) / x.shape[1], -500, 500)))


def solve(moments: np.ndarray, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE) -> Discriminant:
    """From sums of products [class, i, j], where feature 0 is the constant 1. A class without rows is taken to lie
    where the other one does, so that it decides nothing."""
    d = moments.shape[1] - 1
    counts = moments[:, 0, 0]
    if not counts.all():
        moments = moments + moments[::-1] if counts.any() else moments + np.eye(d + 1)
    n = moments[:, 0, 0]
    means = moments[:, 0, 1:] / n[:, None]
    own = moments[:, 1:, 1:] / n[:, None, None] - np.einsum("ki,kj->kij", means, means)
    pooled = np.einsum("k,kij->ij", n / n.sum(), own)
    scale = np.diag(np.maximum(np.diag(pooled), 1e-6))
    shrunk = (1 - to_pooled - to_sphere) * own + to_pooled * pooled + to_sphere * scale
    factors = np.linalg.cholesky(shrunk + 1e-7 * np.eye(d))
    volume = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    priors = np.log(np.maximum(counts, 1) / max(counts.sum(), 1))
    return Discriminant(means, np.linalg.inv(factors), priors - volume)


# ---- over the corpus ----


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each row's whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features(Texts.of(batch.column(1)))
        values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, [docs["doc_id"], docs["text"]], work, f"doc_id {kind}, features array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from: crc32 of its doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _array(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(FEATURES))


def fit(rows: DataFrame, labels: DataFrame) -> Discriminant:
    """The model of all labelled rows that are not held out. A label other than 0 and 1 is none; a doc_id that is
    labelled several times counts as often."""
    usable = labels.filter(F.col("quality").isin(0, 1)).select(labels["doc_id"].alias("_id"), F.col("quality").cast("int").alias("label"))
    known = rows.join(usable.filter(~held_out(F.col("_id"))), F.col("doc_id") == F.col("_id")).select("label", "features")
    size = len(FEATURES) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size, size))
        for batch in batches:
            x = np.concatenate([np.ones((batch.num_rows, 1)), _array(batch.column("features"))], axis=1)
            for k in (0, 1):
                own = x[batch.column("label").to_numpy() == k]
                total[k] += own.T @ own
        k, i, j = np.indices(total.shape).reshape(3, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array(j), pa.array(total.ravel())], ["k", "i", "j", "s"])

    moments = np.zeros((2, size, size))
    for row in known.mapInArrow(run, "k int, i int, j int, s double").groupBy("k", "i", "j").agg(F.sum("s").alias("s")).collect():
        moments[row["k"], row["i"], row["j"]] = row["s"]  # 2 * size * size rows
    return solve(moments)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other columns play no part. Null and empty texts
    have features as any other. A repeated row is scored as often; a row without doc_id is scored, and neither held
    out nor learned from. Without usable labels every score is 0.5. An empty table gives an empty one.
    """
    rows = materialize(feature_rows(docs), "features")
    model = fit(rows, labels)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(column.to_numpy())) if len(column) else np.zeros(0))

    found = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("features").alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def filter_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = fit(materialize(feature_rows(docs), "features"), labels)

    @F.pandas_udf("boolean")
    def accepted(column: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(column, pa.string())], ["text"])
        parts = [model.scores(features(Texts.of(part.column(0)))) >= 0.5 for part in slices(batch, 0)]
        return pd.Series(np.concatenate([np.zeros(0, bool), *parts]))

    return docs.filter(accepted(docs["text"]))
