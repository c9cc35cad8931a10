"""Periodic runs of words: stretches that repeat a block three times or more, found by block convolution.

A run of smallest period q and length at least max(24, 3 q) holds, for B = 8 (q < 16) or the power of two with
B <= q < 2 B, an aligned block of B words that occurs again q words later. So at each dyadic scale B, the sums of
squared differences between a block and all places of the window that follows come from one convolution, by a number
theoretic transform: word labels are so small that no sum reaches the prime, so the sums are exact integers, and zero
says that the block's labels occur there. Such distances seed extensions, in which the words themselves are compared.

Two exact screens keep the transforms few. A block with a word that does not come again within the window has no
occurrence there. And a block whose window lies in a known run of period below B can only find that run again.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import map_texts
from .words import Texts, joined, mix, word_numbers

_U = np.uint64
PRIME, GENERATOR = 2013265921, 31  # 15 * 2**27 + 1: transforms of up to 2**27 numbers, texts of 10**8 words
SHORTEST = 24
TIMES = 3
#: The smallest block; it serves all periods below twice its length.
BLOCK = 8
#: Numbers that are transformed in one go.
HELD = 1 << 19

RUN = "struct<start:long,length:long,period:long>"


@functools.lru_cache(maxsize=64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order twice that."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    step = pow(root, -1, PRIME) if inverse else root
    out = np.ones(1, _U)
    while len(out) < half:
        out = np.concatenate([out, out * _U(pow(step, len(out), PRIME)) % _U(PRIME)])
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """The transform of each row modulo PRIME; the result's order is that which ``restore`` takes."""
    m, n = a.shape
    half, p = n // 2, _U(PRIME)
    while half:
        v = a.reshape(m, -1, 2, half)
        x, y = v[:, :, 0], v[:, :, 1]
        a = np.stack([(x + y) % p, (x + p - y) * _roots(half, False) % p], axis=2).reshape(m, n)
        half //= 2
    return a


def restore(a: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    m, n = a.shape
    half, p = 1, _U(PRIME)
    while half < n:
        v = a.reshape(m, -1, 2, half)
        x, y = v[:, :, 0], v[:, :, 1] * _roots(half, True) % p
        a = np.stack([(x + y) % p, (x + p - y) % p], axis=2).reshape(m, n)
        half *= 2
    return a * _U(pow(n, -1, PRIME)) % p


def labels(words: np.ndarray, block: int) -> np.ndarray:
    """Small numbers for words, equal for equal ones: sums over a block of products of two stay below PRIME."""
    return mix(words.astype(_U) + (_U(block) << _U(40))) % _U(math.isqrt((PRIME - 1) // block))


def occurrences(label: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``starts``, distance) wherever the block's labels stand again, 1 to 2 * block - 1 places further on.

    Places past the end of ``label`` repeat its last number; who asks knows where a text ends.
    """
    rows, distances = [], []
    step = max(1, HELD // (4 * block))
    for at in range(0, len(starts), step):
        own = starts[at : at + step]
        window = np.zeros((len(own), 4 * block), _U)
        window[:, : 3 * block] = label[np.minimum(own[:, None] + np.arange(3 * block), len(label) - 1)]
        turned = np.zeros_like(window)
        turned[:, :block] = window[:, block - 1 :: -1]
        product = restore(transform(window) * transform(turned) % _U(PRIME)).astype(np.int64)
        products = product[:, block - 1 : 3 * block - 1]  # of the block with the window's places 0 .. 2 block - 1
        squares = np.zeros((len(own), 3 * block + 1), np.int64)
        np.cumsum(window[:, : 3 * block].astype(np.int64) ** 2, axis=1, out=squares[:, 1:])
        there = squares[:, block : 3 * block] - squares[:, : 2 * block]
        apart = there[:, :1] + there - 2 * products
        row, distance = np.nonzero(apart[:, 1:] == 0)
        rows.append(row + at)
        distances.append(distance + 1)
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *distances])


def _reach(words: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on, ``most`` at most; backwards if that is negative."""
    sign, left, done, size = (1 if most >= 0 else -1), abs(most), 0, 32
    while left > done:
        k = min(size, left - done)
        if sign > 0:
            same = words[a + done : a + done + k] == words[b + done : b + done + k]
        else:
            same = (words[a - done - k : a - done] == words[b - done - k : b - done])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, size = done + k, 2 * size
    return done


def _extend(words, firsts, text, starts, distances, block) -> dict[tuple[int, int], int]:
    """{(start, end): period} of the runs that the seeds (block at ``starts``, distance) lie in."""
    found: dict[tuple[int, int], int] = {}
    order = np.lexsort((starts, distances))
    starts, distances, text = starts[order], distances[order], text[order]
    cuts = np.flatnonzero(np.append(True, np.diff(distances) != 0)) if len(starts) else []
    for begin, end in zip(cuts, [*cuts[1:], len(starts)]):
        q, at = int(distances[begin]), begin
        while at < end:
            s, low, high = int(starts[at]), int(firsts[text[at]]), int(firsts[text[at] + 1])
            after = _reach(words, s, s + q, high - q - s)
            if after < block:  # equal labels of other words
                at += 1
                continue
            first = s - _reach(words, s, s + q, -(s - low))
            last = s + after + q
            if last - first >= max(SHORTEST, TIMES * q):
                key = (first, last)
                found[key] = min(q, found.get(key, q))
            at = max(at + 1, begin + int(np.searchsorted(starts[begin:end], last - q)))  # the others see the same
    return found


def find(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """All runs of the texts that have the words firsts[i]:firsts[i + 1]: rows (start, end, period), by start, period.

    ``words`` are numbers, equal for equal words; places count through all texts.
    """
    total, sizes = len(words), np.diff(firsts)
    found: dict[tuple[int, int], int] = {}
    if not total:
        return np.zeros((0, 3), np.int64)
    # how far away the same word comes again in the same text
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(words, kind="stable")
    again = np.full(total, total, np.int64)
    same = (words[order[1:]] == words[order[:-1]]) & (text_of[order[1:]] == text_of[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    block = BLOCK
    while True:
        long = np.flatnonzero(sizes >= max(SHORTEST, TIMES * (block if block > BLOCK else 1)))
        if not len(long):
            break
        counts = sizes[long] // block
        text = np.repeat(long, counts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = firsts[text] + nth * block
        bounds = np.stack([starts, starts + block], axis=1).ravel()  # of each second run, the maximum is not used
        furthest = np.maximum.reduceat(np.append(again, 0), bounds)[::2]
        wanted = furthest < 2 * block
        if found and wanted.any():
            reach = np.zeros(total, np.int64)
            for (first, last), _ in found.items():  # so far all have periods below this block's length
                reach[first] = max(reach[first], last)
            reach = np.maximum.accumulate(reach)
            wanted &= reach[starts] < np.minimum(starts + 3 * block, firsts[text + 1])
        starts, text = starts[wanted], text[wanted]
        row, distance = occurrences(labels(words, block), starts, block) if len(starts) else (starts, starts)
        inside = starts[row] + distance + block <= firsts[text[row] + 1]
        if block > BLOCK:
            inside &= distance >= block
        row, distance = row[inside], distance[inside]
        for key, q in _extend(words, firsts, text[row], starts[row], distance, block).items():
            found[key] = min(q, found.get(key, q))
        block *= 2
    runs = np.array([(a, b, q) for (a, b), q in found.items()], np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _work(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = Texts.of(batch.column(1))
    n = len(texts.bounds) - 1
    firsts = texts.words[2]
    words = word_numbers(texts)
    runs = find(words, firsts)
    text_of = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.subtract.at(edge, runs[:, 1], 1)
    stays = np.cumsum(edge[:-1]) == 0
    place = np.searchsorted(text_of, np.arange(n + 1)).astype(np.int32)
    structs = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - firsts[text_of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"]
    )
    columns = [
        batch.column(0),
        pa.array(np.diff(firsts), pa.int64()),
        pa.ListArray.from_arrays(pa.array(place), structs),
        joined(texts, stays),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def collapse(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, ``runs`` (start, length and period in words, by start and
    period), and ``collapsed``, the text's words without the repetitions: of each run the first period stays.

    ``docs`` needs ``doc_id`` and ``text``; other columns play no part. A null or empty text has no words, no runs and an
    empty collapsed text. Repeated rows give repeated rows, a null doc_id stays, an empty table gives none. A text
    is always looked at whole, in memory in proportion to its length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    return map_texts(docs, [docs["doc_id"], docs["text"]], _work, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, of equal ones the first; null if there is none."""
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, run: F.when(better(best, run), run).otherwise(best))


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, and for one id in ten with a periodic end: from word a on, every p-th word comes round again."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))

    def turn(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")).otherwise("")

    # the array is bound once, by a fold over the one-element array that holds it
    turned = F.element_at(F.transform(F.array(words), turn), 1)
    return F.when((h % 10 == 0) & text.isNotNull(), turned).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """Of the rows of ``collapse``: counts, the strongest run, and digests of all runs and of the collapsed text."""
    best = strongest(F.col("runs"))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
