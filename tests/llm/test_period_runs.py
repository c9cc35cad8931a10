"""Periodic runs against a search over all starts and periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ebbtide.llm import period_runs
from ebbtide.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """{(start, length): period}, by every period and every maximal stretch of it."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                if i > start and i - start + q >= max(24, 3 * q):
                    found.setdefault((start, i - start + q), q)
                start = i + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    n = len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    told = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def check(rows, docs):
    want = sorted([(str(i), *digest(WORD.findall(t or ""))) for i, t in docs], key=str)
    got = sorted([(str(r[0]), *r[1:]) for r in rows], key=str)
    assert got == want


def test_transform_multiplies():
    draw = np.random.default_rng(1)
    x, y = draw.integers(0, period_runs.PRIME, (3, 16)).astype(np.uint64), draw.integers(0, period_runs.PRIME, (3, 16)).astype(np.uint64)
    got = period_runs.restore(period_runs.transform(x) * period_runs.transform(y) % np.uint64(period_runs.PRIME))
    for row in range(3):
        want = [0] * 16
        for i in range(16):
            for j in range(16):
                want[(i + j) % 16] = (want[(i + j) % 16] + int(x[row, i]) * int(y[row, j])) % period_runs.PRIME
        assert got[row].tolist() == want


@pytest.mark.parametrize("block", [8, 16, 64])
def test_occurrences_are_those_of_the_labels(block):
    draw = np.random.default_rng(block)
    words = draw.integers(0, 2, 40 * block)
    words[5 * block : 12 * block] = np.resize(words[5 * block : 6 * block + 3], 7 * block)
    label, starts = period_runs.labels(words, block), np.arange(0, 30 * block, block)
    row, distance = period_runs.occurrences(label, starts, block)
    want = {
        (k, d) for k, s in enumerate(starts) for d in range(1, 2 * block)
        if (label[s : s + block] == label[s + d : s + d + block]).all()
    }
    assert set(zip(row.tolist(), distance.tolist())) == want
    assert len(want) > 0


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(6):
        words = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randrange(0, 150))]
        for _ in range(draw.randrange(4)):  # runs of whole and broken periods, some within others
            q, times = draw.randrange(1, 40), draw.uniform(2.5, 6)
            own = [draw.randrange(draw.choice([2, 30])) for _ in range(q)]
            part = [own[i % q] for i in range(int(q * times))]
            if draw.random() < 0.3:
                part[draw.randrange(len(part))] = 99
            at = draw.randrange(len(words) + 1)
            words[at:at] = part * draw.choice([1, 1, 3])
        texts.append(words)
    firsts = np.append(0, np.cumsum([len(t) for t in texts]))
    found = period_runs.find(np.array([w for t in texts for w in t], np.int64), firsts)
    want = [(firsts[i] + a, firsts[i] + a + n, q) for i, t in enumerate(texts) for a, n, q in brute(t)]
    assert [tuple(r) for r in found.tolist()] == sorted(want)


def test_collapse_of_hard_rows(spark):
    chorus = "one two three\n" * 20
    long = " ".join(f"w{i % 700}" for i in range(3000)) + " \t\x0b end"
    texts = ["", " \n\t ", None, chorus, "x", "a " * 23, "a " * 24, "é\x85b " * 30, long, "y" * 200000, "t " + chorus + "u " + chorus]
    rows = [(i, t, "p", 7) for i, t in enumerate(texts)] + [(None, chorus, "p", 7), (3, chorus, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int")
    check(period_runs.digest(period_runs.collapse(docs)).collect(), [(r[0], r[1]) for r in rows])
    got = {r["doc_id"]: r for r in period_runs.collapse(docs.filter("doc_id < 9")).collect()}
    assert got[3]["collapsed"] == "one two three" and got[3]["runs"][0].period == 3
    assert got[8]["runs"][0].asDict() == {"start": 0, "length": 3000, "period": 700}
    assert period_runs.collapse(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()
    check(rows, [(i, " ".join(planted(i, WORD.findall(t or "")))) for i, t in docs])
    assert sum(r["n_runs"] > 0 for r in rows) > 10
