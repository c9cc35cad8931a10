"""Recurring passages against a count of every window."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from ebbtide.llm import phrase_automata
from ebbtide.llm.queries import QUERIES
from ebbtide.llm.words import Texts

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=35):
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


def corpus(seed, n=60, vocabulary=30):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(vocabulary)}"
    shared = [[word() for _ in range(draw.choice([34, 35, 36, 60, 200]))] for _ in range(6)]
    docs = []
    for i in range(n):
        words = [word() for _ in range(draw.randrange(0, 120))]
        for _ in range(draw.randrange(3)):
            part = list(draw.choice(shared))
            if draw.random() < 0.3:
                part[draw.randrange(len(part))] = "odd"
            if draw.random() < 0.3:
                part = part[draw.randrange(20) :]
            at = draw.randrange(len(words) + 1)
            words[at:at] = part
        if draw.random() < 0.2:
            words += ["round", "and", "about"] * draw.randrange(5, 30)
        docs.append((i, draw.choice([" ", "\n", " \t "]).join(words)))
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_removal_equals_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(phrase_automata.remove_repeats(df)) == brute(docs)


def test_heavy_anchors_lose_nothing(spark, monkeypatch):
    """Very small limits, so that most anchors are heavy and their windows go singly."""
    docs = corpus(7, n=150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = []
    usual = phrase_automata.heavy_anchors
    monkeypatch.setattr(phrase_automata, "LIGHT", 3)
    monkeypatch.setattr(phrase_automata, "UNTOLD", 0)
    monkeypatch.setattr(phrase_automata, "HEAVY", 300)
    monkeypatch.setattr(phrase_automata, "heavy_anchors", lambda *a: found.append(usual(*a)) or found[-1])
    assert rows_of(phrase_automata.remove_repeats(df)) == brute(docs)
    assert len(found[0]) > 5 and (np.diff(found[0].astype(object)) > 0).all()


def test_pieces_hold_every_window_once():
    docs = corpus(3)
    texts = Texts.of(pa.array([t for _, t in docs]))
    first, last, _ = phrase_automata.anchored(texts)
    starts = [i for a, b in zip(first, last) for i in range(a, b + 1)]
    counts = np.diff(texts.words[2])
    assert starts == [f + i for f, n in zip(texts.words[2], counts) for i in range(n - 34)]


def test_equal_windows_have_equal_anchors():
    texts = Texts.of(pa.array([t for _, t in corpus(5)]))
    first, last, key = phrase_automata.anchored(texts)
    begin, end, _ = texts.words
    raw = texts.bytes.tobytes()
    seen = {}
    for a, b, k in zip(first, last, key):
        for i in range(a, b + 1):
            window = tuple(raw[begin[j] : end[j]] for j in range(i, i + 35))
            assert seen.setdefault(window, k) == k


def test_hard_rows(spark):
    long = " ".join(f"x{i}" for i in range(90))
    short = " ".join(f"y{i}" for i in range(34))
    texts = ["", None, " \n", "a", long, "lead " + long, short, short, "é\x85 " * 50, "z " * 34, "q " * 35, "q " * 36, "v" * 300000]
    texts += [" ".join(f"n{i % 9000}" for i in range(20000)), short + " end"]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, "only " + long[:40], "x", 1, 2), (500, "once " * 2 + short, None, 0, 0)]
    rows += [(600, " ".join(f"t{i}" for i in range(40)), "x", 1, 2)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, k1 int, n_words int")
    assert rows_of(phrase_automata.remove_repeats(docs)) == brute([r[:2] for r in rows])
    assert phrase_automata.remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_substring_dedup"](spark, SF_DIR).collect()), key=str)
    want = brute(docs)
    assert got == sorted([(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in want], key=str)
    assert sum(r[2] > 0 for r in got) > 10


def test_pieces_are_packed_tightly_and_read_back():
    draw = np.random.default_rng(8)
    vocabulary = np.array(["".join(draw.choice(list("abcdefghijklm"), draw.integers(2, 9))) for _ in range(2000)])
    texts = [" ".join(vocabulary[np.minimum(draw.zipf(1.3, 300) - 1, 1999)]) for _ in range(300)]
    k = np.arange(len(texts))
    batch = pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(k, pa.int32()), pa.array(texts)], ["k1", "k2", "text"])
    sent = [e for out in phrase_automata._send(np.zeros(0, np.uint64), 35, 4)(iter([batch])) for e in out.column(1).to_pylist()]
    plain = [zstandard.ZstdDecompressor().decompress(e) for e in sent]
    assert sum(map(len, sent)) < 0.97 * sum(len(zstandard.ZstdCompressor(level=1).compress(x)) for x in plain)
    pieces, known = [phrase_automata._unpack(e) for e in sent], {" ".join(t.split()) for t in texts}
    for head, body in pieces:
        ends = np.cumsum(head["length"].astype(int))
        for a, b in zip([0, *ends[:2]], ends[:3]):
            assert any(body[a:b].decode().strip() in t for t in known)
