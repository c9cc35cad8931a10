"""Token counts, packing, quality rules and the quality classifier against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from ebbtide.llm import packing, quality_model, quality_rules, token_counts
from ebbtide.llm.queries import BYTE_BPE, QUERIES, UNIGRAM, tokenizer_path
from ebbtide.llm.words import Texts

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n x", "it's  ok", "'s 's", "é  è 12 3a", "\ta \tb", "a\x1c b",
    "a　b", "a\x85b", "x<|endoftext|> y", "<s>", "日本語 テキスト😀", "²½ ⅷ٣", "﻿x", "\x00 \x01 b",
    "a\na\n\na\n", " a b a b a b ", "é é\né é", "# * &&", "x" * 5000, "the cat " * 3000,
]
CLASHING = ["length", "piece", "sequence_id", "score", "kept", "features", "_part", "label"]


def texts_of(sample):
    import duckdb

    return [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{sample}/documents.parquet'").fetchall()]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, repeated rows and columns with names that the operators use."""
    rows = [(i, t, "en", "s", i) for i, t in enumerate(ODD)] + [(900, None, None, None, None), (None, "a b", None, "s", 1)]
    rows += [(3, ODD[3], "en", "s", 3)] * 2
    extra = tuple("x" for _ in CLASHING)
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *extra) for r in rows], schema)


# ---- token counts ----


def unigram(pieces, by_bytes):
    model = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=by_bytes))
    model.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return model


def test_counts_equal_the_models():
    pieces = token_counts.vocabulary(tokenizer_path(UNIGRAM))
    model, counter = unigram(pieces, True), token_counts.Counter(pieces)
    for text in ODD + texts_of(SF_DIR)[:80]:
        assert counter.count(text)[0] == len(model.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(10))
def test_counts_break_ties_as_the_model(seed):
    draw = random.Random(seed)
    words = sorted({"".join(draw.choice("abcd▁") for _ in range(draw.randrange(1, 5))) for _ in range(25)})
    pieces = [("<unk>", 0.0)] + [(w, draw.choice([-1.0, -2.0, -3.0, -1.5])) for w in words]
    model, counter = unigram(pieces, False), token_counts.Counter(pieces)
    for _ in range(100):
        text = "".join(draw.choice("abcd eé") for _ in range(draw.randrange(1, 25)))
        assert counter.count(text)[0] == len(model.encode(text, add_special_tokens=False).ids)


def test_counts_of_hard_rows(spark, hard):
    got = token_counts.count_tokens(hard, tokenizer_path(UNIGRAM)).collect()
    assert len(got) == hard.count()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (0, 900)} == {0}
    assert token_counts.count_tokens(hard.limit(0), tokenizer_path(UNIGRAM)).count() == 0


# ---- packing ----


def test_ids_equal_the_tokenizers():
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    tokenizer.encode_special_tokens = True
    encode = packing.byte_bpe(public_tokenizers.path(BYTE_BPE))
    for text in ODD + texts_of(SF_DIR):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(12))
def test_plan_holds_every_piece_and_is_near_the_bound(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 2, 7, 64, 128])
    counts = {n: draw.randrange(1, 400) for n in range(1, capacity + 1) if draw.random() < 0.7} or {1: 1}
    runs = packing.plan(counts, capacity, groups=draw.choice([1, 4, 32]))
    got: Counter = Counter()
    for times, held in runs:
        assert sum(n * t for n, t in held) <= capacity
        for n, t in held:
            got[n] += times * t
    assert got == Counter(counts)
    used = sum(times for times, _ in runs)
    assert used <= 2 * -(-sum(n * c for n, c in counts.items()) // capacity)


def check_packing(docs, rows, capacity):
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    tokenizer.encode_special_tokens = True
    want: Counter = Counter()
    for r in docs:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        start, length = 0, (len(ids) - 1) % capacity + 1
        piece = 0
        while start < len(ids):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            want[(r["doc_id"], piece, start, length, crc)] += 1
            start, length, piece = start + length, capacity, piece + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing_of_hard_rows(spark, hard, capacity):
    rows = packing.pack(hard, tokenizer_path(BYTE_BPE), capacity).collect()
    check_packing(hard.collect(), rows, capacity)
    assert packing.pack(hard.limit(0), tokenizer_path(BYTE_BPE), capacity).count() == 0


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = QUERIES["op2_best_fit_packing"](spark, SF_DIR).collect()
    used = check_packing(docs, rows, 1024)
    assert used <= 1.03 * sum(r["length"] for r in rows) / 1024 + 1


def test_sequences_hold_the_ids(spark, hard):
    packed = packing.pack(hard, tokenizer_path(BYTE_BPE), 64, keep_ids=True)
    rows = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        own = bytes(rows[r["sequence_id"]]["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert own == bytes(r["ids"])


# ---- quality rules ----


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered, lines, again = Counter(grams), set(), set(), 0
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, again, len(covered), n < 50 or 100 * len(covered) > 50 * n


def coverage(text, size):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    seen, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered |= set(range(i, i + size))
    return sum(len(words[i]) for i in covered) / max(1, sum(map(len, words)))


def test_rules_equal_brute_force(spark, hard):
    sample = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    for docs in (hard, sample):
        rows = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
        for doc in docs.collect():
            got, text = rows[doc["doc_id"]], doc["text"]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
            assert tuple(got[k] for k in names) == base_counts(text)
            for size in quality_rules.LIMITS.coverage:
                assert got[f"share_{size}_grams"] == pytest.approx(coverage(text, size))


def test_rules_drop_repetition_and_keep_the_rest(spark):
    plain = " ".join(f"w{i}" for i in range(120))
    again = " ".join(["one two three four five six seven"] * 5) + " " + " ".join(f"v{i}" for i in range(40))
    lines = "\n".join([" ".join(f"u{i}" for i in range(30))] * 2 + [" ".join(f"t{i}" for i in range(20))])
    docs = spark.createDataFrame([(1, plain, "x"), (2, again, "x"), (3, lines, "x")], "doc_id long, text string, kept string")
    assert [(r["doc_id"], r["kept"]) for r in quality_rules.filter_docs(docs).collect()] == [(1, "x")]
    assert quality_rules.filter_docs(docs.limit(0)).count() == 0


# ---- quality classifier ----


def test_discriminant_equals_the_formula():
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(0, 1, (80, 4)), draw.normal(1, 2, (50, 4))])
    y = np.repeat([0, 1], [80, 50])
    moments = np.stack([(lambda a: a.T @ a)(np.c_[np.ones((y == k).sum()), x[y == k]]) for k in (0, 1)])
    model = quality_model.solve(moments, to_pooled=0.25, to_sphere=0.05)
    own = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = (80 * own[0] + 50 * own[1]) / 130
    want = []
    for k, n in ((0, 80), (1, 50)):
        shrunk = 0.7 * own[k] + 0.25 * pooled + 0.05 * np.diag(np.diag(pooled)) + 1e-7 * np.eye(4)
        far = x - x[y == k].mean(axis=0)
        density = -0.5 * np.einsum("ni,ij,nj->n", far, np.linalg.inv(shrunk), far) - 0.5 * np.linalg.slogdet(shrunk)[1]
        want.append(density + np.log(n / 130))
    assert model.log_odds(x) == pytest.approx(want[1] - want[0])


def test_features_of_odd_texts_are_finite():
    for texts in (ODD, [None, ""], [], ["\n"]):
        found = quality_model.features(Texts.of(pa.array(texts, pa.string())))
        assert found.shape == (len(texts), len(quality_model.FEATURES)) and np.isfinite(found).all()


def test_classifier_on_held_out_rows(spark):
    sample = "/root/testdata/sf0.01"
    rows = QUERIES["op6_quality_classifier"](spark, sample).toPandas()
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]
    assert rows["held_out"].tolist() == held
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.5) == (rows["predicted"] == 1)).all()
    labels = spark.read.parquet(f"{sample}/labels.parquet").toPandas()
    both = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.97
    kept = both[both["quality"] == 1]["predicted"].mean()
    assert kept > 0.97


def test_classifier_on_hard_rows(spark, hard):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1), (None, 0), (5, None), (6, 7)], "doc_id long, quality int")
    one_kind = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    for labels in (none, some, one_kind):
        rows = quality_model.score(hard, labels).collect()
        assert len(rows) == hard.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality_model.score(hard, none).collect()} == {0.5}
    assert quality_model.score(hard.limit(0), some).count() == 0
    assert quality_model.filter_docs(hard, some).columns == hard.columns
