"""Texts that a fast path may not hold, parts without a kind, and mixtures with a stray row."""

from __future__ import annotations

import itertools
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from ebbtide.llm import chat, mixing, packing  # noqa: E402
from ebbtide.llm.queries import BYTE_BPE, tokenizer_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("added", [False, True])
def test_long_runs_of_separators_have_the_tokenizers_ids(added):
    encode, tokenizer = packing.byte_bpe(tokenizer_path(BYTE_BPE), added), Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    tokenizer.encode_special_tokens = not added
    for sign in " \t\n":
        for n in (10_000, 1_000_000, 2_000_000):
            text = f"a<|endoftext|>b{sign * n}x"
            assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert encode(" " * 1_200_000) == tokenizer.encode(" " * 1_200_000, add_special_tokens=False).ids


def test_a_long_run_does_not_stop_the_packing(spark):
    docs = spark.createDataFrame([(1, "a" + "\n" * 1_200_000 + "x"), (2, "b")], "doc_id long, text string")
    rows = packing.pack(docs, tokenizer_path(BYTE_BPE)).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    n = len(tokenizer.encode("a" + "\n" * 1_200_000 + "x", add_special_tokens=False).ids) + 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == n and {r["doc_id"] for r in rows} == {1, 2}


def test_a_stray_row_changes_nobody_elses_share(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    stray = spark.createDataFrame([(-1, "word " * 32, None, None)], docs.schema)

    def chances(df):
        return {(r["source"], r["lang"], r["topic"]): r["probability"] for r in mixing.probabilities(df).collect()}

    own, other = chances(docs), chances(docs.union(stray))
    assert set(other) - set(own) == {(mixing.NONE, mixing.NONE, "prose")}
    assert all(other[k] == pytest.approx(p, rel=0.01) for k, p in own.items())
    larger = chances(docs.union(docs.filter("source IS NOT NULL")))
    assert all(larger[k] == pytest.approx(p, rel=0.01) for k, p in own.items())
    kept = mixing.mix(docs).agg(F.sum(F.col("n_tokens") * F.col("probability")) / F.sum("n_tokens")).first()[0]
    assert kept > 0.7


def test_fitting_goes_on_until_the_marginals_hold(spark):
    rows = [(a, b, c, 7 + 31 * i % 400 + 1000 * (i % 3)) for i, (a, b, c) in enumerate(itertools.product("ab", "xy", "pq"))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    shares = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"p": 0.8, "q": 0.2}}
    fitted = mixing.rake(cells, shares).toPandas()
    for d, wanted in shares.items():
        for value, share in wanted.items():
            assert fitted.loc[fitted[d] == value, "weight"].sum() == pytest.approx(share, abs=1e-10)
    with pytest.warns(UserWarning, match="still off by"):
        mixing.rake(cells.filter("lang = 'x'"), {**shares, "lang": {"x": 0.9}}, rounds=3)


def test_parts_without_kind_units_or_short_references(spark):
    long = "data:image/png;base64," + "A" * 50_000
    parts = [(None, "lost [text]", None, None), ("image", None, "r", None), ("video: <x|>", None, None, 9), ("text", None, None, 3), ("audio", None, "s", 10**18)]
    turns = spark.createDataFrame([(1, 0, "assistant", [*parts, ("audio", None, "t", 10**18)]), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    assert "lost &lsqb;text]" in rows[1]["formatted"] and rows[1]["n_expanded"] == 2**63 - 1 and rows[2]["n_expanded"] == 0
    assert [(a["kind"], a["units"], a["n_tokens"]) for a in rows[1]["attachments"]][:2] == [("image", 0, 0), ("video: <x|>", 9, 0)]
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert back[1]["turns"][0]["text"] == f"lost [text]![image x0](r)![video: <x|> x9]()![audio x{10**18}](s)![audio x{10**18}](t)" == back[1]["loss_text"]
    inline = f"see ![image x2]({long}) and ![audio x1234567](u)![audio x{10**18}](too many)"
    turns = spark.createDataFrame([(1, 0, "assistant", inline)], "conv_id long, turn long, role string, text string")
    made = chat.format_chats(turns)
    (row,) = made.collect()
    assert [(a["reference"], a["units"], a["n_tokens"]) for a in row["attachments"]] == [(long, 2, 512), ("u", 1234567, 25 * 1234567)]
    assert chat.read_back(made).first()["loss_text"] == inline
