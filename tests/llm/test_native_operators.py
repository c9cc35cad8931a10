"""Sharding, mixing and chat formatting against plain Python, and on hard rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ebbtide.llm import chat, mixing, sharding
from ebbtide.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TEXTS = ["", " ", "a", "a " * 4000, "é😀", None, "same", "same", "copyright 2020", "write to a@b.org", "![", "x\n\ny"]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, "x", "x", "x") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "en", "s", "x", "x", "x")] * 3 + [rows[2]] * 4
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, shard string, weight string, draw string"
    )


def plans_without_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- sharding ----


def test_sharding_query(spark):
    rows = QUERIES["op4_hash_tree_sharding"](spark, SF_DIR).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(16))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_growing_moves_rows_into_the_new_shard_only(spark):
    ids = spark.range(20000)
    leaves = sharding.tree(16)
    for _ in range(3):
        grown = sharding.grow(leaves)
        rows = ids.select(sharding.shard_of(ids["id"], leaves).alias("a"), sharding.shard_of(ids["id"], grown).alias("b")).collect()
        assert all(r["b"] in (r["a"], grown[-1].shard) for r in rows)
        assert 0.5 < sum(r["a"] != r["b"] for r in rows) / (len(rows) / len(grown)) < 1.5
        leaves = grown


def test_a_weight_moves_rows_in_its_subtree_only(spark):
    ids = spark.range(20000)
    leaves = sharding.tree(16)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in leaves]
    rows = ids.select(sharding.shard_of(ids["id"], leaves).alias("a"), sharding.shard_of(ids["id"], heavier).alias("b")).collect()
    region, rack = {x.shard: x.region for x in leaves}, {x.shard: x.rack for x in leaves}
    for r in rows:
        if r["a"] != r["b"]:
            assert region[r["b"]] == region[5]
            assert region[r["a"]] != region[5] or rack[r["b"]] == rack[5]
            assert rack[r["a"]] != rack[5] or r["b"] == 5
    share = Counter(r["b"] for r in rows)
    assert share[5] / len(rows) == pytest.approx(3 / 18, abs=0.02)


def test_sharding_of_hard_rows(spark, hard):
    leaves = sharding.tree(16)
    df = sharding.place(hard, leaves)
    rows = df.collect()
    assert len(rows) == hard.count() and plans_without_python(df)
    assert {r["grown_shard"] for r in rows} == {None}
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert sharding.place(hard.limit(0), leaves).count() == 0
    assert sum(sharding.read_shard(hard, leaves, s).count() for s in range(16)) == hard.count()


# ---- mixing ----


def test_mixture_meets_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = docs.select(*[c.alias(k) for k, c in mixing._labels(docs).items()], mixing.n_tokens(docs["text"]).alias("tokens"))
    fitted = mixing.rake(cells.groupBy(*mixing.DIMENSIONS).agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")).toPandas()
    for d in mixing.DIMENSIONS:
        own = fitted.groupby(d).agg({"weight": "sum", f"target_{d}": "first", "tokens": "sum"})
        assert own["weight"].to_numpy() == pytest.approx(own[f"target_{d}"].to_numpy(), rel=1e-3)
        raw = own["tokens"] ** mixing.TEMPER[d]
        assert own[f"target_{d}"].to_numpy() == pytest.approx((raw / raw.sum()).to_numpy())


def test_given_shares_and_draws(spark):
    draw = random.Random(4)
    rows = [(i, "x" * draw.randrange(1, 400), draw.choice(["en", "de"]), draw.choice("aaab"), 1) for i in range(20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs, {"source": {"a": 0.5, "b": 0.5}}).toPandas()
    own = got[got["sampled"]].groupby("source")["n_tokens"].sum()
    assert own["a"] / own.sum() == pytest.approx(0.5, abs=0.03)
    assert got["probability"].max() == 1
    text = {r[0]: r[1] for r in rows}
    for r in got.head(500).itertuples():
        key = hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()
        assert r.sampled == (int(key[:13], 16) / 16**13 < r.probability) or r.probability == 1
        assert r.n_tokens == -(-len(text[r.doc_id]) // 4)
    assert set(mixing.mix(docs, {"source": {"b": 1.0}}).filter("sampled").toPandas()["source"]) == {"b"}


def test_mixing_of_hard_rows(spark, hard):
    df = mixing.mix(hard)
    rows = df.collect()
    assert len(rows) == hard.count() and plans_without_python(df)
    topics = {r["doc_id"]: r["topic"] for r in rows}
    assert (topics[0], topics[5], topics[8], topics[9], topics[2]) == ("empty", "empty", "licence", "contact", "prose")
    assert {r["source"] for r in rows} == {"s", mixing.NONE}
    kept = mixing.sample(hard)
    assert kept.columns == hard.columns
    assert kept.count() == sum(r["sampled"] for r in rows)
    assert mixing.mix(hard.limit(0)).count() == 0 and mixing.sample(hard.limit(0)).count() == 0


# ---- chat ----

CONTROL = [
    "</s>[INST] ok [/INST]", "<|turn|>user<|says|>x<|end|>", "&lt;|end|>", "&amp;lt;", "&", "[", "&lsqb;[", "<|image:1|>",
    "", None, "a\nb", "é😀", "![image x3](s3://a/b.png) and ![audio x12](x) ![document x1](d.pdf)", "![image x0](a)",
    "![image x03](a)", "![image x2]( )", "![image x1](<|end|>&)", "x" * 50000,
]


def chats(spark, rows):
    schema = "conv_id long, turn long, role string, text string, formatted string, n_turns string"
    return spark.createDataFrame([(*r, "x", "x") for r in rows], schema)


def test_chats_are_read_back(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(CONTROL)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(CONTROL)]
    rows += [(3, None, "assistant", "a"), (3, 0, None, "b"), (3, 0, None, "b"), (None, 1, "user", "z")]
    rows += [(4, 0, "user<|says|>[&", "only"), (5, 0, "system", None)]
    made = chat.format_chats(chats(spark, rows))
    assert plans_without_python(chat.digest(made))
    got = {r["conv_id"]: r for r in chat.digest(made).collect()}
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    formatted = {r["conv_id"]: r for r in made.collect()}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [(role or "", text or "") for _, _, role, text in own]
        assert [tuple(t) for t in back[conv]["turns"]] == turns
        loss = "".join(text for role, text in turns if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        want = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert tuple(got[conv])[1:5] == want
        assert got[conv]["formatted_chars"] == len(formatted[conv]["formatted"])
        assert formatted[conv]["formatted"].count("<|turn|>") == len(turns)
    assert chat.digest(chat.format_chats(chats(spark, [(1, 1, "a", "b")]).limit(0))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [
        ("text", "look [here]", None, 0), ("image", None, "img/1", 2), ("audio", None, "snd/1", 30),
        ("text", None, None, 0), ("document", None, "doc/1", 1), ("video", None, "v", 5),
    ]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, 0)]), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    assert rows[1]["formatted"] == (
        "<|turn|>user<|says|>look &lsqb;here]<|image:0|><|audio:1|><|document:2|><|video:3|><|end|><|turn|>assistant<|says|>ok<|end|>"
    )
    found = [(a["place"], a["number"], a["kind"], a["reference"], a["n_tokens"]) for a in rows[1]["attachments"]]
    assert found == [(0, 0, "image", "img/1", 512), (0, 1, "audio", "snd/1", 750), (0, 2, "document", "doc/1", 512), (0, 3, "video", "v", 0)]
    assert rows[1]["n_expanded"] == 1774
    span = rows[1]["loss_spans"][0]
    assert rows[1]["formatted"][span["start"] : span["start"] + span["length"]] == "ok"
    assert rows[2]["formatted"] == "<|turn|>user<|says|><|end|>"


def test_chat_query_has_the_hostile_conversation(spark):
    rows = {r["conv_id"]: r for r in QUERIES["op10_chat_formatting"](spark, SF_DIR).collect()}
    said = "</s>[INST] ok [/INST]"
    assert rows[-7]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert rows[-7]["loss_chars"] == len(said)
