"""The similarity join, the embedding links, components and the URL filter against plain Python, and on hard rows."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import embedding_links, jaccard_join, url_filter
from ebbtide.llm import components as component_module
from ebbtide.llm.components import components
from ebbtide.llm.queries import QUERIES
from ebbtide.llm.rows import ship_package
from ebbtide.session import materialize

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# ---- components ----


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.randrange(150), draw.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(1000, 1040)]
    pairs += [(5, 5), (2000, 3000), (2000, 3000)] + [(4000, 4000 + i) for i in range(60)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    assert got == {i: r for i, r in want.items() if any(i in p and p[0] != p[1] for p in pairs)}


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_components_by_rounds_and_in_one_go(spark, monkeypatch, few):
    monkeypatch.setattr(component_module, "FEW", few)
    pairs = [(i, i + 1) for i in range(0, 60, 2)] + [(i, 59 - i) for i in range(0, 20)] + [(100, 99), (99, 98), (-5, 7), (8, 8)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    assert got == {i: r for i, r in want.items() if any(i in p and p[0] != p[1] for p in pairs)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_take_few_jobs(spark, monkeypatch):
    written = []
    monkeypatch.setattr(component_module, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert components(chain).filter("component <> 0").count() == 0
    assert len(written) == 2


# ---- the join ----


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar(a, b):
    common = len(a & b)
    return bool(a and b) and 100 * common >= 80 * (len(a) + len(b) - common)


def family(draw, n, size):
    """Texts that differ from one another by a few words, so that some are similar and others just not."""
    base = [f"w{draw.randrange(10**6)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n):
        own = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            at = draw.randrange(len(own))
            if draw.random() < 0.5:
                own[at] = f"x{draw.randrange(10**6)}"
            elif draw.random() < 0.5 and len(own) > 6:
                own = own[: len(own) - draw.randrange(1, max(2, len(own) // 6))]
            else:
                own += [f"y{draw.randrange(10**6)}" for _ in range(draw.randrange(1, max(2, len(own) // 6)))]
        out.append(" ".join(own))
    return out


def check_join(docs, rows):
    sets = {d: shingles(t) for d, t in docs}
    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    near = {(a, b) for own in held.values() for a in own for b in own if a < b and similar(sets[a], sets[b])}
    want = roots(sets, near)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
    return near


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_share_a_signature(seed):
    draw = random.Random(seed)
    texts = [t for size in (5, 6, 8, 9, 12, 20, 40, 90, 250) for _ in range(12) for t in family(draw, 3, size)]
    keys, bounds = jaccard_join.shingle_sets(pa.array(texts))
    sets = [shingles(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    signed = defaultdict(set)
    for i, s in zip(*jaccard_join.signatures(keys, bounds)):
        signed[int(i)].add(int(s))
    found = 0
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] != sets[b] and similar(sets[a], sets[b]):
                found += 1
                assert signed[a] & signed[b]
    assert found > 50


def test_count_vectors_bound_the_differences():
    draw = np.random.default_rng(1)
    sets = []
    for n in (5, 600, 1000, 1100, 4200):
        base = draw.integers(0, 2**63, n).astype(np.uint64)
        for part in (0, 0.02, 0.2):
            k = int(n * part)
            sets.append(np.append(base[k:], draw.integers(0, 2**63, k).astype(np.uint64)))
    vectors = jaccard_join.count_vectors(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    for a, x in zip(sets, vectors):
        for b, y in zip(sets, vectors):
            for bins in (16, 64, 256, 1024):
                short, at = jaccard_join._level([x, y], bins)
                if (at >= 0).all():
                    assert np.abs(short[0] - short[1]).sum() <= len(np.setxor1d(a, b))


def test_join_of_families(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)  # so that a signature has several blocks
    draw = random.Random(9)
    texts = [t for n, size in ((40, 12), (40, 30), (40, 90), (30, 7)) for t in family(draw, n, size)]
    passage = " ".join(f"p{i}" for i in range(40))  # shared by texts that are not similar
    texts += [passage + " " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(45)) for _ in range(40)]
    texts += ["", None, "a b", "A b", "a\x0bB", " \n", "é", "one"] + [texts[0]] * 5 + [texts[50].upper()]
    docs = list(enumerate(texts))
    draw.shuffle(docs)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, cls int, n_shingles string")
    rows = jaccard_join.near_duplicates(df.repartition(5)).collect()
    assert len(rows) == len(docs)
    assert len(check_join(docs, rows)) > 200
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in rows})


def test_join_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op8_ngram_jaccard_join"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    assert check_join(docs, rows)


def test_join_of_hard_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, long), (2, long + " z"), (2, long + " z"), (None, long), (None, None), (3, None), (4, ""), (5, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(-1, 0, -1), (-1, 29996, 1), (1, 29996, 1), (2, 29997, 1), (2, 29997, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5)]
    assert sorted((r["doc_id"] or -1) for r in jaccard_join.keep_one(df).collect()) == [-1, -1, 1, 3, 4, 5]
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


# ---- embeddings ----


def check_links(vectors, rows):
    unit = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            unit[i] = x / np.linalg.norm(x)
    pairs = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    want = roots([i for i, _ in vectors], pairs)
    links = defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    found = 0
    for r in rows:
        i = r["vec_id"]
        assert r["n_links"] <= links[i] and r["kept"] == (i == r["component_id"])
        found += r["n_links"]
        if r["n_links"] == links[i]:
            assert r["component_id"] >= want[i]
    assert found >= 0.97 * sum(links.values())
    return found


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "BLOCK", 16)  # so that a bucket has several blocks
    draw = np.random.default_rng(5)
    centre = draw.normal(size=16)
    rows = [(i, [float(x) for x in draw.normal(size=16)]) for i in range(150)]
    rows += [(200 + i, [float(x) for x in centre + draw.normal(0, 0.2, 16)]) for i in range(120)]
    rows += [(400 + i, [float(x) for x in centre]) for i in range(40)]
    rows += [(500, [float(x) for x in 1e30 * centre]), (501, [float(x) for x in -centre]), (502, [1.0, 2.0]), (503, [2.0, 4.0])]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] * 16), (605, [float("inf")] * 16)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cls string")
    got = embedding_links.links(df.repartition(4)).collect()
    assert len(got) == len(rows)
    assert check_links([(r["vec_id"], r["embedding"]) for r in df.collect()], got) > 1000
    own = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert all(own[i] == (0, i, True) for i in range(600, 606))
    assert own[502] == (1, 502, True) and own[503] == (1, 502, False)
    again = spark.createDataFrame([(1, [1.0, 0.0])] * 3 + [(None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in embedding_links.links(again).collect()} == {(1, 3, 1, True), (None, 3, 1, False)}
    assert embedding_links.links(again.limit(0)).count() == 0


def test_more_vectors_take_more_bits_at_the_same_recall():
    for n in (1, 500, 10**5, 10**9):
        bits, tables = embedding_links.tables_for(n)
        met = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - met) ** tables >= embedding_links.RECALL
    assert embedding_links.tables_for(10**9)[0] > embedding_links.tables_for(10**5)[0]


# ---- URLs ----


def judged(url):
    """host, path and the longest rule that fits."""
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(LOWER)
    fits = [r for r in url_filter.rules() if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


URLS = [
    None, "", "x", "http://", "http:///fr/", "HTTP://A.ORG/es/", "http://example.org/es/1", "http://www.Example.ORG/es/",
    "http://notexample.org/es/", "http://example.org", "http://example.org?x=/es/", "http://org/", "http://a.com/fr",
    "http://a.com/fr/#/de/", "http://a.com/de/?://b.org/", "a://b://c.org/x", "http://example.org/en/12/x",
    "http://example.org/en/2", "http://é.com/fr/é", "http://a.com:80/fr/", "http://u@a.org\n/x\ny", "http://a.org/" + "x" * 30000,
]


def test_rules_for_urls(spark):
    df = spark.createDataFrame([(i, u, "h", "x", "x") for i, u in enumerate(URLS)] * 2, "page_id long, url string, html string, host string, part string")
    rows = url_filter.judge(df).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = judged(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("allow" if r["score"] >= 0 else "block"))
    assert url_filter.judge(df.limit(0)).count() == 0
    alone = url_filter.judge(df.filter("page_id < 3")).collect()
    assert {r["verdict"] for r in alone} == {"allow"}


def test_models_equal_plain_counting(spark):
    urls = [(i % 4, u) for i, u in enumerate(["http://a.org/es", "http://b.org/fr", "http://a.org/es", "x", "", "http://é.org"] * 3)]
    df = spark.createDataFrame(urls, "part int, url string")
    tables = url_filter.counts(df)
    for part in range(4):
        own = [u for p, u in urls if p == part]
        kinds = tables[part // 2, part % 2]
        n = sum(len(u.encode()) + 1 for u in own)
        assert kinds.sum(axis=2).tolist() == [[n] * url_filter.ORDERS] * 2
        assert kinds[0, 0].max() == n  # the empty context


def test_url_query_learns_from_the_rules(spark):
    rows = QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.1").toPandas()
    assert len(rows) == 2500
    learned = rows[rows["rule"].isna()]
    spanish, french = (learned[learned["path"].str.startswith(p)] for p in ("/es/", "/fr/"))
    assert (spanish["verdict"] == "block").mean() > 0.95
    assert (french["verdict"] == "allow").mean() > (spanish["verdict"] == "allow").mean() + 0.4
    ruled = rows[rows["rule"].notna()]
    right = np.where(ruled["score"] >= 0, "allow", "block") == ruled["verdict"]
    assert right.mean() > 0.95


# ---- sketches of the join ----


def test_what_short_sets_differ_in_shows_in_their_sketches():
    draw = np.random.default_rng(5)
    n, passed = 30, 0
    for _ in range(100):
        both = draw.integers(0, 2**63, 38).astype(np.uint64)  # 22 of 38 features in common: well below the threshold
        sets = [both[:n], both[38 - n :]]
        sketches = jaccard_join.Sketches(jaccard_join.odd_sketches(np.concatenate(sets), np.array([0, n, 2 * n])))
        passed += (jaccard_join.PERCENT + 100) * sketches.apart(np.array([0]), np.array([1]))[0] <= (100 - jaccard_join.PERCENT) * 2 * n
    assert passed == 0


def test_a_pair_meets_in_few_tasks(spark, monkeypatch):
    """However many signatures two classes share, a few tasks tell of them."""
    monkeypatch.setattr(jaccard_join, "SPREAD", 2)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        members = spark.createDataFrame([(s, c) for s in range(200) for c in (3, 7)], "signature long, cls long")
        sketches = spark.createDataFrame([(c, 4, bytes(64)) for c in (3, 7)], "cls long, n long, sketch binary")
        none = spark.createDataFrame([], "cls long, component long")
        for turn in (0, None):
            found = jaccard_join._blocks(members, sketches, none, turn).mapInArrow(
                jaccard_join._candidates(jaccard_join.PERCENT, best=False), "a long, b long, score long, goal long"
            )
            assert 1 <= found.count() <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_tasks_get_texts_a_few_at_a_time(spark):
    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    ship_package(spark)
    counts = [r["n"] for r in spark.range(0, 3500, 1, 1).mapInArrow(lengths, "n long").collect()]
    assert sum(counts) == 3500 and max(counts) <= 1000


def test_sketches_bound_the_differences():
    draw = np.random.default_rng(3)
    sets = []
    for n in (1, 2, 5, 21, 22, 300, 1400, 3000):
        base = draw.integers(0, 2**63, n).astype(np.uint64)
        for part in (0, 0.02, 0.1, 0.3):
            k = int(n * part)
            sets.append(np.append(base[k:], draw.integers(0, 2**63, k + k // 2).astype(np.uint64)))
    sketches = jaccard_join.Sketches(jaccard_join.odd_sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)])))
    close = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if max(len(a), len(b)) <= 1.25 * min(len(a), len(b)):
                (found,) = sketches.apart(np.array([i]), np.array([j]))
                assert found <= len(np.setxor1d(a, b))
                close += i != j and found > 0.8 * len(np.setxor1d(a, b)) > 0
    assert close > 20  # and closely


def test_one_document_of_each_text_and_component_stays(spark):
    copy = " ".join(f"w{i}" for i in range(80))
    rows = [(5, copy), (5, "one clean text under the same number"), (9, copy + " z"), (9, copy + " z"), (9, "and a third one that is there twice")]
    rows += [(9, "and a third one that is there twice"), (None, copy), (2, None), (2, ""), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs).collect()), key=str)
    want = [(5, copy), (5, rows[1][1]), (9, rows[4][1]), (None, copy), (2, None), (2, "")]
    assert got == sorted(want, key=str)
