"""The Merkle manifest against a tree in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import merkle
from ebbtide.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node the (left, right) siblings of its way up."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                step = ([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k])
                for i in below[k]:
                    paths[i].append(step)
        nodes, below = [h(*(nodes[j] for j in run)) for run in runs], [[i for j in run for i in below[j]] for run in runs]
    return nodes[0] if nodes else None, paths


def audited(rows):
    """The query's rows, by the contract's words. ``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for name in names:
        told = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[name] = (told, *tree([leaf(*r) for r in told]))
    root, tops = tree([trees[name][1] for name in names])
    out = []
    for name, top in zip(names, tops):
        told, subroot, paths = trees[name]
        for row, path in zip(told, paths):
            path = path + top
            own = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                own = (*row[:4], row[4].translate(str.maketrans(UPPER, LOWER)))
            folded = leaf(*own)
            for left, right in path:
                folded = h(*left, folded, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((row[0], leaf(*row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def query(docs):
    found = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lowered(docs["text"])).otherwise(docs["text"])
    return sorted((tuple(r) for r in merkle.audit(docs, {"text": found}).drop("path").collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, idx int, grp string, path int, n int"


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 8, "de": 9, "": 65}, {"en": 513, None: 64, "é": 72}, {str(k): k % 3 + 1 for k in range(70)}])
def test_trees_of_any_size(spark, sizes):
    rows = [(1000 * k + i, "s", lang, i, f"Text {i} A") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA).repartition(3)
    assert query(docs) == audited(rows)


def test_hard_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "", 0, ""), (None, "s", "en", 1, "A"), (None, "s", "en", 1, "B"), (7, "s", "en", 5, "ÀB" * 300000)]
    rows += [(3, "s", "en", 1, "SAME")] * 12 + [(3, "s", "en", 1, "other")] * 3 + [(-5, "s", "en", 1, "A\x00b")]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA)
    assert query(docs) == audited(rows)
    assert merkle.audit(docs.limit(0)).count() == 0
    assert merkle.build(docs.limit(0).select("doc_id", "lang", "hash")).root.count() == 0


def test_query_equals_plain_python(spark):
    rows = [tuple(r[c] for c in merkle.FIELDS) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, SF_DIR).collect()), key=str)
    assert got == audited(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_only_some_levels_are_stored(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    manifest = merkle.build(docs)
    assert [nodes.count() for nodes in manifest.trees] == [600, 10, 1]
    assert manifest.root.first()[0] == tree([h(str(i)) for i in range(600)])[0]
