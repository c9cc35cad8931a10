"""The similarity join's links, all of them, against plain Python."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_links import family, shingles, similar  # noqa: E402

from ebbtide.llm import jaccard_join  # noqa: E402


@pytest.mark.parametrize("tile", [5, 128])
def test_every_link_is_counted(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)  # 5: components have several tiles
    monkeypatch.setattr(jaccard_join, "WIDE", 64)
    draw = random.Random(3)
    texts = [t for size in (12, 60) for t in family(draw, 30, size)]
    base = [f"c{i}" for i in range(300)]
    texts += [" ".join([*base[:i], f"z{i}", *base[i + 1 :]]) for i in range(40)]  # 40 texts, all similar to one another
    texts += [texts[0]] * 4 + [texts[-1]] * 3 + [None, "", "a b", "A b"]
    docs = list(enumerate(texts))
    rows = jaccard_join.counted_links(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    sets = [shingles(t) for t in texts]
    want = Counter({i: 0 for i, _ in docs})
    for a in range(len(sets)):
        for b in range(a):
            if similar(sets[a], sets[b]):
                want[a] += 1
                want[b] += 1
    assert {r["doc_id"]: r["n_links"] for r in rows} == dict(want) and len(rows) == len(docs)
    assert sum(want.values()) > 40 * 39
