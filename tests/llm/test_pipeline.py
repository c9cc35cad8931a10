"""The pipeline's stages, each held against its predecessor's output by plain Python."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_links import check_join  # noqa: E402
from test_text_operators import base_counts, check_packing, coverage  # noqa: E402

from ebbtide.llm import jaccard_join, mixing, quality_model, quality_rules  # noqa: E402
from ebbtide.llm.words import Texts  # noqa: E402
from ebbtide.session import materialize  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_DIR), "stage"))
    return out


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "near_duplicates", "source_mixing", "packing",
    ]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
        own, given = rows_of(df), rows_of(stages[0])
        assert all(given[i] == r for i, r in own.items())


def test_classifier_stage(spark, stages):
    docs = rows_of(stages[0])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    x = {i: quality_model.features(Texts.of(pa.array([r["text"]])))[0] for i, r in docs.items()}
    moments = np.zeros((2, len(quality_model.FEATURES) + 1, len(quality_model.FEATURES) + 1))
    for i, label in labels.items():
        if i in x and zlib.crc32(str(i).encode()) % 3 != 1:
            row = np.append(1, x[i])
            moments[label] += np.outer(row, row)
    model = quality_model.solve(moments)
    assert set(rows_of(stages[1])) == {i for i, f in x.items() if model.scores(f[None])[0] >= 0.5}


def test_rules_stage(stages):
    limits = quality_rules.LIMITS
    want = set()
    for i, r in rows_of(stages[1]).items():
        lines: dict[str, int] = {}
        for line in r["text"].split("\n"):
            lines[line] = lines.get(line, 0) + 1
        letters = {k: sum(len(w) for w in k.split()) for k in lines}
        whole = max(1, sum(letters[k] * n for k, n in lines.items()))
        again = sum(letters[k] * (n - 1) for k, n in lines.items()) / whole
        covered = all(coverage(r["text"], size) <= most for size, most in limits.coverage.items())
        if not base_counts(r["text"])[5] and covered and again <= limits.line_characters:
            want.add(i)
    assert set(rows_of(stages[2])) == want


def test_near_duplicate_stage(stages):
    docs = [(i, r["text"]) for i, r in rows_of(stages[2]).items()]
    linked = jaccard_join.near_duplicates(stages[2]).collect()
    check_join(docs, linked)
    assert set(rows_of(stages[3])) == {r["component_id"] for r in linked}


def test_mixing_stage(stages):
    drawn = rows_of(mixing.mix(stages[3]))
    assert set(rows_of(stages[4])) == {i for i, r in drawn.items() if r["sampled"]}
    assert len(rows_of(stages[4])) > 0.2 * len(drawn)


def test_packing_stage(stages):
    check_packing(stages[4].collect(), stages[5].collect(), 1024)


def test_run_equals_the_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(tuple(r[k] for k in key) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == sorted(tuple(r[k] for k in key) for r in stages[5].collect())


def test_empty_documents_go_through(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), "stage")
    assert docs.count() == 0
