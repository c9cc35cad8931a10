"""The packing's ids against the unchanged tokenizer, on texts that hold its added tokens."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_text_operators import ODD  # noqa: E402

from ebbtide.llm import packing  # noqa: E402
from ebbtide.llm.queries import BYTE_BPE, QUERIES, tokenizer_path  # noqa: E402

TEXTS = [
    "x<|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b\n<|endoftext|>\n", "<|endoftext|", "é<|endoftext|>é",
    "<|<|endoftext|>|>", "it<|endoftext|>'s",
]


def test_ids_equal_the_unchanged_tokenizer():
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    encode = packing.byte_bpe(tokenizer_path(BYTE_BPE), added=True)
    for text in ODD + TEXTS:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_query_and_pipeline_keep_added_tokens(spark, folder):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    want = {}
    for i, text in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want[i] = (len(ids), zlib.crc32(ids.tobytes()))
    for packed in (QUERIES["op2_best_fit_packing"](spark, folder), corpus_pipeline.pack_sequences(spark, docs, folder)):
        assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packed.collect()} == want
