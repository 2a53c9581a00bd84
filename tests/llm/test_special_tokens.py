"""Packing of texts that hold a special token's text, against the tokenizer as it is loaded."""

from __future__ import annotations

import zlib

import numpy as np

from bellwire.llm import packing
from bellwire.llm.queries import word_bpe


def test_special_token_texts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_bpe())
    texts = [
        "a <|endoftext|> b",
        "x<|endoftext|>y <|startoftext|>",
        "<|ENDOFTEXT|> <|endoftext|",
        "é<|endoftext|>B don't\n<|endoftext|><|endoftext|>",
        "plain words",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in packing.pack(df, word_bpe()).collect():
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part), texts[r["doc_id"]]
