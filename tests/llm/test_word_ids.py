"""Words of the vocabulary: which way their ids are found, and that each way finds the tokenizer's."""

from __future__ import annotations

import pyarrow as pa

from bellwire.llm import packing
from bellwire.llm.queries import word_bpe


def test_words_of_letters_go_straight_to_the_merge_table():
    """New words of ASCII letters are most of a text's; no pattern runs over them, nor are they hashed."""
    from tokenizers import Tokenizer

    words = packing.WordIds(word_bpe())
    seen = []

    class Plain:
        match = staticmethod(lambda text, plain=words.plain: seen.append(text) or plain.match(text))

    words.plain = Plain
    texts = [
        "Onlyorin WITHERINEDHA threines onlyorin",
        "\u00f3mentell don't threines, threines. 4th &&& a\u00d7b",
        None,
        "",
        "\u0130stanbul \u03a3\u0391\u03a3 \u4e2d\u6587 e\u0301 <|endoftext|>x x<|STARTOFTEXT|>",
        "\t threines\u00a0threines\0 " + "ab" * 700,
    ]
    ids, at = words.encode(pa.array(texts))
    tokenizer = Tokenizer.from_file(word_bpe())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert not any(t.isascii() and t.isalpha() for t in seen) and "don't" in seen
    for t, row in zip(texts, want):
        assert words.encode(pa.array([t], pa.string()))[0].tolist() == row
    assert words.encode(pa.array([], pa.string()))[0].tolist() == []
