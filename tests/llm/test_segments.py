"""The segment encoder against the tokenizer library, on texts made to hit its cuts and folds."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from hourmart.llm.segments import SegmentEncoder  # noqa: E402

PIECES = [*"abcJHTWYIKxyz ABC  \n\n.,;'|<>!%&_-09\r\t", "'s", "'LL", "ß", "É", "é", "ñ", "×",
          "÷", "İ", "ı", "̌", "̇", "̱", "̸", "<|endoftext|>", "<|ENDOFTEXT|>",
          "<|startoftext|>", "ſ", "ǅ", "ƻ", "中", " ", " ", "\U0001f600", "ª",
          "µ", "Ÿ", "Ω", "K", "ﬁ", "ʰ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("special", [True, False])
def test_ids_equal_the_library(name, special):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts = texts if special else [t.replace("<|", "") for t in texts]
    want = [e.ids for e in Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)]
    encoder = SegmentEncoder(public_tokenizers.path(name))
    got = [flat[a:b].tolist() for _, flat, ends in encoder.ids(pa.array(texts)) for a, b in zip(ends[:-1], ends[1:])]
    assert got == want
    assert encoder.counts(pa.array(texts + [None])).tolist() == [len(w) for w in want] + [0]
