"""Token ids of the packing operator against the tokenizer itself."""

import random
import struct
import sys
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimtree.llm import packing


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path(packing.VOCABULARY)
    return packing.WordIds(path), Tokenizer.from_file(path)


def differing(both, texts):
    words, plain = both
    wanted = plain.encode_batch(texts, add_special_tokens=False)
    found = (struct.unpack(f"<{len(d) // 4}I", d) for d in map(words.encode, texts))
    return [t for t, ids, want in zip(texts, found, wanted, strict=True) if list(ids) != want.ids]


def test_named_texts(both):
    texts = ["BELEDİYESİ, 2020", "ףּ.", "ﬁn, ﬁ.", "é, é.", "don't. it's, 're", "ǅ, ǆ.", "ſ. ß, ẞ.", "Σας, ΣΑΣ.", "<|endoftext|>.", "<|EndOfText|>,", "ª. º, ²."]
    assert differing(both, texts) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_signs(both, seed):
    rng = random.Random(seed)
    signs = list("aAzé İıßΣςŉ'’.,!-_ 12²\n\t") + ["́", "̇", "ףּ", "<|", "|>", "'s", "東", "ﬁ", "ª", "ǰ", "가", "각"]
    assert differing(both, ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(60_000)]) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_all_signs(both, seed):
    rng = random.Random(seed)
    known = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    low = [c for c in known if c < "\u0600"]
    pick = lambda: rng.choice(known if rng.random() < 0.5 else low)
    texts = ["".join(rng.choice((pick(), pick(), " ", ".", "a")) for _ in range(rng.randint(1, 10))) for _ in range(60_000)]
    assert differing(both, texts) == []
