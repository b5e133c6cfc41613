"""The encoder of op7 learns parts by the tokenizer's model alone, with the tokenizer's ids."""

import random

import numpy as np
from kinmesh.llm import packing


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.own, self.texts = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.own, name)

    def encode(self, text, **options):
        self.texts.append(text)
        return self.own.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.own.encode_batch_fast(texts, **options)


def test_latin_parts_need_the_model_alone(monkeypatch):
    counting = Counting(packing._tokenizer(packing.default_tokenizer()))
    monkeypatch.setattr(packing, "_tokenizer", lambda path: counting)
    encode = packing.Encoder(packing.default_tokenizer())
    for text in ("It's 42 words, isn't it?", "Où naît l'été ... Œuvre ǅ", "a\x00b\x1cc\x7f\x85d\xa0e\xad"):
        assert encode(text) == np.array(counting.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert not counting.texts
    encode("дом")
    assert counting.texts == ["дом"]


def test_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "KEEP", 50)  # so that generations change all the time
    encode, rng = packing.Encoder(packing.default_tokenizer()), random.Random(7)
    for letters in ([*map(chr, range(0x80))], [*map(chr, range(0x250))], "abz'sdmrevlt019\x1c\x1f\x85\xa0\t\n.,!ΣσςİıÅé <|>"):
        for _ in range(1500):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 80)))
            assert encode(text) == np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), ascii(text)
            assert len(encode.held) <= 50 and len(encode.held.old) <= 50
