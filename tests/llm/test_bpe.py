import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from municare.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(**bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids, repr(text)
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_every_token_is_its_own_encoding(codec, library):
    for token in random.Random(1).sample(range(50256), 5000):
        same(codec, library, codec.bytes_of[token].decode("utf-8", "ignore"))


def test_random_texts(codec, library):
    rng = random.Random(2)
    alphabet = "aaaabbbe eeethinr \n\t'sS.,!0123é漢😀\x85\xa0 \x1c\x1f​　\r\x0b\x0c᠎﻿ "
    for _ in range(4000):
        same(codec, library, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))))
    for _ in range(500):
        same(codec, library, "".join(rng.choice("ab") for _ in range(rng.randint(1, 90))))
        same(codec, library, rng.choice("aehst0-= ") * rng.randint(1, 300))
    for _ in range(500):
        same(codec, library, "".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x10000, 0x1F9FF)])) for _ in range(20)))


def test_special_tokens_in_texts(codec, library):
    for text in ("a<|endoftext|>b <|endoftext|> c", "<|endoftext|><|endoftext|>", "<|endoftext", "|><|endoftext|> "):
        same(codec, library, text)


def test_invalid_ids_decode(codec, library):
    ids = [codec.encode("漢")[0], 220]
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_columns(odd, library):
    got = bpe.digests(odd, PATH, ["doc_id", "lang"]).collect()
    tokens = bpe.decode(bpe.encode(odd, PATH, ["doc_id"]), PATH).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    assert len(got) == len(texts) == len(tokens)
    for r, t, text in zip(got, tokens, texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert t["token_ids"] == ids and t["text"] == text
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(odd.limit(0), PATH, ["doc_id"]).count() == 0
