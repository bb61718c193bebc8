import hashlib
import random

import public_tokenizers
import pytest
from corpus_rows import ODD
from tokenizers import Tokenizer

from paywarden.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(file.read())


def test_ids_are_those_of_the_library(library, codec):
    signs = "ab  \n\t é 　x'stre1²٣_-.\x1c\x85\U0001F600日́<|endoftext|>"
    pick = random.Random(7)
    for _ in range(3000):
        text = "".join(pick.choice(signs) for _ in range(pick.randrange(40)))
        text += pick.choice(["", "", "<|endoftext|>", " <|endoftext|> x"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_after_their_memo_was_dropped(library, codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    text = " ".join(f"word{i % 7} other{i}," for i in range(60))
    assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_invalid_bytes_decode_as_in_the_library(library, codec):
    ids = codec.encode("日本")[:1]
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_of_odd_rows(documents, library):
    rows = bpe.round_trip(documents(ODD), PATH).collect()
    assert len(rows) == len(ODD)
    found = sorted(map(repr, rows))
    expected = []
    for key, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(repr(tuple(r)) for r in rows) == sorted(map(repr, expected)) and found


def test_encode_and_decode_keep_columns(documents):
    docs = documents(ODD)
    coded = bpe.encode(docs, PATH)
    assert coded.columns == [*docs.columns, "ids"]
    back = bpe.decode(coded, PATH)
    assert all((r["text"] or "") == r["decoded"] for r in back.collect())
    assert bpe.encode(coded, PATH).columns == coded.columns


def test_empty_table_and_large_file(documents, monkeypatch):
    none = documents(ODD).filter("false")
    assert bpe.round_trip(none, PATH).count() == 0
    monkeypatch.setattr(bpe, "MAX_FILE_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.encode(none, PATH)
