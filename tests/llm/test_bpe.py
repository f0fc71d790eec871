"""Encoding by prefixes against the tokenizers library, and round trips of the decoded names."""

from __future__ import annotations

import random
import struct
import unicodedata

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leakscope.llm import prefix_bpe
from tests.llm.cases import documents, with_null_id, without_rows

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def bpe():
    return prefix_bpe.load_word_bpe(PATH)


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_padding()
    found.no_truncation()
    return found


def unpack(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_and_scripts(bpe, library):
    rng = random.Random(3)
    points = [*range(32, 127), *range(0xA0, 0x300), *range(0x370, 0x600), 0x4E00, 0x1F300, 0x301, 0x307, 0x3000, 0x1C,
              0x85, 0x130, 0x1E9E, 0xA7CB, 0x10D50, 0x16EA0, 0x13460, 0x323B0]
    texts = ["", " ", "\t\n", "it's I'LL don't 's 'something", "ΑΣ ΣΑΣ", "a" * 5000, "ab" * 3000, "!" * 999, "1234567",
             "a<|endoftext|>b<|startoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "é ḍ̇"]
    texts += ["".join(rng.choice("abn") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice(points)) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for text in texts:
        ids = bpe.ids(text)
        assert unpack(ids) == expected(library, text), text[:80]
        assert bpe.text(ids) == library.decode(unpack(ids), skip_special_tokens=False)


def test_every_code_point(bpe, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Co"]
    for at in range(0, len(points), 4096):
        text = " a".join(points[at:at + 4096])
        assert unpack(bpe.ids(text)) == expected(library, text), hex(ord(points[at]))


def test_pieces_and_forgotten_words_change_nothing(bpe, library, monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    whole = bpe.ids(text)
    monkeypatch.setattr(prefix_bpe, "PIECE", 50)
    monkeypatch.setattr(prefix_bpe, "WORDS_KEPT", 7)
    monkeypatch.setattr(prefix_bpe, "PAIRS_KEPT", 5)
    other = prefix_bpe.load_word_bpe(PATH)
    assert other.ids(text) == whole and unpack(whole) == expected(library, text)


def test_a_pair_is_compatible_if_it_encodes_to_itself(bpe, library):
    rng = random.Random(7)
    plain = [i for i, name in enumerate(bpe.names) if name.isascii() and name.isalpha() and name.islower()]
    ends = [i for i, name in enumerate(bpe.names) if name.endswith("</w>") and name[:-4].isascii()
            and name[:-4].isalpha() and name[:-4].islower()]
    for _ in range(3000):
        left, right = rng.choice(plain), rng.choice(ends)
        word = bpe.names[left] + bpe.names[right][:-4]
        assert bpe.compatible(left, right) == (expected(library, word) == [left, right])


def test_encode_and_decode_documents(spark, bpe, library):
    docs = with_null_id(spark, documents(spark))
    found = prefix_bpe.decode(prefix_bpe.encode(docs, bpe), bpe)
    assert found.columns == ["doc_id", "n_tokens", "ids", "text"]
    given = sorted((str(r.doc_id), expected(library, r.text)) for r in docs.collect())
    got = sorted((str(r.doc_id), unpack(r.ids)) for r in found.collect())
    assert got == given  # nulls, empty and repeated rows included
    assert all(r.n_tokens == len(r.ids) // 4 for r in found.collect())
    assert [r.text for r in found.where("n_tokens = 0").distinct().collect()].count("") >= 1
    assert prefix_bpe.encode(without_rows(docs), bpe).count() == 0
    nothing = found.withColumn("ids", F.lit(None).cast("binary"))
    assert {r.text for r in prefix_bpe.decode(nothing, bpe).collect()} == {""}


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        prefix_bpe.load_word_bpe(str(public_tokenizers.path("byte_bpe_50k.json")))
