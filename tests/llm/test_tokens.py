"""Byte-level BPE against tiktoken, word vocabulary and packing against tokenizers, and their edge cases."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from shelfcast.llm import bpe, packing, tokens

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "s", "t", "re", "'", "'s", "'ll", "'ve", " ", "  ", "\n", "\t", "\r\n", "1", "23", "é", "ß", "你好", "!", "--", "\xa0", "\x1c", "\x85", "👍🏽", "m", "''s", "Σ", "İ", "é", "the", "​"]


def odd_texts(count=400):
    chance = random.Random(5)
    return ["", "'", "a" * 3000, "&" * 999, "word " * 20_000, *("".join(chance.choice(ODD) for _ in range(chance.randint(0, 30))) for _ in range(count))]


def own_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_equal_tiktoken_and_decode_to_the_text(frame):
    texts = odd_texts()
    rows = [(number, text, "x") for number, text in enumerate(texts)] + [(len(texts), None, "x"), (3, texts[3], "again")]
    encoded = tokens.encode(frame(rows, "doc_id long, text string, ids string"), RANKS)
    found = tokens.decode_ids(encoded, RANKS).collect()
    assert len(found) == len(rows)
    own = own_encoding()
    for row in found:
        text = (texts + [None])[row["doc_id"]] or ""
        assert row["ids"] == own.encode_ordinary(text)
        assert bytes(row["bytes"]) == text.encode()


def test_many_blocks_give_the_same_ids(frame, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 50)
    texts = odd_texts(60)
    whole = {row["doc_id"]: row["ids"] for row in tokens.encode(frame(list(enumerate(texts)), "doc_id long, text string"), RANKS).collect()}
    own = own_encoding()
    assert all(whole[number] == own.encode_ordinary(text) for number, text in enumerate(texts))


def thue_morse(length):
    """Two words that polynomial hashes modulo a power of two cannot tell apart."""
    word = "".join("ab"[bin(place).count("1") % 2] for place in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_of_equal_hashes_are_told_apart(frame, length):
    one, other = thue_morse(length)
    texts = [one, other, f"{one} {other} {one}", f"x {other}"]
    own, library = own_encoding(), Tokenizer.from_file(WORDS)
    for row in tokens.round_trip(frame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), RANKS).collect():
        assert row["ids"] == own.encode_ordinary(texts[row["doc_id"]]) and bytes(row["bytes"]).decode() == texts[row["doc_id"]]
    encoder = packing.Encoder(WORDS)
    for some in (texts, texts[::-1]):  # words known from before as well
        ids, counts = encoder.encode(some)
        for text, part in zip(some, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert part.tolist() == library.encode(text, add_special_tokens=False).ids


def test_input_in_another_order_at_each_reading(spark, frame, monkeypatch):
    """Rows in a random order that changes with every reading."""
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 40)
    texts, own = odd_texts(80), own_encoding()
    rows = frame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    shuffled = rows.mapInPandas(lambda batches: (batch.sample(frac=1) for batch in batches), rows.schema)
    found = {row["doc_id"]: row["ids"] for row in tokens.encode(shuffled, RANKS).collect()}
    assert found == {number: own.encode_ordinary(text) for number, text in enumerate(texts)}
    with pytest.raises(PySparkException, match="another order"):
        tokens.encode(shuffled, RANKS, stable=True).collect()


def test_no_documents_give_no_ids(frame):
    encoded = tokens.encode(frame([], "doc_id long, text string"), RANKS)
    assert encoded.columns == ["doc_id", "ids"] and encoded.count() == 0


def test_word_vocabulary_equals_the_library():
    library, encoder = Tokenizer.from_file(WORDS), packing.Encoder(WORDS)
    texts = odd_texts()
    ids, counts = encoder.encode(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids


def packed(frame, rows, schema="doc_id long, text string"):
    return packing.pack(frame(rows, schema), WORDS).collect()


def test_packing_keeps_every_id_once_and_leaves_little_room(frame):
    chance, library = random.Random(2), Tokenizer.from_file(WORDS)
    vocabulary = ["".join(chance.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    texts = [" ".join(chance.choice(vocabulary[k % 5 * 60 : k % 5 * 60 + 60]) for _ in range(chance.choice((0, 3, 80, 400, 3000)))) for k in range(120)]
    rows = [(number, text) for number, text in enumerate(texts)] + [(500, None), (500, None)]
    found = packed(frame, rows)
    sequences, documents = {}, {}
    for row in found:
        assert 0 < row["length"] <= 2048
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
        documents.setdefault(row["doc_id"], []).append(row)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(row["length"] for row in found) // 2048) + 2
    for number, text in enumerate(texts):
        pieces = sorted(documents[number], key=lambda row: row["start"])
        ids = np.concatenate([np.frombuffer(row["ids"], dtype="<u4") for row in pieces]).tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 1]
        assert [row["start"] for row in pieces] == np.cumsum([0, *(row["length"] for row in pieces)])[:-1].tolist()
        assert {row["doc_tokens"] for row in pieces} == {len(ids)}
    assert [row["length"] for row in documents[500]] == [1, 1]


def test_the_window_is_filled_with_the_nearest_documents():
    rarity = np.ones(1 << 16)
    about = lambda base, size: np.arange(base, base + size, dtype=np.uint16)
    own = [about(10, 40), about(5000, 40), about(15, 40), about(9000, 40)]
    order = [piece[0] for piece in packing.fill_windows(own, rarity, 40.0, window=80)]
    assert order == [0, 2, 1, 3]


def test_packing_nothing(frame):
    assert packed(frame, []) == []
