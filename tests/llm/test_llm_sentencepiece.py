"""The backtracking codec against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from airlake.llm.queries import piece_model
from airlake.llm.sentencepiece_codec import Decoder, Encoder, PieceModel, codec_digest, decode, encode

PARTS = [
    "a", "b", "the", "ing", "es", " ", "  ", "     ", "\n", "\t", "\0", "é", "ö", "日本", "🙂", "▁", "1", "22", ".", "<0x0A>",
    "<s>", "aaaa", "́", "\U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=piece_model())


@pytest.fixture(scope="module")
def model():
    return PieceModel(piece_model())


def test_encodes_and_decodes_random_texts_like_the_library(model, library):
    import codecs

    from airlake.llm.sentencepiece_codec import _replace_each_byte

    codecs.register_error("replace_each_byte", _replace_each_byte)
    encoder, decoder, rng = Encoder(model), Decoder(model), random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 30)))
        ids = np.frombuffer(encoder.encode(text), dtype=np.int32)
        assert ids.tolist() == library.encode(text), text
        assert decoder.decode(ids) == library.decode(ids.tolist()), text
    for _ in range(4000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999), 231, 232, 29871]) for _ in range(rng.randint(0, 8))]
        ids = [i for i in ids if i]  # the surface of <unk> is the one that the model file names
        assert decoder.decode(np.array(ids, dtype=np.int32)) == library.decode(ids), ids


def test_long_text_without_a_space(model, library):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefgtheingö日", k=20_000))
    assert np.frombuffer(Encoder(model).encode(text), dtype=np.int32).tolist() == library.encode(text)


def test_small_caches_change_nothing(model, library, monkeypatch):
    from airlake.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(sentencepiece_codec, "PAIR_ENTRIES", 3)
    encoder, text = Encoder(model), "one two three  four\nfive one two three " * 3
    assert np.frombuffer(encoder.encode(text), dtype=np.int32).tolist() == library.encode(text)


def test_digests_over_rows_with_nulls_repeats_and_extra_columns(spark, library):
    texts = [None, "", " ", "Hello  wörld\n", "Hello  wörld\n", "x" * 50_000]
    rows = [(i if i < 4 else None, t, "extra", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = sorted(map(tuple, codec_digest(docs, piece_model()).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "")
        text = library.decode(ids)
        joined = ",".join(map(str, ids))
        want.append((i, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_operators_keep_other_columns_and_round_trip(spark):
    docs = spark.createDataFrame([(1, "a b", 7), (2, None, 8)], "doc_id long, text string, other int")
    coded = encode(docs, piece_model())
    assert coded.columns == ["doc_id", "text", "other", "ids"]
    back = decode(coded, piece_model()).orderBy("doc_id").collect()
    assert [(r.text, r.decoded, r.other) for r in back] == [("a b", "a b", 7), (None, "", 8)]
    empty = decode(encode(docs.limit(0), piece_model()), piece_model())
    assert empty.collect() == []


def test_null_ids_decode_to_the_empty_text(spark):
    rows = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in decode(rows, piece_model()).collect()] == ["", ""]
