"""SentencePiece codec and token files against the libraries and round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.sentencepiece_codec import Codec, decode_pieces, encode_pieces
from tidemark.llm.token_output import EliasFano, Encoder, read_documents, read_ids, round_trip, write_ids

HARD = [
    None, "", " ", "   x", "a  b   c" + " " * 40 + "d", "x\n\n\ty\r\n", "é è ﬁ ① 日本語😀😀", "a▁b ▁▁", "<s> </s><0x41>",
    "a" * 200, "\x00\x01 z", " " * 33, "Don't STOP!! x's ÀÉ. ß. İI. a.b ...  .,;: <|endoftext|>. é́. 12,3 ½ ΑΣ. ſ K K.",
]


@pytest.fixture(scope="module")
def codec():
    return Codec(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def check(codec, library, texts):
    ids, sizes = codec.encode_batch(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == library.encode(text or ""), text
        assert codec.decode(part.tolist()) == library.decode(part.tolist())


def test_codec_on_hard_and_random_texts(codec, library):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdeinorst ▁\n.,é日①😀", k=draw.randint(1, 60))) for _ in range(2000)]
    check(codec, library, HARD + texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_codec_on_any_text(codec, library, texts):
    check(codec, library, texts or [""])


def test_codec_on_all_documents(spark, library, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    encoded = encode_pieces(documents)
    for r in encoded.collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])
    decoded = {r["doc_id"]: r["text"] for r in decode_pieces(encoded).collect()}
    assert decoded == {i: t or "" for i, t in texts.items()}


def test_forgetting_units_changes_nothing(library):
    small = Codec(public_tokenizers.path("piece_bpe_32k.model"), remembered=3)
    for text in ("one two three four", "five two six", "one one"):
        check(small, library, [text])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(steps):
    values = np.cumsum(np.array(steps, dtype=np.int64))
    coded = EliasFano.encode(values)
    assert coded.decode().tolist() == values.tolist()
    assert all(coded.select(i) == v for i, v in enumerate(values.tolist()) if i % 7 == 0)


def test_encoder_against_the_library(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"), remembered=5000)
    texts = HARD + [r["text"] for r in documents.collect()]
    for start in range(0, len(texts), 40):
        part = texts[start : start + 40]
        ids, sizes = encode(pa.array(part, type=pa.string()), 1)
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in part]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_other_vocabularies_give_the_ids_of_the_library(spark, documents):
    """Byte-level tokens keep case and white space, so texts are encoded whole."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["Hello World, this is a Test.", *HARD]
    ids, sizes = Encoder(path)(pa.array(texts, type=pa.string()), 7)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))
    assert ids[:4].tolist() == [15496, 2159, 11, 428]
    found = {r["doc_id"]: r for r in round_trip(documents.limit(20), tokenizer=path).collect()}
    for r in documents.limit(20).collect():
        want = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        assert found[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(want, dtype="<u4").tobytes())


def test_forgetting_words_changes_nothing(documents):
    """Whatever is remembered, and in whatever order; frequent words stay."""
    path, texts = public_tokenizers.path("word_bpe_49k.json"), [r["text"] for r in documents.collect()]
    large, small = Encoder(path), Encoder(path, remembered=300)
    for start in range(0, len(texts), 10):
        part = pa.array(texts[start : start + 10], type=pa.string())
        for a, b in zip(large(part, 1), small(part, 1), strict=True):
            assert a.tolist() == b.tolist()
    assert list(small._known.values()) == list(range(len(small._sizes))) and len(small._known) < len(large._known)


def test_single_documents_are_selected(spark, documents, tmp_path):
    write_ids(documents, str(tmp_path / "ids"), chunk_tokens=500)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    asked = [*sorted(texts)[:3], *sorted(texts)[50::40], -5]
    found = {r["doc_id"]: list(r["tokens"]) for r in read_documents(spark, str(tmp_path / "ids"), asked).collect()}
    assert found == {i: [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1] for i in asked if i in texts}
    assert read_documents(spark, str(tmp_path / "ids"), []).count() == 0


def test_files_hold_documents_in_order(spark, documents, tmp_path):
    write_ids(documents, str(tmp_path / "ids"), chunk_tokens=500)
    found = read_ids(spark, str(tmp_path / "ids")).toPandas().sort_values("start").reset_index(drop=True)
    assert found["doc_id"].is_monotonic_increasing
    assert (found["start"] == found["n_tokens"].cumsum() - found["n_tokens"]).all()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in found.itertuples():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) == (r.n_tokens, r.ids_crc32)


def test_odd_rows(odd_rows, no_rows):
    found = round_trip(odd_rows).toPandas().sort_values("start")
    assert len(found) == odd_rows.count()
    assert found["doc_id"].isna().tolist()[:2] == [True, True]  # nulls come first
    assert found["start"].is_unique and (found["n_tokens"] >= 1).all()
    pieces = encode_pieces(odd_rows).toPandas()
    assert len(pieces) == odd_rows.count()
    assert pieces.loc[~pieces["round_trip"], "doc_id"].tolist() == [8]  # the text with the space mark
    assert round_trip(no_rows).count() == encode_pieces(no_rows).count() == 0
