import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from skytally.llm.queries import op8_sentencepiece
from skytally.llm.sentencepieces import build, decode, encode, parse
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b   c ", "\n\n", "<s> </s> <unk> <0x41>", "日本語 ▁ ▁▁x", "aaaa" * 50, "    " * 30 + "x",
    "\x00\x07 tab\there", "🙂🙂 é́", "word " * 20_000,
]


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_parity_on_odd_texts(reference):
    with open(PATH, "rb") as file:
        tokenizer = build(parse(file.read()))
    for text in ODD:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == reference.encode(text), text[:40]
        assert tokenizer.decode(ids, skip_special_tokens=False) == reference.decode(ids)


def _message(*fields):
    """Serialise (number, value): int as varint, float as 32 bits, text and bytes with size."""

    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_model_with_byte_fallback():
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [("▁", -3.0, 1), ("▁ab", -1.5, 1), ("a", -3.5, 1), ("b", -3.6, 1), ("bab", -2.0, 1), ("ab", -4.0, 1)]
    data = b"".join(_message((1, _message((1, t), (2, s), (3, k)))) for t, s, k in pieces)
    data += _message((2, _message((3, 1), (35, 1), (40, 0), (41, 2**64 - 1), (42, 2**64 - 1), (43, 2**64 - 1))))
    data += _message((3, _message((1, "identity"), (3, 1), (4, 1))))
    model = parse(data)
    assert model.byte_fallback and model.kind == 1 and model.pieces[258][:1] == ("▁ab",)
    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    tokenizer = build(model)
    for text in ("ab", "abab bab", " a  b ", "aéb", "", "bbbaaab ab"):
        assert tokenizer.encode(text, add_special_tokens=False).ids == other.encode(text), text


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        build(parse(_message((1, _message((1, "x"), (2, 0.0), (3, 4))))))
    with pytest.raises(ValueError):
        build(parse(_message((2, _message((3, 3))))))


def test_edges(spark, reference):
    rows = [(i, t, "x", 1) for i, t in enumerate([*ODD, None, "again", "again"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    found = {r.doc.doc_id: r for r in decode(encode(docs, PATH), PATH).collect()}
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        ids = reference.encode(text or "")
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded == reference.decode(ids)
    assert encode(docs.limit(0), PATH).count() == 0


def test_whole_table(spark, reference):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = op8_sentencepiece(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.asarray(reference.encode(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
