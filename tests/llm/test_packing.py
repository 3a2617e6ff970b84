import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skytally.llm.packing import pack
from skytally.llm.queries import op9_packing
from skytally.llm.tokens import ByteBpe
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def expected_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, length):
    """Every id once, documents whole, sequences full and without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = expected_ids(texts[doc])
        assert np.frombuffer(b"".join(p.ids for p in pieces), "<u4").tolist() == ids
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    last = max(by_sequence, default=-1)
    assert sorted(by_sequence) == list(range(last + 1))
    for number, pieces in by_sequence.items():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at == length or number == last and at <= length


def test_edge_texts(spark):
    texts = {
        1: "a b c", 2: None, 3: "", 4: "  two  spaces ", 5: "x" * 3000, 6: "tab\t next\n line \n",
        7: "<|endoftext|> it's é  ü", 8: " lead", 9: "trail ", 10: "a b c", 11: "word " * 2000,
        12: " ", 13: "'s 't a 's", 14: "12 34 5,6 ,7",
    }
    docs = spark.createDataFrame(
        [(k, v, "clash", 0) for k, v in texts.items()], "doc_id long, text string, ids string, part int"
    ).repartition(3)
    check(pack(docs, PATH, length=64).collect(), texts, 64)


def test_names_of_added_tokens(spark):
    """As the library's own call with add_special_tokens=False has them."""
    names = [t.content for t in TOKENIZER.get_added_tokens_decoder().values()]
    texts = dict(enumerate(f"{a}{name}{b}" for name in names for a in ("", "a", "b ") for b in ("", "c", name)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = pack(docs, PATH).collect()
    check(rows, texts, 1024)
    of = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows}
    assert of[list(texts.values()).index("a<|endoftext|>c")] == [64, 50256, 66, 0]


def test_a_share_of_all_texts_is_compared():
    encoder = ByteBpe(PATH)
    encoder.encoding = type("Wrong", (), {"encode_ordinary": staticmethod(lambda text: [1])})
    wrong = 0
    for i in range(1000):
        try:
            encoder.ids(f"some text {i}")
        except ValueError:
            wrong += 1
    assert 5 <= wrong <= 40


def test_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert pack(spark.createDataFrame([], schema), PATH).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], schema)
    rows = pack(twice, PATH).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 2), (1, 3), (1, 3)]


def test_totals_need_no_python_rows(spark, capsys):
    """Rows that the driver gives would be made in Python workers of another kind."""
    docs = spark.createDataFrame([(x, f"text {x}") for x in range(9)], "doc_id long, text string")
    pack(docs.repartition(3), PATH).explain()
    assert "ExistingRDD" not in capsys.readouterr().out


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    check(pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), PATH).collect(), texts, 1024)
    digests = op9_packing(spark, SF_DIR).collect()
    one = next(r for r in digests if r.start == 0 and r.length == r.doc_tokens)
    ids = np.asarray(expected_ids(texts[one.doc_id]), "<u4").tobytes()
    assert one.ids_crc32 == zlib.crc32(ids)
