import hashlib

import numpy as np
import pytest

from skytally.llm import repeats
from skytally.llm.queries import op7_suffix_array
from skytally.llm.repeats import fragments, remove_repeats
from skytally.llm.suffixes import permuted_prefixes, suffix_array
from tests.conftest import SF_DIR


def brute_force(texts, length):
    """(n_bytes, n_removed, n_spans, kept) by id, windows hashed one by one."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for at in np.flatnonzero(gone) if not at or not gone[at - 1])
        out[i] = (len(data), int(gone.sum()), spans, kept)
    return out


def found(frame):
    rows = frame.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}


@pytest.mark.parametrize("letters, size", [(1, 60), (2, 300), (4, 900), (256, 1000)])
def test_suffix_array(letters, size):
    rng = np.random.default_rng(letters)
    for turn in range(6):
        text = rng.integers(0, letters, size).astype(np.uint8)
        if turn % 2:
            text = np.tile(text[: size // 7], 8)
        data = text.tobytes()
        for depth in (len(data) + 1, 20):
            order = suffix_array(text, depth)
            assert sorted(order) == list(range(len(data)))
            keys = [data[at : at + depth] for at in order]
            assert keys == sorted(keys)
        for length in (9, 8, 3, 20):
            some = order[order + length <= len(data)]
            shares = [data[a : a + length] == data[b : b + length] for a, b in zip(some[1:], some)]
            assert permuted_prefixes(text, some, length).tolist() == [False, *shares]


def test_fragments_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 97)
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (0, 5, 12, 300, 13, 0, 900, 40)]
    texts.append(texts[3])
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    plain, all_ = None, []
    for frequent in (np.zeros(0, np.uint64), None):
        if frequent is None:
            frequent = np.sort(np.array([a for a, _ in all_[:3]], np.int64).astype(np.uint64))
        windows, anchor_of, all_ = [], {}, []
        for parts in fragments(data, offsets, 12, frequent):
            for number, start, count, anchor in zip(*parts):
                all_.append((anchor, start))
                for at in range(start, start + count):
                    windows.append((number, at))
                    text = texts[number][at : at + 12]
                    assert len(text) == 12 and anchor_of.setdefault(text, anchor) == anchor
        expected = [(i, at) for i, t in enumerate(texts) for at in range(len(t) - 11)]
        assert sorted(windows) == expected
        plain = plain or anchor_of
    assert plain != anchor_of


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_SHARD_BYTES", 300)
    passage = "a passage that repeats é and goes on for a while. "
    texts = {
        1: None, 2: "", 3: "short", 4: f"start {passage} end", 5: f"{passage}", 6: passage,
        7: "x" * 200, 8: "xy" * 100, 9: f"ü{passage}ü{passage[3:30]}ü", 10: passage[:30] + "é" * 40,
        11: passage * 5, 12: "é" * 40,
    }
    docs = spark.createDataFrame(
        [(i, t, 0, "x") for i, t in texts.items()], "doc_id long, text string, kept int, id string"
    ).repartition(4)
    for length in (20, 13):
        assert found(remove_repeats(docs, length)) == brute_force(texts, length)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_shared_and_missing_ids(spark):
    text = "one text of some length that is long enough"
    rows = [(1, text), (1, text), (None, text), (2, text), (3, text + " a"), (3, "another " + text)]
    rows += [(4, text), (4, None), (5, text), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = remove_repeats(docs, 20).collect()
    got = {(r.doc.doc_id, r.text): r.n_removed for r in rows}
    assert len(rows) == 10 and got[4, None] == got[5, ""] == 0 and got[1, text] == got[None, text] == 0 and got[2, text] == len(text)
    assert sorted(got[3, t] > 0 for t in (text + " a", "another " + text)) == [False, True]


def test_kept_text_has_whole_characters(spark):
    docs = spark.createDataFrame(
        [(1, "0123456789é"), (2, "0123456789è")], "doc_id long, text string"
    )
    row = next(r for r in remove_repeats(docs, 11).collect() if r.doc.doc_id == 2)
    assert bytes(row.kept) == "è".encode()[1:] and row.kept_text == ""


def test_frequent_passage(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_SHARD_BYTES", 2000)
    rng = np.random.default_rng(9)
    line = "this line is found in very many of the documents"
    texts = {
        i: f"{rng.integers(1e9)} {rng.integers(1e9)} {line} {rng.integers(1e9)}" + " same" * (i % 5)
        for i in range(400)
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    assert found(remove_repeats(docs, 30)) == brute_force(texts, 30)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute_force(dict(docs.select("doc_id", "text").collect()), 100)
    assert found(remove_repeats(docs)) == expected
    for r in op7_suffix_array(spark, SF_DIR).collect():
        assert r.kept_sha256 == hashlib.sha256(expected[r.doc_id][3]).hexdigest()
