import pickle
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skytally.llm import toxicity
from skytally.llm.queries import op10_toxicity, toxicity_model
from skytally.llm.toxicity import BlockIndex, Numbers, _words, fit, score
from tests.conftest import SF_DIR


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(7)
    vectors = rng.random((700, 30)) * (rng.random((700, 30)) < 0.15)
    vectors[100:140] = vectors[100]
    vectors = vectors[vectors.any(axis=1)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = BlockIndex.build(vectors, np.arange(len(vectors)) % 2, np.arange(len(vectors)), block=16)
    for row in (0, 5, 101, 300):
        words = np.flatnonzero(vectors[row])
        for k, without in ((1, -1), (10, -1), (60, 0), (2000, -1)):
            places, cosines = index.nearest(words, vectors[row][words], k, without)
            all_ = vectors[index.ids] @ vectors[row]
            if without >= 0:
                all_[without] = 0
            expected = np.sort(all_[all_ > 1e-12])[::-1][:k]
            assert np.allclose(cosines, expected) and np.allclose(all_[places], cosines)
            assert len(set(places)) == len(places)


def test_blocks_are_passed_over():
    """Three kinds of examples with own common words: the blocks of the others are not scored, and
    the result is that of brute force, for queries together as for one."""
    rng = np.random.default_rng(3)
    vectors = np.zeros((3000, 400))
    for kind in range(3):
        own = slice(kind * 1000, kind * 1000 + 1000)
        vectors[own, kind * 20 : kind * 20 + 20] = rng.random((1000, 20)) + 0.2
        vectors[own, 60:] = rng.random((1000, 340)) * (rng.random((1000, 340)) < 0.02)
    vectors = vectors[rng.permutation(3000)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = BlockIndex.build(vectors, np.zeros(3000, int), np.arange(3000), block=16)
    asked = range(0, 3000, 60)
    queries = [(np.flatnonzero(vectors[x]), vectors[x][vectors[x] > 0]) for x in asked]
    places = np.argsort(index.ids)
    for without in ([-1] * 50, [int(places[x]) for x in asked]):
        for x, left_out, (found, cosines) in zip(asked, without, index.nearest_of(queries, 10, without)):
            all_ = vectors @ vectors[x]
            if left_out >= 0:
                all_[x] = 0
            expected = np.lexsort((np.arange(3000), -np.round(all_, 12)))[:10]
            assert index.ids[found].tolist() == expected.tolist()
            assert np.allclose(cosines, all_[expected])
    assert 0 < index.visited < 0.5 * index.bounded


def test_common_words_have_no_lists_and_scores_are_made_in_place():
    """A worker holds the weights of common words by example and in the matrix, not in lists too."""
    rng = np.random.default_rng(11)
    vectors = rng.random((900, 200)) * (rng.random((900, 200)) < np.r_[np.full(50, 0.4), np.full(150, 0.01)])
    vectors[:, 0] += 0.1
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = BlockIndex.build(vectors, np.zeros(900, int), np.arange(900), block=16)
    rare = (vectors > 0).sum(axis=0) < 45
    assert 0 < rare.sum() < 200
    assert len(index.members) == len(index.weights) == (vectors[:, rare] > 0).sum()
    common, sums = np.zeros((2, int((~rare).sum())), np.float32), np.zeros((2, 57, 16), np.float32)
    common[:, 0] = 1
    index._matrix()
    assert np.shares_memory(index._visit(common, sums, 10)[0], sums)
    found, cosines = index.nearest(np.flatnonzero(vectors[5]), vectors[5][vectors[5] > 0], 20)
    assert np.allclose(cosines, np.sort(vectors @ vectors[5])[::-1][:20])
    assert np.allclose(vectors[index.ids[found]] @ vectors[5], cosines)


def test_workers_hold_each_weight_once():
    rng = np.random.default_rng(13)
    vectors = rng.random((700, 300)) * (rng.random((700, 300)) < np.r_[np.full(40, 0.3), np.full(260, 0.01)])
    vectors[:, 0] += 0.1
    vectors[5, 1:], vectors[9, :40], vectors[9, 40] = 0, 0, 1  # only common words, none of them
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = BlockIndex.build(vectors, np.arange(700) % 2, np.arange(700), block=16)
    entries = (vectors > 0).sum()
    assert len(index.own) + len(index.weights) == entries
    assert len(pickle.dumps(index)) < 12 * entries + 25 * 700 + 10_000
    some = [3, 699, 0, *np.flatnonzero(np.isin(index.ids, [5, 9]))]
    for at, (words, weights) in zip(some, index.examples(some)):
        own = vectors[index.ids[at]]
        assert words.tolist() == np.flatnonzero(own).tolist() and (weights == own[words]).all()
        places, cosines = index.nearest(words, weights, 40)
        every = np.sort(vectors @ own)[::-1][:40]
        assert np.allclose(cosines, every[every > 1e-12], rtol=0, atol=1e-12)
        assert np.allclose(vectors[index.ids[places]] @ own, cosines, rtol=0, atol=1e-12)


def test_numbers_of_words(monkeypatch):
    words = [f"w{x}" for x in range(500)] + ["東京", "grüße"]
    asked = [*words[::-1], "w500", "", "東", "w1", "w1"]
    expected = [*range(501, -1, -1), -1, -1, -1, 1, 1]
    for first in (1000, 502, 100, 0):
        monkeypatch.setattr(toxicity, "_FIRST", first)
        for of in (hash, len, lambda w: 7, lambda w: hash(w[:2])):  # also words of equal hash
            monkeypatch.setattr(toxicity, "_hash", of)
            numbers = Numbers(pa.array(words))
            assert numbers.of(asked).tolist() == expected and len(numbers) == 502
            again = pickle.loads(pickle.dumps(numbers))
            assert again._made is None and again.of(asked).tolist() == expected
            assert len(numbers.of([])) == 0
    assert Numbers(pa.array([], pa.string())).of(["a"]).tolist() == [-1]


def test_numbers_take_little_memory():
    """A dict of these words takes 30 MB."""
    numbers = Numbers(pa.array([f"word{x}" for x in range(250_000)]))
    tracemalloc.start()
    try:
        assert numbers.of(["word249999", "word0"]).tolist() == [249_999, 0]
        held = tracemalloc.get_traced_memory()[0] + numbers.words.nbytes
    finally:
        tracemalloc.stop()
    assert held < 18e6, held


def test_words_are_those_of_the_pattern():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x30000)]))
    texts = [None, "", "A_b-c\x1fd9\n", every, "".join(c + "a" for c in every), "Grüße, 東京 – x²!", "\u0130x"]
    for text in texts:
        assert _words(text) == re.findall(r"\w+", (text or "").lower())


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [(i, f"filler{i % 50} words go here" + " nastyword" * (i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts], "doc_id long, toxic int")
    return docs, labels


def test_edges(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame([(None, 1), (3, None), (0, 0), (9999, 1)], "doc_id long, toxic int")
    model = fit(docs, labels.unionByName(odd))
    assert list(model.vocabulary) == ["nastyword"]
    rows = spark.createDataFrame(
        [
            (1, "a nastyword", 5.0, "x"), (2, None, 5.0, "x"), (None, "", None, None),
            (3, "clean", 0.1, "y"), (1, "a nastyword", 5.0, "x"), (4, "clean " * 200_000 + "nastyword", 0.0, ""),
        ],
        "doc_id long, text string, score double, evidence string",
    )
    found = score(rows, model).collect()
    assert len(found) == 6
    for r in found:
        toxic = "nastyword" in (r.text or "")
        assert (r.score > 0.9) == toxic and (r.score < 0.1) != toxic
        assert [e.label for e in r.evidence] == ([1, 1, 1] if toxic else [])
    assert score(rows.limit(0), model).count() == 0


def test_without_labels(spark, labelled):
    docs, labels = labelled
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert {r.score for r in score(docs, fit(docs, none)).collect()} == {0.0}


def test_bounds_hold(labelled):
    docs, labels = labelled
    model = fit(docs, labels, examples=100)
    assert len(model.index.ids) <= 100


def test_held_out_quality(spark):
    folder = SF_DIR.replace("0.001", "0.1")
    truth = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect())
    rows = op10_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    hits = [truth[r.doc_id] for r in held if r.predicted]
    caught = sum(hits)
    assert caught / len(hits) > 0.85, (caught, len(hits))
    assert caught / sum(truth[r.doc_id] for r in held) > 0.75, caught


def test_rare_and_clean_words_count(spark):
    """No word is left out: two examples with a rare toxic word are enough to be found, and a
    document of clean words only has clean neighbours."""
    texts = [(i, f"plain{i % 40} words go{i % 7} here" + " nastyword" * (i % 4 == 0)) for i in range(400)]
    texts += [(1000 + i, f"scarce{i} vile") for i in range(2)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i >= 1000)) for i, _ in texts], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert len(model.index.ids) == len(texts)
    rows = spark.createDataFrame([(1, "scarce0"), (2, "vile"), (3, "plain3 words go3 here")], "doc_id long, text string")
    found = {r.doc.doc_id: r for r in score(rows, model).collect()}
    assert {e.id for e in found[1].evidence} == {1000} and {e.id for e in found[2].evidence} == {1000, 1001}
    assert found[1].score > found[3].score and found[2].score > found[3].score
    assert len(found[3].evidence) == 3 and {e.label for e in found[3].evidence} == {0}
    assert found[3].evidence[0].cosine > 0.99


def test_scores_equal_a_plain_recomputation(spark):
    """Votes and evidence of the whole query on sf0.001, from dense vectors and all cosines."""
    folder = SF_DIR
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity_model(spark, folder, docs)
    texts = dict(docs.collect())
    sets = {i: set(re.findall(r"\w+", (t or "").lower())) for i, t in texts.items()}
    ids, labels = model.index.ids.tolist(), model.index.labels.tolist()
    chi = _plain_chi([sets[i] for i in ids], labels)

    def vector(i):
        words = re.findall(r"\w+", (texts[i] or "").lower())
        out = {}
        for w in sets[i]:
            held = sum(w in s for s in sets.values()) if w in chi else 1
            idf = np.log((1 + len(texts)) / (1 + held)) + 1
            out[w] = (1 + np.log(words.count(w))) * idf * np.sqrt(max(chi.get(w, 1), 1))
        length = np.sqrt(sum(x * x for x in out.values())) or 1
        return {w: x / length for w, x in out.items()}

    vectors = {i: vector(i) for i in texts}
    scored = {r.doc_id: r for r in op10_toxicity(spark, folder).collect()}
    assert set(scored) == set(texts)
    for i in sorted(texts):
        own = vectors[i]
        cosines = [sum(x * vectors[e].get(w, 0) for w, x in own.items()) for e in ids]
        best = sorted((-c, e, y) for c, e, y in zip(cosines, ids, labels) if c > 1e-9)[: model.neighbours]
        shares = [(-c) ** model.power for c, _, _ in best]
        positive = sum(s * y for s, (_, _, y) in zip(shares, best)) + model.shrink * model.prior
        vote = positive / (sum(shares) + model.shrink)
        near = [model.probability(vote + d) for d in (-1e-6, 0, 1e-6)]
        assert min(near) - 1e-9 <= scored[i].score <= max(near) + 1e-9
        assert np.allclose([e.cosine for e in scored[i].evidence], [-c for c, _, _ in best[:3]], atol=1e-5)


def _plain_chi(sets, labels):
    total, positive, chi = len(sets), sum(labels), {}
    for w in set().union(*sets):
        a = sum(y for s, y in zip(sets, labels) if w in s)
        n = sum(w in s for s in sets)
        odds = abs(a * (total - positive) - (n - a) * positive)
        below = n * (total - n) * positive * (total - positive)
        chi[w] = total * max(odds - total / 2, 0) ** 2 / below if below else 0.0
    return chi
