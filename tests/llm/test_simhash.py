import re

import numpy as np
import xxhash

from skytally.llm import simhash
from skytally.llm.components import components
from skytally.llm.queries import op5_simhash
from skytally.llm.simhash import Plan, fingerprint, near_groups
from tests.conftest import SF_DIR


def plain_fingerprint(text, k=3):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks, distance=3):
    """Component number of each mark, by comparing all of them."""
    marks = np.array(marks, np.uint64)
    label = np.arange(len(marks))
    for i in range(len(marks)):
        near = np.bitwise_count(marks ^ marks[i]) <= distance
        near = np.isin(label, label[near])
        label[near] = label[near].min()
    return label


def check(rows, texts):
    """rows: (id, unsigned fingerprint, component) against texts by id."""
    ids = sorted(texts)
    marks = [plain_fingerprint(texts[i]) for i in ids]
    label = groups(marks)
    expected = {}
    for i, mark, at in zip(ids, marks, label):
        expected[i] = (mark, min(j for j, b in zip(ids, label) if b == at))
    assert {r[0]: (r[1], r[2]) for r in rows} == expected and len(rows) == len(ids)


def found(frame):
    return [(r.doc_id, r.fingerprint % 2**64, r.component_id) for r in frame.collect()]


def test_fingerprint():
    for text in (None, "", " \n", "One", "one  TWO", "a b c", "É é A\x0bB c\x85d e", "x y z " * 3000):
        assert fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_radii_cover_every_pair_in_reach():
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63, 40)
    marks = np.unique(np.r_[base, *(base ^ (1 << rng.integers(0, 63, 40)) for _ in range(20))])
    for total in (len(marks), 1 << 22, 1 << 28):
        plan = Plan(marks, total, 3)
        radii = plan.radii(marks)
        assert sorted(b for g in plan.bands for b in g) == list(range(64))
        assert (radii.max(axis=1) >= 0).all() and ((radii + 1).sum(axis=1) == 4).all()
        bits = [np.array([sum(1 << b for b in g)], np.uint64) for g in plan.bands]
        for at, mark in enumerate(marks):
            apart = (marks ^ mark).astype(np.uint64)
            near = np.bitwise_count(apart) <= 3
            seen = np.zeros(len(marks), bool)
            for band, mask in enumerate(bits):
                seen |= np.bitwise_count(apart & mask).astype(int) <= radii[at, band]
            assert seen[near].all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (9, 3)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(200, 260))} | {9: 3, 3: 3}
    assert {r.node: r.root for r in rows} == expected and len(rows) == len(expected)


def test_edges(spark):
    texts = [
        (5, None), (2, ""), (9, "same words here"), (4, "SAME words\there"), (7, "two words"),
        (None, "same words here"), (None, "nobody has this"), (4, "same words here"),
    ]
    docs = spark.createDataFrame(
        [(i, t, 0, 0) for i, t in texts], "doc_id long, text string, fingerprint int, id int"
    )
    rows = near_groups(docs).collect()
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in rows)
    assert got == [(-1, -1), (-1, 4), (2, 2), (4, 4), (4, 4), (5, 2), (7, 7), (9, 4)]
    assert near_groups(docs.limit(0)).count() == 0


def test_groups_tell_components_of_one_id_apart(spark):
    rows = [(1, "one two three four"), (1, "nothing like the other text at all"), (2, "one two three four")]
    found = near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {1}
    of = {r.fingerprint: r.group for r in found}
    assert len(of) == len(set(of.values())) == 2
    assert len({r.text_hash for r in found}) == 2


def test_crowded_tiles_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_TILE_ROWS", 40)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(300):
        own = list(words)
        for at in rng.integers(0, 400, 1 + i % 4):
            own[at] = f"x{i}"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check(found(near_groups(docs)), texts)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = op5_simhash(spark, SF_DIR).collect()
    rows = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows]
    check(rows, dict(docs.select("doc_id", "text").collect()))
