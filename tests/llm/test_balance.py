import random
import zlib

from skytally.llm import balance
from skytally.llm.balance import combine, contents, difference, shard_documents
from skytally.llm.queries import op12_sharding
from tests.conftest import SF_DIR


def test_combine_puts_fullest_to_emptiest():
    one, other = [(9, "a"), (4, "b"), (2, "c")], [(7, "d"), (1, "e")]
    assert combine(one, other, 3) == [(9, "a"), (9, ("c", "d")), (5, ("b", "e"))]
    assert combine([(5, "a")], [(3, "b")], 3) == [(5, "a"), (3, "b")]


def test_difference_keeps_items_and_sizes():
    draw = random.Random(3)
    for k in (1, 2, 7, 40):
        for n in (0, 1, 3, 200):
            sizes = [draw.randint(1, 1000) for _ in range(n)]
            bins = difference(((s, i) for i, s in enumerate(sizes)), k)
            assert len(bins) == min(n, k)
            assert sorted(i for _, c in bins for i in contents(c)) == list(range(n))
            assert all(size == sum(sizes[i] for i in contents(c)) for size, c in bins)


def test_difference_two_bins():
    """The textbook case: 8, 7, 6, 5, 4 leaves a difference of 2."""
    bins = difference(((s, s) for s in (8, 7, 6, 5, 4)), 2)
    assert [size for size, _ in bins] == [16, 14]


def check(rows, texts, shards, overhead=16):
    """Every document once, groups whole, slots gapless; the bytes of the shards."""
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_text, by_shard = {}, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + overhead, zlib.crc32(data))
        by_text.setdefault(data, set()).add(r.shard)
        by_shard.setdefault(r.shard, []).append(r)
    assert all(len(s) == 1 for s in by_text.values())
    assert set(by_shard) <= set(range(shards))
    for there in by_shard.values():
        assert sorted(r.slot for r in there) == list(range(len(there)))
    return sorted(sum(r.size for r in there) for there in by_shard.values())


def run(spark, texts, shards, **how):
    docs = spark.createDataFrame(
        [(i, t, "clash", 0) for i, t in texts.items()], "doc_id long, text string, shard string, slot int"
    )
    rows = shard_documents(docs.repartition(5), shards, **how)
    return rows.select("doc.doc_id", "size", "text_crc32", "shard", "slot").collect()


def test_edge_texts(spark):
    texts = {1: None, 2: "", 3: "a", 4: "a", 5: "é", 6: "x" * 5000, 7: "A", 8: " a"}
    sizes = check(run(spark, texts, 3), texts, 3)
    assert sizes[-1] == 5016
    assert shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    rows = shard_documents(docs, 2).select("doc.doc_id", "shard", "slot").collect()
    assert sorted((r.doc_id or 0, r.slot) for r in rows) == [(0, 0), (1, 0), (1, 1)]
    assert len({r.shard for r in rows if r.doc_id}) == 1


def test_hot_group_has_its_shard_alone(spark):
    """A third of all rows are one text; the others are even without it."""
    texts = {i: "copied text" if i % 3 == 0 else f"{i} " * (i % 50 + 1) for i in range(900)}
    sizes = check(run(spark, texts, 10), texts, 10)
    assert sizes[-1] == 300 * len("copied text") + 300 * 16
    assert sizes[-2] - sizes[0] <= 60


def test_small_groups_are_bundled(spark, monkeypatch):
    """With coarse items all groups are dealt inside tasks first."""
    monkeypatch.setattr(balance, "FINE", 1)
    monkeypatch.setattr(balance, "BUCKETS", 8)
    monkeypatch.setattr(balance, "_CHUNK", 100)
    draw = random.Random(5)
    texts = {i: f"{i} " * draw.randint(1, 60) for i in range(3000)}
    sizes = check(run(spark, texts, 7), texts, 7)
    assert sizes[-1] - sizes[0] <= 0.01 * sizes[0]


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = op12_sharding(spark, SF_DIR).collect()
    sizes = check(rows, texts, 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    largest = {}
    for text in texts.values():
        largest[text] = largest.get(text, 0) + len((text or "").encode()) + 16
    # No shard exceeds what it must: its share, or the largest group.
    assert sizes[-1] <= max(max(largest.values()), 1.02 * sum(sizes) / 40)
