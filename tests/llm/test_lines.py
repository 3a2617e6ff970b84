import numpy as np

from skytally.llm import lines, perfect_hash
from skytally.llm.lines import dedup_lines
from tests.conftest import SF_DIR

WHITE = " \t\n\x0b\x0c\r"


def brute_force(rows, min_chars=10):
    """Expected (id, n_lines, n_dropped, kept) of (id, text) rows."""

    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(WHITE))

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        kept = [
            x for x in all_
            if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i
        ]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(docs, **more):
    rows = dedup_lines(docs, **more).select("doc.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, rows), key=str)


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    levels = perfect_hash.unpacked(*perfect_hash.packed(perfect_hash.build(keys)))
    assert sorted(perfect_hash.numbers(levels, keys)) == list(range(5000))
    assert perfect_hash.build(keys[:0]) == []


def test_edges(spark):
    same = "A line that Is shared ü"
    rows = [
        (3, f"{same}\n\n  {same.lower()}\t\nown line of three"), (1, f"\n{same}"), (2, same),
        (2, same), (5, None), (6, ""), (None, same), (7, "short\nshort\nÜÜÜÜÜÜÜÜÜÜ"),
        (8, "short\nÜÜÜÜÜÜÜÜÜÜ\nüüüüüüüüüü\n123456789é\n123456789"),
        (9, "123456789é\n123456789\n" + "long " * 30000), (10, "twice in one\ntwice in one"),
    ]
    docs = spark.createDataFrame(
        [(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_lines int, kept string"
    ).repartition(3)
    assert found(docs) == brute_force(rows)
    assert found(docs.limit(0)) == []


def test_frequent_line_is_dealt_over_copies(spark, monkeypatch):
    monkeypatch.setattr(lines, "_SHARD_LINES", 50)
    monkeypatch.setattr(lines, "_SHARD_KEYS", 20)
    rows = [
        (i, f"the frequent line\nline number {i // 2}\nanother one {i % 40}") for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == brute_force(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found(docs) == brute_force(docs.select("doc_id", "text").collect())
