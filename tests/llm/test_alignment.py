import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skytally.llm.alignment import align_ends, gallop, token_groups, with_counts
from skytally.llm.queries import op11_cross_tokenizer
from skytally.llm.tokens import _bytes_of_characters
from tests.conftest import SF_DIR

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(texts):
    """The contract, token by token."""
    bpe = Tokenizer.from_file(A)
    bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    of = _bytes_of_characters()
    links, out = [], []
    for text in texts:
        a, b, groups, held = [], [], [], []
        if text:
            a = bpe.encode(" " + text, add_special_tokens=False).ids
            b = pieces.encode(text)
            a_bytes = [bytes(of[c] for c in bpe.id_to_token(i)) for i in a]
            b_bytes = [
                bytes([int(pieces.id_to_piece(i)[3:5], 16)])
                if pieces.is_byte(i)
                else pieces.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a, b = [], []
        if a:
            ends_a = np.cumsum([len(x) for x in a_bytes]).tolist()
            ends_b = np.cumsum([len(x) for x in b_bytes]).tolist()
            group = ([], [])
            i = j = 0
            for end in sorted({*ends_a, *ends_b}):
                if i < len(a) and ends_a[i] == end:
                    group[0].append(a[i])
                if j < len(b) and ends_b[j] == end:
                    group[1].append(b[j])
                both = ends_a[i] == end and ends_b[j] == end
                held.append((a[i], b[j]))
                i, j = i + (ends_a[i] == end), j + (ends_b[j] == end)
                if both:
                    groups.append(group)
                    group = ([], [])
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        links.append(held)
        out.append([len(a), len(b), len(groups), len(held), text])
    counts = Counter(pair for held in links for pair in set(held))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    for row, held in zip(out, links):
        row[4:4] = [sum(counts[p] == best[p[0]] for p in held), sum(counts[p] for p in held)]
    return out


def mine(frame):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return {r.doc.n: [r[c] for c in columns] for r in frame.collect()}


EDGES = [
    None, "", " ", "a", "  two  spaces ", "tab\tand\nline\n\n", "straße Öl — naïve 日本語 🙂🙂", "x" * 3000,
    "<|endoftext|> <s> </s> <unk> <0x41>", "▁ a mark", "a b c", "a b c", "the the the", "\x00 \x7f",
    "word " * 3000, "'s 't 12 34 5,6", "é" * 500, "​ zero", "á combining", "ﬁ ½ ㎏",
]


def test_edge_texts(spark):
    rows = [(n, text, n, "clash") for n, text in enumerate(EDGES)]
    docs = spark.createDataFrame(rows, "n int, text string, block int, groups string").repartition(3)
    expected = plain(EDGES)
    found = mine(with_counts(token_groups(docs, A, B)))
    assert [found[n] for n in range(len(EDGES))] == expected
    assert found[0] == found[1] == [0, 0, 0, 0, 0, 0, ""]
    assert found[9][0] == 0  # the mark comes back as a space


def test_empty_table(spark):
    docs = spark.createDataFrame([], "n int, text string")
    assert with_counts(token_groups(docs, A, B)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_gallop(seed):
    draw = np.random.default_rng(seed)
    for size, other in ((0, 0), (1, 1), (5, 900), (900, 5), (300, 310), (64, 64)):
        needles, haystack = (np.unique(draw.integers(0, 2000, n)) for n in (size, other))
        assert gallop(needles, haystack).tolist() == np.searchsorted(haystack, needles).tolist()


@pytest.mark.parametrize("sizes", [(40, 300), (300, 40), (7, 7)])
def test_align_ends(sizes):
    draw = np.random.default_rng(1)
    ends = [np.append(np.unique(draw.integers(1, 400, n)), 400) for n in sizes]
    met = align_ends(*ends)
    both = np.intersect1d(*ends)
    assert ends[0][met.common_a].tolist() == ends[1][met.common_b].tolist() == both.tolist()
    starts = [np.append(0, e[:-1]) for e in ends]
    for i in range(len(ends[0])):
        over = np.flatnonzero((starts[1] < ends[0][i]) & (ends[1] > starts[0][i]))
        assert (met.first_b[i], met.last_b[i]) == (over[0], over[-1])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = {
        d.doc_id: (*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "")
        for d, row in zip(docs, plain([d.text for d in docs]))
    }
    found = {r.doc_id: tuple(r)[1:] for r in op11_cross_tokenizer(spark, SF_DIR).collect()}
    assert found == expected
