"""Alignment of two tokenizers over whole texts.

Both encode the same bytes, so their tokens end at byte offsets that can be compared. Offsets
where both end cut the tokens into groups, found by a galloping intersection: the shorter list
of ends drives, each of its ends is searched for in the longer one, from where the last search
ended, by steps that double and then by halves. The ranks found there give each token the range
of the other side's tokens that it overlaps.

Documents are handled in blocks. A block keeps its distinct id pairs once, with the number of
its documents that hold them linked, and each document the pairs it has as indices into that
list. Counting over the corpus then moves pairs of blocks, not links of documents.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import boxed, quoted, scratch, staged
from skytally.llm.sentencepieces import MARK
from skytally.llm.tokens import byte_bpe

_BLOCK_LINKS = 1 << 20
_SLICE_CHARS = 1 << 20
_STRIDE = 32


def gallop(needles: np.ndarray, haystack: np.ndarray) -> np.ndarray:
    """How many of ``haystack`` are below each of ``needles``. Both rise strictly.

    The needles are cut into runs of ``_STRIDE``, which are searched side by side. The search
    for a needle begins where that for the one before it in its run ended.
    """
    n, size = len(needles), len(haystack)
    runs = -(-n // _STRIDE)
    padded = np.full(runs * _STRIDE, needles[-1] if n else 0, needles.dtype)
    padded[:n] = needles
    lanes = padded.reshape(runs, _STRIDE).T
    ranks = np.empty((_STRIDE, runs), np.int64)
    fenced = np.append(haystack, np.iinfo(haystack.dtype).max)
    at = np.zeros(runs, np.int64)
    for step, wanted in enumerate(lanes):
        low, width = at, np.ones(runs, np.int64)
        high = low.copy()
        # Double the width while the end of the range is still below what is wanted.
        active = np.flatnonzero(fenced[high] < wanted)
        while len(active):
            low[active] = high[active] + 1
            high[active] = np.minimum(high[active] + width[active], size)
            width[active] *= 2
            active = active[fenced[high[active]] < wanted[active]]
        # Now what is wanted lies in low..high: halve.
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            below = fenced[middle] < wanted[active]
            low[active[below]] = middle[below] + 1
            high[active[~below]] = middle[~below]
            active = active[low[active] < high[active]]
        ranks[step] = low
        at = low
    return ranks.T.reshape(-1)[:n]


@dataclass
class Aligned:
    """Tokens of some documents, one after the other, and how they meet."""

    common_a: np.ndarray  # places of the A tokens that end where a B token ends
    common_b: np.ndarray  # places of those B tokens
    first_b: np.ndarray  # of each A token: the first B token it overlaps
    last_b: np.ndarray  # and the last one


def align_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Meet two rising lists of ends, the last of which is the same."""
    swapped = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    ranks = gallop(short, long)
    meet = long[ranks] == short
    in_short, in_long = np.flatnonzero(meet), ranks[meet]
    if not swapped:
        # Rank: B tokens that end before the A token does. The next one reaches over its end.
        after = ranks + meet
        return Aligned(in_short, in_long, np.append(0, after[:-1])[: len(ranks)], ranks)
    # Rank: A tokens that end before the B token does; turn it round by counting.
    ended = np.bincount(ranks, minlength=len(ends_a) + 1)
    before = np.cumsum(ended)[: len(ends_a)]  # B tokens whose end lies at or before A's end
    met = np.zeros(len(ends_a), np.int64)
    met[in_long] = 1
    return Aligned(in_long, in_short, np.append(0, before[:-1]), before - met)


class Vocabularies:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        self.bpe = byte_bpe(a_path)
        with open(b_path, "rb") as file:
            self.pieces = sentencepiece.SentencePieceProcessor(model_proto=file.read())
        size = self.bpe.encoding.n_vocab
        self.a_bytes = [self._a_bytes(i) for i in range(size)]
        self.b_bytes = [self._b_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        self.within_a, self.ending_a = self._rendered(size, "|")
        self.within_b, self.ending_b = self._rendered(len(self.b_bytes), ";")

    def _a_bytes(self, number: int) -> bytes:
        try:
            return self.bpe.encoding.decode_single_token_bytes(number)
        except KeyError:  # an id that is not used
            return b""

    def _b_bytes(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        if self.pieces.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode()

    @staticmethod
    def _rendered(size: int, end: str) -> tuple[np.ndarray, np.ndarray]:
        """Every id as text, followed by a comma, and by the sign that ends its side."""
        return tuple(np.array([f"{i}{sign}" for i in range(size)], object) for sign in (",", end))

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by either side, none if the text is empty or a side does not give it back."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = self.bpe.encoding.encode_ordinary(" " + text)
        b = self.pieces.encode(text)
        if self.bpe.encoding.decode_bytes(a) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return [], []
        return a, b


_loaded: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Vocabularies(a_path, b_path)
    return _loaded[a_path, b_path]


def _starts(sizes) -> np.ndarray:
    return np.append(0, np.cumsum(sizes)).astype(np.int64)


def _rendered(v: Vocabularies, a, b, met: Aligned, bounds_a, bounds_b) -> Iterator[str]:
    """The groups of each document as text."""
    ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    ends_a[met.common_a], ends_b[met.common_b] = True, True
    tokens = np.concatenate(
        [np.where(ends_a, v.ending_a[a], v.within_a[a]), np.where(ends_b, v.ending_b[b], v.within_b[b])]
    )
    # The group of a token is the number of cuts before it; A comes before B in a group.
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    tokens = tokens[order].tolist()
    for start, end in zip(bounds_a[:-1] + bounds_b[:-1], bounds_a[1:] + bounds_b[1:]):
        yield "".join(tokens[start:end])[:-1]


class _Block:
    """Documents of one block, until its links are many enough."""

    def __init__(self):
        self.columns, self.codes, self.sizes, self.links = [], [], [], 0

    def add(self, columns: list[pa.Array], codes: np.ndarray, sizes: np.ndarray) -> None:
        self.columns.append(columns)
        self.codes.append(codes)
        self.sizes.append(sizes)
        self.links += len(codes)

    def batch(self, names, number: int) -> pa.RecordBatch:
        """The rows of the documents; the first also has the pairs of the block."""
        sizes = np.concatenate(self.sizes)
        pairs, index = np.unique(np.concatenate(self.codes), return_inverse=True)
        document = np.repeat(np.arange(len(sizes)), sizes)
        held, repeats = np.unique(document * max(len(pairs), 1) + index, return_counts=True)
        document, index = np.divmod(held, max(len(pairs), 1))
        cuts = np.searchsorted(document, np.arange(len(sizes) + 1))
        n_docs = np.bincount(index, minlength=len(pairs))
        nothing = [None] * (len(sizes) - 1)
        slices = list(zip(cuts[:-1], cuts[1:]))
        columns = [pa.concat_arrays(list(c)) for c in zip(*self.columns)]
        columns += [
            pa.array([number] * len(sizes), pa.int64()),
            pa.array([index[s:e].astype("<u4").tobytes() for s, e in slices], pa.binary()),
            pa.array([repeats[s:e].astype("<u4").tobytes() for s, e in slices], pa.binary()),
            pa.array([pairs.astype("<i8").tobytes(), *nothing], pa.binary()),
            pa.array([n_docs.astype("<i8").tobytes(), *nothing], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)


def token_groups(docs: DataFrame, a_path: str, b_path: str, text="text") -> DataFrame:
    """Whole texts with their token groups by a byte-level BPE file (A) and a piece model (B).

    Columns: doc (struct of the other columns), n_a, n_b, n_groups, n_links, groups, and what
    :func:`with_counts` needs: block, pair_index, pair_repeats, pairs, pair_docs. ``groups`` is
    ``a1,a2|b1;a3|b2,b3``, ids in order. A side's special names in a text are plain text. Texts
    that are null or empty, or that a side does not give back byte for byte, have no tokens:
    zeros and an empty text. Repeated rows are documents of their own; an empty table gives
    no rows.
    """
    rows = boxed(docs, text)
    fields = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType())]
    fields += [("groups", T.StringType()), ("block", T.LongType())]
    fields += [(c, T.BinaryType()) for c in ("pair_index", "pair_repeats", "pairs", "pair_docs")]
    schema = T.StructType([rows.schema["doc"], *[T.StructField(*f) for f in fields]])

    def run(batches):
        v = vocabularies(a_path, b_path)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for start, end in _slices(batch.column("text")):
                some = batch.slice(start, end - start)
                block.add(*_aligned_slice(v, some.column("doc"), some.column("text").to_pylist()))
                if block.links >= _BLOCK_LINKS:
                    yield block.batch(schema.names, number)
                    number, block = number + 1, _Block()
        if block.columns:
            yield block.batch(schema.names, number)

    return rows.mapInArrow(run, schema)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded size together; a long one may be a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        size += text.as_buffer().size if text.is_valid else 0
        if size >= _SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _aligned_slice(v: Vocabularies, doc: pa.Array, texts: list[str | None]):
    """(columns, pair code of each link, links of each document) of some documents."""
    ids = [v.encode(text or "") for text in texts]
    bounds_a, bounds_b = (_starts([len(pair[side]) for pair in ids]) for side in (0, 1))
    a = np.concatenate([np.asarray(x, np.int64) for x, _ in ids])
    b = np.concatenate([np.asarray(x, np.int64) for _, x in ids])
    # All documents as one text: both sides end together where a document does.
    met = align_ends(np.cumsum(v.a_sizes[a]), np.cumsum(v.b_sizes[b]))
    spans = met.last_b - met.first_b + 1
    n_links = np.add.reduceat(np.append(spans, 0), bounds_a[:-1]) * (np.diff(bounds_a) > 0)
    starts = _starts(spans)
    linked_b = np.arange(starts[-1]) - np.repeat(starts[:-1] - met.first_b, spans)
    codes = np.repeat(a, spans) << 32 | b[linked_b]
    n_groups = np.diff(np.searchsorted(met.common_a, bounds_a))
    columns = [
        doc,
        pa.array(np.diff(bounds_a)),
        pa.array(np.diff(bounds_b)),
        pa.array(n_groups),
        pa.array(n_links),
        pa.array(list(_rendered(v, a, b, met, bounds_a, bounds_b)), pa.string()),
    ]
    return columns, codes, n_links


_PAIRS = "block long, place int, a int, b int, n long"


def _pair_rows(blocks: DataFrame) -> DataFrame:
    """One row per block and pair, with the documents of the block that hold it."""

    def run(batches):
        for batch in batches:
            for block, pairs, docs in zip(*(batch.column(c) for c in ("block", "pairs", "pair_docs"))):
                codes = np.frombuffer(pairs.as_py(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(codes), block.as_py(), np.int64)),
                        pa.array(np.arange(len(codes), dtype=np.int32)),
                        pa.array((codes >> 32).astype(np.int32)),
                        pa.array((codes & 0xFFFFFFFF).astype(np.int32)),
                        pa.array(np.frombuffer(docs.as_py(), "<i8")),
                    ],
                    ["block", "place", "a", "b", "n"],
                )

    return blocks.select("block", "pairs", "pair_docs").mapInArrow(run, _PAIRS)


def pair_counts(groups: DataFrame) -> DataFrame:
    """(a, b, count, best): how many documents hold an id pair linked, and whether no other
    pair of the A id is held by more. Reads the rows of :func:`token_groups`."""
    found = _pair_rows(groups.where("pairs IS NOT NULL"))
    counts = found.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = F.max("count").over(Window.partitionBy("a"))
    return counts.withColumn("best", F.col("count") == highest)


def with_counts(groups: DataFrame) -> DataFrame:
    """Rows of :func:`token_groups`, whatever columns were added, with ``n_best``, the links
    whose pair is held by the most documents of all pairs of its A id, ties included, and
    ``count_sum``, the documents that hold a link's pair, summed over the links."""
    extra = [c for c in groups.columns if c not in ("block", "pair_index", "pair_repeats", "pairs", "pair_docs")]
    with scratch(groups.sparkSession) as stage:
        kept = stage(groups, "token-groups")
        counts = stage(pair_counts(kept), "pair-counts")
        pairs = _pair_rows(kept.where("pairs IS NOT NULL")).join(counts, ["a", "b"])
        documents = kept.select("block", "pair_index", "pair_repeats", F.struct(*map(quoted, extra)).alias("row"))
        schema = T.StructType(
            [documents.schema["row"], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
        )
        counted = (
            documents.groupBy("block")
            .cogroup(pairs.select("block", "place", "count", "best").groupBy("block"))
            .applyInArrow(_sums, schema)
        )
        return staged(counted.select("row.*", "n_best", "count_sum"), "aligned")


def _sums(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """The two sums of each document of a block."""
    counts = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    place = pairs.column("place").to_numpy()
    counts[place] = pairs.column("count").to_numpy()
    best[place] = pairs.column("best").to_numpy()
    n_best, count_sum = [], []
    for index, repeats in zip(documents.column("pair_index"), documents.column("pair_repeats")):
        index = np.frombuffer(index.as_py(), "<u4")
        repeats = np.frombuffer(repeats.as_py(), "<u4").astype(np.int64)
        n_best.append(int(best[index] @ repeats))
        count_sum.append(int(counts[index] @ repeats))
    return pa.table(
        [documents.column("row"), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
        ["row", "n_best", "count_sum"],
    )
