"""Toxicity by the nearest labelled examples.

A bounded sample of labelled documents is the example set. Examples are TF-IDF vectors over all
their words, and a word weighs the more the closer it goes with either label (the root of its
chi-square, at least 1: no word is left out). An inverted index with block maxima holds them. A
document's nearest examples by cosine are found exactly: blocks of like examples are visited by
falling bound until no other can hold one of the nearest. These vote with weights that fall with
distance, and an isotonic fit over votes of examples on each other turns the vote into a
probability.
"""

from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import boxed, quoted, release, staged, whole_number

_BETWEEN = {c: " " for c in range(128) if not (chr(c).isalnum() or chr(c) == "_")}
_REMEMBERED = 50_000
_HELD = 100_000  # words of a task that are counted before their numbers are looked up
_FIRST = 1 << 16  # words whose numbers are in a dict
_hash = hash
_TOGETHER = 128
_MARGIN = 1e-5  # above the error of a sum in single precision


@dataclass
class BlockIndex:
    """Unit vectors of examples: common words by example, all others as inverted lists.

    Weights are above zero, and each is held once. Examples that are alike lie side by side, in
    blocks of ``block``. Words of at least ``dense`` of the examples have a row of a matrix each,
    made where it is used and rounded, and the highest weight of every block. All other words have
    lists, which are short and read whole. Both together bound what a block can reach; blocks are
    visited by falling bound, and no more once the bound is below the last of the best k.
    """

    labels: np.ndarray  # of the examples
    ids: np.ndarray
    firsts: np.ndarray  # by example: where its common words begin; one more for the end
    rows: np.ndarray  # places in ``common`` of these words, ascending in each
    own: np.ndarray  # and their weights
    common: np.ndarray  # words with a row of the matrix, which have no list
    starts: np.ndarray  # by word: where its list begins; one more for the end
    members: np.ndarray  # examples of all lists
    weights: np.ndarray  # and the word's weights in them
    block: int
    dense: float
    bounded: int = 0  # pairs of a query and a block so far
    visited: int = 0  # those whose examples were scored
    _rows: tuple | None = field(default=None, repr=False)

    @classmethod
    def build(cls, vectors: np.ndarray, labels, ids, block=64, dense=0.05):
        """From dense rows."""
        examples, words = np.nonzero(vectors)
        weights = vectors[examples, words]
        return cls.sparse(examples, words, weights, vectors.shape[1], labels, ids, block, dense)

    @classmethod
    def sparse(cls, examples, words, weights, n_words: int, labels, ids, block=64, dense=0.05):
        """From the entries of the vectors: example, word and weight."""
        order = np.lexsort((words, examples))
        examples, words, weights = examples[order].astype(np.int32), words[order].astype(np.int32), weights[order]
        firsts = np.r_[0, np.cumsum(np.bincount(examples, minlength=len(ids)))]
        del order, examples
        many = np.bincount(words, minlength=n_words) >= max(dense * len(ids), 1)
        alike = _alike(firsts, words, weights, many, block)
        ends = list(zip(firsts[alike].tolist(), firsts[alike + 1].tolist()))
        if ends:
            words = np.concatenate([words[a:b] for a, b in ends])
            weights = np.concatenate([weights[a:b] for a, b in ends])
        examples = np.repeat(np.arange(len(ids), dtype=_narrow(len(ids))), np.diff(firsts)[alike])
        shared = many[words]
        firsts = np.r_[0, np.cumsum(np.bincount(examples[shared], minlength=len(ids)))]
        common = np.flatnonzero(many)
        rows = (np.cumsum(many) - 1).astype(_narrow(len(common)))[words[shared]]
        listed = np.flatnonzero(~shared)
        order = listed[np.argsort(words[listed], kind="stable")]
        starts = np.r_[0, np.cumsum(np.bincount(words[listed], minlength=n_words))]
        starts = starts.astype(np.int32 if len(listed) < 2**31 else np.int64)
        members, lists, own = examples[order], weights[order], weights[shared]
        return cls(labels[alike], ids[alike], firsts, rows, own, common, starts, members, lists, block, dense)

    def __getstate__(self):
        return self.__dict__ | {"_rows": None}

    def examples(self, some: list[int]):
        """Words, ascending, and weights of each of some examples."""
        place = np.full(len(self.ids), -1, np.int32)
        place[some] = np.arange(len(some))
        listed = np.flatnonzero((place >= 0)[self.members])
        owner = place[self.members[listed]]
        listed = listed[np.argsort(owner, kind="stable")]
        words, weights = np.searchsorted(self.starts, listed, "right") - 1, self.weights[listed]
        ends = np.cumsum(np.bincount(owner, minlength=len(some)))[:-1]
        out = []
        for at, few, rare in zip(some, np.split(words, ends), np.split(weights, ends)):
            own = slice(self.firsts[at], self.firsts[at + 1])
            every = np.r_[self.common[self.rows[own]], few]
            order = np.argsort(every)
            out.append((every[order], np.r_[self.own[own], rare][order]))
        return out

    def _matrix(self):
        """(row by word, or -1; weights by block, word and place in it; maxima by word and block)."""
        if self._rows is None:
            row = np.full(len(self.starts) - 1, -1, np.int32)
            row[self.common] = np.arange(len(self.common))
            blocks = -(-len(self.ids) // self.block)
            matrix = np.zeros((blocks, len(self.common), self.block), np.float32)
            for number in range(blocks):
                ends = self.firsts[number * self.block : (number + 1) * self.block + 1]
                place = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                matrix[number, self.rows[ends[0] : ends[-1]], place] = self.own[ends[0] : ends[-1]]
            self._rows = row, matrix, np.ascontiguousarray(matrix.max(axis=2, initial=0).T)
        return self._rows

    def nearest(self, words: np.ndarray, query: np.ndarray, k: int, without=-1):
        """The k examples of largest cosine above zero: (index positions, cosines), nearest
        first, ties to the smaller id. ``without`` leaves one example out."""
        return self.nearest_of([(words, query)], k, [without])[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]):
        """:meth:`nearest` of several queries."""
        row, matrix, highest = self._matrix()
        if not queries or not len(matrix):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        size = len(matrix) * self.block
        common = np.zeros((len(queries), len(highest)), np.float32)
        listed = np.zeros((len(queries), size))
        sums = np.zeros((len(queries), size), np.float32)
        for at, ((words, query), left_out) in enumerate(zip(queries, without)):
            rows = row[words]
            rare = rows < 0
            common[at, rows[~rare]] = query[~rare]
            some, sizes = _ranges(self.starts, words[rare])
            parts = self.weights.take(some) * np.repeat(query[rare].astype(float), sizes)
            sums[at] = listed[at] = np.bincount(self.members.take(some), parts, size)
            if left_out >= 0:
                sums[at, left_out] = -2  # its common words do not lift it above zero
        scores, least = self._visit(common, sums.reshape(len(queries), -1, self.block), k)
        found, whole = [], np.zeros(len(highest))
        for (words, query), own, bound, rare in zip(queries, scores, least, listed):
            places = np.flatnonzero(own >= max(bound - _MARGIN, 1e-12))
            if len(places) > k:
                bound = np.partition(own[places], len(places) - k)[len(places) - k]
                places = places[own[places] >= bound - _MARGIN]
            rows = row[words]
            whole[rows[rows >= 0]] = query[rows >= 0]
            found.append(self._exact(places, whole, rare, k))
            whole[:] = 0
        return found

    def _visit(self, common: np.ndarray, sums: np.ndarray, k: int):
        """Scores of all examples (zero in blocks that were not visited), made in place of the
        sums, and for each query what its k-th best is at least, in single precision: within its
        error of this counts as above."""
        _, matrix, highest = self._rows
        bounds = common @ highest + sums.max(axis=2)
        order = np.argsort(-bounds, axis=1)
        bounds = np.take_along_axis(bounds, order, 1)
        each = np.arange(len(sums))
        seen, best = np.zeros(sums.shape[:2], bool), np.zeros((len(sums), k), np.float32)
        # The first blocks give a bound, some more a close one, by which all others go.
        few = max(2 * k // self.block, 4)
        at, step, steps = 0, few, iter([8 * few, len(matrix)])
        while at < len(matrix):
            # Bounds fall: where none of the next ones counts, no later one does.
            enough = np.maximum(best[:, 0] - _MARGIN, 1e-12)
            query, rank = np.nonzero(bounds[:, at : at + step] >= enough[:, None])
            if not len(query):
                break
            block = order[query, at + rank]
            by_block = np.argsort(block, kind="stable")
            query, block = query[by_block], block[by_block]
            starts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
            for low, high in zip(starts, [*starts[1:], len(block)]):
                some, one = query[low:high], block[low]
                sums[some, one] += common[some] @ matrix[one]
                seen[some, one] = True
            self.visited += len(block)
            if at + step < len(matrix):  # never after the last step, so this is of few blocks
                some = each[:, None], order[:, at : at + step]
                scores = np.where(seen[some][:, :, None], sums[some], 0).reshape(len(sums), -1)
                best = np.partition(np.concatenate([best, scores], axis=1), scores.shape[1], axis=1)[:, -k:]
            at, step = at + step, next(steps, 0)
        self.bounded += order.size
        sums[~seen] = 0
        return sums.reshape(len(sums), -1), best[:, 0]

    def _exact(self, places: np.ndarray, whole: np.ndarray, rare: np.ndarray, k: int):
        """The nearest of some examples, from a query's common words and the sums of its others."""
        if not len(places):
            return places, np.zeros(0)
        some, sizes = _ranges(self.firsts, places)
        parts = whole[self.rows.take(some)] * self.own.take(some)
        scores = rare[places] + np.bincount(np.repeat(np.arange(len(places)), sizes), parts, len(places))
        top = np.lexsort((places, self.ids[places], -scores))[:k]
        return places[top], scores[top]


def _alike(firsts, words, weights, many, block: int, directions=64) -> np.ndarray:
    """An order of the examples in which like ones are near: their common words are projected to
    a few fixed random directions, and the points halved across their longest extent until a
    block holds them. It steers the cost and no result."""
    size = len(firsts) - 1
    axes = np.random.default_rng(5).standard_normal((int(many.sum()), directions), np.float32)
    row = np.cumsum(many) - 1
    points = np.zeros((size, directions), np.float32)
    for low in range(0, size, 256):
        high = min(low + 256, size)
        some = slice(firsts[low], firsts[high])
        kept = many[words[some]]
        rows = np.zeros((high - low, len(axes)), np.float32)
        owner = np.repeat(np.arange(high - low), np.diff(firsts[low : high + 1]))
        rows[owner[kept], row[words[some][kept]]] = weights[some][kept]
        points[low:high] = rows @ axes
    order, waiting = [], [np.arange(size)]
    while waiting:
        some = waiting.pop()
        if len(some) <= block:
            order.append(some)
            continue
        own = points[some] - points[some].mean(axis=0)
        along = own[np.argmax((own**2).sum(axis=1))]
        for _ in range(6):
            along = own.T @ (own @ along)
            along /= max(float(np.linalg.norm(along)), 1e-30)
        some = some[np.argsort(own @ along, kind="stable")]
        half = -(-len(some) // (2 * block)) * block
        waiting += [some[half:], some[:half]]
    return np.concatenate(order)


def _narrow(n: int):
    """A type for numbers below n."""
    return np.uint16 if n <= 2**16 else np.int32


def _ranges(starts: np.ndarray, which: np.ndarray):
    """All positions of some lists, one after the other, and the lists' sizes."""
    low, sizes = starts[which], starts[which + 1] - starts[which]
    return np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


class Numbers:
    """Numbers of words: their places in an array that holds each once, the often asked first.

    A dict of all would take several times the array's bytes in every worker. So only the first
    words are in one, made where it is used; the others are found by their hashes, and compared.
    """

    def __init__(self, words: pa.StringArray):
        self.words, self._made = words, None

    def __len__(self):
        return len(self.words)

    def __getstate__(self):
        return {"words": self.words, "_made": None}  # hashes differ from process to process

    def _tables(self):
        """(numbers of the first words, hashes of the others, ascending, and their numbers)."""
        if self._made is None:
            first = {w: x for x, w in enumerate(self.words.slice(0, _FIRST).to_pylist())}
            hashes = np.empty(len(self) - len(first), np.int64)
            for low in range(0, len(hashes), 1 << 14):
                some = self.words.slice(len(first) + low, 1 << 14).to_pylist()
                hashes[low : low + len(some)] = list(map(_hash, some))
            order = np.argsort(hashes)
            hashes, order = hashes[order], (order + len(first)).astype(np.int32)
            twins = np.flatnonzero(hashes[1:] == hashes[:-1])
            for x in sorted({*order[twins].tolist(), *order[twins + 1].tolist()}):
                first[self.words[x].as_py()] = x  # a search by hash finds one of them only
            self._made = first, hashes, order
        return self._made

    def of(self, words: list[str]) -> np.ndarray:
        """The number of each word, -1 for one that is not in the array."""
        first, hashes, order = self._tables()
        out = np.fromiter(map(first.get, words, repeat(-1)), np.int64, len(words))
        others = np.flatnonzero(out < 0)
        if len(others) and len(hashes):
            asked = np.fromiter((_hash(words[x]) for x in others.tolist()), np.int64, len(others))
            at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
            hit = hashes[at] == asked
            others, numbers = others[hit], order[at[hit]]
            held = self.words.take(pa.array(numbers)).to_pylist()
            same = [words[x] == w for x, w in zip(others.tolist(), held)]
            out[others] = np.where(same, numbers, -1)
        return out


@dataclass
class Model:
    vocabulary: dict[str, float]  # words that go with label 1, and their chi-square; for reading
    known: Numbers  # of all words of the examples
    weights: np.ndarray  # by word, the last one for words that no example has
    index: BlockIndex
    prior: float
    neighbours: int
    power: float
    shrink: float
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def vectors(self, counts: list[Counter]):
        """For each text's counts the numbers of the words that examples have, and their weights.
        Words that no example has count for the length of the vector, which is 1 with them."""
        numbers = self.known.of(list(chain.from_iterable(counts)))
        often = np.fromiter(chain.from_iterable(c.values() for c in counts), float, len(numbers))
        every = (1 + np.log(often)) * self.weights[numbers]
        out = []
        for low, high in pairwise(accumulate(map(len, counts), initial=0)):
            words, weights = numbers[low:high], every[low:high]
            order = np.argsort(words)  # the same order for the same words
            order = order[words[order] >= 0]
            out.append((words[order], weights[order] / (np.linalg.norm(weights) or 1)))
        return out

    def votes(self, vectors: list, without: list[int] | None = None):
        """For each vector the weighted share of positive neighbours, and the neighbours."""
        found = self.index.nearest_of(vectors, self.neighbours, without or [-1] * len(vectors))
        for places, cosines in found:
            share = cosines**self.power
            positive = share @ self.index.labels[places] + self.shrink * self.prior
            yield float(positive / (share.sum() + self.shrink)), (places, cosines)

    def probability(self, vote: float) -> float:
        if self.steps is None:
            return float(vote)
        at = max(int(np.searchsorted(self.steps[0], vote, "right")) - 1, 0)
        return float(self.steps[1][at])


def _words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    text = (text or "").lower()
    if text.isascii():
        return text.translate(_BETWEEN).split()
    between = [c for c in set(text) if not (c.isalnum() or c == "_")]
    if len(between) > 64:
        return text.translate(dict.fromkeys(map(ord, between), " ")).split()
    for c in between:
        text = text.replace(c, " ")
    return text.split()


def _counts(text: str | None) -> Counter:
    return Counter(_words(text))


def _isotonic(votes, labels, prior):
    """Rising steps (from this vote on, this probability) that fit the labels best. Each step
    counts one more example at the prior, so none is quite 0 or 1, and begins half way from the
    last vote of the step before."""
    order = np.argsort(votes, kind="stable")
    steps: list[list[float]] = []
    for vote, label in zip(votes[order], labels[order]):
        if steps and steps[-1][0] == vote:
            steps[-1][1] += label
            steps[-1][2] += 1
        else:
            steps.append([vote, label, 1, vote])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, positive, n, last = steps.pop()
            steps[-1][1] += positive
            steps[-1][2] += n
            steps[-1][3] = last
    rates = np.array([(positive + prior) / (n + 1) for _, positive, n, _ in steps])
    begins = [steps[0][0]] + [(a[3] + b[0]) / 2 for a, b in zip(steps, steps[1:])]
    return np.array(begins), np.maximum.accumulate(rates)


def fit(
    docs: DataFrame,
    labelled: DataFrame,
    examples=20_000,
    least_chi=15.0,
    neighbours=32,
    power=2.0,
    shrink=0.5,
    calibrated_on=5_000,
    key="doc_id",
    text="text",
) -> Model:
    """The model from ``labelled`` (key, label 0/1) and the texts of ``docs``.

    ``examples`` bounds the labelled rows used, chosen by a hash of their id, and
    ``calibrated_on`` the examples that vote on each other. All words of the examples are used;
    those with a chi-square of ``least_chi`` that go with label 1 are named in the model.
    Document frequencies are counted over all of ``docs``. Null keys and labels are left out; an
    id labelled twice counts with its larger label. Without labelled rows every score is 0.
    """
    spark = docs.sparkSession
    rows = labelled.select(
        whole_number(F.col(labelled.columns[0])).alias("id"),
        F.col(labelled.columns[1]).cast("int").alias("label"),
    ).where("id IS NOT NULL AND label IN (0, 1)")
    chosen = rows.groupBy("id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(examples)
    texts = docs.select(whole_number(quoted(key)).alias("id"), quoted(text).alias("text"))
    # The sample is bounded by ``examples``, so it may be broadcast.
    sample = texts.join(F.broadcast(chosen), "id")

    def words_of(batches):
        for batch in batches:
            counts = [_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([list(c) for c in counts], pa.list_(pa.string())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
                ],
                ["id", "label", "words", "counts"],
            )

    sample = sample.select("id", "label", "text").mapInArrow(
        words_of, "id long, label int, words array<string>, counts array<int>"
    )
    sample = staged(sample, "examples")
    sample = sample.toArrow().combine_chunks()
    ids = sample["id"].to_numpy()
    labels = sample["label"].to_numpy().astype(np.int64)
    lists = sample["words"].combine_chunks()
    examples = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    counts = sample["counts"].combine_chunks().flatten().to_numpy().astype(np.float32)
    del sample, lists
    # Frequent words first, so that lists that are read often lie together; equally frequent
    # ones by the alphabet. Examples in the order of their ids.
    listed, old = coded.dictionary, coded.indices.to_numpy()
    held = np.bincount(old, minlength=len(listed))
    order = pa.table({"held": held, "word": listed, "old": np.arange(len(listed))})
    order = order.sort_by([("held", "descending"), ("word", "ascending")])["old"].to_numpy()
    known = Numbers(listed.take(pa.array(order)))
    words = np.argsort(order).astype(np.int32)[old]
    # The driver holds little memory: what was only on the way goes.
    del coded, listed, held, old
    pa.default_memory_pool().release_unused()
    release(spark)
    order = np.lexsort((labels, ids))
    ids, labels, examples = ids[order], labels[order], np.argsort(order).astype(np.int32)[examples]
    total, positive = len(ids), int(labels.sum())

    chi, odds = _association(words, labels[examples], len(known), total, positive)
    named = np.flatnonzero((chi >= least_chi) & (odds > 0))
    named = named[np.argsort(-chi[named], kind="stable")].tolist()
    vocabulary = {known.words[w].as_py(): float(chi[w]) for w in named}
    frequencies, size = _frequencies(texts, known)
    # A word that no example has counts as one of a single document.
    idf = np.log((1 + size) / (1 + np.maximum(np.r_[frequencies, 1], 1))) + 1
    weights = idf * np.sqrt(np.maximum(np.r_[chi, 1], 1))
    entries = np.log(counts, out=counts)
    entries += 1
    entries *= weights.astype(np.float32)[words]
    entries /= np.sqrt(np.bincount(examples, entries**2, minlength=total)).astype(np.float32)[examples]
    index = BlockIndex.sparse(examples, words, entries, len(known), labels, ids)
    del examples, words, entries, counts
    prior = positive / total if total else 0.0
    model = Model(vocabulary, known, weights, index, prior, neighbours, power, shrink)
    if total:
        _calibrate(model, calibrated_on)
    return model


def _association(words, labels, n_words: int, total: int, positive: int):
    """Chi-square of each word with the label, with Yates's correction, so that a word of one or
    two examples is not taken for a sure sign; and the sign of what it goes with."""
    a = np.bincount(words, labels, minlength=n_words)
    n = np.bincount(words, minlength=n_words).astype(float)
    odds = a * (total - positive) - (n - a) * positive
    below = n * (total - n) * (positive * (total - positive))
    chi = total * np.maximum(np.abs(odds) - total / 2, 0) ** 2
    return np.divide(chi, below, out=np.zeros(n_words), where=below > 0), odds


def _frequencies(texts: DataFrame, known: Numbers):
    """The number of documents with each of the words, and of all documents."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        numbers = shared.value
        found, size, held = np.zeros(len(numbers) + 1, np.int64), 0, Counter()

        def look_up():
            places = numbers.of(list(held))
            np.add.at(found, places, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(set(_words(text)))
                if len(held) >= _HELD:
                    look_up()
            size += len(batch)
        look_up()
        found = found[:-1]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, some], pa.int64()), pa.array(np.r_[size, found[some]], pa.int64())],
            ["number", "n"],
        )

    parts = texts.select("text").mapInArrow(run, "number long, n long")
    summed = parts.groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    out = np.zeros(len(known) + 1, np.int64)
    out[summed["number"].to_numpy()] = summed["n"].to_numpy()
    return out[:-1], int(out[-1])


def _calibrate(model: Model, bound: int) -> None:
    """Votes of examples on each other."""
    ids, labels = model.index.ids, model.index.labels
    some = sorted(range(len(ids)), key=lambda x: (int(ids[x]) * 0x9E3779B97F4A7C15) % 2**64)[:bound]
    votes = []
    for low in range(0, len(some), 512):
        part = some[low : low + 512]
        vectors = model.index.examples(part)
        for at in range(0, len(part), 32):
            votes += [vote for vote, _ in model.votes(vectors[at : at + 32], part[at : at + 32])]
    model.index._rows = None  # workers make their own
    model.steps = _isotonic(np.array(votes), labels[some], model.prior)


def score(docs: DataFrame, model: Model, evidence=3, text="text") -> DataFrame:
    """Every document with its ``score`` and ``evidence``.

    Columns: doc (struct of the other columns), text, score (0 to 1, the chance of label 1) and
    evidence, the nearest examples (id, label, cosine), at most ``evidence`` of them. Only the
    text counts; a null or empty one, or one without a word of any example, votes the share of
    label 1 and has no evidence. An empty table gives no rows.
    """
    rows = boxed(docs, text)
    near = T.ArrayType(
        T.StructType(
            [
                T.StructField("id", T.LongType()),
                T.StructField("label", T.IntegerType()),
                T.StructField("cosine", T.DoubleType()),
            ]
        )
    )
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", near)]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, remembered = shared.value, {}
        for batch in batches:
            results = [None] * len(batch)
            for start in range(0, len(batch), _TOGETHER):
                texts = batch.column("text").slice(start, _TOGETHER).to_pylist()
                if len(remembered) >= _REMEMBERED:
                    remembered.clear()
                keys = [
                    blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    for t in texts
                ]
                new = {x: t for x, t in zip(keys, texts) if x not in remembered}
                vectors = model.vectors([_counts(t) for t in new.values()])
                for x, (vote, (places, cosines)) in zip(new, model.votes(vectors)):
                    reason = places[:evidence].copy(), cosines[:evidence].copy()
                    remembered[x] = model.probability(vote), *reason
                results[start : start + len(keys)] = [remembered[x] for x in keys]
            scores, places, cosines = zip(*results) if results else ([], [], [])
            ends = np.cumsum([0, *map(len, places)], dtype=np.int32)
            places = np.concatenate([np.zeros(0, np.int64), *places])
            reasons = pa.StructArray.from_arrays(
                [
                    pa.array(model.index.ids[places], pa.int64()),
                    pa.array(model.index.labels[places], pa.int32()),
                    pa.array(np.concatenate([np.zeros(0), *cosines]), pa.float64()),
                ],
                ["id", "label", "cosine"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text"),
                    pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends), reasons),
                ],
                ["doc", "text", "score", "evidence"],
            )

    return rows.mapInArrow(run, schema)
