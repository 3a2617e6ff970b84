"""Suffix arrays of byte strings by induced sorting, in whole-array steps.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The
leftmost-S (LMS) substrings are sorted by inducing, named, and the string of names is sorted;
the order of all suffixes is then induced from the LMS suffixes. Inducing goes bucket by
bucket of the first byte; within a bucket all suffixes at hand are handled at once.

The order is exact for the first ``depth`` bytes, which is what the callers compare. The
string of names is sorted by doubling rather than by inducing again: its alphabet is as large
as the string, which leaves nothing to do at once in a bucket.
"""

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is of type S. Behind the end is something smaller than any byte."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    smaller = np.append(text[:-1] < text[1:], False)
    following = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(following[::-1])[::-1]
    return smaller[following]


class _Inducer:
    def __init__(self, text: np.ndarray):
        self.text, self.is_s = text, _types(text)
        self.sizes = np.bincount(text, minlength=256)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.bytes_used = np.flatnonzero(self.sizes)
        self.lms = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]).astype(np.int32) + 1

    def _before(self, suffixes, s_type):
        """The left neighbours of that type, grouped by first byte, and the size of groups."""
        before = suffixes[suffixes > 0] - 1
        before = before[self.is_s[before] == s_type]
        first = self.text[before]
        order = np.argsort(first, kind="stable")
        return before[order], np.bincount(first, minlength=256)

    def order(self, lms: np.ndarray) -> np.ndarray:
        """All suffixes, induced from the LMS suffixes in the order given."""
        array = np.empty(len(self.text), np.int32)
        first = self.text[lms]
        grouped = lms[np.argsort(first, kind="stable")]
        counts = np.bincount(first, minlength=256)
        cuts = np.cumsum(counts) - counts
        heads = self.starts.copy()

        def put(suffixes):
            found, sizes = self._before(suffixes, False)
            at = 0
            for byte in np.flatnonzero(sizes):
                array[heads[byte] : heads[byte] + sizes[byte]] = found[at : at + sizes[byte]]
                heads[byte] += sizes[byte]
                at += sizes[byte]

        put(np.array([len(self.text)], np.int32))
        for byte in self.bytes_used:
            done = self.starts[byte]
            while done < heads[byte]:
                some = array[done : heads[byte]]
                done = heads[byte]
                put(some)
            if counts[byte]:
                put(grouped[cuts[byte] : cuts[byte] + counts[byte]])
        tails = self.ends.copy()

        def put_back(suffixes):
            found, sizes = self._before(suffixes[::-1], True)
            at = 0
            for byte in np.flatnonzero(sizes):
                tails[byte] -= sizes[byte]
                some = found[at : at + sizes[byte]]
                array[tails[byte] : tails[byte] + sizes[byte]] = some[::-1]
                at += sizes[byte]

        for byte in self.bytes_used[::-1]:
            done = self.ends[byte]
            while done > tails[byte]:
                some = array[tails[byte] : done]
                done = tails[byte]
                put_back(some)
            if heads[byte] > self.starts[byte]:
                put_back(array[self.starts[byte] : heads[byte]])
        return array


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number; zeros behind the end."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    return np.ndarray(len(text) + 8, "<u8", padded.data, strides=(1,))


def _same(words, a, b, lengths):
    """Whether the ``lengths`` bytes from a on equal those from b on."""
    equal = np.ones(len(a), bool)
    open_, at = np.flatnonzero(lengths > 0), 0
    while len(open_):
        apart = words[a[open_] + at] ^ words[b[open_] + at]
        left = lengths[open_] - at
        short = left < 8
        apart[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        equal[open_[apart != 0]] = False
        at += 8
        open_ = open_[(apart == 0) & (left > 8)]
    return equal


def _doubled(names: np.ndarray, rounds: int) -> np.ndarray:
    """Order of the suffixes of a string of names, exact for 2 ** ``rounds`` names."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    sorted_ = names[order]
    new = np.r_[True, sorted_[1:] != sorted_[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~(new & np.r_[new[1:], True])
    for step in range(rounds):
        where = np.flatnonzero(tied)
        if not len(where):
            break
        some, after = order[where], order[where] + (1 << step)
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[some] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        some, key = some[by], key[by]
        order[where] = some
        new = np.r_[True, key[1:] != key[:-1]]
        rank[some] = np.maximum.accumulate(np.where(new, where, 0))
        tied[where] = ~(new & np.r_[new[1:], True])
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of an array of bytes, ordered by their first ``depth`` bytes."""
    if not len(text):
        return np.zeros(0, np.int32)
    inducer = _Inducer(text)
    lms = inducer.lms
    if not len(lms):
        return inducer.order(lms)
    number = np.full(len(text), -1, np.int32)
    number[lms] = np.arange(len(lms))
    induced = inducer.order(lms)
    induced = induced[number[induced] >= 0]
    # A substring goes on to the next LMS start, that byte included.
    sizes = np.diff(np.append(lms, len(text))) + 1
    sizes[-1] = len(text) - lms[-1]
    at = number[induced]
    alike = sizes[at[1:]] == sizes[at[:-1]]
    pairs = np.flatnonzero(alike)
    alike[pairs] = _same(words_at(text), induced[1:][pairs], induced[:-1][pairs], sizes[at[1:]][pairs])
    # The last substring runs into the end and is like no other.
    alike &= (at[1:] != len(lms) - 1) & (at[:-1] != len(lms) - 1)
    names = np.empty(len(lms), np.int64)
    names[at] = np.cumsum(np.r_[0, ~alike])
    if names[at[-1]] + 1 < len(lms):
        # Two names cover two bytes at least.
        order = _doubled(names, max(depth, 2).bit_length())
    else:
        order = at
    return inducer.order(lms[order])


def permuted_prefixes(text: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``suffixes`` whether the suffix there and the one before it share
    their first ``length`` bytes.

    Compared in text order (by way of each suffix's predecessor), so that neighbours in the
    text are read together. The bytes of every suffix must go that far.
    """
    before = np.full(len(text), -1, np.int32)
    before[suffixes[1:]] = suffixes[:-1]
    here = np.flatnonzero(before >= 0)
    words, there = words_at(text), before[here]
    for at in [*range(0, length - 7, 8), *([max(length - 8, 0)] if length % 8 else [])]:
        mask = np.uint64(2 ** (8 * min(length, 8)) - 1)
        same = ((words[here + at] ^ words[there + at]) & mask) == 0
        here, there = here[same], there[same]
    shares = np.zeros(len(text), bool)
    shares[here] = True
    return shares[suffixes]
