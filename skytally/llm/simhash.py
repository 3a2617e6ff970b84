"""SimHash near-duplicates by a generalised pigeonhole.

The 64 bits are dealt into bands, correlated bits together. For each fingerprint every band
gets a radius r >= -1 with the sum of (r + 1) one more than the distance sought: two
fingerprints within that distance then agree in some band up to its radius. The radii are
chosen per fingerprint by dynamic programming over the candidates each is estimated to bring,
so that a band in which a fingerprint has a crowded value is left out or kept exact. Estimates
come from a bounded sample and steer the cost only.

Fingerprints probe the bands of all others; candidates are verified bit by bit where they
meet, in tiles of bounded size, and a tile gives a spanning forest of its links, not all pairs.
"""

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.common import quoted, staged, whole_number
from skytally.llm.components import components

_SEED = 42
_TILE_ROWS = 1 << 15
_PAIRS_AT_ONCE = 1 << 21


def fingerprint(text: str | None, shingle=3) -> int:
    """The 64-bit fingerprint of a whole text, as a signed number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    counts, total = np.zeros(64, np.int64), len(words) - n + 1
    for at in range(0, total, 4096):
        spans = zip(starts[at : min(at + 4096, total)], ends[at + n - 1 :])
        hashes = b"".join([digest(joined[a:e], _SEED) for a, e in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle=3, key="doc_id", text="text") -> DataFrame:
    """(key, id, text_hash, fingerprint) of each document."""
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("id", T.LongType()),
            T.StructField("text_hash", T.LongType()),
            T.StructField("fingerprint", T.LongType()),
        ]
    )

    def run(batches):
        for batch in batches:
            marks = [fingerprint(t, shingle) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(marks, pa.int64())], schema.names
            )

    column, whole = quoted(key), quoted(text)
    return docs.select(
        column.alias("key"),
        whole_number(column).alias("id"),
        F.xxhash64(whole).alias("text_hash"),
        whole.alias("text"),
    ).mapInArrow(run, schema)


class Plan:
    """Bands, and estimates of how many fingerprints share a band's value.

    ``sample`` holds signed fingerprints of a uniform sample of the ``total`` distinct ones.
    """

    def __init__(self, sample: np.ndarray, total: int, distance: int):
        self.distance = distance
        # Wide bands for many fingerprints: few share a value, more values are probed.
        count = 4 if total <= 1 << 20 else 3 if total <= 1 << 26 else 2
        self.scale = total / max(len(sample), 1)
        self.bands = _bit_groups(sample, min(count, distance + 1))
        self.widest = max(1, -(-(distance + 1) // len(self.bands)) - 1)
        self.known = [
            np.unique(self.values(sample, band), return_counts=True)
            for band in range(len(self.bands))
        ]

    def values(self, marks: np.ndarray, band: int) -> np.ndarray:
        """The bits of a band, side by side."""
        marks, out = marks.astype(np.uint64), np.zeros(len(marks), np.uint64)
        for at, bit in enumerate(self.bands[band]):
            out |= ((marks >> np.uint64(bit)) & np.uint64(1)) << np.uint64(at)
        return out.astype(np.int64)

    def masks(self, band: int, radius: int) -> np.ndarray:
        """What to flip in a value to get every value within the radius."""
        width = len(self.bands[band])
        flips = [
            sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)
        ]
        return np.array(flips, np.int64)

    def radii(self, marks: np.ndarray) -> np.ndarray:
        """The cheapest radii for each fingerprint: (fingerprints, bands), -1 for left out."""
        n, units = len(marks), self.distance + 1
        best = np.full((units + 1, n), np.inf)
        best[0] = 0
        choices = []
        for band in range(len(self.bands)):
            values, (known, counts) = self.values(marks, band), self.known[band]
            cost = [np.zeros(n)]
            for radius in range(self.widest + 1):
                total = np.zeros(n)
                for mask in self.masks(band, radius):
                    if len(known):
                        at = np.minimum(np.searchsorted(known, values ^ mask), len(known) - 1)
                        total += np.where(known[at] == values ^ mask, counts[at], 0)
                cost.append(total * self.scale + len(self.masks(band, radius)))
            after = np.full((units + 1, n), np.inf)
            choice = np.zeros((units + 1, n), np.int64)
            for used in range(units + 1):
                for spent in range(min(used, len(cost) - 1) + 1):
                    with_ = best[used - spent] + cost[spent]
                    better = with_ < after[used]
                    after[used] = np.where(better, with_, after[used])
                    choice[used] = np.where(better, spent, choice[used])
            best = after
            choices.append(choice)
        out, left, rows = np.zeros((n, len(self.bands)), np.int64), np.full(n, units), np.arange(n)
        for band in reversed(range(len(self.bands))):
            spent = choices[band][left, rows]
            out[:, band], left = spent - 1, left - spent
        return out


def _bit_groups(sample: np.ndarray, count: int) -> list[list[int]]:
    """The 64 bits in ``count`` groups of about one size, correlated bits together."""
    bits = (sample.astype(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    bits = bits.astype(np.float64) - bits.mean(axis=0) if len(sample) else np.zeros((1, 64))
    together = np.abs(bits.T @ bits)
    spread = np.sqrt(np.maximum(np.diag(together), 1e-9))
    together /= np.outer(spread, spread)
    np.fill_diagonal(together, 0)
    left, groups = list(range(64)), []
    for number in range(count):
        size = len(left) // (count - number)
        group = [max(left, key=lambda b: together[b, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            near = max(left, key=lambda b: together[b, group].sum())
            group.append(near)
            left.remove(near)
        groups.append(group)
    return groups


def _band_rows(plan: Plan, probing: bool):
    """Turns fingerprints into (band, value, fingerprint) rows: every band's own value for
    those that are found, the values within the radii for those that probe."""

    def run(batches):
        for batch in batches:
            marks = batch.column(0).to_numpy()
            radii = plan.radii(marks) if probing else np.zeros((len(marks), len(plan.bands)), int)
            for band in range(len(plan.bands)):
                values = plan.values(marks, band)
                for radius in range(radii.max(initial=0) + 1):
                    chosen = radii[:, band] == radius
                    masks = plan.masks(band, radius)
                    spread = (values[chosen][:, None] ^ masks).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(spread), band, np.int32)),
                            pa.array(spread),
                            pa.array(np.repeat(marks[chosen], len(masks))),
                        ],
                        ["band", "value", "fingerprint"],
                    )

    return run


def forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray, out: list) -> None:
    """Add to ``out`` those of the links (a, b) that join what ``labels`` holds apart, and
    update the labels. Links are numbers of nodes."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            return
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        # One link for each label that goes under a lower one.
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        out.append((a[first], b[first]))
        parent = np.arange(len(labels))
        parent[high[first]] = low[first]
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
        labels[:] = parent[labels]


def _tile_links(distance: int):
    def run(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        nodes = np.unique(np.r_[probes["fingerprint"], index["fingerprint"]].astype(np.int64))
        index = index.sort_values(["value", "fingerprint"])
        values, marks = index["value"].to_numpy(), index["fingerprint"].to_numpy()
        asked, asking = probes["value"].to_numpy(), probes["fingerprint"].to_numpy()
        low = np.searchsorted(values, asked, "left")
        counts = np.searchsorted(values, asked, "right") - low
        labels, links = np.arange(len(nodes)), []
        sums = np.cumsum(counts)
        at = 0
        while at < len(asked):
            done = sums[at - 1] if at else 0
            to = max(int(np.searchsorted(sums, done + _PAIRS_AT_ONCE, "right")), at + 1)
            n = counts[at:to]
            left = np.repeat(asking[at:to], n)
            places = np.repeat(low[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            right = marks[places]
            near = np.bitwise_count((left ^ right).astype(np.uint64)) <= distance
            near &= right < left
            left, right = left[near], right[near]
            forest(np.searchsorted(nodes, left), np.searchsorted(nodes, right), labels, links)
            at = to
        pairs = [np.concatenate(x) for x in zip(*links)] if links else [np.zeros(0, np.int64)] * 2
        return pd.DataFrame({"a": nodes[pairs[0]], "b": nodes[pairs[1]]})

    return run


def links(marks: DataFrame, distance=3, planning_sample=1 << 16) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all those within ``distance``.

    ``planning_sample`` bounds how many fingerprints are looked at to lay out the bands.
    """
    spark, total = marks.sparkSession, marks.count()
    step = max(1, total // planning_sample)
    sample = marks.where(F.pmod(F.xxhash64("fingerprint", F.lit("plan")), F.lit(step)) == 0)
    sample = sample.limit(2 * planning_sample).toArrow().column(0).to_numpy()
    plan = Plan(sample, total, distance)
    schema = "band int, value long, fingerprint long"
    index = marks.mapInArrow(_band_rows(plan, False), schema)
    probes = staged(marks.mapInArrow(_band_rows(plan, True), schema), "probes")
    bins = max(1, total // _TILE_ROWS)
    tile = F.pmod(F.xxhash64("value"), F.lit(bins)).cast("int").alias("tile")

    def counted(rows, name):
        return rows.groupBy("band", tile).agg(
            (F.count("*") / _TILE_ROWS).cast("int").alias(name)
        )

    cuts = counted(probes, "rows").join(counted(index, "columns"), ["band", "tile"])
    cuts = staged(cuts, "tiles")

    def dealt(rows, own, other):
        """Each row to its slice in one direction, copied along the other."""
        rows = rows.select("*", tile).join(cuts, ["band", "tile"])
        slice_ = F.pmod(F.xxhash64("fingerprint", F.lit("tile")), F.col(own) + 1).cast("int")
        names = {own: "i" if own == "rows" else "j", other: "j" if own == "rows" else "i"}
        return rows.select(
            "band",
            "tile",
            slice_.alias(names[own]),
            F.explode(F.sequence(F.lit(0), F.col(other))).alias(names[other]),
            "value",
            "fingerprint",
        )

    by = ["band", "tile", "i", "j"]
    return (
        dealt(probes, "rows", "columns")
        .groupBy(*by)
        .cogroup(dealt(index, "columns", "rows").groupBy(*by))
        .applyInPandas(_tile_links(distance), "a long, b long")
    )


def near_groups(
    docs: DataFrame, shingle=3, distance=3, key="doc_id", text="text", planning_sample=1 << 16
) -> DataFrame:
    """One row per document: the key, its fingerprint (long), ``component_id``, ``group``, the
    same for all rows of a component and no others, and ``text_hash``, the 64-bit hash of its text.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the smallest id
    reachable over links, the document's own included. Texts without words have fingerprint 0
    and link like any other; a null text is an empty one. Rows that share an id are separate
    rows of one document. Rows without an id link too, but give no component its name: it is
    null where no row has an id. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, shingle, key, text), "fingerprints")
    marks = staged(rows.groupBy("fingerprint").agg(F.min("id").alias("first")), "marks")
    roots = components(links(marks.select("fingerprint"), distance, planning_sample))
    rooted = marks.join(roots, marks["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = staged(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(named, "root").select("fingerprint", "component_id", F.col("root").alias("group"))
    return rows.join(named, "fingerprint").select(
        F.col("key").alias(key), "fingerprint", "component_id", "group", "text_hash"
    )
