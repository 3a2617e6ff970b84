import random
import re

import pytest
from pyspark.sql import functions as F

from skytally.catalog import samples
from skytally.operators import ordered
from skytally.plans.ingest import forwarded
from tests.conftest import SF_DIR, plan, snapshots, values


def brute(rows, state=None):
    """Forwarded (receiver, arrival, now, sequence), one receiver after the other."""
    out = []
    for receiver in {r[0] for r in rows}:
        last, count = (state or {}).get(receiver, (0.0, 0))
        for _, arrival, now in sorted(r for r in rows if r[0] == receiver):
            if now != last:
                out.append((receiver, float(arrival), float(now), count))
                count += 1
            last = now
    return sorted(out)


def run(spark, rows, slices, state=None, unique=False):
    frame = snapshots(spark, [(*r, []) for r in rows]).repartition(5)
    kept = ordered.dedupe_snapshots(
        ordered.with_slices(frame, slices), state=state, unique_arrival=unique
    )
    return values(ordered.number_snapshots(kept, state=state), "receiver", "arrival", "now", "sequence")


def test_only_consecutive_repeats_go(spark):
    rows = [("r", 1, 7), ("r", 2, 8), ("r", 3, 7), ("r", 4, 7)]
    assert [r[2] for r in run(spark, rows, 1)] == [7.0, 8.0, 7.0]


def test_first_snapshot_at_zero_is_not_new(spark):
    assert run(spark, [("r", 1, 0), ("r", 2, 5)], 2) == [("r", 2.0, 5.0, 0)]


@pytest.mark.parametrize("slices", [1, 3, 16])
@pytest.mark.parametrize("unique", [True, False])
def test_slices_do_not_change_the_result(spark, slices, unique):
    rng = random.Random(slices)
    rows, clock = [], {"hot": 1, "a": 1, "b": 1}
    for arrival in range(600):
        receiver = rng.choices(["hot", "a", "b"], [8, 1, 1])[0]
        clock[receiver] = max(1, clock[receiver] + rng.choice([0, 0, 1, 1, -1]))
        rows.append((receiver, arrival, clock[receiver]))
    assert run(spark, rows, slices, unique=unique) == brute(rows)


def test_one_arrival_with_half_of_the_rows(spark):
    """A third of all rows are copies of one snapshot, many more share its arrival."""
    rng = random.Random(3)
    rows = [("r", 50, 9)] * 200 + [("r", 50, 10 + i // 2) for i in range(100)]
    rows += [(rng.choice("rs"), a, 1 + a // 3) for a in range(300)]
    assert run(spark, rows, 8) == brute(set(rows))


def test_slices_are_even(spark):
    rows = snapshots(spark, [("r", 50, i, []) for i in range(400)] + [("r", i, 1, []) for i in range(400)])
    sizes = [r[0] for r in ordered.with_slices(rows, 8).groupBy("_slice").count().select("count").collect()]
    assert max(sizes) <= 200


def test_state_carries_over(spark):
    state = {"r": (8.0, 5), "gone": (3.0, 2)}
    frame = spark.createDataFrame(
        [(r, *s) for r, s in state.items()], "receiver STRING, last_now DOUBLE, forwarded BIGINT"
    )
    rows = [("r", 1, 8), ("r", 2, 9), ("new", 1, 4), ("new", 2, 4), ("r", 3, 9), ("r", 4, 8)]
    assert run(spark, rows, 3, frame) == brute(rows, state)


def test_helper_columns_do_not_leak(spark):
    frame = snapshots(spark, [("r", 1, 7, [])])
    assert ordered.dedupe_snapshots(frame).columns == frame.columns
    assert ordered.number_snapshots(frame).columns == [*frame.columns, "sequence"]


def test_envelope_is_text(spark):
    frame = snapshots(spark, [("r", 1, 1634651003, []), ("r", 2, 1634905178.5, [])])
    frame = frame.withColumn("messages", F.when(F.col("arrival") == 1, F.lit(7)).cast("bigint"))
    got = forwarded(frame)
    names = ["MessageCount", "TimeStamp", "CountOfAircraft", "SequenceNumber"]
    assert values(got, *names) == [("0", "1634905178.5", "0", "1"), ("7", "1634651003", "0", "0")]
    assert {got.schema[n].dataType.simpleString() for n in names} == {"string"}


def test_one_plan_reads_twice_and_shuffles_wide_rows_once(spark):
    sliced = ordered.with_slices(samples.polled_snapshots(spark, SF_DIR), 4)
    text = plan(forwarded(sliced, unique_arrival=True))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2
    details = [block for block in text.split("\n\n") if " Exchange" in block.split("\n")[0]]
    assert len([block for block in details if "aircraft" in block]) == 1


@pytest.mark.parametrize("slices", [1, 4])
def test_landed_snapshots_take_their_place(spark, slices):
    """Copies of landed ones and repeats of them are no changes; late ones are numbered last."""
    landed = [("r", 1, 7), ("r", 4, 8), ("s", 2, 3)]
    fresh = [("r", 1, 7), ("r", 2, 7), ("r", 3, 9), ("r", 4, 8), ("r", 5, 8), ("r", 6, 7), ("s", 2, 3), ("s", 3, 4)]
    old = snapshots(spark, [(*r, []) for r in landed]).select("receiver", "arrival", "now")
    state = spark.createDataFrame(
        [("r", None, 2), ("s", None, 1)], "receiver STRING, last_now DOUBLE, forwarded BIGINT"
    )
    frame = snapshots(spark, [(*r, []) for r in fresh])
    found = ordered.changed_snapshots(frame, slices, state, landed=old)
    assert found.columns == [*frame.columns, "sequence"]
    assert values(found, "receiver", "arrival", "now", "sequence") == [
        ("r", 3.0, 9.0, 2), ("r", 6.0, 7.0, 3), ("s", 3.0, 4.0, 1),
    ]
