"""The daily catch-up: documents the change feed has not enriched."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.aggregates import flight_metric
from skytally.operators.enrich import (
    enrich,
    enrich_rejects,
    patch_locations,
    seconds_of,
    with_location,
)
from skytally.operators.filters import backfill_candidates, backfill_due
from skytally.operators.upsert import keep_one, without_keys
from skytally.sinks.commits import CommitLog
from skytally.sinks.logged import LoggedTable


def backfill_locations(
    flights: DataFrame, as_of, hemisphere_safe=False
) -> tuple[DataFrame, DataFrame]:
    """The table with every due document patched in place, and the count per flight."""
    flights = with_location(flights)
    due = backfill_due(as_of, hemisphere_safe=hemisphere_safe)
    handled = enrich(backfill_candidates(flights, as_of, hemisphere_safe=hemisphere_safe))
    return patch_locations(flights, due), flight_metric(handled)


def backfill_missing(
    raw: DataFrame, enriched: DataFrame, as_of, since=None, hemisphere_safe=False
) -> tuple[DataFrame, DataFrame]:
    """The increment instead: due raw documents without an enriched row, and the rejects.

    To be appended to the enriched table, so nothing stored is rewritten. ``since``
    (epoch seconds) leaves out documents stored before a time that earlier runs have
    covered; it goes by when a document was stored, which both tables carry, not by the
    aircraft's time: one that is stored late with an old time is still due.
    """
    if since is not None:
        stored = F.col("ingest_ts") >= since
        raw, enriched = raw.where(stored), enriched.where(stored)
    due = backfill_candidates(raw, as_of, hemisphere_safe=hemisphere_safe)
    missing = due.join(enriched.select("id", "flight"), ["id", "flight"], "left_anti")
    return enrich(keep_one(missing, ["id"], ["hex"])), enrich_rejects(missing)


def flights_view(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """All documents: the enriched row where there is one, else the raw one as it is.

    Pending documents keep ``lat`` and ``lon`` and have no point. ``Timestamp`` is a number
    for all; ``timestamp_text`` is what a raw document has there, so that one that cannot be
    read is not lost.
    """
    raw = with_location(raw)
    pending = raw.join(enriched.select("id", "flight"), ["id", "flight"], "left_anti")
    shared = [c for c in enriched.columns if c in raw.columns]
    place = {c: F.lit(None).cast(raw.schema[c].dataType) for c in ("lat", "lon")}
    done = enriched.select(*shared).withColumns(
        {**place, "timestamp_text": F.lit(None).cast("string")}
    )
    pending = pending.withColumns(
        {"Timestamp": seconds_of(raw), "timestamp_text": F.col("Timestamp").cast("string")}
    )
    return done.unionByName(pending.select(*done.columns))


class ClosedDays:
    """Which days of a table of documents are enriched to the last one, in a log of commits.

    A day is noted with the folders its documents lay in. When one is added, or replaced, the day
    is open again by that, without anyone having to say so.
    """

    def __init__(self, raw: LoggedTable, enriched: LoggedTable, path: str):
        self.raw, self.enriched = raw, enriched
        self.log = CommitLog(raw.spark, path)

    def _noted(self) -> dict[str, list[str]]:
        numbers = self.log.numbers()
        return self.log.read(numbers[-1])["days"] if numbers else {}

    def split(self) -> tuple[list[str], list[str]]:
        """(closed, open) days of the documents."""
        noted, days = self._noted(), self.raw.state().days
        closed = [d for d, names in sorted(days.items()) if names and noted.get(d) == sorted(names)]
        return closed, [d for d, names in sorted(days.items()) if names and d not in closed]

    def close(self, before: str) -> list[str]:
        """Note the open days before a date that have no pending document; returns them.

        Reads these days of both tables, as keys only. A day with a document that cannot be
        enriched stays open.
        """
        state = self.raw.state()
        days = [d for d in self.split()[1] if d < before]
        if not days:
            return []
        keys = ["id", "flight"]
        pending = self.raw.read(days=days).select(self.raw.day, *keys)
        pending = without_keys(pending, self.enriched.read(days=days).select(*keys), keys)
        left = {str(r[0]) for r in pending.select(self.raw.day).distinct().collect()}
        done = [d for d in days if d not in left]

        def build(base):
            noted = self.log.read(base)["days"] if base else {}
            now = {d: sorted(state.days[d]) for d in done}
            return {"days": noted | now} if done else None

        self.log.commit(build)
        self.log.drop_before(self.log.numbers()[-1] if self.log.numbers() else 0)
        return done

    def view(self, days=None) -> DataFrame:
        """All documents, or those of some days: :func:`flights_view`, where closed days are
        the enriched table alone, and of a pending document that was changed the newest."""
        closed, open_days = self.split()
        if days is not None:
            closed, open_days = ([d for d in some if d in set(days)] for some in (closed, open_days))
        raw = self.raw.read(days=open_days)
        newest = keep_one(raw, ["id", "flight"], [F.desc_nulls_last("ingest_ts"), F.xxhash64(*raw.columns)])
        rows = flights_view(newest, self.enriched.read(days=open_days))
        done = self.enriched.read(days=closed)
        if not closed:
            return rows
        if not open_days:
            return done.select(
                *[
                    F.col(f.name) if f.name in done.columns else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in rows.schema.fields
                ]
            )
        return rows.unionByName(done.select(*[c for c in done.columns if c in rows.columns]), allowMissingColumns=True)
