"""Tables that a log of commits describes: what is live of them, and since when.

``data/<day>/w=<name>`` holds what one write put into one day; a commit names the folders it
adds and those it replaces. So many small writes of a day can be made into one folder while
others read and write: readers keep to the folders of the version they began with, until
:meth:`LoggedTable.vacuum` deletes what no kept version needs.
"""

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.operators.upsert import keep_one
from skytally.sinks.commits import CommitLog

_WHOLE_EVERY = 16
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class State:
    """What is live at a version: per day the names of its folders, and which of them a
    compaction wrote; per writer the last batch."""

    def __init__(self):
        self.days: dict[str, set[str]] = {}
        self.folded: set[str] = set()
        self.batches: dict[str, int] = {}

    def apply(self, entry: dict) -> None:
        if "whole" in entry:
            whole = entry["whole"]
            self.days = {day: set(names) for day, names in whole["days"].items()}
            self.folded, self.batches = set(whole["folded"]), dict(whole["batches"])
            return
        for day, names in entry["remove"].items():
            self.days[day] = self.days.get(day, set()) - set(names)
            self.folded -= {f"{day}/{n}" for n in names}
        for day in entry["add"]:
            self.days.setdefault(day, set()).add(entry["name"])
            if entry["folded"]:
                self.folded.add(f"{day}/{entry['name']}")
        if entry["writer"] is not None:
            self.batches[entry["writer"]] = entry["batch"]

    def whole(self) -> dict:
        days = {day: sorted(names) for day, names in sorted(self.days.items()) if names}
        return {"days": days, "folded": sorted(self.folded), "batches": self.batches}

    def is_folded(self, day: str) -> bool:
        """Whether the day is one folder that a compaction wrote."""
        names = self.days.get(day, ())
        return len(names) == 1 and f"{day}/{next(iter(names))}" in self.folded


class LoggedTable:
    """Rows by day, added in batches. ``order`` is how rows lie in the files of a day."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, order=(), day="date"):
        self.spark, self.path, self.day = spark, path.rstrip("/"), day
        self.schema = T.StructType([f for f in schema.fields if f.name != day])
        self.order = list(order)
        self.log = CommitLog(spark, self.path)

    # Versions

    def version(self) -> int:
        return (self.log.numbers() or [0])[-1]

    def state(self, version: int | None = None) -> State:
        """Replays the log from the last commit that holds the whole state."""
        numbers = [n for n in self.log.numbers() if version is None or n <= version]
        entries = []
        for number in reversed(numbers):
            entries.append(self.log.read(number))
            if "whole" in entries[-1]:
                break
        state = State()
        for entry in reversed(entries):
            state.apply(entry)
        return state

    def _commit(self, decide) -> int:
        """``decide``: from the state it builds on to an entry, or None."""

        def build(base):
            state = self.state(base)
            entry = decide(state)
            if entry is not None and (base + 1) % _WHOLE_EVERY == 0:
                state.apply(entry)
                entry = entry | {"whole": state.whole()}
            return entry

        return self.log.commit(build)

    # Reading

    def read(self, version: int | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version, the latest if none is given; of some days only if ``days``
        names them (``2024-01-10``). No other folder is listed."""
        return self._rows(self.state(version), days)

    def _rows(self, state: State, days=None) -> DataFrame:
        days = state.days if days is None else [d for d in days if d in state.days]
        return self._folders([(day, name) for day in sorted(days) for name in sorted(state.days[day])])

    def _folders(self, folders: list[tuple[str, str]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(self.day, T.DateType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        paths = [f"{data}/{self.day}={day}/w={name}" for day, name in folders]
        read = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("w", T.StringType())]))
        return read.option("basePath", data).parquet(*paths).drop("w")

    # Writing

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Put rows into folders of a new name; the name and the days it has."""
        name = uuid.uuid4().hex
        data = f"{self.path}/data"
        rows = rows.select(*self.schema.names, self.day).withColumn("w", F.lit(name))
        rows.write.mode("append").partitionBy(self.day, "w").parquet(data)
        jvm = self.spark._jvm
        there = jvm.org.apache.hadoop.fs.Path(f"{data}/{self.day}=*/w={name}")
        files = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().getParent().getName() for f in files.globStatus(there) or []]
        return name, sorted(f.removeprefix(f"{self.day}=") for f in found)

    def has_batch(self, writer: str, batch: int) -> bool:
        return self.state().batches.get(writer, -1) >= batch

    def append(self, rows: DataFrame, writer: str | None = None, batch: int | None = None) -> int:
        """Add rows. What a writer adds as a batch is added once: a batch whose number is not
        above the writer's last one has been committed before and changes nothing."""
        if writer is not None and self.has_batch(writer, batch):
            return self.version()
        name, days = self._write(rows)

        def decide(state):
            if writer is not None and state.batches.get(writer, -1) >= batch:
                return None
            return self._entry(name, add=days, writer=writer, batch=batch)

        return self._commit(decide)

    @staticmethod
    def _entry(name, add=(), remove=None, folded=False, writer=None, batch=None) -> dict:
        return {
            "name": name, "add": list(add), "remove": remove or {}, "folded": folded,
            "writer": writer, "batch": batch,
        }

    # Compaction

    def _fold(self, rows: DataFrame) -> DataFrame:
        """What a day's rows become when its folders are made one."""
        return rows

    def compact(self, before: str | None = None, days: Iterable[str] | None = None) -> list[str]:
        """Make each day one folder, of as few files as its bytes need.

        Takes the days before a date, or those named; all if neither is given. Days that are
        one such folder already are not read. What is added to a day meanwhile stays beside the
        new folder; a day that someone else compacts first is left to them. Returns the days
        done.
        """
        state = self.state()
        wanted = set(state.days) if days is None else set(days) & set(state.days)
        open_days = sorted(
            day for day in wanted
            if state.days[day] and not state.is_folded(day)
            and (before is None or day == _NO_DAY or day < before)
        )
        if not open_days:
            return []
        rows = self._fold(self._rows(state, open_days))
        rows = rows.repartitionByRange(self.day, *self.order).sortWithinPartitions(self.day, *self.order)
        name, written = self._write(rows)
        done = []

        def decide(now):
            done[:] = [d for d in open_days if state.days[d] <= now.days.get(d, set())]
            if not done:
                return None
            remove = {d: sorted(state.days[d]) for d in done}
            return self._entry(name, add=[d for d in written if d in done], remove=remove, folded=True)

        self._commit(decide)
        return done

    def vacuum(self, keep: int = 10) -> int:
        """Delete the folders that only versions before the last ``keep`` read, and the commits
        from before these. Returns how many folders went."""
        numbers = self.log.numbers()
        if len(numbers) <= keep:
            return 0
        first = numbers[-keep]
        needed = {(d, n) for v in numbers[-keep:] for d, names in self.state(v).days.items() for n in names}
        gone = set()
        for number in numbers:
            if number <= first:
                entry = self.log.read(number)
                gone |= {(d, n) for d, names in entry["remove"].items() for n in names}
        jvm, count = self.spark._jvm, 0
        for day, name in sorted(gone - needed):
            place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{self.day}={day}/w={name}")
            files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
            count += files.exists(place) and files.delete(place, True)
        wholes = [n for n in numbers if n <= first and "whole" in self.log.read(n)]
        if wholes:
            self.log.drop_before(wholes[-1])
        return count


class MergedTable(LoggedTable):
    """One row per key, the one of the highest version, out of all that were added.

    Rows carry ``version``, which rises with each change of a document at its source, and
    ``gone``. Adding is all that a change costs: what has the same key is found when the table
    is read, on the days that have changes, and made one row by compaction. A row with an older
    version, or one that was added before, changes nothing, whenever it comes.
    """

    MARKS = T.StructType([T.StructField("version", T.DoubleType()), T.StructField("gone", T.BooleanType())])

    def __init__(self, spark, path, schema: T.StructType, keys=("id", "flight"), order=(), day="date"):
        kept = [f for f in schema.fields if f.name not in self.MARKS.names]
        super().__init__(spark, path, T.StructType([*kept, *self.MARKS.fields]), order, day)
        self.keys = list(keys)

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per key. Of rows of one version, the same one is taken every time."""
        others = [c for c in rows.columns if c not in (*self.keys, "version")]
        tie = F.xxhash64(*others)
        return keep_one(rows, self.keys, [F.desc_nulls_last("version"), tie])

    def _fold(self, rows: DataFrame) -> DataFrame:
        # Rows that are gone stay, as an older version of them may still come.
        return keep_one(
            rows,
            [self.day, *self.keys],
            [F.desc_nulls_last("version"), F.xxhash64(*[c for c in rows.columns if c != "version"])],
        )

    def read(self, version: int | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """One row per key. Days without changes since their compaction are only scanned."""
        state = self.state(version)
        days = set(state.days) if days is None else set(days) & set(state.days)
        folded = {d for d in days if state.is_folded(d)}
        rows = self._rows(state, folded)
        if days - folded:
            rows = rows.unionByName(self._fold(self._rows(state, days - folded)))
        return rows.where(~F.col("gone")).drop(*self.MARKS.names)


class WindowTable(LoggedTable):
    """Nearby windows as partial rows, one per window and batch, that add up when read.

    A sighting that comes late, or with a clock ahead, is one more partial row of its window, on
    the day the window ends; nothing waits for it and nothing is counted anew. Compaction makes
    the partial rows of a window one.
    """

    SCHEMA = T.StructType(
        [
            T.StructField("flight", T.StringType()),
            T.StructField("FirstSeen", T.TimestampType()),
            T.StructField("LastSeen", T.TimestampType()),
            T.StructField("nearest", T.DoubleType()),
            T.StructField("RecordCount", T.LongType()),
        ]
    )

    def __init__(self, spark, path, day="date"):
        super().__init__(spark, path, self.SCHEMA, ["flight", "LastSeen"], day)

    def _fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.day, "flight", "FirstSeen", "LastSeen").agg(
            F.min("nearest").alias("nearest"), F.sum("RecordCount").alias("RecordCount")
        )

    def read(self, version: int | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """The windows as of a version. Days that are compacted are only scanned."""
        state = self.state(version)
        days = set(state.days) if days is None else set(days) & set(state.days)
        folded = {d for d in days if state.is_folded(d)}
        rows = self._rows(state, folded)
        if days - folded:
            rows = rows.unionByName(self._fold(self._rows(state, days - folded)).select(*rows.columns))
        return rows.select(
            "flight",
            "FirstSeen",
            "LastSeen",
            F.round("nearest", 0).alias("closestDistanceInMetresFromHome"),
            "RecordCount",
        )


def day_of_key(key: str = "id") -> Column:
    """The day of the time that a document's id begins with: it stays, whatever else changes."""
    seconds = F.substring_index(F.col(key), "-", 1).try_cast("double")
    return F.to_date(F.timestamp_seconds(F.when(F.abs(seconds) < 1e11, seconds)))
