"""The candle store: Parquet in a folder for each series and range of time, one row for each key, sorted by time.

A write rewrites only the ranges of time that its candles fall into, as a new snapshot. A log in ``current`` names, by
series and range, the snapshot that counts, with its number of candles and its first and last time; an entry of the log
is one small file that only one writer can make. A reader resolves the log once and never sees half of a write. A writer
that finds that another has changed one of its ranges meanwhile merges again with what that one wrote. Old snapshots
stay until ``vacuum``.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from candlewright.functions.time import floored
from candlewright.operators.gaps import presence
from candlewright.operators.series import BUCKET_BARS
from candlewright.schema import CANDLES, KEY, MINUTE_MS, PRICES, SERIES, as_candles
from candlewright.sources.files import create_once, drop_path, names_in, numbers_in, read_text

#: Bars of a range, which is what the upsert of one candle rewrites at most: about 8 MB.
RANGE_BARS = 1 << 18
#: Bars without a candle that part what the log says of a write.
SPAN_BARS = 64
#: Every so many entries of the log one holds the whole state, so that readers need no more than that.
WHOLE_EVERY = 20
#: How long what readers and writers may still need is kept.
RETENTION_MS = 24 * 3_600_000
#: How often a write is merged again before it gives up.
ATTEMPTS = 20

State = dict[str, dict[str, list]]


class Conflict(RuntimeError):
    """Another writer has changed a range that this one has merged with what was there before."""


def first_wins(candles: DataFrame, arrival: Column) -> DataFrame:
    """Within a batch the first candle of a key stays."""
    order = F.struct(arrival, *PRICES)
    return as_candles(candles.groupBy(*KEY).agg(F.min_by(F.struct(*PRICES), order).alias("_c")).select(*KEY, "_c.*"))


def last_wins(old: DataFrame, new: DataFrame) -> DataFrame:
    """Between batches the later candle of a key stays; each side has a key once."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return as_candles(both.groupBy(*KEY).agg(F.max_by(F.struct(*PRICES), "_batch").alias("_c")).select(*KEY, "_c.*"))


def in_range(candles: DataFrame, start_ts: int, end_ts: int) -> DataFrame:
    """start_ts included, end_ts not."""
    return candles.where((F.col("ts") >= start_ts) & (F.col("ts") < end_ts))


def at_or_from(candles: DataFrame, point_ts: int, from_ts: int) -> DataFrame:
    """The candle at one time and all from another on, both included; all from the first where that is not before."""
    if point_ts >= from_ts:
        return candles.where(F.col("ts") >= from_ts)
    return candles.where((F.col("ts") == point_ts) | (F.col("ts") >= from_ts))


def watermarks(candles: DataFrame) -> DataFrame:
    """(series, min_ts, max_ts, n)."""
    return candles.groupBy(*SERIES).agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("n"))


def intervals_to_fetch(marks: DataFrame, start_ts: int, end_ts: int) -> DataFrame:
    """(series, start_ts, end_ts) before and behind what a series has; a series that is up to date has none."""
    behind = marks.where(F.col("max_ts") + 1 <= end_ts).select(*SERIES, (F.col("max_ts") + 1).alias("start_ts"), F.lit(end_ts).cast("long").alias("end_ts"))
    before = marks.where(F.col("min_ts") - 1 >= start_ts).select(*SERIES, F.lit(start_ts).cast("long").alias("start_ts"), (F.col("min_ts") - 1).alias("end_ts"))
    return behind.unionByName(before)


def head_tail(candles: DataFrame, k: int) -> DataFrame:
    """The first and last ``k`` candles of each series, once each, with part = head or tail (head for both).

    Time buckets give their own first and last ones, of which a series has few, and those are ranked once more.
    """
    rows = candles.withColumn("_bucket", floored(F.col("ts"), F.col("timeframe_minutes").cast("long") * MINUTE_MS * BUCKET_BARS))

    def ends(df: DataFrame, *by: str) -> DataFrame:
        up, down = (Window.partitionBy(*SERIES, *by).orderBy(o) for o in (F.asc("ts"), F.desc("ts")))
        return df.withColumn("_up", F.row_number().over(up)).withColumn("_down", F.row_number().over(down)).where((F.col("_up") <= k) | (F.col("_down") <= k))

    return ends(ends(rows, "_bucket")).select(*KEY, *PRICES, F.when(F.col("_up") <= k, "head").otherwise("tail").alias("part"))


def _series_name(*series: Column) -> Column:
    """A name without marks that a path would escape: a digest of the series."""
    return F.md5(F.concat_ws("/", *[F.concat(F.length(k.cast("string")).cast("string"), F.lit(":"), k.cast("string")) for k in series]))


def _folder(series: list) -> str:
    return hashlib.md5("/".join(f"{len(str(k))}:{k}" for k in series).encode()).hexdigest()


@dataclass
class CandleStore:
    """Candles under ``root``, a folder that driver and executors share. Any number of readers and writers."""

    spark: SparkSession
    root: str

    def create(self) -> CandleStore:
        """The store itself; its folders come with the first write."""
        return self

    def exists(self) -> bool:
        return bool(numbers_in(self.spark, f"{self.root}/current"))

    def _entry(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/current/{version:012d}"))

    def _state(self) -> tuple[int, State]:
        """The newest version, and for each series (as JSON text) and range its [snapshot, n, min_ts, max_ts, files]."""
        versions = numbers_in(self.spark, f"{self.root}/current")
        later: list[dict] = []
        state: State = {}
        for v in reversed(versions):
            entry = self._entry(v)
            if "whole" in entry:
                state = entry["whole"]
                break
            later.append(entry)
        for entry in reversed(later):
            for series, ranges in entry["set"].items():
                state[series] = state.get(series, {}) | ranges
        return (versions[-1] if versions else 0), state

    def _point(self, seen: int, changes: State, new: dict[str, list] | None = None) -> None:
        """Let ranges point to new snapshots, if no other writer has changed one of them since version ``seen``.

        ``new`` has, by series, the [first, last] times of the runs of candles that this changes; none where only files change.
        """
        while True:
            version, state = self._state()
            for v in range(seen + 1, version + 1):
                other = self._entry(v)["set"]
                if any(r in ranges for series, ranges in changes.items() if series in other for r in other[series]):
                    raise Conflict(f"version {v} has changed the same ranges")
            seen = version
            entry: dict = {"set": changes, "new": new or {}}
            if (version + 1) % WHOLE_EVERY == 0:
                entry["whole"] = state | {series: state.get(series, {}) | ranges for series, ranges in changes.items()}
            if create_once(self.spark, f"{self.root}/current/{version + 1:012d}", json.dumps(entry, sort_keys=True)):
                return

    def _path(self, snap: str, series: str, at: str, of: str = "snapshots") -> str:
        return f"{self.root}/{of}/{snap}/series={_folder(json.loads(series))}/range={at}"

    def _read(self, pieces: list[tuple[str, str, str]]) -> DataFrame:
        """The candles of (snapshot, series, range)."""
        folders = [self._path(snap, series, at) for snap, series, at in pieces]
        return self.spark.read.schema(CANDLES).parquet(*folders) if folders else self.spark.createDataFrame([], CANDLES)

    def series(self) -> list[tuple]:
        """The series of the store, from its log."""
        return sorted(tuple(json.loads(s)) for s in self._state()[1])

    def marks(self) -> DataFrame:
        """(series, min_ts, max_ts, n) of all series, from the log: nothing is scanned."""
        rows = [(*json.loads(s), min(p[2] for p in ranges.values()), max(p[3] for p in ranges.values()), sum(p[1] for p in ranges.values())) for s, ranges in self._state()[1].items()]
        return self.spark.createDataFrame(rows, "market string, category string, symbol string, timeframe_minutes int, min_ts long, max_ts long, n long")

    def within(self, spans: list[tuple]) -> DataFrame:
        """The ranges of time that hold candles of any of ``spans`` (series, start_ts, end_ts), whole: what lies around them comes along."""
        by: dict[str, list[tuple[int, int]]] = {}
        for *s, a, z in spans:
            by.setdefault(json.dumps(s), []).append((a, z))
        state = self._state()[1]
        return self._read([(piece[0], s, at) for s, own in by.items() for at, piece in state.get(s, {}).items() if any(piece[3] >= a and piece[2] <= z for a, z in own)])

    def presence(self, minutes: int | None = None) -> DataFrame:
        """(series, range, part, bits): bitmaps of the candles that are there, kept with the watermarks; no candle is read."""
        kind = "market string, category string, symbol string, timeframe_minutes int, at long, part int, bits binary"
        pieces = [(piece[0], s, at) for s, ranges in self._state()[1].items() if minutes is None or json.loads(s)[3] == minutes for at, piece in ranges.items()]
        paths = [self._path(*p, of="presence") for p in pieces]
        return (self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)).withColumnRenamed("at", "range")

    def scan(self, where: Column | None = None, series: list[tuple] | None = None, start_ts: int | None = None, end_ts: int | None = None) -> DataFrame:
        """Candles of all series, or of those listed; a store or series that is not there has no rows.

        Only the ranges of the series asked for that reach into [start_ts, end_ts) are listed and read, and what lies
        outside of it in them is left out; ``where`` on ts goes to the Parquet scan.
        """
        wanted = None if series is None else {json.dumps(list(s)) for s in series}
        pieces = [
            (piece[0], s, at)
            for s, ranges in self._state()[1].items()
            if wanted is None or s in wanted
            for at, piece in ranges.items()
            if (start_ts is None or piece[3] >= start_ts) and (end_ts is None or piece[2] < end_ts)
        ]
        df = self._read(pieces)
        if start_ts is not None:
            df = df.where(F.col("ts") >= start_ts)
        if end_ts is not None:
            df = df.where(F.col("ts") < end_ts)
        return df if where is None else df.where(where)

    def query(self, series: tuple, start_ts: int, end_ts: int, columns: list[str] | None = None) -> DataFrame:
        """One series from start_ts up to, not including, end_ts, in the order of time; ``columns`` prunes the scan."""
        rows = self.scan(series=[series], start_ts=start_ts, end_ts=end_ts)
        return (rows if columns is None else rows.select("ts", *[c for c in columns if c != "ts"])).orderBy("ts")

    def write(self, candles: DataFrame, arrival: Column | None = None) -> DataFrame:
        """Add a batch: of a key the first in it stays, and replaces what the store has. (series, n) written.

        Rows with a null in the key are dropped. The batch is computed once, into a table that the merge reads, and only
        the ranges of time of each series that it has candles in are rewritten.
        """
        clean = as_candles(candles) if arrival is None else candles
        for k in KEY:
            clean = clean.where(F.col(k).isNotNull())
        incoming = f"{self.root}/incoming/{uuid.uuid4().hex}"
        try:
            first_wins(clean, F.lit(0) if arrival is None else arrival).withColumn("range", _range()).write.parquet(incoming)
            batch = self.spark.read.schema(StructType([*CANDLES.fields, StructField("range", LongType())])).parquet(incoming)
            per = _spans(batch).collect()  # one for each range that is written, more only where candles lie far apart in it
            touched = {(json.dumps(list(r)[:4]), str(r["range"])) for r in per}
            new: dict[str, list] = {}
            for r in per:
                new.setdefault(json.dumps(list(r)[:4]), []).append([r["a"], r["z"]])
            if touched:
                self._merge(batch.drop("range"), touched, new)
        finally:
            drop_path(self.spark, incoming)
        totals: dict[tuple, int] = {}
        for r in per:
            totals[tuple(r)[:4]] = totals.get(tuple(r)[:4], 0) + r["n"]
        return self.spark.createDataFrame([(*s, n) for s, n in totals.items()], "market string, category string, symbol string, timeframe_minutes int, n long")

    def _merge(self, batch: DataFrame, touched: set[tuple[str, str]], new: dict[str, list]) -> None:
        for _ in range(ATTEMPTS):
            seen, state = self._state()
            old = [(state[s][r][0], s, r) for s, r in touched if r in state.get(s, {})]
            changes, snap = self._written(last_wins(self._read(old), batch) if old else batch)
            try:
                return self._point(seen, changes, new)
            except Conflict:
                drop_path(self.spark, f"{self.root}/snapshots/{snap}")
                drop_path(self.spark, f"{self.root}/presence/{snap}")
        raise Conflict(f"other writers changed the same ranges {ATTEMPTS} times")

    def _written(self, rows: DataFrame) -> tuple[State, str]:
        """Write candles as a snapshot, a file for each series and range; what the log is to say of them."""
        snap = uuid.uuid4().hex
        # Files keep the series columns; the folders' names are digests of them.
        placed = rows.withColumn("series", _series_name(*[F.col(k) for k in SERIES])).withColumn("range", _range()).repartition("series", "range")
        placed.sortWithinPartitions("series", "range", "ts").write.partitionBy("series", "range").parquet(f"{self.root}/snapshots/{snap}")
        schema = StructType([*CANDLES.fields, StructField("series", StringType()), StructField("range", LongType())])
        made = self.spark.read.schema(schema).parquet(f"{self.root}/snapshots/{snap}")
        _, part, bit = presence(made, RANGE_BARS)
        parts = made.withColumn("file", F.col("_metadata.file_path")).groupBy(*SERIES, "series", "range", part).agg(
            F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("z"), F.collect_set("file").alias("files"), F.bitmap_construct_agg(bit).alias("bits"), F.first("range").alias("at")
        )
        parts.write.partitionBy("series", "range").parquet(f"{self.root}/presence/{snap}")
        parts = self.spark.read.schema(parts.schema).parquet(f"{self.root}/presence/{snap}")
        changes: State = {}
        files = F.size(F.array_distinct(F.flatten(F.collect_list("files"))))
        for r in parts.groupBy(*SERIES, "range").agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("z").alias("z"), files.alias("files")).collect():
            changes.setdefault(json.dumps(list(r)[:4]), {})[str(r["range"])] = [snap, r["n"], r["a"], r["z"], r["files"]]
        return changes, snap

    def compact(self, series: list[tuple] | None = None) -> int:
        """Rewrite the ranges that are in more than one file as one sorted file each; the candles stay as they are.

        Returns how many. A write leaves one file for each range, unless Spark was told to limit the rows of a file.
        """
        seen, state = self._state()
        wanted = None if series is None else {json.dumps(list(s)) for s in series}
        many = [(piece[0], s, at) for s, ranges in state.items() if wanted is None or s in wanted for at, piece in ranges.items() if piece[4] > 1]
        if many:
            self._point(seen, self._written(self._read(many))[0])
        return len(many)

    def changes(self, since: int, minutes: int | None = None) -> tuple[int, DataFrame]:
        """The newest version, and (series, start_ts, end_ts) of what the versions after ``since`` have written, both ends included.

        An interval for each write and range, more where a write has candles far apart. Where the log no longer goes back to ``since``, all that the store has is new.
        """
        versions = numbers_in(self.spark, f"{self.root}/current")
        found: set[tuple] = set()
        if versions and versions[0] > since + 1:
            last, state = self._state()
            found = {(*json.loads(s), piece[2], piece[3]) for s, ranges in state.items() for piece in ranges.values()}
        else:
            last = versions[-1] if versions else since
            for v in versions:
                if v > since:
                    found |= {(*json.loads(s), a, z) for s, spans in self._entry(v)["new"].items() for a, z in spans}
        rows = sorted(r for r in found if minutes is None or r[3] == minutes)
        return last, self.spark.createDataFrame(rows, "market string, category string, symbol string, timeframe_minutes int, start_ts long, end_ts long")

    def vacuum(self, retention_ms: int = RETENTION_MS) -> int:
        """Delete snapshots of ranges that were replaced more than ``retention_ms`` ago; returns how many.

        Readers need that long at most. What a vacuum has gone through is kept as a number in ``swept``, and the next one goes on from
        there; entries of the log before the last whole one that is that old go, too, so neither the log nor a vacuum's work grows with
        what was ever written. Snapshots that no entry names may belong to a writer that is about to point to them;
        they go when they are older than that and than a day.
        """
        now = time.time() * 1000
        logged = {int(n): at for n, at in names_in(self.spark, f"{self.root}/current").items() if n.isdigit()}
        swept = max(numbers_in(self.spark, f"{self.root}/swept"), default=0)
        latest: dict[tuple[str, str], str] = {}
        named: set[str] = set()
        replaced: list[tuple[str, str, str]] = []
        whole, done = 0, swept
        for v in sorted(logged):
            entry = self._entry(v)
            old = logged[v] <= now - retention_ms
            if not latest and "whole" in entry:  # the oldest entry that is left: what it replaced is swept
                latest = {(s, at): piece[0] for s, ranges in entry["whole"].items() for at, piece in ranges.items()}
            for s, ranges in entry["set"].items():
                for at, piece in ranges.items():
                    before = latest.get((s, at))
                    named.add(piece[0])
                    if before is not None and before != piece[0] and v > swept and old:
                        replaced.append((before, s, at))
                    latest[s, at] = piece[0]
            if old:
                done = max(done, v)
                whole = v if "whole" in entry else whole
        gone = sum(bool(drop_path(self.spark, self._path(*piece))) for piece in replaced)
        for piece in replaced:
            drop_path(self.spark, self._path(*piece, of="presence"))
        if done > swept:
            create_once(self.spark, f"{self.root}/swept/{done:012d}", "")
            for v in numbers_in(self.spark, f"{self.root}/swept"):
                if v < done:
                    drop_path(self.spark, f"{self.root}/swept/{v:012d}")
        for v in sorted(logged):
            if v < whole:
                drop_path(self.spark, f"{self.root}/current/{v:012d}")
        used = set(latest.values())
        named |= used | {snap for snap, _, _ in replaced}
        for snap, changed in names_in(self.spark, f"{self.root}/snapshots").items():
            orphan = snap not in named and changed <= now - max(retention_ms, RETENTION_MS)
            emptied = snap in named and snap not in used and not any(n for d, n in self._left(snap))
            if orphan or emptied:
                drop_path(self.spark, f"{self.root}/snapshots/{snap}")
                drop_path(self.spark, f"{self.root}/presence/{snap}")
        return gone

    def _left(self, snap: str) -> list[tuple[str, int]]:
        """The series folders of a snapshot and how many ranges each still has."""
        base = f"{self.root}/snapshots/{snap}"
        return [(d, len(names_in(self.spark, f"{base}/{d}"))) for d in names_in(self.spark, base) if d.startswith("series=")]


def _spans(batch: DataFrame) -> DataFrame:
    """(series, range, a, z, n): what a batch has in a range of time, in parts where it has nothing for ``SPAN_BARS`` bars."""
    apart = F.greatest(F.col("timeframe_minutes"), F.lit(1)).cast("long") * MINUTE_MS * SPAN_BARS
    blocks = batch.groupBy(*SERIES, "range", F.floor(F.col("ts") / apart).alias("_b")).agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("z"))
    order = Window.partitionBy(*SERIES, "range").orderBy("_b")
    new = blocks.withColumn("_new", (F.col("a") - F.lag("z").over(order) > apart).cast("int"))
    parts = new.withColumn("_i", F.sum(F.coalesce("_new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(*SERIES, "range", "_i").agg(F.min("a").alias("a"), F.max("z").alias("z"), F.sum("n").alias("n")).drop("_i")


def _range() -> Column:
    """The range of time of a candle, counted from 1970."""
    return F.floor(F.col("ts") / (F.greatest(F.col("timeframe_minutes"), F.lit(1)).cast("long") * MINUTE_MS * RANGE_BARS)).cast("long")
