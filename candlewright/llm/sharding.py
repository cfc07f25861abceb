"""Sharding by size-tiered compaction under a versioned manifest (operator 1), with DataFrame functions only.

A store is a folder: ``data`` has immutable Parquet shards, ``manifests`` a table of shards for each version, and
``commits`` one small file a version, which names its manifest. A version exists when its file does: the file is
written aside and takes a name that must be free, so of two writers one wins and the other starts again from the
new version. Readers take the files of one version and never see half of a change.

Arrivals become shards as they come, one for each of the partitions that they come in. Compaction sorts small shards
into tiers, each ``fanout`` times as large as the one below, and packs the shards of a tier, oldest first, into equal
runs of about ``target`` bytes; each run is rewritten as one shard by one task, without a shuffle. Old files stay until ``vacuum``, which also takes
away what writers left behind that never committed.

The driver handles the names of folders, of which there is one for each write, of single shards where part of a write has been
merged since, and of the ``MAX_FILES`` shards that a compaction reads at most, but no rows.
"""

from __future__ import annotations

import functools
import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType
from pyspark.sql.window import Window

from candlewright.llm._shared import cut
from candlewright.sources.files import create_once, drop_path, names_in, numbers_in, read_text

TARGET, FANOUT, LEAST = 128 << 20, 4, 1 << 20
#: Shards that one compaction reads at most; the others are for the next.
MAX_FILES = 10_000
#: Runs that one job rewrites, a task each.
RUNS = 512
#: How long files that no version names are left alone: their writer may still commit.
GRACE_MS = 24 * 3_600_000
MANIFEST = "path string, bytes long, rows long, since long, shards long"


@contextmanager
def _partitions_stay(spark: SparkSession) -> Iterator[None]:
    """A union of single partitions has one for each; otherwise Spark may put them together."""
    key = "spark.sql.unionOutputPartitioning"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass
class ShardStore:
    """A store of rows of one schema. ``root`` is a folder that driver and executors share."""

    spark: SparkSession
    root: str
    schema: StructType

    def version(self) -> int:
        """The newest version, 0 for an empty store."""
        return max(numbers_in(self.spark, f"{self.root}/commits"), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(path, bytes, rows, since, shards): the shards of a version, which one added each, and how many were added with it."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{self._named(version)}")

    def _named(self, version: int) -> str:
        return json.loads(read_text(self.spark, f"{self.root}/commits/{version:012d}"))["manifest"]

    def places(self, version: int | None = None) -> list[str]:
        """What a reader of a version opens: the folders of writes whose shards all count, and single shards of the others."""
        per = self.manifest(version).groupBy(F.substring_index("path", "/", 2).alias("folder")).agg(F.count("*").alias("n"), F.first("shards").alias("shards"), F.collect_list("path").alias("paths"))
        whole = F.when(F.col("n") == F.col("shards"), F.array("folder")).otherwise(F.col("paths"))
        return [r[0] for r in per.select(F.explode(whole)).toLocalIterator()]

    def read(self, version: int | None = None) -> DataFrame:
        paths = self.places(version)
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*[f"{self.root}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], self.schema)

    def append(self, arrivals: DataFrame) -> int:
        """Add rows as new shards; returns the version that has them. Columns go by name and must be the store's."""
        new = self._write(arrivals.select(*[F.col(f"`{c}`") for c in self.schema.names]))
        while True:
            base = self.version()
            try:
                return self._commit(base, self.manifest(base).unionByName(new.withColumn("since", F.lit(base + 1).cast("long"))))
            except Conflict:
                continue

    def small(self, target: int = TARGET) -> DataFrame:
        """The shards of the manifest that a compaction may merge."""
        return self.manifest().where(F.col("bytes") < 0.75 * target)

    def plan(self, target: int = TARGET, fanout: int = FANOUT) -> DataFrame:
        """(path, bytes, tier, run): what a compaction would rewrite. A tier waits until it has ``fanout`` shards."""
        small = self.small(target).orderBy("since", "path").limit(MAX_FILES)
        tier = F.greatest(F.lit(0), F.floor(F.log(F.col("bytes") / F.lit(LEAST)) / F.log(F.lit(fanout)))).cast("int")
        in_tier = Window.partitionBy("tier")
        in_order = in_tier.orderBy("since", "path").rowsBetween(Window.unboundedPreceding, -1)
        full = small.withColumn("tier", tier).withColumn("_n", F.count("*").over(in_tier)).withColumn("_all", F.sum("bytes").over(in_tier))
        even = F.col("_all") / F.ceil(F.col("_all") / F.lit(target))
        runs = full.where(F.col("_n") >= fanout).withColumn("_run", F.floor(F.coalesce(F.sum("bytes").over(in_order), F.lit(0)) / even))
        runs = runs.withColumn("_of", F.count("*").over(Window.partitionBy("tier", "_run"))).where("_of > 1")
        return runs.select("path", "bytes", "tier", (F.dense_rank().over(Window.orderBy("tier", "_run")) - 1).alias("run"))

    def compact(self, target: int = TARGET, fanout: int = FANOUT) -> int | None:
        """Merge tiers with enough shards; returns the new version, or None where there is nothing to merge."""
        base = self.version()
        plan, _ = cut(self.plan(target, fanout).select("path", "run"), "runs")  # at most MAX_FILES rows
        runs: dict[int, list[str]] = {}
        for r in plan.orderBy("run", "path").toLocalIterator():
            runs.setdefault(r["run"], []).append(f"{self.root}/{r['path']}")
        if not runs:
            return None
        # One task reads the shards of a run and writes one; nothing is shuffled.
        merged = [self.spark.read.schema(self.schema).parquet(*paths).coalesce(1) for paths in runs.values()]
        with _partitions_stay(self.spark):
            parts = [self._write(functools.reduce(DataFrame.unionAll, merged[i : i + RUNS])) for i in range(0, len(merged), RUNS)]
        new = functools.reduce(DataFrame.unionAll, parts)
        many, gone = sum(map(len, runs.values())), plan.select("path")
        while True:
            old = self.manifest(base)
            if old.join(gone, "path", "left_semi").count() != many:
                raise Conflict("another compaction has rewritten the same shards")
            try:
                return self._commit(base, old.join(F.broadcast(gone), "path", "left_anti").unionByName(new.withColumn("since", F.lit(base + 1).cast("long"))))
            except Conflict:
                base = self.version()

    def vacuum(self, keep: int = 1, grace_ms: int = GRACE_MS) -> int:
        """Delete shards that none of the newest ``keep`` versions has, and the older versions; returns how many shards.

        A reader needs its version kept for as long as it reads. Manifests and shards that no kept version names go with
        their versions or, where their writer never committed, when they are older than ``grace_ms``.
        """
        seen = numbers_in(self.spark, f"{self.root}/commits")
        if not seen:
            return 0
        kept, old = seen[-keep:], seen[:-keep]
        live = self.manifest(kept[0]).select("path")
        for v in kept[1:]:
            live = live.union(self.manifest(v).select("path"))
        gone = 0
        in_use = live.select(F.substring_index("path", "/", 2).alias("folder")).distinct()
        for v in old:
            dead = self.manifest(v).join(live, "path", "left_anti").select("path", F.substring_index("path", "/", 2).alias("folder"))
            partly = dead.join(in_use, "folder", "left_semi").select("path", F.lit(1).alias("n"))
            wholly = dead.join(in_use, "folder", "left_anti").groupBy("folder").agg(F.count("*").alias("n"))
            for r in partly.union(wholly).toLocalIterator():  # one call for each write of which nothing is left
                gone += r[1] * bool(drop_path(self.spark, f"{self.root}/{r[0]}"))
            drop_path(self.spark, f"{self.root}/manifests/{self._named(v)}")
            drop_path(self.spark, f"{self.root}/commits/{v:012d}")
        # Of the live shards only the names of their folders come here, of which there is one for each write.
        named = {"manifests": {self._named(v) for v in kept}, "data": {r[0] for r in live.select(F.split("path", "/")[1]).distinct().collect()}}
        bar = time.time() * 1000 - grace_ms
        for folder, names in named.items():
            for name, changed in names_in(self.spark, f"{self.root}/{folder}").items():
                if name not in names and changed < bar:
                    drop_path(self.spark, f"{self.root}/{folder}/{name}")
        return gone

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write rows as shards in a folder of their own; (path, bytes, rows) of those that hold any."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        made = self.spark.read.schema(StructType([])).parquet(f"{self.root}/{folder}")
        file = F.concat(F.lit(f"{folder}/"), F.element_at(F.split("_metadata.file_path", "/"), -1))
        shards = made.groupBy(file.alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
        return shards.crossJoin(F.broadcast(shards.agg(F.count("*").alias("shards"))))  # one row

    def _commit(self, base: int, shards: DataFrame) -> int:
        name = uuid.uuid4().hex
        shards.select("path", "bytes", "rows", "since", "shards").coalesce(1).write.parquet(f"{self.root}/manifests/{name}")
        if not create_once(self.spark, f"{self.root}/commits/{base + 1:012d}", json.dumps({"manifest": name})):
            drop_path(self.spark, f"{self.root}/manifests/{name}")
            raise Conflict(f"version {base + 1} exists")
        return base + 1


def shard_arrivals(df: DataFrame, root: str, key: str = "doc_id", arrivals: int = 4, target: int = TARGET, keep: int = 1) -> ShardStore:
    """A store of all rows of ``df``, appended in ``arrivals`` parts and compacted after every second one, until nothing merges.

    Parts are ranges of a whole-numbered key, with null keys in the last one, and go by a hash of any other key. The
    newest ``keep`` versions stay readable; what only older ones have goes between compactions. An empty table makes an empty
    store; texts, nulls in other columns and repeated rows are stored as they are, columns of any name too.
    """
    store = ShardStore(df.sparkSession, root, df.schema)
    if isinstance(df.schema[key].dataType, IntegralType):
        least, most = df.agg(F.min(key), F.max(key)).first()
        edges = [least + (most - least + 1) * i // arrivals for i in range(arrivals + 1)] if least is not None else [0] * (arrivals + 1)
        parts = [(F.col(key) >= a) & (F.col(key) < b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        parts[-1] = parts[-1] | F.col(key).isNull()
    else:
        parts = [F.pmod(F.xxhash64(key), F.lit(arrivals)) == i for i in range(arrivals)]
    for i, part in enumerate(parts):
        store.append(df.where(part))
        if i % 2 or i == arrivals - 1:
            store.vacuum(keep)
            while store.compact(target) is not None:
                store.vacuum(keep)
    return store
