"""What the operators share: Arrow batch limits, tables in the shared folder, hot-group tiling and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.session import ship
from candlewright.sources.files import app_folder, drop_path, written

#: Bytes and rows of an Arrow batch that goes to a Python worker, so that two workers stay small beside the JVM.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096


def arrow_limits(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes as well as rows, and give the package to the executors' Python.

    One batch of very long texts must not fill a worker. Both settings stay in the session: plans are made after this returns.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return ship(spark)


def own_dir(spark: SparkSession) -> str:
    """The application's folder in the shared one."""
    return app_folder(spark)


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it again: ends the lineage, survives lost executors."""
    return written(df, name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt to as many tasks as shuffles have, for few rows of which many are made.

    A number that is given stays; without one, Spark merges small partitions and one task would make all.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def numbered(df: DataFrame, order: list[Column], name: str, counted: str = "true") -> tuple[DataFrame, int]:
    """``df`` with ``_number`` 0, 1, 2, ... in the given order, and how many rows the condition ``counted`` holds for.

    Rows are sorted by range, numbered within their range as they pass, and written; then each range begins where those
    before it end. One row a range reaches the driver. Rows that are equal in ``order`` come in any order.
    """
    spark = arrow_limits(df.sparkSession)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(seen, seen + batch.num_rows))], names=[*batch.schema.names, "_place"])
            seen += batch.num_rows

    ranges = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    rows, _ = cut(ranges.mapInArrow(count, f"{kind}, _place long").withColumn("_range", F.spark_partition_id()), name)
    sizes = sorted(rows.groupBy("_range").agg(F.count("*"), F.count_if(F.expr(counted))).collect())
    before, starts = 0, []
    for at, n, _ in sizes:
        starts.append((at, before))
        before += n
    offsets = spark.createDataFrame(starts, "_range int, _before long")
    return rows.join(F.broadcast(offsets), "_range").withColumn("_number", F.col("_before") + F.col("_place")).drop("_range", "_before", "_place"), sum(m for _, _, m in sizes)


def split_hot(df: DataFrame, keys: list[str], member: str, limit: int) -> DataFrame:
    """Add ``tile``, ``chunk`` and ``chunks`` (0: not dealt out).

    Rows of a key with more than ``limit`` rows are dealt to chunks, and every pair of chunks (i, j), i <= j, is the tile
    ``i * chunks + j``. Two rows of one key share at least one tile, so pairs are complete, and a tile holds about ``2 * limit`` rows
    however large its key is. ``member`` decides the chunk. Rows of other keys have the single tile 0. The large keys
    are counted into a table first: Spark then sees its size, and broadcasts it only if that is small.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    sizes, _ = cut(sizes.select(*keys, F.ceil(F.col("_n") / F.lit(limit)).cast("long").alias("_chunks")), "large")
    own = F.pmod(F.xxhash64(F.col(member)), F.col("_chunks")).cast("long")
    with_sizes = df.join(sizes, keys, "left").withColumn("_own", own)
    tiles = F.when(F.col("_chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1), lambda j: F.least(F.col("_own"), j) * F.col("_chunks") + F.greatest(F.col("_own"), j))
    )
    dealt = with_sizes.withColumn("tile", F.explode(tiles))
    return dealt.withColumn("chunk", F.coalesce("_own", F.lit(0).cast("long"))).withColumn("chunks", F.coalesce("_chunks", F.lit(0).cast("long"))).drop("_chunks", "_own")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for each node of ``edges`` (u, v): the component is its smallest node.

    Each round takes the smallest label among a node and its neighbours, then the label of that label (pointer
    jumping); a round is a table in the shared folder, so no lineage grows and a lost executor costs one round at
    most. Both steps are joins whose large keys adaptive execution splits, and a partially aggregated minimum.
    Null ends are dropped, self loops keep their node, repeated edges count once, no edges give no rows.
    """
    spark = edges.sparkSession
    kind = edges.schema["u"].dataType
    links = edges.where("u IS NOT NULL AND v IS NOT NULL").select("u", "v")
    links = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    links, links_path = cut(links, "links")
    labels, path = cut(links.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("component")), "labels")
    for _ in range(max_rounds):
        seen = links.join(labels, links["u"] == labels["node"]).select(F.col("v").alias("node"), "component")
        least = labels.unionAll(seen).groupBy("node").agg(F.min("component").alias("component"))
        jump = least.select(F.col("node").alias("at"), F.col("component").alias("root"))
        new = least.join(jump, least["component"] == jump["at"]).select("node", F.col("root").alias("component"))
        new, new_path = cut(new.join(labels.withColumnRenamed("component", "was"), "node").select("node", "component", (F.col("component") != F.col("was")).alias("moved")), "labels")
        more = bool(new.where("moved").limit(1).count())
        drop_path(spark, path)
        labels, path = new.select("node", "component"), new_path
        if not more:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    drop_path(spark, links_path)
    return labels.select(F.col("node").cast(kind), F.col("component").cast(kind))
