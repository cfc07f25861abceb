"""Near-duplicate vectors by a subspace pigeonhole join (operator 7).

Unit vectors at cosine ``c`` or more are at squared distance ``2 - 2c`` or less. A fixed random rotation spreads that
distance over the dimensions, and the rotated vectors are split into blocks, each with its share of the budget in
proportion to its dimensions: a linked pair keeps within the share in at least one block. Each block is range-joined:
its first dimensions are cut into cells as wide as the block's radius, a vector goes to all cells that the ball of half
the radius around it touches, and a pair within the radius meets in the cell of its midpoint at least.

Whoever meets is checked by block distances first and exact cosine last. A pair counts only in the first block that
keeps it and there in its first common cell, so link counts add up without listing pairs, and each cell returns a
spanning set of links for the components. Equal vectors are one class with a count before all this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.functions.runs import run_starts, runs
from candlewright.llm._shared import arrow_limits, components, cut, split_hot
from candlewright.llm._vectors import compared, cosines, matrix, unit, usable

BLOCKS = 4
#: Vectors of a cell that are compared as one; the pairs of larger cells are dealt out in tiles.
CELL_ROWS = 4096
#: Rows of a label that need no more than one dimension cut into cells; each further one is for 2.2 times as many.
DENSE, THINNING = 8192, 2.2
#: The narrowest cells, so that a dimension from -1 to 1 has fewer than the 4096 that ``_pack`` can tell apart.
LEAST_WIDTH = 2.0**-10


class Blocks:
    """The rotation, the blocks and their cells for vectors of one size."""

    def __init__(self, size: int, threshold: float, cut_dims: int, seed: int = 3) -> None:
        self.size, self.threshold = size, threshold
        self.budget = max(0.0, 2 - 2 * threshold) + 1e-9
        self.rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]
        edges = np.linspace(0, size, min(BLOCKS, size) + 1).astype(int)
        self.blocks = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.shares = [self.budget * (b.stop - b.start) / size for b in self.blocks]
        self.cut_dims = min(cut_dims, min(b.stop - b.start for b in self.blocks))

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ self.rotation

    def low_cells(self, y: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest cell of each vector in each cut dimension of a block."""
        at, r = y[:, self.blocks[block].start : self.blocks[block].start + self.cut_dims], np.sqrt(self.shares[block])
        width = max(r, LEAST_WIDTH)  # cells may be wider than the radius, and their numbers must be packed
        return np.floor((at - r / 2) / width - 1e-9).astype(np.int64), np.floor((at + r / 2) / width + 1e-9).astype(np.int64)

    def cells(self, y: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, packed cell) for every cell of every vector in a block."""
        low, high = self.low_cells(y, block)
        row, cell = np.arange(len(y)), np.zeros(len(y), np.int64)
        for d in range(self.cut_dims):
            parts = []
            for step in range(int((high[:, d] - low[:, d]).max(initial=0)) + 1):
                own = low[row, d] + step <= high[row, d]
                parts.append((row[own], _pack(cell[own], low[row[own], d] + step)))
            row, cell = (np.concatenate(x) for x in zip(*parts, strict=True))
        return row, cell


def _pack(cell: np.ndarray, at: np.ndarray) -> np.ndarray:
    return cell * 4096 + at + 2048


def _compare(b: Blocks, block: int, cell: int, x: np.ndarray, n: np.ndarray, tile: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of the vectors of one cell (or tile): how many rows link to each, and for each the root of its links."""
    y = b.rotated(x)
    own = b.blocks[block]
    low = b.low_cells(y, block)[0]
    chunk, pair = tile
    links, root = np.zeros(len(x), np.int64), np.arange(len(x))
    norms = (y[:, own] ** 2).sum(1)
    for at in range(0, len(x), 256):
        rows = np.arange(at, min(at + 256, len(x)))
        near = norms[rows][:, None] + norms[None] - 2 * y[rows][:, own] @ y[:, own].T <= b.shares[block] + 1e-12
        near &= rows[:, None] < np.arange(len(x))[None]
        i, j = np.nonzero(near)
        i = rows[i]
        if pair is not None:  # a pair of one chunk is also in that chunk's tiles with others
            keep = (chunk[i] != chunk[j]) | (chunk[i] == pair[0]) & (pair[0] == pair[1])
            i, j = i[keep], j[keep]
        first = np.zeros(len(i), np.int64)
        for d in range(b.cut_dims):
            first = _pack(first, np.maximum(low[i, d], low[j, d]))
        keep = first == cell
        i, j = i[keep], j[keep]
        for earlier in range(block):
            part = b.blocks[earlier]
            keep = ((y[i, part] - y[j, part]) ** 2).sum(1) > b.shares[earlier]
            i, j = i[keep], j[keep]
        for lo in range(0, len(i), 1 << 14):
            p, q = i[lo : lo + (1 << 14)], j[lo : lo + (1 << 14)]
            keep = cosines(x[p], x[q]) >= b.threshold
            p, q = p[keep], q[keep]
            links += np.bincount(p, n[q], len(x)).astype(np.int64) + np.bincount(q, n[p], len(x)).astype(np.int64)
            _unite(root, p, q)
    while np.any(root[root] != root):
        root = root[root]
    return links, root


def _unite(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    while True:
        a, b = root[p], root[q]
        keep = a != b
        if not keep.any():
            return
        p, q, a, b = p[keep], q[keep], a[keep], b[keep]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while np.any(root[root] != root):
            root[:] = root[root]


def near_vectors(df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) for each row: rows of one label at cosine ``threshold`` or more are linked.

    n_links counts the other rows that are linked to a row directly, component_id is the smallest key that links
    reach, kept says that it is the row's own. Rows with a null label or an unusable vector (null, zero, with null or
    non-finite components) link with nothing; vectors of different sizes do not link. A null key takes part but is no
    component_id, and is not kept. Rows that repeat a key are rows of their own. An empty table gives no rows.
    """
    spark = arrow_limits(df.sparkSession)
    rows = df.select(F.col(key).alias("_key"), F.col(label).alias("_label"), compared(df, vector).alias("_v"))
    able = F.col("_label").isNotNull() & usable(F.col("_v"))
    classes = rows.where(able).groupBy("_label", "_v").agg(F.min("_key").alias("least"), F.count("*").alias("n"))
    classes, _ = cut(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    dense = classes.groupBy("_label").count().agg(F.max("count")).first()[0] or 0
    sizes = [r[0] for r in classes.select(F.size("_v")).distinct().orderBy(F.size("_v")).collect()]
    # Of isotropic vectors about one in THINNING shares a cell of one dimension.
    cut_dims = int(min(5, 1 + max(0, np.ceil(np.log(max(1, dense / DENSE)) / np.log(THINNING)))))
    label_codes = F.xxhash64("_label")
    parts = [_links_of_size(classes.where(F.size("_v") == size).select("cid", "n", label_codes.alias("lab"), "_v"), Blocks(size, threshold, cut_dims)) for size in sizes]
    if not parts:
        return rows.select(F.col("_key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("_key").cast("long").alias("component_id"), F.col("_key").isNotNull().alias("kept"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    found, _ = cut(found, "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("cid <> root").select(F.col("cid").alias("u"), F.col("root").alias("v")))
    known = classes.join(joined.withColumnRenamed("node", "cid"), "cid")
    heads = known.groupBy("component").agg(F.min("least").alias("head"))
    known = known.join(heads, "component").select("cid", "head")
    per_class = classes.join(counts, "cid", "left").join(known, "cid", "left")
    per_class = per_class.select("_label", "_v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("head", "least").alias("component_id"))
    linked = rows.where(able).join(per_class, ["_label", "_v"]).select("_key", "n_links", "component_id")
    alone = rows.where(~able).select("_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"))
    return linked.unionByName(alone).select(F.col("_key").alias(key), F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"), F.coalesce(F.col("_key") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links_of_size(classes: DataFrame, blocks: Blocks) -> DataFrame:
    """(cid, links, root) of every cell in which a class has a link; classes has cid, n, lab, _v."""
    keys = ["lab", "block", "cell"]
    names = ["lab", "block", "cell", "cid", "n", "_v"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                y = blocks.rotated(matrix(some.column("_v"), blocks.size))
                for block in range(len(blocks.blocks)):
                    row, cell = blocks.cells(y, block)
                    pick = pa.array(row)
                    yield pa.RecordBatch.from_arrays([some.column("lab").take(pick), pa.array(np.full(len(row), block)), pa.array(cell), *(some.column(c).take(pick) for c in ("cid", "n", "_v"))], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, [*keys, "tile"]):
            bounds = run_starts(table, [*keys, "tile"])
            block, cell, tile, chunks, cid, n = (table.column(c).to_numpy() for c in ("block", "cell", "tile", "chunks", "cid", "n"))
            column = table.column("_v").combine_chunks()
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                of = (table.column("chunk").slice(lo, hi - lo).to_numpy(), divmod(int(tile[lo]), int(chunks[lo]))) if chunks[lo] else (None, None)
                links, root = _compare(blocks, int(block[lo]), int(cell[lo]), matrix(column.slice(lo, hi - lo), blocks.size), n[lo:hi], of)
                some = np.flatnonzero(links)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(cid[lo:hi][some]), pa.array(links[some]), pa.array(cid[lo:hi][root[some]])], names=["cid", "links", "root"])

    placed = classes.mapInArrow(place, f"lab long, block long, cell long, cid long, n long, _v {classes.schema['_v'].dataType.simpleString()}")
    tiled = split_hot(placed, keys, "cid", CELL_ROWS)
    dealt = tiled.repartition(*keys, "tile").sortWithinPartitions(*keys, "tile")
    return dealt.mapInArrow(join, "cid long, links long, root long")
