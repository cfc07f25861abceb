"""SimHash near-duplicates by anchor-point covering (operator 10).

The fingerprint has 64 bits and pairs link at up to ``3`` differing bits, so one of its two halves differs in at most
one bit. On 31 bits of each half the anchors are the words of the perfect [31, 26] Hamming code, whose covering radius
is 1: every half lies within 1 of an anchor, and each half goes to all anchors within radius plus threshold,
``1 + 1``. A linked pair therefore meets at the anchor next to either of them. There are 2^26 anchors a half, and a
half is copied to 16 of them at most, so the replication is fixed (32 rows of 16 bytes for each distinct fingerprint)
and anchors stay nearly empty unless fingerprints are alike. All rows of an anchor are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.functions.runs import run_starts, runs
from candlewright.llm._shared import arrow_limits, components, cut, split_hot, spread

THRESHOLD = 3
#: Rows of an anchor that are compared as one; the pairs of larger anchors are dealt out in tiles.
ANCHOR_ROWS = 4096
#: Shingles that are hashed at a time, which bounds memory on very long texts.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """The unsigned fingerprint of a text: bits set in over half the XXH64 (seed 42) of its word shingles.

    A-Z count as a-z and words are runs of other than ASCII white space. Fewer than ``width`` words are one shingle;
    no words, or null, give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = zip(first[at : at + SHINGLES_AT_ONCE], last[at : at + SHINGLES_AT_ONCE], strict=True)
        hashes = np.array([digest(line[i:j], 42) for i, j in part], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = (), width: int = 3) -> DataFrame:
    """Columns ``keep`` and fp, the fingerprint as a signed long; one row for each row of the input."""
    arrow_limits(df.sparkSession)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = "".join(f"_k{i} {kept.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py(), width) for x in batch.column("_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made)], names=[*batch.schema.names[:-1], "fp"])

    out = kept.mapInArrow(apply, head + "fp long")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "fp")


def syndrome(half: np.ndarray) -> np.ndarray:
    """The position, 1..31, at which 31-bit words differ from their nearest codeword; 0 for a codeword.

    Position i is column i of the code's parity check, so the syndrome is the XOR of the positions that are set.
    """
    out = np.zeros(len(half), np.int64)
    for i in range(31):
        out ^= (half >> i & 1) * (i + 1)
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index of the fingerprint): of both halves every codeword within 2 of their lower 31 bits."""
    found, index = [], []
    for side in (0, 1):
        half = (fps.view(np.uint64) >> np.uint64(32 * side)).astype(np.int64) & 0x7FFFFFFF
        s = syndrome(half)
        tag = np.int64(side) << 31
        inside = s == 0
        found.append(half[inside] | tag)
        index.append(np.flatnonzero(inside))
        off = np.flatnonzero(~inside)
        h, t = half[off], s[off]
        found.append(h ^ (1 << (t - 1)) | tag)
        index.append(off)
        for i in range(1, 32):
            j = i ^ t
            pair = i < j
            found.append(h[pair] ^ (1 << (i - 1)) ^ (1 << (j[pair] - 1)) | tag)
            index.append(off[pair])
    return np.concatenate(found), np.concatenate(index)


def _spanning(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the components of one anchor's fingerprints, one fewer than each component has members."""
    out = []
    rest = np.unique(fps)
    while len(rest) > 1:
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            for f in front:
                near |= np.bitwise_count(rest ^ f) <= THRESHOLD
            front, rest = rest[near], rest[~near]
            out.extend((int(f), int(root)) for f in front)
    return out


def links(distinct: DataFrame) -> DataFrame:
    """(u, v) signed fingerprints: enough links of ``distinct`` (fp) to join all that 3 or fewer bits connect."""
    arrow_limits(distinct.sparkSession)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 1024):
                part = fps[at : at + 1024]
                anchor, index = anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[index])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["anchor", "tile"]):
            bounds = run_starts(table, ["anchor", "tile"])
            fps = table.column("fp").to_numpy().view(np.uint64)
            sizes = np.diff(bounds)
            at = bounds[:-1][sizes == 2]
            at = at[np.bitwise_count(fps[at] ^ fps[at + 1]) <= THRESHOLD]
            u, v = [fps[at]], [fps[at + 1]]
            for k in np.flatnonzero(sizes > 2):
                if found := _spanning(fps[bounds[k] : bounds[k + 1]]):
                    pairs = np.array(found, np.uint64)
                    u.append(pairs[:, 0])
                    v.append(pairs[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    covered = spread(distinct.select("fp"), "fp").mapInArrow(cover, "anchor long, fp long")
    tiled = split_hot(covered, ["anchor"], "fp", ANCHOR_ROWS)
    dealt = tiled.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile")
    return dealt.mapInArrow(compare, "u long, v long")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3) -> DataFrame:
    """(key, fp, component, n_members): for each row the smallest key that links of up to 3 bits reach.

    Equal fingerprints are one class before any pair is looked at, so copies cost nothing. Rows with null text or no
    words have fingerprint 0 and link like others. A null key takes part; its component is the smallest key that is
    not null, or null where there is none. Repeated rows stay. An empty table gives no rows.
    """
    rows, by_fp = _groups(df, text, key, width)
    return rows.join(by_fp, "fp").select(F.col("_key").alias(key), "fp", "component", "n_members")


def _groups(df: DataFrame, text: str, key: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Tables (_key, fp) of all rows and (fp, root, component, n_members) of all fingerprints.

    ``root``, the smallest fingerprint that links reach, tells groups apart that have the same smallest key.
    """
    rows, _ = cut(fingerprints(df.select(F.col(key).alias("_key"), F.col(text).alias("_words")), "_words", ("_key",), width), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("_key").alias("least"), F.count("*").alias("n"))
    found, _ = cut(links(classes), "near")
    joined = components(found)
    linked = joined.withColumnRenamed("node", "fp").join(classes, "fp")
    heads = linked.groupBy("component").agg(F.min("least").alias("head"), F.sum("n").alias("total"))
    known = linked.select("fp", "component").join(heads, "component").select("fp", "component", "head", "total")
    by_fp = classes.join(known, "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"), F.coalesce("head", "least").alias("component"), F.coalesce("total", "n").alias("n_members"))
    by_fp, _ = cut(by_fp, "classes")
    return rows, by_fp


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 3) -> DataFrame:
    """The rows of ``df`` with one row of each component: that of the smallest key; all columns stay as they are.

    Where rows of one group repeat its smallest key, one of them stays: of the smallest fingerprint, then of the smallest
    text, then by the other columns that have an order. A key that is the smallest of several groups stays once in each.
    Rows with a null key cannot be named as the one that stays; they all stay. Keys with one row are decided by a
    join with a table of the keys that go: where Spark finds it small by its size, no text is shuffled, else each text is
    once. Only of keys that stay and have several rows are texts read again for their fingerprints.
    """
    rows, by_fp = _groups(df, text, key, width)
    near = rows.where("_key IS NOT NULL").join(by_fp, "fp")
    per_key = near.groupBy("_key").agg(F.count_if(F.col("_key") == F.col("component")).alias("_heads"), F.count("*").alias("_rows"))
    others, _ = cut(per_key.where("_heads = 0 OR _rows > 1"), "others")
    kept = df.join(others, df[key] == others["_key"], "left_anti")
    again = others.where("_heads > 0").select("_key")
    if not again.limit(1).count():
        return kept
    stay = near.where(F.col("_key") == F.col("component")).join(again, "_key").groupBy("_key", "root").agg(F.min("fp").alias("fp")).select("_key", "fp")
    own = [f"_c{i}" for i in range(len(df.columns))]
    ordered = [c for c, f in zip(own, df.schema, strict=True) if f.name != text and "map<" not in f.dataType.simpleString()]
    named = df.select(F.col(key).alias("_key"), F.col(text).alias("_words"), *[F.col(f"`{c}`").alias(o) for c, o in zip(df.columns, own, strict=True)])
    several = fingerprints(named.join(again, "_key", "left_semi"), "_words", ("_key", "_words", *own), width).join(stay, ["_key", "fp"], "left_semi")
    one = several.groupBy("_key", "fp").agg(F.min_by(F.struct(*own), F.struct("_words", *ordered)).alias("_row"))
    return kept.unionByName(one.select(*[F.col(f"_row.{o}").alias(c) for c, o in zip(df.columns, own, strict=True)]))
