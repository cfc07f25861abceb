"""Features as numeric blocks for training: warm-up nulls become NaN at this edge and nowhere before."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.operators.series import numbered
from candlewright.schema import SERIES
from candlewright.session import ship

RESERVED = ("names", "block", "timestamp")


def check_names(names: list[str]) -> list[str]:
    if clash := [n for n in names if n in RESERVED]:
        raise ValueError(f"names {clash} stand for other things in an entry")
    return names


def entry(features: DataFrame, series: tuple, names: list[str], dtype: str = "float64") -> dict:
    """One series on the driver: {names, feat (bars x columns), timestamp}. For series that fit there."""
    rows = features
    for k, v in zip(SERIES, series, strict=True):
        rows = rows.where(F.col(k) == F.lit(v))
    table = rows.select("ts", *[F.col(n).cast("double") for n in check_names(names)]).orderBy("ts").toArrow()
    feat = np.empty((table.num_rows, len(names)), dtype, order="F")
    for i, n in enumerate(names):
        feat[:, i] = np.asarray(table.column(n).to_numpy(zero_copy_only=False), np.float64)
    return {"names": list(names), "feat": feat, "timestamp": table.column("ts").to_numpy()}


def tensors(made: dict, device: str = "cpu") -> dict:
    """An entry as torch tensors over the same memory, one a column; another device copies. Needs torch."""
    import torch

    block = torch.from_numpy(made["feat"])
    block = block if device == "cpu" else block.to(device)
    return {"names": made["names"], "block": block, "timestamp": torch.from_numpy(made["timestamp"])} | {n: block[:, i] for i, n in enumerate(check_names(made["names"]))}


def blocks(features: DataFrame, names: list[str] | None = None, rows: int = 4096) -> DataFrame:
    """(series, block, n, first_ts, last_ts, data): float64 blocks of ``rows`` bars, row by row, made on the executors.

    ``data`` holds little-endian doubles, n times the number of names; NaN where a feature is null.
    """
    ship(features.sparkSession)
    names = check_names(names or [c for c in features.columns if c not in (*SERIES, "ts")])
    bars = numbered(features).withColumn("block", F.floor(F.col("bar") / rows).cast("long"))
    values = F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))) for n in names])
    packed = bars.groupBy(*SERIES, "block").agg(F.sort_array(F.collect_list(F.struct("ts", values.alias("v")))).alias("r"))
    flat = packed.select(*SERIES, "block", F.size("r").cast("long").alias("n"), F.col("r.ts")[0].alias("first_ts"), F.element_at("r.ts", -1).alias("last_ts"), F.flatten("r.v").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.asarray(x.values, "<f8").tobytes() for x in batch.column("v")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary())], names=[*batch.schema.names[:-1], "data"])

    return flat.mapInArrow(pack, "market string, category string, symbol string, timeframe_minutes int, block long, n long, first_ts long, last_ts long, data binary")


def column_sums(made: DataFrame, names: list[str], wanted: tuple[str, ...]) -> DataFrame:
    """Without ``data``: for each wanted column how many values of a block are numbers, and their sum, read from its bytes."""
    at, kept = [names.index(w) for w in wanted], [f for f in made.schema.fields if f.name != "data"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks_ = [np.frombuffer(x.as_buffer(), "<f8").reshape(-1, len(names)) for x in batch.column("data")]
            out = [batch.column(f.name) for f in kept]
            for i in at:
                out += [pa.array([int(np.count_nonzero(~np.isnan(b[:, i]))) for b in blocks_], pa.int64()), pa.array([float(np.nansum(b[:, i])) for b in blocks_], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in kept] + [x for w in wanted for x in (f"n_{w}", f"sum_{w}")])

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return made.mapInArrow(read, head + "".join(f", n_{w} long, sum_{w} double" for w in wanted))


def windows_of(made: dict, length: int, step: int = 1) -> np.ndarray:
    """Overlapping windows over an entry's block, without a copy: (windows, length, columns)."""
    feat = made["feat"]
    if len(feat) < length:
        return np.empty((0, length, feat.shape[1]), feat.dtype)
    return np.lib.stride_tricks.sliding_window_view(feat, length, axis=0).transpose(0, 2, 1)[::step]


