"""Target-distribution importance resampling (operator 13).

Features are runs of 1 to 3 words. A dictionary of distinct n-grams is counted, each string in it is hashed once, and the counts are
summed up by bucket, once for the corpus and once for the target. Each task keeps dictionaries of its own by default, since one
for the whole corpus is a shuffle of nearly all n-grams. The gain of a bucket is the logarithm of the ratio of its shares. Documents weigh the gains of their features, and the largest weights with Gumbel noise are drawn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm._shared import arrow_limits, cut, numbered
from candlewright.llm._words import LOWER, byte_class, coded, first_places, ngram_codes, runs, slices, spaced, strings

BUCKETS, LONGEST = 10_000, 3
#: Words that a document needs to be drawn, and the share that is drawn, in hundredths.
FEWEST_WORDS, PERCENT = 20, 5
#: Digits, small letters and everything beyond ASCII.
LETTERS = byte_class(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))


#: Bytes, and where each string starts and ends in them.
Strings = tuple[np.ndarray, np.ndarray, np.ndarray]


def features(data: np.ndarray, offsets: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray, Strings]]:
    """For each length of n-gram: the row and the code of each occurrence, and the distinct strings by code."""
    low = LOWER[data]
    starts, ends, row = runs(LETTERS[low], offsets)
    if not len(starts):
        return
    words, _ = coded(strings(low, starts, ends))
    text, begin, end = spaced(low, starts, ends)
    for n, at, code in ngram_codes(words, row, longest):
        if len(at):
            first = at[first_places(code)]
            yield row[at], code, (text, begin[first], end[first + n - 1])


def hashed(found: Strings, buckets: int) -> np.ndarray:
    """The bucket of each string: its UTF-8 bytes' CRC-32, modulo ``buckets``."""
    data, crc32 = found[0].tobytes(), zlib.crc32
    return np.array([crc32(data[a:b]) for a, b in zip(found[1].tolist(), found[2].tolist(), strict=True)], np.int64) % buckets


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, one_dictionary: bool = False) -> np.ndarray:
    """How many features of all texts fall into each bucket; null texts have none.

    A task counts the distinct strings of a few megabytes of text at a time, hashes each once and adds the counts up by bucket. With
    ``one_dictionary`` strings are counted over the whole corpus first, by a shuffle of all of them, and each is hashed once
    there; the counts are the same. One row a bucket reaches the driver.
    """
    arrow_limits(df.sparkSession)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches):
            for _, code, found in features(data, offsets, longest):
                yield pa.RecordBatch.from_arrays([strings(*found).cast(pa.string()), pa.array(np.bincount(code))], names=["feature", "n"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, offsets in slices(batches):
            for _, code, found in features(data, offsets, longest):
                np.add.at(total, hashed(found, buckets), np.bincount(code))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    texts = df.select(F.col(text).alias("_text"))
    if one_dictionary:
        dictionary = texts.mapInArrow(distinct, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        parts = dictionary.select((F.crc32(F.col("feature").cast("binary")) % buckets).alias("bucket"), "n")
    else:
        parts = texts.mapInArrow(by_bucket, "bucket long, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B))))`` of each of B buckets, in doubles."""
    t, s = target.astype(float), raw.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def fit(df: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Gains of all buckets from all texts of both tables."""
    return gains(bucket_counts(target, target_text, buckets, longest), bucket_counts(df, text, buckets, longest))


def weigh(df: DataFrame, gain: np.ndarray, text: str = "text", keep: tuple[str, ...] = (), longest: int = LONGEST) -> DataFrame:
    """Columns ``keep``, then n_words, n_features and weight, the sum of its features' gains, one row for each row.

    Each different string of a task's texts is hashed once, and the buckets' gains are joined to the documents' features. Null
    texts and texts without a word have no features and weight 0. Repeated rows stay, other columns stay behind.
    """
    spark = arrow_limits(df.sparkSession)
    known = spark.sparkContext.broadcast(gain)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = "".join(f"_k{i} {kept.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            n, weight, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, (row, code, found) in enumerate(features(data, offsets, longest)):
                per = known.value[hashed(found, len(known.value))]
                here = np.bincount(row, minlength=batch.num_rows)
                n += here
                words += here if not i else 0
                total = np.concatenate([[0], np.cumsum(per[code])])
                edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
                weight += total[edge[1:]] - total[edge[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(words), pa.array(n), pa.array(weight)], names=[*batch.schema.names[:-1], "n_words", "n_features", "weight"])

    out = kept.mapInArrow(apply, head + "n_words long, n_features long, weight long")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_features", "weight")


def noise(key: str, seed: int = 42) -> Column:
    """Gumbel noise of a key in thousandths: ``floor(-1000 * ln(-ln((h + 0.5) / 2^32)))``, h from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(weighed: DataFrame, key: str = "doc_id", percent: int = PERCENT, fewest: int = FEWEST_WORDS, seed: int = 42) -> DataFrame:
    """``weighed`` with score and rank: 1, 2, 3, ... for the rows drawn, null for the others.

    Of the N rows with ``fewest`` words or more, ``floor(percent * N / 100)`` are drawn, the highest scores first, equal ones by key,
    null keys first. All rows are sorted by range, and ranks come from how many lie in the ranges before; no task sees more than its range.
    """
    spread, _ = cut(weighed, "weighed")  # else ranges would be found by weighing everything twice
    scored = spread.withColumn("score", F.col("weight") + noise(key, seed)).withColumn("_out", F.col("n_words") < fewest)
    ranked, totals = numbered(scored, [F.col("_out").asc(), F.col("score").desc(), F.col(key).asc()], "ranked", "NOT _out")
    drawn = percent * totals // 100
    return ranked.withColumn("rank", F.when(~F.col("_out") & (F.col("_number") < drawn), F.col("_number") + 1)).drop("_out", "_number")
