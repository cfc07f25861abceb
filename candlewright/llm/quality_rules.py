"""Quality rules (operator 11): counts of a text, and a log-likelihood ratio of hashed n-grams with a fixed threshold.

Runs of ``N`` bytes are hashed into ``BUCKETS`` buckets. Two multinomials, of trusted texts and
of the raw corpus, each with one more count, give each bucket a gain ``floor(1000 * ln(trusted share / raw share))``. A text's verdict is the
sum of gains over all of its runs against ``threshold`` times their number: whole numbers, so it does not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm._shared import arrow_limits
from candlewright.llm._words import BLANKLESS, byte_class, coded, ngram_codes, per_row, runs, slices

#: Bytes of an n-gram, and the bits of a bucket's number.
N, BITS = 3, 16
BUCKETS = 1 << BITS
#: An odd multiplier that spreads n-grams over 32 bits, of which the highest are the bucket.
SPREAD = 2654435761
#: Gain for each n-gram, in thousandths of a nat, from which a text is kept.
THRESHOLD = -100

#: Documents that teach the trusted multinomial at most; the raw one has all documents.
MAX_TRUSTED = 50_000

SYMBOLS = byte_class(b"#*$%&|<>")
#: Words of a window that is looked for again in the text, and the share of words in such windows that a text may have, in hundredths.
WINDOW, MOST_REPEATED, FEWEST_WORDS = 5, 20, 10


def buckets_of(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte; n-grams over a row's end are the caller's to leave out."""
    if len(data) < N:
        return np.zeros(0, np.int64)
    code = np.zeros(len(data) - N + 1, np.uint64)
    for i in range(N):
        code = (code << np.uint64(8)) | data[i : len(data) - N + 1 + i]
    return (((code * np.uint64(SPREAD)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - BITS)).astype(np.int64)


def _within(offsets: np.ndarray, length: int) -> np.ndarray:
    """Of each place whether an n-gram that starts there stays in its row."""
    inside = np.ones(max(length - N + 1, 0), bool)
    for back in range(1, N):
        edges = offsets[1:-1] - back
        inside[edges[(edges >= 0) & (edges < len(inside))]] = False
    return inside


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall into each bucket. Null texts have none.

    Each task counts its texts into one array; what reaches the driver is one row a bucket.
    """
    arrow_limits(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, data, offsets in slices(batches):
            total += np.bincount(buckets_of(data)[_within(offsets, len(data))], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = df.select(F.col(text).alias("_text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of a nat for each bucket, from the counts of both sides; buckets without raw n-grams have 0.

    Both shares have one count more, on the scale of the trusted side, so what is rare says little and what is frequent much, on
    few texts as on many. No trusted n-grams at all give no gain anywhere.
    """
    if not trusted.sum():
        return np.zeros(len(raw), np.int64)
    usual = raw * (trusted.sum() / raw.sum())
    return np.where(raw > 0, np.floor(1000 * np.log((trusted + 1) / (usual + 1))), 0).astype(np.int64)


def trusted_texts(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", max_trusted: int | None = MAX_TRUSTED) -> DataFrame:
    """Texts of the rows of ``df`` whose key ``labels`` marks 1, and nowhere 0; a key marked twice counts once, null keys never.

    Of more than ``max_trusted`` such keys about that many teach, chosen by a digest of the key; so few are broadcast, and no text is
    shuffled. None takes them all, whose texts a shuffle brings to them.
    """
    marks = labels.groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_mark")).where("_mark = 1 AND _key IS NOT NULL").select("_key")
    if max_trusted is not None:
        many = marks.count()
        draw = F.conv(F.substring(F.sha2(F.col("_key").cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("long")
        marks = F.broadcast(marks.where(draw < F.lit(min(1.0, max_trusted / max(many, 1))) * (1 << 32)))
    return df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(marks, "_key", "left_semi").select(F.col("_text").alias(text))


def fit(df: DataFrame, trusted: DataFrame, text: str = "text") -> np.ndarray:
    """Gains of all buckets, from all texts of both tables."""
    return gains(bucket_counts(trusted, text), bucket_counts(df, text))


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row's text."""
    n = len(offsets) - 1
    blankless = BLANKLESS[data]
    starts, ends, row = runs(blankless, offsets)
    line_starts, line_ends, line_row = runs(data != 0x0A, offsets)
    words_before = np.concatenate([[0], np.cumsum(blankless)])
    said = words_before[line_ends] > words_before[line_starts]
    lines = pa.Array.from_buffers(pa.large_binary(), len(line_starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(line_ends - line_starts)])), pa.py_buffer(data[data != 0x0A])])
    line_codes, _ = coded(lines)
    distinct = np.unique((line_row[said] << 32) | line_codes[said]) >> 32
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - starts)])), pa.py_buffer(data[blankless])])
    own, _ = coded((row << 32) | coded(words)[0])
    covered = np.zeros(len(row) + 1, np.int64)
    for length, at, code in ngram_codes(own, row, WINDOW):
        if length == WINDOW and len(at):
            again = at[np.bincount(code)[code] > 1]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + WINDOW, -1)
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": per_row(blankless & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_row(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_row[said], minlength=n) - np.bincount(distinct, minlength=n),
        "n_repeat_words": np.bincount(row[np.cumsum(covered[:-1]) > 0], minlength=n),
    }


def apply_rules(df: DataFrame, gain: np.ndarray, text: str = "text", keep: tuple[str, ...] = (), threshold: int = THRESHOLD) -> DataFrame:
    """Columns ``keep``, then the counts, n_grams, gain, base_failed and kept: one row for each row.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words: words between ASCII white space, code points in them,
    characters of ``#*$%&|<>``, lines with a word that equal an earlier one, words inside repeated windows of five. base_failed: fewer
    than ten words, or more than a fifth of them in repeated windows. kept: not base_failed, and gain (the sum over all n-grams) is
    ``threshold * n_grams`` or more. Null and empty texts have no words and are not kept. Equal texts get equal rows, repeated rows stay,
    and other columns stay behind, whatever their names. A task holds one batch, or one text that is longer.
    """
    spark = arrow_limits(df.sparkSession)
    known = spark.sparkContext.broadcast(gain)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = "".join(f"_k{i} {kept.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            found = measure(data, offsets)
            value = np.zeros(len(data), np.int64)
            inside = _within(offsets, len(data))
            value[: len(inside)] = np.where(inside, known.value[buckets_of(data)], 0)
            total, n = per_row(value, offsets), np.maximum(np.diff(offsets) - N + 1, 0)
            failed = (found["n_words"] < FEWEST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
            columns = [*(found[c].astype(np.int64) for c in counts), n, total, failed, ~failed & (total >= threshold * n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, columns)], names=[*batch.schema.names[:-1], *counts, "n_grams", "gain", "base_failed", "kept"])

    out = kept.mapInArrow(judge, head + "".join(f"{c} long, " for c in counts) + "n_grams long, gain long, base_failed boolean, kept boolean")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *counts, "n_grams", "gain", "base_failed", "kept")
