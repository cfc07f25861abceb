"""Phrase collocation mining (operator 12).

Words of a language that occur often enough are numbered; all others break a piece, as its ends do. From each place
the ids of the words from there on go into one key of fixed width. Keys are dealt by range, radix sorted within ranges, and run
lengths count them. Pairs of words come first; then keys of five words, each of which begins with the keys of three and four
from the same place, so that run lengths of beginnings count these too. A piece is broken there between words that are no frequent pair.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm._shared import arrow_limits, cut, numbered, own_dir
from candlewright.llm._words import LOWER, byte_class, coded, first_places, runs, slices, strings, text_bytes
from candlewright.sources.files import drop_path

#: Words of the longest phrase, and the fewest occurrences of one.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of frequent words that workers may hold; beyond it words get their ids by a join.
DICTIONARY_BYTES = 32 << 20
#: Keys of a range, which one task sorts.
RANGE_KEYS = 1 << 20
#: Keys that a task sums up before it lets them go.
HELD_KEYS = 1 << 18
#: What takes a task's batches apart into ids, pieces and weights of words.
Source = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]
#: Ends of pieces; words lie between these and blanks.
ENDS = byte_class(b".,;:!?\n\v\f\r")
WORD = ~(ENDS | byte_class(b" \t"))


def _pieces(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and piece of each word; pieces of a slice have numbers that never return."""
    starts, ends, row = runs(WORD[low], offsets)
    return starts, ends, row, np.cumsum(ENDS[low])[starts] + row if len(starts) else row


def _words(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """Codes of the (language, word) pairs of a slice, the languages and words by code, and the pieces."""
    low = LOWER[data]
    starts, ends, row, piece = _pieces(low, offsets)
    words, _ = coded(strings(low, starts, ends))
    langs, names = coded(batch.column(0))
    pairs, _ = coded((langs[row] << 32) | words)
    first = first_places(pairs)
    return pairs, names.take(pa.array(langs[row[first]])), strings(low, starts[first], ends[first]), piece


def windows(ids: np.ndarray, piece: np.ndarray, longest: int = LONGEST, least: int = 2, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places where runs of ``least`` ids or more begin, and rows of ``longest`` ids from there on, 0 from where the run ends.

    Runs end with their piece and before an id of 0 and, given the sorted ``pairs`` that phrases may hold, between any others.
    """
    link = (ids[:-1] > 0) & (ids[1:] > 0) & (piece[:-1] == piece[1:])
    if pairs is not None:
        link[link] = _among(pairs, (ids[:-1][link] << 32) | ids[1:][link])
    out = np.zeros((len(ids), longest), np.uint32)
    out[:, 0] = ids
    alive = np.ones(len(ids), bool)
    for k in range(1, longest):
        n = max(len(ids) - k, 0)
        alive = alive[:n] & link[k - 1 :]
        out[:n, k][alive] = ids[k:][alive]
    at = np.flatnonzero(out[:, least - 1] > 0)
    return at, out[at]


def _among(values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among sorted values."""
    if not len(values):
        return np.zeros(len(x), bool)
    return values[np.minimum(np.searchsorted(values, x), len(values) - 1)] == x


def summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ids in order, and the sum of ``n`` of each."""
    code = rows[:, 0].astype(np.int64)
    for k in range(1, rows.shape[1]):
        code, _ = coded((code << 32) | rows[:, k].astype(np.int64))
    if rows.shape[1] == 1:
        code, _ = coded(code)
    rows, n = rows[first_places(code)], np.bincount(code, n).astype(np.int64)
    order = radix_order(rows)
    return rows[order], n[order]


def radix_order(rows: np.ndarray) -> np.ndarray:
    """The order of rows of ids, by one stable counting pass for each half of an id, the last half first."""
    order = np.arange(len(rows))
    for k in range(rows.shape[1] - 1, -1, -1):
        for half in (rows[:, k] & 0xFFFF, rows[:, k] >> 16):
            if half.any():
                order = order[np.argsort(half.astype(np.uint16)[order], kind="stable")]
    return order


def _binary(rows: np.ndarray) -> pa.Array:
    """Big-endian keys of rows of ids."""
    width = 4 * rows.shape[1]
    flat = np.ascontiguousarray(rows, dtype=">u4").view(np.uint8).reshape(len(rows), width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(flat)])


def run_lengths(rows: np.ndarray, counts: np.ndarray, least: int, shortest: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(beginnings, sums) of sorted rows for each length from ``shortest``: those of ``least`` or more, and those that reach the first or last row.

    The range before or after may hold more of the latter.
    """
    total = np.concatenate([[0], np.cumsum(counts)])
    for length in range(shortest, rows.shape[1] + 1):
        new = np.concatenate([[True], (rows[1:, :length] != rows[:-1, :length]).any(axis=1)])
        at = np.flatnonzero(new)
        n = total[np.concatenate([at[1:], [len(rows)]])] - total[at]
        some = (n >= least) | (at == 0) | (at == at[-1])
        some &= rows[at, length - 1] > 0
        yield rows[at[some], :length], n[some]


def count_words(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) of all words; a null language is ``und``, a null text has no words."""
    arrow_limits(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            pairs, langs, words, _ = _words(batch, data, offsets)
            yield pa.RecordBatch.from_arrays([langs, words.cast(pa.string()), pa.array(np.bincount(pairs))], names=["lang", "word", "n"])

    rows = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("_lang"), F.col(text).alias("_text"))
    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _by_lookup(frequent: DataFrame) -> Source:
    """Ids, pieces and weights of the words of texts, with the frequent words in every worker."""
    listed = frequent.select("id", F.concat_ws("\t", "lang", "word").alias("w")).orderBy("id").toArrow().column("w").combine_chunks()
    known = frequent.sparkSession.sparkContext.broadcast(listed)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch, data, offsets in slices(batches):
            pairs, langs, words, piece = _words(batch, data, offsets)
            # A word holds no tab, so the last one divides language and word.
            found = pc.index_in(pc.binary_join_element_wise(langs.cast(pa.string()), words.cast(pa.string()), "\t"), known.value)
            ids = pc.fill_null(pc.add(found, 1), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield ids[pairs] if len(pairs) else pairs, piece, np.ones(len(pairs), np.int64)

    return read


def _by_join(df: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, n): the ids of the words of each different piece, by a join, where the frequent words are too many for a worker."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            low = LOWER[data]
            starts, ends, row = runs(~ENDS[low], offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), strings(low, starts, ends).cast(pa.string())], names=["lang", "piece"])

    pieces = df.mapInArrow(split, "lang string, piece string").groupBy("lang", "piece").agg(F.count("*").alias("n"))
    words = pieces.select("lang", "n", F.sha2(F.col("piece").cast("binary"), 256).alias("own"), F.posexplode(F.filter(F.split("piece", "[ \t]+"), lambda w: w != "")).alias("at", "word"))
    listed = F.array_sort(F.collect_list(F.struct("at", F.coalesce(F.col("id") + 1, F.lit(0)).alias("id")))).alias("ids")
    rows = words.join(frequent.select("lang", "word", "id"), ["lang", "word"], "left").groupBy("lang", "own").agg(listed, F.first("n").alias("n"))
    return cut(rows.select("ids.id", "n"), "ids")[0]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same from a table of lists."""
    for batch in batches:
        lists, n = batch.column(0), batch.column(1).to_numpy()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        yield lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), row, n[row]


def count_runs(rows: DataFrame, read: Source, shortest: int, longest: int, least: int, pairs: np.ndarray | None = None) -> DataFrame:
    """(key, a) of the runs of ``shortest`` to ``longest`` words that occur ``least`` times or more; four bytes of a key are a word.

    Tasks sum up their keys as they go. Ranges are taken from a table of those, each is sorted in one task, and a key is in one range
    as often as tasks have seen it.
    """
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(pairs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((0, longest), np.uint32), np.zeros(0, np.int64)
        for ids, piece, weight in read(batches):
            at, new = windows(ids, piece, longest, shortest, known.value)
            held, n = summed(np.concatenate([held, new]), np.concatenate([n, weight[at]]))
            if len(held) >= HELD_KEYS:
                yield pa.RecordBatch.from_arrays([_binary(held), pa.array(n)], names=["key", "n"])
                held, n = held[:0], n[:0]
        yield pa.RecordBatch.from_arrays([_binary(held), pa.array(n)], names=["key", "n"])

    path = f"{own_dir(spark)}/keys-{uuid.uuid4().hex}"
    rows.mapInArrow(encode, "key binary, n long").write.option("compression", "zstd").parquet(path)
    keys = spark.read.schema("key binary, n long").parquet(path)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // RANGE_KEYS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        ids = np.concatenate([text_bytes(b.column(0))[0] for b in parts]).view(">u4").astype(np.uint32).reshape(-1, longest)
        own = np.concatenate([b.column(1).to_numpy() for b in parts])
        order = radix_order(ids)
        for found, a in run_lengths(ids[order], own[order], least, shortest):
            yield pa.RecordBatch.from_arrays([_binary(found), pa.array(a)], names=["key", "a"])

    found = keys.repartitionByRange(n, "key").mapInArrow(count, "key binary, a long")
    out, _ = cut(found.groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least), "runs")
    drop_path(spark, path)
    return out


def phrases(df: DataFrame, frequent: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """(key, a) of all runs of 2 to 5 words of ``frequent`` (lang, word, id) that occur ``least`` times or more.

    Pairs are counted first. Where those that are frequent fit into a worker, longer runs are looked for among them only.
    """
    arrow_limits(df.sparkSession)
    rows = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("_lang"), F.col(text).alias("_text"))
    held = frequent.agg(F.sum(F.octet_length("lang") + F.octet_length("word") + 9)).first()[0] or 0
    read = _by_lookup(frequent) if held <= dictionary_bytes else _listed
    rows = rows if held <= dictionary_bytes else _by_join(rows, frequent)
    two = count_runs(rows, read, 2, 2, least)
    pairs = None
    if 8 * two.count() <= dictionary_bytes:
        listed = two.select("key").toArrow().column("key").to_pylist()
        ids = np.frombuffer(b"".join(listed), ">u4").astype(np.int64).reshape(-1, 2)
        pairs = np.sort((ids[:, 0] << 32) | ids[:, 1])
    return two.unionByName(count_runs(rows, read, 3, LONGEST, least, pairs))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language, by score, occurrences and phrase.

    Everything is counted within a language (null: ``und``) over all texts (null: empty), overlaps included. A phrase of 2 to 5 words
    that occurs ``least`` times is cut after each of its words into parts that occur l and r times; the lowest
    ``floor(1000 * a * n / (l * r))`` counts, the shortest first part among equals. Phrases inside a longer one that occurs as often are left out.
    No rows or no frequent words give no rows; other columns stay behind.
    """
    words, _ = cut(count_words(df, text, lang), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent, _ = numbered(words.where(F.col("n") >= least), [F.col("lang").asc(), F.col("word").asc()], "frequent")
    frequent = frequent.withColumnRenamed("_number", "id")
    found = phrases(df, frequent, text, lang, least, dictionary_bytes)
    # A phrase inside a longer one that is as frequent is inside one that is a word longer and as frequent, too.
    inner = F.array(F.expr("substring(key, 1, length(key) - 4)"), F.expr("substring(key, 5)"))
    longer = found.where("length(key) > 8").select(F.explode(inner).alias("key"), "a").groupBy("key").agg(F.max("a").alias("_longer"))
    stays = found.join(longer, "key", "left").where("_longer IS NULL OR _longer < a").drop("_longer")

    word_key = F.unhex(F.lpad(F.hex(F.col("id") + 1), 8, "0"))
    by_id = frequent.select(word_key.alias("_id"), F.col("lang"), "word", F.col("n").alias("f"))
    places = stays.select("key", "a", F.posexplode(F.expr("transform(sequence(1, length(key), 4), i -> substring(key, i, 4))")).alias("at", "_id"))
    read = places.join(by_id, "_id").groupBy("key").agg(F.first("a").alias("a"), F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_w"))
    read = read.select("key", "a", "lang", F.concat_ws(" ", "_w.word").alias("phrase")).join(totals, "lang")

    parts = found.select("key", F.col("a").alias("f")).unionAll(by_id.select(F.col("_id").alias("key"), "f"))
    cuts = read.withColumn("k", F.explode(F.expr("sequence(1, length(key) div 4 - 1)")))
    cuts = cuts.withColumn("_left", F.expr("substring(key, 1, 4 * k)")).withColumn("_right", F.expr("substring(key, 4 * k + 1)"))
    cuts = cuts.join(parts.select(F.col("key").alias("_left"), F.col("f").alias("l")), "_left").join(parts.select(F.col("key").alias("_right"), F.col("f").alias("r")), "_right")
    whole = F.expr("(CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    cuts = cuts.withColumn("score", whole)
    best = cuts.groupBy("lang", "key", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b"))
    best = best.select("lang", "phrase", "a", "_b.l", "_b.r", "n", "_b.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = best.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    few = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
