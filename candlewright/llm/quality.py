"""Quality by attention-based multiple-instance learning (operator 5).

A document is a bag of passages, of which only the bag has a label. Every passage of the whole text is encoded: the
shares of its byte classes, of pairs of neighbouring classes and of repeated words go through a learned tanh layer. A gated attention
layer, ``w . (tanh(V h) * sigmoid(U h))``, weighs the passages, and a logistic layer scores the weighted mean of their
codes. All layers are learned together, by numpy on the driver, from a bounded sample of labelled documents whose
passage features Spark computes; the sample is chosen by a hash of the ids from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm._shared import arrow_limits

#: Bytes of a passage; a text ends with a shorter one.
PASSAGE = 1024
#: Most documents, and most passages of all of them together, that training sees. Scoring sees all passages.
MAX_DOCS, MAX_PASSAGES = 4000, 96_000
HIDDEN, GATES = 24, 12
#: Passages that are encoded at a time.
AT_ONCE = 1024


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The fine class of each byte (letters, each ASCII mark, ...) and the coarse one that pairs are made of."""
    fine, coarse = np.zeros(256, np.int64), np.zeros(256, np.int64)
    marks = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            fine[b], coarse[b] = 26 + (b >= 0xC0), 4
        elif c.islower():
            fine[b], coarse[b] = b - ord("a"), 0
        elif c.isupper():
            fine[b], coarse[b] = 28, 1
        elif c.isdigit():
            fine[b], coarse[b] = 29, 2
        elif c in " \t\r\n\v\f":
            fine[b], coarse[b] = 30 + (c == "\n"), 3 + 2 * (c == "\n")
        elif b in marks:
            fine[b], coarse[b] = 33 + marks.index(b), 6 + (c in ".,;:'\"-()")
        else:
            fine[b], coarse[b] = 32, 8
    return fine, coarse


FINE, COARSE = _classes()
N_FINE, N_COARSE = int(FINE.max()) + 1, int(COARSE.max()) + 1
#: Shares of repeated words, the number of words and their length.
N_WORDS = 5
FEATURES = N_FINE + N_COARSE * N_COARSE + N_WORDS
_BLANK = np.isin(np.arange(256), list(b" \t\r\n\v\f"))
_WEIGHTS = np.random.default_rng(1).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def word_features(part: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Of each passage: shares of words like the one before, like the one two before, and seen earlier; count, length."""
    new = np.ones(len(part), bool)
    new[1:] = owner[1:] != owner[:-1]
    letter = ~_BLANK[part]
    start = letter.copy()
    start[1:] &= ~letter[:-1] | new[1:]
    out = np.zeros((n, N_WORDS))
    at = np.flatnonzero(start)
    if not len(at):
        return out
    word = np.cumsum(start) - 1
    inside = np.flatnonzero(letter)
    place = inside - at[word[inside]]
    value = (part[inside].astype(np.uint64) + np.uint64(1)) * _WEIGHTS[np.minimum(place, 63)]
    hashes = np.add.reduceat(value, np.searchsorted(inside, at))
    own = owner[at]
    total = np.maximum(np.bincount(own, minlength=n), 1)
    for k in (1, 2):
        same = np.flatnonzero((hashes[k:] == hashes[:-k]) & (own[k:] == own[:-k])) + k
        out[:, k - 1] = np.bincount(own[same], minlength=n) / total
    order = np.lexsort((hashes, own))
    again = order[1:][(hashes[order][1:] == hashes[order][:-1]) & (own[order][1:] == own[order][:-1])]
    out[:, 2] = np.bincount(own[again], minlength=n) / total
    out[:, 3] = np.log1p(total) / 8
    out[:, 4] = np.minimum(np.bincount(owner[inside], minlength=n) / total / 16, 4)
    return out


def passage_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Square roots of class and pair shares of passages, given as ranges of bytes that follow each other."""
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    part = data[starts[0] : ends[-1]] if len(starts) else data[:0]
    singles = np.bincount(owner * N_FINE + FINE[part], minlength=len(starts) * N_FINE).reshape(-1, N_FINE)
    c = COARSE[part]
    inside = owner[1:] == owner[:-1]
    pairs = np.bincount((owner[1:] * N_COARSE + c[:-1])[inside] * N_COARSE + c[1:][inside], minlength=len(starts) * N_COARSE**2).reshape(-1, N_COARSE**2)
    shares = np.concatenate([singles / np.maximum(lengths, 1)[:, None], pairs / np.maximum(lengths - 1, 1)[:, None], word_features(part, owner, len(starts))], axis=1)
    return np.sqrt(shares).astype(np.float32)


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text column, and start, end and row of each passage; a null or empty text has none."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    n = -(-sizes // PASSAGE)
    row = np.repeat(np.arange(len(sizes)), n)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[row] + rank * PASSAGE
    return data, starts, np.minimum(starts + PASSAGE, offsets[row + 1]), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """The layers, and the arithmetic of a bag: sums over its passages, so a bag may come in parts."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        shape = {"E": (FEATURES, HIDDEN), "V": (HIDDEN, GATES), "U": (HIDDEN, GATES), "w": (GATES,), "o": (HIDDEN,)}
        self.p = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in shape.items()} | {"e": np.zeros(HIDDEN), "b": np.zeros(1)}
        self.mean, self.scale, self.prior = np.zeros(FEATURES), np.ones(FEATURES), 0.5

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Codes, both gates and the attention's exponential of passages. The gates bound it: no shift is needed."""
        p = self.p
        h = np.tanh((x - self.mean) / self.scale @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return h, v, u, np.exp((v * u) @ p["w"])

    def score(self, weighted: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of bags from the sums of weight times code and of weights; a bag without passages has the prior."""
        z = weighted / np.maximum(weight, 1e-300)[:, None]
        return np.where(weight > 0, _sigmoid(z @ self.p["o"] + self.p["b"][0]), self.prior)

    def train(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray, epochs: int = 60, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
        """Adam on the bags' cross-entropy. Passages of a bag follow each other; bag i has label i."""
        self.mean, self.scale = x.mean(0), x.std(0) + 0.02
        self.prior = float(label.mean())
        rng, p = np.random.default_rng(seed), self.p
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        edge = np.searchsorted(bag, np.arange(len(label) + 1))
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(label))
            for at in range(0, len(order), 128):
                pick = order[at : at + 128]
                rows = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in pick])
                own = np.repeat(np.arange(len(pick)), edge[pick + 1] - edge[pick])
                if not len(rows):
                    continue
                g = self._gradient(x[rows], own, label[pick])
                step += 1
                lr = rate * (1 - epoch / epochs)
                for k in p:
                    d = g[k] + decay * p[k]
                    first[k] += 0.1 * (d - first[k])
                    second[k] += 0.001 * (d * d - second[k])
                    p[k] = p[k] - lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, own: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(label)
        scaled = (x - self.mean) / self.scale
        h, v, u, e = self.encode(x)
        total = np.maximum(np.bincount(own, e, n), 1e-300)
        a = e / total[own]
        z = np.zeros((n, HIDDEN))
        np.add.at(z, own, a[:, None] * h)
        dy = (_sigmoid(z @ p["o"] + p["b"][0]) - label) / n
        dz = dy[:, None] * p["o"]
        da = (dz[own] * h).sum(1)
        ds = a * (da - np.bincount(own, a * da, n)[own])
        dv = ds[:, None] * u * p["w"] * (1 - v * v)
        du = ds[:, None] * v * p["w"] * u * (1 - u)
        dh = (a[:, None] * dz[own] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"E": scaled.T @ dh, "e": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ ds, "o": z.T @ dy, "b": dy.sum(keepdims=True)}


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES) -> Model:
    """A model from about ``max_docs`` keys of ``df`` that ``labels`` marks 0 or 1, all of them where there are fewer.

    Held-out rows (crc32 of the key as text divisible by 5), null keys, texts and labels do not take part, and a key
    that ``labels`` marks twice counts with its smallest label. A key teaches once, whatever rows repeat it: by its
    smallest text that is not empty, and by all of that text. Keys are taken in the order of their hash for as long as their
    passages are no more than ``max_passages`` together, which the driver gets; one that does not fit any more is passed over.
    """
    spark = arrow_limits(df.sparkSession)
    marks = labels.where(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0).where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"))
    many = marks.count()
    if not many:
        return Model()
    grain = 1 << 24
    marks = marks.where(F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(grain)) < min(1.0, max_docs / many) * grain)
    rows = df.where(F.col(text) != "").select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(marks), "_key")
    rows = rows.groupBy("_key").agg(F.min("_text").alias("_text"), F.min("_label").alias("_label"))
    # Whole bags, as many as fit: about ``max_docs`` rows of a key and a number come here.
    sizes = rows.select("_key", F.xxhash64(F.col("_key").cast("string")).alias("h"), F.ceil(F.octet_length("_text") / PASSAGE).alias("n")).orderBy("h", "_key").collect()
    if sum(r["n"] for r in sizes) > max_passages:
        left, fit_in = max_passages, []
        for r in sizes:
            if r["n"] <= left:
                left -= r["n"]
                fit_in.append((r["_key"],))
        rows = rows.join(F.broadcast(spark.createDataFrame(fit_in, rows.select("_key").schema)), "_key", "left_semi")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, row = passages(batch.column("_text"))
            for i in np.unique(row):
                own = np.flatnonzero(row == i)
                x = np.concatenate([passage_features(data, starts[part], ends[part]) for part in np.split(own, range(AT_ONCE, len(own), AT_ONCE))])
                yield pa.RecordBatch.from_arrays([batch.column("_key").slice(i, 1), batch.column("_label").slice(i, 1), pa.array([x.tobytes()], pa.binary())], names=["k", "y", "x"])

    key_type = df.schema[key].dataType.simpleString()
    sample = rows.select("_key", F.col("_label").cast("int").alias("_label"), "_text").mapInArrow(features, f"k {key_type}, y int, x binary").orderBy("k", "x").toArrow()
    if not sample.num_rows:
        return Model()
    bags = [np.frombuffer(v.as_py(), np.float32).reshape(-1, FEATURES) for v in sample.column("x")]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return Model().train(np.concatenate(bags), bag, sample.column("y").to_numpy().astype(float))


def score_quality(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = (), threshold: float = 0.3) -> DataFrame:
    """Columns ``keep``, then score (0 to 1) and predicted (1 where score >= ``threshold``), one row for each row.

    Every passage of a whole text counts. Null and empty texts have no passage and get the share of label 1 among
    the rows learned from. Equal texts get equal scores; other columns stay behind, whatever their names.
    """
    spark = arrow_limits(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = "".join(f"_k{i} {kept.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, starts, ends, row = passages(batch.column("_text"))
            weighted, weight = np.zeros((batch.num_rows, HIDDEN)), np.zeros(batch.num_rows)
            for at in range(0, len(row), AT_ONCE):
                own = row[at : at + AT_ONCE]
                h, _, _, e = known.encode(passage_features(data, starts[at : at + AT_ONCE], ends[at : at + AT_ONCE]))
                lo, n = own[0], own[-1] - own[0] + 1
                weight[lo : lo + n] += np.bincount(own - lo, e, n)
                np.add.at(weighted, own, e[:, None] * h)
            score = known.score(weighted, weight)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    out = kept.mapInArrow(apply, head + "score double, predicted int")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score", "predicted")
