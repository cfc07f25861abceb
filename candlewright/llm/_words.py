"""Words, n-grams and distinct strings of a text column, by numpy over the bytes of an Arrow batch.

The classes of bytes that words are made of are ASCII in every contract here, so UTF-8 is never taken apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time, as long as single texts are no longer.
AT_ONCE = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(members: bytes, outside: bool = False) -> np.ndarray:
    """A table that tells of each byte whether it is one of ``members``, or with ``outside`` whether it is none."""
    return np.isin(np.arange(256), list(members)) != outside


#: Bytes of words between ASCII white space.
BLANKLESS = byte_class(b" \t\n\v\f\r", outside=True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins and the last one ends; null is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = -1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``AT_ONCE`` bytes of text, or of one longer text, with the bytes and offsets of column ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + AT_ONCE, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of true bytes; a run ends with its row."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets[1:], starts, "right")


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte ranges as an Arrow array of strings, copied by one gather."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[index])])


def coded(values: pa.Array | np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes from 0 in order of first appearance, and the distinct values."""
    found = pc.dictionary_encode(values if isinstance(values, pa.Array) else pa.array(values))
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def first_places(codes: np.ndarray) -> np.ndarray:
    """Where each code appears first, for codes in order of first appearance."""
    so_far = np.maximum.accumulate(codes)
    return np.flatnonzero(np.diff(so_far, prepend=-1) > 0)


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between any two, and where each starts and ends there: n-grams are ranges of it."""
    lengths = ends - starts
    new = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    out = np.full(int(lengths.sum()) + len(starts), 0x20, np.uint8)
    move = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[move + np.repeat(new, lengths)] = data[move + np.repeat(starts, lengths)]
    return out, new, new + lengths


def ngram_codes(codes: np.ndarray, group: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, starts, codes) for n = 1 to ``longest``: where n-grams start that stay within one group, and their codes.

    Equal codes of one n are equal n-grams. A longer one is the code of the one before it and its last word.
    """
    at, held = np.arange(len(codes)), codes
    yield 1, at, held
    for n in range(2, longest + 1):
        fits = at + n - 1 < len(codes)
        at, held = at[fits], held[fits]
        fits = group[at] == group[at + n - 1]
        at, held = at[fits], held[fits]
        held, _ = coded((held << 32) | codes[at + n - 1])
        yield n, at, held


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value of each byte over each row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
