"""Chat formatting by columnar byte assembly (operator 2).

A turn is ``<s>role[INST]text[/INST]</s>`` and a newline. Inside roles and texts the control strings ``<s>``, ``</s>``,
``[INST]`` and ``[/INST]`` get a backslash after their first character, and a backslash is doubled, so no control
string is left there and reading turns it back. For a batch of turns the segment lengths give offsets, the offsets give
for every output byte its place in the source, and one gather fills one preallocated Arrow buffer.

A conversation is formatted in segments of ``SEGMENT_TURNS`` turn numbers, so a conversation of any length is spread
over tasks. Turn numbers that are null or repeated can give a segment any number of rows, so a task makes it in parts of
at most ``PART_ROWS`` rows and about ``PART_BYTES`` bytes, in their order, and holds no more than a part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.functions.runs import run_starts
from candlewright.llm._shared import arrow_limits

SEGMENT_TURNS = 256
#: Most rows of a part of a segment, and the bytes of roles and texts that end it.
PART_ROWS, PART_BYTES = 4096, 8 << 20
#: Segments of more bytes are copied as slices: for them an index for each byte would only cost memory.
LARGE_BYTES = 1 << 20
BEGIN, ROLE_END, TEXT_END = b"<s>", b"[INST]", b"[/INST]</s>\n"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_TURN = re.compile(rb"<s>(.*?)\[INST\](.*?)\[/INST\]</s>\n", re.S)
_ESCAPE = re.compile(rb"\\(\\?)")


def escape(column: pa.Array) -> pa.Array:
    """Texts without control strings; null becomes empty."""
    column = pc.replace_substring(pc.fill_null(column, ""), "\\", "\\\\")
    for control in CONTROLS:
        column = pc.replace_substring(column, control, f"{control[0]}\\{control[1:]}")
    return column


def unescape(text: bytes) -> bytes:
    return _ESCAPE.sub(rb"\1", text)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def assemble(roles: pa.Array, texts: pa.Array, first_turn: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """One binary value for each run of turns, and where each turn's text begins and ends in it, in bytes.

    ``first_turn`` has the turn at which each run begins, and the number of turns at the end.
    """
    roles, texts = escape(roles), escape(texts)
    fixed = np.frombuffer(BEGIN + ROLE_END + TEXT_END, np.uint8)
    role_bytes, role_at = _buffer(roles)
    text_bytes, text_at = _buffer(texts)
    source = np.concatenate([fixed, role_bytes, text_bytes])
    n = len(roles)
    begins = np.empty((n, 5), np.int64)
    sizes = np.empty((n, 5), np.int64)
    begins[:, 0], sizes[:, 0] = 0, len(BEGIN)
    begins[:, 1], sizes[:, 1] = len(fixed) + role_at[:-1], np.diff(role_at)
    begins[:, 2], sizes[:, 2] = len(BEGIN), len(ROLE_END)
    begins[:, 3], sizes[:, 3] = len(fixed) + len(role_bytes) + text_at[:-1], np.diff(text_at)
    begins[:, 4], sizes[:, 4] = len(BEGIN) + len(ROLE_END), len(TEXT_END)
    begins, sizes = begins.ravel(), sizes.ravel()
    ends = np.cumsum(sizes)
    target = ends - sizes
    total = int(ends[-1]) if n else 0
    out = pa.allocate_buffer(total)
    filled = np.frombuffer(out, np.uint8)
    large = np.flatnonzero(sizes > LARGE_BYTES)
    if not len(large):
        np.take(source, np.arange(total) + np.repeat(begins - target, sizes), out=filled)
    else:
        small = np.where(sizes > LARGE_BYTES, 0, sizes)
        within = np.arange(int(small.sum())) - np.repeat(np.cumsum(small) - small, small)
        filled[within + np.repeat(target, small)] = source[within + np.repeat(begins, small)]
        for i in large:
            filled[target[i] : ends[i]] = source[begins[i] : begins[i] + sizes[i]]
    turn_at = np.append(target[::5], total)
    run_at = turn_at[first_turn]
    made = pa.Array.from_buffers(pa.binary(), len(first_turn) - 1, [None, pa.py_buffer(run_at.astype(np.int32)), out])
    base = np.repeat(run_at[:-1], np.diff(first_turn))
    return made, target[3::5] - base, ends[3::5] - base


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, segment, part, n_turns, formatted, loss_starts, loss_ends): the text of each part of a conversation.

    The formatted conversation is the texts of its segments and their parts in their order. The loss spans are the code points of the texts
    of ``assistant`` turns, as they stand there, with escapes. Turns go by number; rows that share a number go by
    role and text, and null numbers come first. Null roles and texts are empty, null conversations are one of
    their own, repeated rows are turns again, other columns stay behind.
    """
    arrow_limits(df.sparkSession)
    rows = df.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.floor(F.coalesce(F.col(turn), F.lit(-(2**62))) / SEGMENT_TURNS).cast("long").alias("segment"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_conv", F.coalesce("conv_id", F.lit(-(2**63)))).withColumn("_null", F.col("conv_id").isNull().cast("int"))
    keys = ["_conv", "_null", "segment"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "_turn", "_role", "_text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _parts(batches, keys):
            for part in table.combine_chunks().to_batches():
                bounds = run_starts(pa.Table.from_batches([part]), keys)
                roles, texts = part.column("_role"), part.column("_text")
                made, begins, ends = assemble(roles, texts, bounds)
                assistant = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
                starts, stops = [], []
                for i, value in enumerate(made):
                    own = np.flatnonzero(assistant[bounds[i] : bounds[i + 1]]) + bounds[i]
                    data = np.frombuffer(value.as_buffer(), np.uint8)
                    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                    starts.append(points[begins[own]])
                    stops.append(points[ends[own]])
                first = pa.array(bounds[:-1])
                yield pa.RecordBatch.from_arrays([part.column("conv_id").take(first), part.column("segment").take(first), pa.array(np.full(len(first), number)), pa.array(np.diff(bounds)), made.cast(pa.string()), *(pa.array(x, pa.list_(pa.int64())) for x in (starts, stops))], names=["conv_id", "segment", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])

    return rows.mapInArrow(apply, "conv_id long, segment long, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>")


def _parts(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[int, pa.Table]]:
    """(0, table of whole runs) of sorted batches; a run that grows beyond the limits comes in parts 0, 1, ... instead."""
    held: list[pa.RecordBatch] = []
    rows = size = number = 0
    for batch in batches:
        for some in (batch.slice(at, PART_ROWS) for at in range(0, batch.num_rows, PART_ROWS)):
            bounds = run_starts(pa.Table.from_batches([some]), keys)
            same = bool(held) and all(held[-1].column(k)[-1] == some.column(k)[0] for k in keys)
            if held and (not same or rows + bounds[1] > PART_ROWS or size >= PART_BYTES):
                yield number, pa.Table.from_batches(held)
                number = number + 1 if same else 0
                held, rows, size = [], 0, 0
            if len(bounds) > 2:
                # The first run ends here and may be a later part; the last one may go on.
                yield number, pa.Table.from_batches([*held, some.slice(0, bounds[1])])
                if len(bounds) > 3:
                    yield 0, pa.Table.from_batches([some.slice(bounds[1], bounds[-2] - bounds[1])])
                held, rows, size, number = [], 0, 0, 0
            last = some.slice(bounds[-2])
            held.append(last)
            rows += last.num_rows
            size += sum(last.column(c).nbytes for c in ("_role", "_text"))
    if held:
        yield number, pa.Table.from_batches(held)


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at byte {at}")
        at = m.end()
        yield unescape(m[1]), unescape(m[2])
    if at != len(formatted):
        raise ValueError(f"no turn begins at byte {at}")


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output.

    The parts of a conversation pass in order through two running digests, so a task holds one batch of them.
    """
    arrow_limits(formatted.sparkSession)
    rows = formatted.withColumn("_null", F.col("conv_id").isNull().cast("int")).withColumn("_conv", F.coalesce("conv_id", F.lit(-(2**63))))
    rows = rows.repartition("_conv", "_null").sortWithinPartitions("_conv", "_null", "segment", "part").select("conv_id", "formatted", "loss_starts", "loss_ends")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def close(state: list) -> list:
            return [state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]]

        for batch in batches:
            done = []
            for conv, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(close(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text.encode()):
                    state[1] += 1
                    state[2].update(role + b"\n" + said + b"\n")
                for i, j in zip(starts, ends, strict=True):
                    said = unescape(text[i:j].encode())
                    state[3] += len(said.decode())
                    state[4].update(said)
                state[5] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(map(list, zip(*done, strict=True)), schema.types, strict=True)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(close(state), schema.types, strict=True)], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return rows.mapInArrow(apply, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))
