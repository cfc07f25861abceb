"""Byte-level BPE encoding and decoding through sentencepiece (operator 8).

A rank file (base64 token, rank) becomes a sentencepiece BPE model: every byte is one printable character, a token is
the piece of its characters, its score is the negative rank, and normalisation is the identity. Sentencepiece then
joins the pair with the best score first, which is the rank order. Texts are cut by the vocabulary's pattern before,
and each match is encoded separately. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from candlewright.llm._shared import arrow_limits

#: Characters of a text that are matched and encoded at a time.
PIECE_CHARS = 1 << 18
#: Matches that a worker remembers with their ids.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 64
#: No match goes past a blank that stands between two ASCII letters, so a long text can be cut before it.
_SAFE = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def byte_characters() -> list[str]:
    """For each byte a printable character: itself where Latin-1 prints it, else the next free one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    chars = {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [chars[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model; piece 0 is the unknown piece, piece ``i + 1`` the i-th token by rank."""
    table = {b: c for b, c in enumerate(byte_characters())}
    model = proto.ModelProto()
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=token.decode("latin-1").translate(table), score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    spec = model.trainer_spec
    spec.model_type, spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = proto.TrainerSpec.BPE, 0, -1, -1, -1
    spec.vocab_size = len(model.pieces)
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder of one vocabulary in one process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.table = {b: c for b, c in enumerate(byte_characters())}
        self.by_piece = [rank for _, rank in sorted(ranks.items(), key=lambda x: x[1])]
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.known: dict[str, bytes] = {}

    def _ids(self, matches: set[str]) -> dict[str, bytes]:
        """Ids of matches, packed as little-endian 32-bit integers. A match that is a token is that token."""
        made, rest = {}, []
        for m in matches:
            rank = self.ranks.get(m.encode())
            if rank is None:
                rest.append(m)
            else:
                made[m] = struct.pack("<I", rank)
        if rest:
            mapped = [m.encode().decode("latin-1").translate(self.table) for m in rest]
            for m, ids in zip(rest, self.sp.encode(mapped, out_type=int, num_threads=1), strict=True):
                made[m] = struct.pack(f"<{len(ids)}I", *(self.by_piece[i - 1] for i in ids))
        return made

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text, part by part."""
        for part in safe_parts(text):
            matches = self.find(part)
            long: dict[str, bytes] = {}
            if new := set(matches).difference(self.known):
                if len(self.known) + len(new) > CACHE_ENTRIES:
                    self.known.clear()
                    new = set(matches)
                long = self._ids({m for m in new if len(m) > CACHE_CHARS})
                self.known.update(self._ids(new.difference(long)))
            yield b"".join(map((self.known | long if long else self.known).__getitem__, matches))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed)))


def safe_parts(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode_column(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = (), with_ids: bool = True) -> DataFrame:
    """Columns ``keep``, then n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array of int).

    Null texts are empty: no ids, and the digests of no bytes. Every row of the input gives one row, in no order;
    repeated rows stay, other columns do not come along unless named, however they are called. ``path`` names a rank
    file that every executor has.
    """
    arrow_limits(df.sparkSession)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = ", ".join(f"_k{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    schema = (head + ", " if head else "") + "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(read_ranks(path), pattern)
        for batch in batches:
            lengths, digests, decoded, ids = [], [], [], []
            for value in batch.column("_text"):
                count, sha, back, parts = 0, hashlib.sha256(), hashlib.sha256(), []
                for packed in bpe.encode(value.as_py() or ""):
                    count += len(packed) // 4
                    sha.update(packed)
                    back.update(bpe.decode(packed))
                    if with_ids:
                        parts.append(packed)
                lengths.append(count)
                digests.append(sha.hexdigest())
                decoded.append(back.hexdigest())
                if with_ids:
                    ids.append(b"".join(parts))
            out = [*batch.columns[:-1], pa.array(lengths, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                ends = pa.array([0, *accumulate(lengths)], pa.int32())
                out.append(pa.ListArray.from_arrays(ends, pa.array(memoryview(b"".join(ids)).cast("i") if ids else [], pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names[:-1], *["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out) - batch.num_columns + 1]])

    out = kept.mapInArrow(apply, schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *out.columns[len(keep) :])
