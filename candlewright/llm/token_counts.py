"""Token counts of whole texts (operator 3): the lengths only, from batches that are balanced by bytes."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm._shared import arrow_limits

#: Characters of new parts that one call of the tokenizer gets, and of the texts that are cut together.
CALL_CHARS, GROUP_CHARS = 1 << 18, 1 << 18
#: Patterns of words, single digits and marks, and of English endings; no match of theirs holds white space.
BLANKLESS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)
#: Parts whose counts a worker remembers, and the longest of them.
KNOWN_PARTS, KNOWN_CHARS = 300_000, 64


def safe_parts(text: str) -> list[str]:
    """The parts of a text between ASCII blanks and line ends; white space itself has no tokens.

    No token, special token or normal form goes past one, for tokenizers that drop white space before they merge.
    """
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def drops_blanks(spec: dict) -> bool:
    """Whether a tokenizer file lets texts be cut at blanks: nothing in it keeps white space or looks past it.

    Normal forms must go character by character, the first pre-tokenizer must drop white space, and no added token may
    have any inside or around it. Files that say anything else are taken to need whole texts.
    """
    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part.get(inner, []) if part.get("type") == "Sequence" else [part]

    def harmless(step: dict) -> bool:
        blanks = step.get("type") == "Replace" and step.get("pattern") == {"Regex": "\\s+"} and step.get("content") == " "
        return blanks or step.get("type") in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents")

    first = next(iter(steps(spec.get("pre_tokenizer"), "pretokenizers")), {})
    # A pattern whose matches alone are kept, none of which can hold white space.
    pattern = first.get("pattern", {}).get("Regex", " ")
    kept = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and pattern in BLANKLESS
    added = all(not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") and t["content"].split() == [t["content"]] for t in spec.get("added_tokens") or [])
    return added and (kept or first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")) and all(map(harmless, steps(spec.get("normalizer"), "normalizers")))


class JsonCounter:
    """Counts of a ``tokenizers`` file, special strings as its default says, nothing added, cut off or padded.

    Texts are cut at blanks where ``drops_blanks`` allows it, and else encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as file:
            self.cuts = drops_blanks(json.load(file))
        self.known: dict[str, int] = {"": 0}

    def _encode(self, parts: list[str]) -> Iterator[tuple[str, int]]:
        """Counts of parts, from batches of about equal size."""
        batch, held = [], 0
        for part in parts:
            batch.append(part)
            held += len(part)
            if held >= CALL_CHARS:
                yield from zip(batch, map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)), strict=True)
                batch, held = [], 0
        if batch:
            yield from zip(batch, map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)), strict=True)

    def __call__(self, texts: list[str]) -> list[int]:
        """Counts of whole texts: their parts', each different one of which is encoded once."""
        if not self.cuts:
            return [n for _, n in self._encode(texts)]
        cut = [safe_parts(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        long = dict(self._encode([p for p in new if len(p) > KNOWN_CHARS]))
        if len(self.known) + len(new) > KNOWN_PARTS:
            self.known = {"": 0}
            new = set().union(*cut).difference(self.known)
        self.known.update(self._encode([p for p in new if len(p) <= KNOWN_CHARS]))
        if not long:
            return [sum(map(self.known.__getitem__, parts)) for parts in cut]
        return [sum(self.known[p] if len(p) <= KNOWN_CHARS else long[p] for p in parts) for parts in cut]


class PieceCounter:
    """Counts of a sentencepiece file. Its normaliser joins blanks over a cut, so texts are not cut."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)

    def __call__(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.sp.encode(texts, num_threads=1)]


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = (), limit: int = 2048) -> DataFrame:
    """Columns ``keep``, then n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. One row for each row of the input, repeated rows too; other
    columns stay behind, whatever their names. ``path`` names a tokenizer file that every executor has.
    """
    arrow_limits(df.sparkSession)
    kept = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    head = "".join(f"_k{i} {kept.schema[i].dataType.simpleString()}, " for i in range(len(keep)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = JsonCounter(path) if path.endswith(".json") else PieceCounter(path)
        for batch in batches:
            texts = batch.column("_text")
            tokens: list[int] = []
            group: list[str] = []
            held = 0
            for value in texts:
                group.append(value.as_py() or "")
                held += len(group[-1])
                if held >= GROUP_CHARS:
                    tokens += count(group)
                    group, held = [], 0
            tokens += count(group)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n_bytes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], names=[*batch.schema.names[:-1], "n_bytes", "n_tokens", "over_limit"])

    out = kept.mapInArrow(apply, head + "n_bytes long, n_tokens long, over_limit boolean")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens", "over_limit")
