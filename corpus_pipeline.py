"""The corpus pipeline: five stages from documents to encoded documents, each a table that the next one reads."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm import langid, quality, simhash
from candlewright.llm._shared import own_dir
from candlewright.llm.byte_bpe import encode_column
from candlewright.llm.mixing import mix_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame) -> tuple[DataFrame, str, list[Column]]:
    """``docs`` under names that no operator gives to what it adds, the text's name there, and the columns as they were."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    back = [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    return docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, docs.columns, strict=True)]), names[docs.columns.index("text")], back


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels``, does not reject (score 0.3 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    named, text, back = _aside(docs)
    scored = quality.score_quality(named, quality.fit(docs, labels), text, tuple(named.columns), threshold=0.3)
    return scored.where("predicted = 1").select(*back)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; null texts, texts without letters and other languages go."""
    named, text, back = _aside(docs)
    found = langid.identify(named, langid.fit(docs), text, tuple(named.columns))
    return found.where("NOT rejected").select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that SimHash links of up to 3 bits join (3-word shingles)."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at target weights: a row for each pass over a document that takes words of it."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row of the mix with its ids, their number and digest, and the digest of the text decoded from them."""
    return encode_column(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("language id", language_filter),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix),
    ("byte-level bpe", encode),
]

#: Learned stages and hashed draws are beyond SQL; the tests hold each stage against a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{own_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
