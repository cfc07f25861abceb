"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm import chat, importance, langid, quality, quality_rules
from candlewright.llm._shared import own_dir
from candlewright.llm.ann import nearest
from candlewright.llm.byte_bpe import encode_column
from candlewright.llm.collocations import collocations
from candlewright.llm.embedding_dedup import near_vectors
from candlewright.llm.mixing import mix_report
from candlewright.llm.sharding import shard_arrivals
from candlewright.llm.simhash import near_duplicates
from candlewright.llm.token_counts import count_tokens


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _held_out() -> Column:
    return (~F.coalesce(langid.training_row("doc_id"), F.lit(True))).alias("held_out")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = shard_arrivals(_read(spark, sf_dir, "documents"), f"{own_dir(spark)}/shards-{uuid.uuid4().hex}")
    return store.read().select("doc_id", "lang", "source", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -1L AS conv_id, turn, role, text FROM VALUES (0L, 'user', :said), (1L, 'assistant', :said) AS t(turn, role, text)", args={"said": said})
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_chat(rows))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id",), limit=2048)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(_read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = quality.score_quality(docs, quality.fit(docs, _read(spark, sf_dir, "labels")), keep=("doc_id",), threshold=0.3)
    return found.select("doc_id", _held_out(), "score", "predicted")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_read(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_column(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=("doc_id",), with_ids=False)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs), keep=("doc_id",))
    return found.select("doc_id", _held_out(), "lang_pred", "score", "cross_entropy", "rejected")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"), "n_members")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    gain = quality_rules.fit(docs, quality_rules.trusted_texts(docs, _read(spark, sf_dir, "labels")))
    return quality_rules.apply_rules(docs, gain, keep=("doc_id",))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    weighed = importance.weigh(docs, importance.fit(docs, _read(spark, sf_dir, "benchmark")), keep=("doc_id",))
    return importance.resample(weighed).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_chat": op2_chat,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_nearest": op6_nearest,
    "op7_near_vectors": op7_near_vectors,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_quality_rules": op11_quality_rules,
    "op12_collocations": op12_collocations,
    "op13_importance": op13_importance,
}

#: The template's escapes, in DuckDB.
_ESCAPED = "replace(replace(replace(replace(replace({0}, chr(92), chr(92) || chr(92)), '<s>', '<' || chr(92) || 's>'), '</s>', '<' || chr(92) || '/s>'), '[INST]', '[' || chr(92) || 'INST]'), '[/INST]', '[' || chr(92) || '/INST]')"

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": "SELECT doc_id, lang, source, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256 FROM documents",
    "op2_chat": f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(21 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id""",
    "op11_quality_rules": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, encode(coalesce(text, '')) AS raw FROM documents),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
marks AS (
    SELECT doc_id FROM good
    WHERE CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) < least(1.0::DOUBLE, 50000::DOUBLE / (SELECT count(*) FROM good)) * 4294967296),
words AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos, word
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
        FROM (SELECT doc_id, regexp_split_to_array(text, '[\x20\x09-\x0D]+') AS w FROM docs)) WHERE word <> ''),
windows AS (
    SELECT doc_id, pos, word, lead(pos, 4) OVER o IS NOT NULL AS whole,
        word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
again AS (SELECT *, whole AND count(*) OVER (PARTITION BY doc_id, five) > 1 AS repeated FROM windows),
covered AS (SELECT doc_id, word, max(repeated) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM again),
per_word AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (WHERE inside) AS n_repeat_words FROM covered GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
per_line AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
octets AS (SELECT doc_id, list_transform(regexp_extract_all(hex(raw), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM docs),
grams AS MATERIALIZED (
    SELECT doc_id, ((unnest(list_transform(range(1, len(b) - 1), lambda i: b[i] * 65536 + b[i + 1] * 256 + b[i + 2])) * 2654435761) & 4294967295) >> 16 AS bucket
    FROM octets),
raw AS (SELECT bucket, count(*) AS r FROM grams GROUP BY bucket),
trusted AS (SELECT bucket, count(*) AS t FROM grams SEMI JOIN marks USING (doc_id) GROUP BY bucket),
sums AS (SELECT (SELECT CAST(sum(r) AS DOUBLE) FROM raw) AS rs, (SELECT CAST(sum(t) AS DOUBLE) FROM trusted) AS ts),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) / (CAST(r AS DOUBLE) * (ts / rs) + 1))) AS BIGINT) AS g
    FROM raw LEFT JOIN trusted USING (bucket), sums),
scored AS (SELECT doc_id, count(*) AS n_grams, CAST(sum(g) AS BIGINT) AS gain FROM grams JOIN gain USING (bucket) GROUP BY doc_id),
found AS (
    SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_grams, 0) AS BIGINT) AS n_grams, coalesce(gain, 0) AS gain
    FROM docs LEFT JOIN per_word USING (doc_id) LEFT JOIN per_line USING (doc_id) LEFT JOIN scored USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND gain >= -100 * n_grams AS kept
FROM found""",
    "op12_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(p) AS piece, unnest(range(len(p))) AS pos
    FROM (SELECT lang, doc_id, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents)),
listed AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (
    SELECT lang, k, array_to_string(w[i + 1:i + k], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i FROM listed, (VALUES (1), (2), (3), (4), (5)) AS lengths(k))),
f AS (SELECT lang, phrase, k, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k AS words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
longer AS (
    SELECT DISTINCT s.lang, s.phrase
    FROM candidates s JOIN candidates b ON s.lang = b.lang AND s.words < b.words AND 100 * b.a >= 100 * s.a AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
cuts AS (
    SELECT c.lang, c.phrase, a, n, pos, l.f AS l, r.f AS r, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, words)) AS pos FROM candidates ANTI JOIN longer USING (lang, phrase)) c
    JOIN totals USING (lang)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.pos], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.pos + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000""",
    "op13_importance": r"""
WITH crc AS (SELECT list(list_reduce(range(1, 9), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), v) ORDER BY v) AS t FROM range(256) AS r(v)),
texts AS (SELECT 's' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
listed AS (
    SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM texts),
features AS (
    SELECT side, id, array_to_string(w[i + 1:i + k], ' ') AS feature
    FROM (SELECT side, id, w, k, unnest(range(len(w) - k + 1)) AS i FROM listed, (VALUES (1), (2), (3)) AS lengths(k))),
counted AS (SELECT side, id, feature, count(*) AS n FROM features GROUP BY ALL),
hexed AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted)),
hashed AS (
    SELECT feature, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM hexed, crc),
placed AS (SELECT side, id, bucket, n FROM counted JOIN hashed USING (feature)),
buckets AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 's'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS t FROM placed GROUP BY bucket),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT CAST(sum(s) AS DOUBLE) FROM buckets) + 10000) / ((CAST(s AS DOUBLE) + 1) * ((SELECT CAST(sum(t) AS DOUBLE) FROM buckets) + 10000)))) AS BIGINT) AS g
    FROM buckets),
weighed AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM placed JOIN gain USING (bucket) WHERE side = 's' GROUP BY id),
scored AS (
    SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS long_enough,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM listed LEFT JOIN weighed USING (id) WHERE side = 's'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY long_enough) AS many FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND place <= 5 * many // 100 THEN place END AS rank
FROM ranked""",
}
