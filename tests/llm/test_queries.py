"""The operators' queries on the smallest tables: columns, and their SQL where there is some."""

import glob
import os

import duckdb
import pytest

from candlewright.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
COLUMNS = {
    "op2_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op3_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op4_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_near_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op12_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op13_importance": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


def test_there_are_thirteen():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == k for c, k in COLUMNS.get(name, {}).items())
    rows = df.collect()
    table = {"op2_chat": None, "op6_nearest": None, "op7_near_vectors": "embeddings", "op12_collocations": None}.get(name, "documents")
    assert rows if table is None else len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    made = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in made.description]
    want = sorted(str(dict(zip(names, r, strict=True))[c]) for r in made.fetchall() for c in sorted(names))
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(r[c]) for r in df.collect() for c in sorted(names)) == want
