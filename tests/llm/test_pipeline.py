"""Stages on the smallest tables: what each keeps, and that the results hang together."""

import hashlib
import os

import numpy as np
import public_tokenizers as P
import pytest
from data import clashing, docs, odd_rows

import corpus_pipeline
from candlewright.llm import langid, quality, simhash
from candlewright.llm.byte_bpe import ByteBpe, read_ranks
from candlewright.llm.mixing import mix_report

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        made = spark.read.parquet(f"{folder}/{i}")
        out.append((docs, made))
        docs = made
    return out


def test_quality_stage(spark, stages):
    docs, made = stages[0]
    assert made.columns == COLUMNS
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in quality.score_quality(docs, model, keep=("doc_id",)).collect() if r.score >= 0.3}
    assert {r.doc_id for r in made.collect()} == want and 0 < len(want) < docs.count()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(k in want for k, q in truth.items() if q == 1)


def test_language_stage(stages):
    docs, made = stages[1]
    assert made.columns == COLUMNS
    model = langid.fit(docs)
    rows = docs.collect()
    rejected = model.predict([r.text for r in rows])[3]
    assert {r.doc_id for r in made.collect()} == {r.doc_id for r, x in zip(rows, rejected, strict=True) if not x}
    assert made.count() >= 0.99 * docs.count()


def test_dedup_stage(stages):
    docs, made = stages[2]
    assert made.columns == COLUMNS
    rows = docs.collect()
    prints = [(r.doc_id, simhash.fingerprint(r.text)) for r in rows]
    left = sorted(prints)
    kept = set()
    while left:  # flood one group after another, from its smallest id
        group = [left.pop(0)]
        kept.add(group[0][0])
        for _, f in group:
            near = [p for p in left if bin(p[1] ^ f).count("1") <= 3]
            group.extend(near)
            left = [p for p in left if p not in near]
    assert {r.doc_id for r in made.collect()} == kept and len(kept) < len(rows)


def test_mixing_stage(stages):
    docs, made = stages[3]
    assert made.columns == COLUMNS
    taken = {r.doc_id: r.taken for r in mix_report(docs).collect()}
    got = dict.fromkeys(taken, 0)
    for r in made.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == taken


def test_encoding_stage(stages):
    docs, made = stages[4]
    bpe = ByteBpe(read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    texts = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())
    rows = made.collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in rows) == texts
    for r in rows:
        packed = np.array(r.ids, "<u4").tobytes()
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert hashlib.sha256(bpe.decode(packed)).hexdigest() == r.decoded_sha256


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, tmp_path, stage):
    """Nulls, empty and long texts, repeated rows and columns named as the stages name theirs; and no rows at all."""
    name, apply = corpus_pipeline.STAGES[stage]
    rows = odd_rows()
    for i, given in enumerate((rows, [])):
        clashing(docs(spark, given)).write.parquet(f"{tmp_path}/{i}")
        df = spark.read.parquet(f"{tmp_path}/{i}")
        out = apply(spark, df, SF)
        if stage < 4:
            assert out.columns == df.columns, name
        got = out.collect()
        ids = [r.doc_id for r in got]
        assert set(ids) <= {r[0] for r in given}
        if not given:
            assert not got
        elif stage == 4:
            assert len(got) == len(rows) and next(r for r in got if r.doc_id == 2).n_tokens == 0
        elif stage == 3:
            assert not {2, 3, 4} & set(ids) and None in ids  # without words there is nothing to take
        elif stage == 2:
            # 2, 3 and 4 have fingerprint 0; 1 and both rows of 8 are copies; a null key always stays.
            assert {1, 2, 5, 6, 7, None} <= set(ids) and not {3, 4, 8} & set(ids) and len(ids) == len(set(ids))
        elif stage == 1:
            assert not {2, 3, 4} & set(ids)


def test_run_is_the_stages_in_turn(spark, stages):
    got = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect())
    assert got == sorted((r.doc_id, r.ids_sha256) for r in stages[-1][1].select("doc_id", "ids_sha256").collect())
