"""The queries' results on the given tables against plain versions of the same work."""

import base64
import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from test_mixing import WORD, slow_targets
from tokenizers import Tokenizer

from candlewright.llm.queries import QUERIES

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(MORE), reason="the test tables are not here")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SMALL}/documents.parquet").set_index("doc_id")


def result(spark, name, folder=SMALL):
    return QUERIES[name](spark, folder).toPandas()


def test_token_counts_are_the_librarys(spark, docs):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    library.no_truncation()
    got = result(spark, "op3_token_counts").set_index("doc_id")
    for i, text in docs.text.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(got.loc[i]) == (len((text or "").encode()), n, n > 2048)


def test_ids_are_the_librarys(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = result(spark, "op8_byte_bpe").set_index("doc_id")
    for i, text in docs.text.items():
        ids = library.encode(text or "", disallowed_special=())
        assert tuple(got.loc[i]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_the_mix_meets_its_contract(spark, docs):
    size = {i: len(WORD.findall(t or "")) for i, t in docs.text.items()}
    source = {i: s for i, s in docs.source.items()}
    sums, taken = Counter(), Counter()
    for i, n in size.items():
        sums[source[i]] += n
    want = slow_targets(dict(sums))
    got = result(spark, "op4_mixing")
    assert sorted(got.doc_id) == sorted(size)
    for r in got.itertuples():
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sums[s]) and abs(r.target - want[s]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_fingerprints_and_components(spark, docs):
    prints = {}
    for i, text in docs.text.items():
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                p, q = sorted((find(i), find(j)))
                root[q] = p
    got = result(spark, "op10_simhash")
    assert sorted(zip(got.doc_id, got.fingerprint, got.component_id, strict=True)) == [(i, f"{prints[i]:016x}", find(i)) for i in ids]
    assert any(find(i) != i for i in ids)


def vectors(folder):
    e = pd.read_parquet(f"{folder}/embeddings.parquet")
    ok = e.embedding.map(lambda v: v is not None and len(v) > 0 and np.isfinite(np.asarray(v, float)).all() and np.any(np.asarray(v, float)))
    e = e[ok]
    x = np.stack(e.embedding.to_numpy()).astype(float)
    return e.vec_id.to_numpy(), e.label.to_numpy(), x / np.linalg.norm(x, axis=1)[:, None]


def test_neighbours_are_those_of_brute_force(spark):
    ids, _, y = vectors(MORE)
    got = result(spark, "op6_nearest", MORE)
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        along = y @ y[ids == q][0]
        others = [(-s, i) for s, i in zip(along, ids, strict=True) if i != q]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5]
        np.testing.assert_allclose(own.score, [along[ids == i][0] for i in own.vec_id], atol=1e-12)
        bar = -sorted(others)[4][0]
        hits += int((own.score >= bar - 1e-12).sum())
        total += 5
    assert hits >= 0.9 * total > 0


def test_near_vectors_with_planted_copies(spark, tmp_path):
    e = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    rng, more = np.random.default_rng(4), []
    for k, r in enumerate(e.head(40).itertuples()):
        for step in range(k % 4):
            v = np.asarray(r.embedding, np.float32)
            noise = rng.normal(size=len(v)) * np.linalg.norm(v) / len(v) ** 0.5
            more.append((10_000 + len(more), (v + noise * (0.0, 0.1, 0.15)[step]).astype(np.float32), r.label if k % 9 else None))
    cols = {"vec_id": [m[0] for m in more], "embedding": [m[1] for m in more], "label": [m[2] for m in more]}
    both = pd.concat([e[["vec_id", "embedding", "label"]], pd.DataFrame(cols)], ignore_index=True).astype({"label": "Int64"})
    both.to_parquet(f"{tmp_path}/embeddings.parquet")
    y = np.stack(both.embedding.to_numpy()).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    label = both.label.to_numpy(object, na_value=None)
    near = (y @ y.T >= 0.98) & (label[:, None] == label[None]) & np.array([x is not None for x in label])[:, None]
    np.fill_diagonal(near, False)
    component = np.arange(len(y))
    for _ in range(len(y)):
        new = np.array([min(component[i], *component[near[i]], component[i]) for i in range(len(y))])
        if (new == component).all():
            break
        component = new
    ids = both.vec_id.to_numpy()
    want = sorted((int(i), int(n), int(ids[c]), bool(ids[c] == i)) for i, n, c in zip(ids, near.sum(1), component, strict=True))
    got = result(spark, "op7_near_vectors", str(tmp_path))
    assert sorted((int(r.vec_id), int(r.n_links), int(r.component_id), bool(r.kept)) for r in got.itertuples()) == want
    assert near.sum() > 60


def test_quality_of_held_out_documents(spark):
    labels = pd.read_parquet(f"{MORE}/labels.parquet").set_index("doc_id").quality
    got = result(spark, "op5_quality", MORE)
    held = got[got.held_out & got.doc_id.isin(labels.index[labels.notna()])]
    assert set(got.held_out) == {True, False} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.itertuples())
    truth = labels.loc[held.doc_id].to_numpy(float)
    good, bad = held.score.to_numpy()[truth == 1], held.score.to_numpy()[truth == 0]
    assert len(good) > 10 and len(bad) > 5
    assert (good[:, None] > bad[None]).mean() >= 0.97 and (got.predicted == (got.score >= 0.3)).all()


def test_language_of_held_out_documents(spark):
    d = pd.read_parquet(f"{MORE}/documents.parquet").set_index("doc_id")
    got = result(spark, "op9_language_id", MORE)
    held = got[got.held_out]
    truth = d.lang.loc[held.doc_id].to_numpy()
    known = pd.notna(truth) & (held.lang_pred != "und").to_numpy()
    assert known.sum() > 100 and (held.lang_pred.to_numpy()[known] == truth[known]).mean() >= 0.98
    assert held.rejected.to_numpy()[known].mean() <= 0.01
