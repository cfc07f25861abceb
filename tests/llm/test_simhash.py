import random

import numpy as np
import pytest
import xxhash
from data import clashing, doc, docs, odd_rows, words

from candlewright.llm import _shared, simhash


def slow_fingerprint(text, width=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(keyed):
    """Smallest key of each row's component, from (key, fingerprint) of all rows."""
    parent = list(range(len(keyed)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keyed)):
        for j in range(i):
            if bin(keyed[i][1] ^ keyed[j][1]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(keyed):
        r = find(i)
        if k is not None:
            least[r] = min(k, least.get(r, k))
    return [least.get(find(i)) for i in range(len(keyed))]


@pytest.mark.parametrize("text", [r[1] for r in odd_rows() if r[0] != 7] + ["A B C D", "É é", "a\u00a0b c"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = words(500, 3)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text)


def test_anchors_are_codewords_and_cover():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 2**64, 300, np.uint64)
    near = fps.copy()
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    a, ai = simhash.anchors(fps.view(np.int64))
    b, bi = simhash.anchors(near.view(np.int64))
    assert not simhash.syndrome(a & 0x7FFFFFFF).any() and np.bincount(ai).max() <= 32
    first, second = set(zip(a.tolist(), ai.tolist(), strict=True)), set(zip(b.tolist(), bi.tolist(), strict=True))
    met = {i for _, i in first & second}
    assert met == set(range(300))


def fps_frame(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")


@pytest.mark.parametrize("limit", [3, 4096])
def test_links_join_what_brute_force_joins(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", limit)
    rng = random.Random(1)
    values = {rng.getrandbits(64) for _ in range(60)}
    for base in list(values)[:8]:
        for _ in range(12):
            v = base
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    values |= {0, 1, 3, 7, 15, 31, (1 << 64) - 1}
    values = sorted(values)
    found = simhash.links(fps_frame(spark, values))
    pairs = found.collect()
    assert all(bin((p.u ^ p.v) & (2**64 - 1)).count("1") <= 3 or limit for p in pairs)
    comps = {r.node & (2**64 - 1): r.component for r in _shared.components(found).collect()}
    want = slow_components([(v, v) for v in values])
    groups, got = {}, {}
    for v, c in zip(values, want, strict=True):
        groups.setdefault(c, set()).add(v)
    for v in values:
        got.setdefault(comps.get(v, ("alone", v)), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_near_duplicates(spark):
    base = words(200, 11).split()
    edited = [" ".join([*base[:i], "zzz", *base[i + 1 :]]) for i in range(5, 195, 19)]
    rows = [*odd_rows(), *[doc(100 + i, t) for i, t in enumerate([" ".join(base), " ".join(base), *edited])], doc(60, "TWO  Words"), doc(None, None)]
    got = simhash.near_duplicates(clashing(docs(spark, rows))).collect()
    keyed = [(r[0], slow_fingerprint(r[1])) for r in rows]
    want = sorted(zip(keyed, slow_components(keyed), strict=True), key=str)
    assert sorted((((r.doc_id, r.fp & (2**64 - 1)), r.component) for r in got), key=str) == want
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_keep_one(spark):
    rows = [*odd_rows(), doc(50, words(40, 1)), doc(0, "one")]
    df = clashing(docs(spark, rows))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 1, 8, 8 and 50 are copies; 0 and 5; 2, 3 and 4 have no words.
    assert ids == sorted([0, 1, 2, 6, 7, 9, 10, 11, 12, None], key=str)
    repeated = docs(spark, [doc(3, "a b c d"), doc(3, "a b c d"), doc(4, "a b c d")])
    assert [r.doc_id for r in simhash.keep_one(repeated).collect()] == [3]


def test_keep_one_where_keys_clash(spark):
    a, b, c = words(60, 21), words(60, 22), words(60, 23)
    rows = [doc(1, a), doc(2, a), doc(2, b), doc(3, b), doc(5, c), doc(5, words(60, 24)), doc(5, c, "bb"), doc(5, c), doc(6, c)]
    kept = simhash.keep_one(docs(spark, rows)).collect()
    # 2 is a copy of 1 and the head of another group; 5 is the head of two groups and is there three times in one.
    assert sorted((r.doc_id, r.text, r.lang) for r in kept) == sorted([(1, a, "aa"), (2, b, "aa"), (5, c, "aa"), (5, words(60, 24), "aa")])


def test_components(spark):
    e = [(1, 2), (2, 3), (3, 1), (10, 11), (5, 5), (None, 4), (11, 10), *[(k, k + 1) for k in range(100, 160)], *[(200, k) for k in range(201, 260)]]
    got = {r.node: r.component for r in _shared.components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert {got[k] for k in (1, 2, 3)} == {1} and got[11] == 10 and got[5] == 5 and 4 not in got
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(200, 260)} == {200}
    assert _shared.components(spark.createDataFrame([], "u long, v long")).count() == 0
