"""Quality rules, collocations and importance resampling against plain Python over odd and made rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from data import DOCS, clashing, doc, docs, odd_rows, words

from candlewright.llm import importance, quality_rules
from candlewright.llm._words import coded, first_places, ngram_codes, runs
from candlewright.llm.collocations import collocations, radix_order, windows

BLANKLESS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow_counts(text):
    text = text or ""
    own = BLANKLESS.findall(text)
    five = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    inside = {i + k for i in range(len(own) - 4) if five[tuple(own[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if BLANKLESS.search(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def slow_bucket(raw):
    return (((raw[0] << 16 | raw[1] << 8 | raw[2]) * 2654435761) & 0xFFFFFFFF) >> 16


def slow_gains(trusted, raw):
    def counts(texts):
        return Counter(slow_bucket(t[i : i + 3]) for t in (x.encode() for x in texts if x) for i in range(len(t) - 2))

    t, r = counts(trusted), counts(raw)
    ts, rs = sum(t.values()), sum(r.values())
    return {b: math.floor(1000 * math.log((t[b] + 1) / (r[b] * (ts / rs) + 1))) for b in r}


REPEATS = [
    doc(20, "a b c d e a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    doc(21, "a a a a a a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9"),
    doc(22, "one line here\none line here\n \n \nlast | # * line\none line here \n" + words(30, 3)),
    doc(23, "a\tb\nc d\x0be x a b c\rd e " + words(30, 4)),
    doc(24, words(5, 1) + "\x1c" + words(5, 2) + "\x85 " + words(20, 3)),
]


@pytest.mark.parametrize("parts", [1, 3])
def test_rules(spark, parts):
    rows = odd_rows() + REPEATS
    df = clashing(docs(spark, rows)).repartition(parts)
    trusted = [r for r in rows if r[0] in (1, 8, 11)]
    gain = quality_rules.fit(df, docs(spark, trusted))
    plain = slow_gains([r[1] for r in trusted], [r[1] for r in rows])
    assert {b: int(gain[b]) for b in plain} == plain
    got = sorted(map(tuple, quality_rules.apply_rules(df, gain, keep=("doc_id", "_text"), threshold=-200).collect()), key=str)
    want = []
    for i, text, *_ in rows:
        n = slow_counts(text)
        raw = (text or "").encode()
        value = [plain[slow_bucket(raw[at : at + 3])] for at in range(len(raw) - 2)]
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        want.append((i, "mine", *n, len(value), sum(value), failed, not failed and sum(value) >= -200 * len(value)))
    assert got == sorted(want, key=str)
    assert {r[0] for r in got if r[-2]} >= {20, 2, 3}


def test_rules_tell_junk_from_prose(spark):
    good = [doc(i, words(80, i, random.Random(i).choice(["aa", "bb", "cc"]))) for i in range(200)]
    junk = [doc(1000 + i, " ".join(w.upper() + "$$$" for w in words(80, 500 + i).split())) for i in range(40)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 2)] + [(2, 0), (None, 1)] + [(1000 + i, 0) for i in range(20)], "doc_id long, quality int")
    df = docs(spark, good + junk)
    trusted = quality_rules.trusted_texts(df, labels)
    assert trusted.count() == 99 == quality_rules.trusted_texts(df, labels, max_trusted=None).count()  # not the one that is marked both ways
    assert 25 < quality_rules.trusted_texts(df, labels, max_trusted=50).count() < 75
    got = {r.doc_id: r.kept for r in quality_rules.apply_rules(df, quality_rules.fit(df, trusted), keep=("doc_id",)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(40))


def test_rules_without_rows_or_trust(spark):
    none = spark.createDataFrame([], DOCS)
    assert quality_rules.apply_rules(none, quality_rules.fit(none, none), keep=("doc_id",)).count() == 0
    some = docs(spark, [doc(1, words(40, 1))])
    assert quality_rules.apply_rules(some, quality_rules.fit(some, none)).first()["kept"]


def slow_phrases(rows, least, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            f.update((lang, tuple(own[i : i + k])) for k in range(1, 6) for i in range(len(own) - k + 1))
    sure = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in sure.items():
        inside = any(g == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in sure.items())
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n[lang]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n, -score) for lang, found in out.items() for i, (score, a, p, left, right, n) in enumerate(sorted(found)[:top]))


def phrase_rows():
    rng = random.Random(3)
    vocabulary = [*"abcdefgh", "New", "york", "city", "é", " ", "x\x85y"]
    made = []
    for i in range(120):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " new york city hall ", "\x0c"]) for _ in range(rng.randint(0, 60)))
        made.append(doc(i, text, rng.choice(["en", "fr", None, "und", ""])))
    return [*made, *made[:7], *odd_rows(), doc(900, "the end " * 3000, "en")]


@pytest.mark.parametrize("lookup", [True, False])
def test_collocations(spark, lookup):
    rows = phrase_rows()
    df = clashing(docs(spark, rows)).repartition(5)
    got = sorted(map(tuple, collocations(df, least=12, dictionary_bytes=1 << 20 if lookup else 0).collect()))
    want = slow_phrases(rows, 12)
    assert got == want and len(got) > 30


def test_collocations_top_and_none(spark):
    rows = phrase_rows()
    got = sorted(map(tuple, collocations(docs(spark, rows), least=12, top=3).collect()))
    assert got == slow_phrases(rows, 12, 3)
    assert collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations(docs(spark, [doc(1, None), doc(2, "rare words only")])).count() == 0


def test_scores_pass_64_bits(spark, monkeypatch):
    from candlewright.llm import collocations as module

    # Counts as a very large corpus has them, in place of those of the two texts.
    big = 3_000_000_000
    real = module.count_words
    monkeypatch.setattr(module, "count_words", lambda *a: real(*a).selectExpr("lang", "word", f"n * {big} AS n"))
    real_phrases = module.phrases
    monkeypatch.setattr(module, "phrases", lambda *a: real_phrases(*a).selectExpr("key", f"a * {big} AS a"))
    rows = [doc(1, "p q, p r, p q, s", "en")] * 60
    got = list(map(tuple, module.collocations(docs(spark, rows)).collect()))
    assert got == [(*r[:3], r[3] * big, r[4] * big, r[5] * big, r[6] * big, r[7]) for r in slow_phrases(rows, 100)]


def test_radix_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 1 << 17, (5000, 5)).astype(np.uint32) * rng.integers(0, 2, (5000, 5)).astype(np.uint32)
    order = radix_order(rows)
    assert [tuple(r) for r in rows[order]] == sorted(map(tuple, rows))


def test_windows_end_at_rare_words_and_pieces():
    ids, piece = np.array([1, 2, 0, 3, 4, 5, 6, 7, 8]), np.array([0, 0, 0, 0, 0, 1, 1, 1, 1])
    at, got = windows(ids, piece, 3)
    assert at.tolist() == [0, 3, 5, 6, 7] and got.tolist() == [[1, 2, 0], [3, 4, 0], [5, 6, 7], [6, 7, 8], [7, 8, 0]]
    assert windows(ids, piece, 3, 3)[1].tolist() == [[5, 6, 7], [6, 7, 8]]
    pairs = np.array([(5 << 32) | 6, (6 << 32) | 7])
    assert windows(ids, piece, 4, 2, pairs)[1].tolist() == [[5, 6, 7, 0], [6, 7, 0, 0]]
    assert windows(ids[:0], piece[:0], 4, 2, pairs)[1].tolist() == []


def test_ngram_codes_stay_in_their_group():
    words_, group = np.array([5, 6, 5, 6, 5, 6]), np.array([0, 0, 0, 1, 1, 1])
    made = {n: [tuple(words_[i : i + n]) for i in at[first_places(code)]] for n, at, code in ngram_codes(coded(words_)[0], group, 3)}
    assert made == {1: [(5,), (6,)], 2: [(5, 6), (6, 5)], 3: [(5, 6, 5), (6, 5, 6)]}
    assert [x.tolist() for x in runs(np.array([1, 1, 0, 1, 1], bool), np.array([0, 1, 1, 4, 5]))] == [[0, 1, 3, 4], [1, 2, 4, 5], [0, 2, 2, 3]]


def slow_features(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return len(own), [" ".join(own[i : i + k]) for k in (1, 2, 3) for i in range(len(own) - k + 1)]


def slow_resample(rows, target):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s = Counter(bucket(f) for r in rows for f in slow_features(r[1])[1])
    t = Counter(bucket(f) for x in target for f in slow_features(x)[1])
    ss, ts = sum(s.values()), sum(t.values())
    scored = []
    for i, text, *_ in rows:
        n, found = slow_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ss + 10000) / ((s[b] + 1) * (ts + 10000)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in scored if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = rank + 1
    return sorted((tuple(r[:5]) for r in scored), key=str)


@pytest.mark.parametrize("parts", [1, 4])
def test_importance(spark, parts):
    rows = odd_rows() + [doc(100 + i, words(15 + i % 30, i % 50, ("aa", "bb", "cc")[i % 3])) for i in range(150)] + [doc(-i, "İ K \x80 ab1 AB1 " * i) for i in range(1, 6)]
    target = [words(30, 4, "bb"), None, "", "Ünï ab1 ab1"]
    df = clashing(docs(spark, rows)).repartition(parts)
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    weighed = importance.weigh(df, importance.fit(df, benchmark), keep=("doc_id",))
    got = importance.resample(weighed).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=str) == slow_resample(rows, target)


def test_one_dictionary_or_many(spark):
    df = docs(spark, odd_rows() + [doc(50 + i, words(40, i % 9)) for i in range(30)]).repartition(3)
    many = importance.bucket_counts(df)
    assert many.sum() > 3000 and (many == importance.bucket_counts(df, one_dictionary=True)).all()


def test_importance_without_rows(spark):
    none = spark.createDataFrame([], DOCS)
    gain = importance.fit(none, none)
    assert not gain.any() and len(gain) == importance.BUCKETS
    assert importance.resample(importance.weigh(none, gain, keep=("doc_id",))).count() == 0
    one = importance.resample(importance.weigh(docs(spark, [doc(1, None)]), gain, keep=("doc_id",))).first()
    assert (one["n_features"], one["weight"], one["rank"]) == (0, 0, None)
