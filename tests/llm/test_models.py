import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from data import clashing, doc, docs, odd_rows, words

from candlewright.llm import langid, quality


def slow_symbols(text):
    out = [" "] * 3
    for c in (text or "").lower():
        s = c if c.isalpha() else " "
        if s != " " or out[-1] != " ":
            out.append("�" if ord(s) > 0xFFFF else s)
    return out


def slow_model(texts):
    """Kneser-Ney by dictionaries, for one language: a function (history of 3, symbol) -> probability."""
    counts = {4: Counter()}
    for t in texts:
        s = slow_symbols(t)
        counts[4].update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    return counts


def slow_probability(counts, size, history, symbol):
    p = 1.0 / (size + 1)
    for k in (1, 2, 3, 4):
        c = counts[k]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = n1 / (n1 + 2 * n2) if n1 else 0.5
        h = tuple(history[4 - k :]) if k > 1 else ()
        total = sum(v for g, v in c.items() if g[:-1] == h)
        kinds = sum(g[:-1] == h for g in c)
        if total:
            p = max(c.get((*h, symbol), 0) - d, 0) / total + d * kinds / total * p
    return p


TRAIN = {"aa": [words(12, i) for i in range(4)], "bb": [words(12, i, "bb") for i in range(4)]}


def model():
    lang, key, n = [], [], []
    for i, texts in enumerate(TRAIN.values()):
        codes, _, scored = langid.symbols(texts)
        keys, c = np.unique(langid.grams(codes, np.flatnonzero(scored)), return_counts=True)
        lang.append(np.full(len(keys), i))
        key.append(keys)
        n.append(c)
    return langid.Model(list(TRAIN), np.concatenate(lang), np.concatenate(key), np.concatenate(n))


@pytest.mark.parametrize("text", [words(6, 50), words(6, 51, "bb"), "kqz Ö!? xx", "a\0b 𝒳 c", "Kato  kato\n"])
def test_entropies_are_those_of_kneser_ney(text):
    m = model()
    symbols = {s for t in TRAIN.values() for x in t for s in slow_symbols(x)}
    s = slow_symbols(text)
    got = m.entropies([text])[0][0]
    for i, texts in enumerate(TRAIN.values()):
        counts = slow_model(texts)
        want = -sum(math.log(slow_probability(counts, len(symbols), s[j - 3 : j], s[j])) for j in range(3, len(s))) / (len(s) - 3)
        assert got[i] == pytest.approx(want, rel=1e-4)


def test_hash_arrays_are_sorted_and_one_to_one():
    m = model()
    assert all((np.diff(h.astype(np.float64)) >= 0).all() and len(np.unique(h)) == len(h) for h in m.hashes.values())


def test_batches_do_not_matter(monkeypatch):
    m = model()
    texts = [words(5, i) for i in range(9)] + [None, "", "..."]
    whole = m.predict(texts)
    monkeypatch.setattr(langid, "WINDOW", 7)
    one = [m.predict([t]) for t in texts]
    assert whole[0] == [x[0][0] for x in one]
    np.testing.assert_allclose(whole[1], [x[1][0] for x in one], atol=1e-6)
    assert whole[0][-3:] == ["und"] * 3 and list(whole[1][-3:]) == [0, 0, 0] and whole[3][-3:].all()


def corpus(n=240):
    return [doc(i, words(15 + i % 30, 1000 + i, k), k) for i in range(n) for k in [("aa", "bb", "cc")[i % 3]]]


def test_language_id_held_out(spark):
    rows = corpus()
    df = clashing(docs(spark, [*rows, *[(r[0], r[1], None if r[0] in (7, 10) else r[2], r[3], r[4]) for r in odd_rows() if r[0] is None or r[0] < 0]]))
    m = langid.fit(df)
    assert m.langs == ["aa", "bb", "cc"] and np.isfinite(m.limits).all()
    got = langid.identify(df, m, keep=("doc_id",)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id is not None and __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 and not r.rejected for r in held)
    odd = docs(spark, [doc(1, None), doc(2, "123 !?"), doc(3, ""), doc(4, "qxzj wvkq xzqj jxqz vqxz zzxq qqjx")])
    by = {r.doc_id: r for r in langid.identify(odd, m, keep=("doc_id",)).collect()}
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and all(by[k].score == 0 and by[k].rejected for k in (1, 2, 3))
    assert by[4].rejected and by[4].lang_pred in m.langs


def test_language_id_edges(spark):
    assert langid.fit(docs(spark, [])).langs == []
    unlabelled = docs(spark, [doc(i, "abc", None) for i in range(20)])
    m = langid.fit(unlabelled)
    got = langid.identify(unlabelled, m, keep=("doc_id",)).collect()
    assert len(got) == 20 and {(r.lang_pred, r.score, r.rejected) for r in got} == {("und", 0.0, True)}
    m = langid.fit(docs(spark, corpus(60)))
    rows = odd_rows()
    assert langid.identify(clashing(docs(spark, rows)), m, keep=("doc_id",)).count() == len(rows)
    assert langid.identify(docs(spark, []), m).count() == 0


def test_small_languages_teach_and_take_the_widest_limit(spark, monkeypatch):
    rows = [*corpus(), *[doc(1000 + i, "qxz wvk zzx jqk " * 5, "dd") for i in range(3)]]
    m = langid.fit(docs(spark, rows))
    assert m.langs == ["aa", "bb", "cc", "dd"] and m.limits[3] == max(m.limits[:3])
    assert m.predict(["wvk qxz jqk zzx wvk"])[0] == ["dd"]


@pytest.mark.parametrize("most", [4096, 1])
def test_languages_and_grams_are_bounded(spark, monkeypatch, most):
    # With 1 every number of occurrences is beyond those told apart, as all are in a large corpus.
    monkeypatch.setattr(langid, "MOST_SEEN", most)
    df = docs(spark, corpus())
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df, max_langs=2)
    whole, few = langid.fit(df), langid.fit(df, max_grams=180)
    held = [sum(len(m.hashes[4]) for m in x.models) for x in (whole, few)]
    assert held[0] > held[1] and 120 < held[1] <= 240
    texts = [words(40, 5000 + i, k) for i in range(9) for k in ("aa", "bb", "cc")]
    assert few.predict(texts)[0] == ["aa", "bb", "cc"] * 9


def test_discounts_are_those_of_all_grams(spark):
    rows = corpus()
    df = docs(spark, rows)
    whole, few = langid.fit(df), langid.fit(df, max_grams=300)
    counts = spark.createDataFrame([(0, int(k), int(n)) for k, n in [(1 << 48 | 2, 1), (1 << 48 | 3, 1), (2 << 48 | 2, 1), (7, 2), (1 << 32 | 7, 5)]], "lang int, gram long, n long")
    keys, n = (np.array([r[i] for r in sorted(counts.collect(), key=lambda r: r["gram"])]) for i in (1, 2))
    assert langid._discounts_of(counts)[0] == langid.discounts(keys.view(np.uint64), n)
    # What stays has its own counts and the discounts of before: of a frequent 4-gram both models say much the same.
    often = langid.grams(*(lambda c: (c[0], np.flatnonzero(c[2])))(langid.symbols([rows[0][1]])))
    assert whole.log_probabilities(often).shape == few.log_probabilities(often).shape == (len(often), 3)


def model_of(langs, texts):
    """A model from the 4-grams of (index of the language, text), counted here."""
    counts = Counter()
    for i, t in texts:
        codes, _, scored = langid.symbols([t])
        counts.update((i, int(k)) for k in langid.grams(codes, np.flatnonzero(scored)))
    lang, key = (np.array([k[j] for k in counts], t) for j, t in ((0, np.int64), (1, np.uint64)))
    return langid.Model(langs, lang, key, np.array(list(counts.values())))


def test_every_training_row_teaches_and_calibrates(spark):
    rows = corpus(360)
    df = docs(spark, rows)
    got = langid.fit(df)
    folds = {r.doc_id: r.fold for r in df.where(langid.training_row("doc_id")).selectExpr("doc_id", f"pmod(xxhash64(string(doc_id)), {langid.FOLDS}) AS fold").collect()}
    taught = [(r[0], got.langs.index(r[2]), r[1]) for r in rows if r[0] in folds]
    texts = [words(30, 9000 + i, k) for i in range(5) for k in ("aa", "bb", "cc")]
    np.testing.assert_allclose(got.entropies(texts)[0], model_of(got.langs, [x[1:] for x in taught]).entropies(texts)[0], rtol=1e-5)
    h = defaultdict(list)
    for f in range(langid.FOLDS):
        others = model_of(got.langs, [(i, t) for k, i, t in taught if folds[k] != f])
        for i, t in [(i, t) for k, i, t in taught if folds[k] == f]:
            h[i].append(others.entropies([t])[0][0, i])
    for i in range(3):
        q = np.percentile(h[i], 99)
        assert len(h[i]) > 80 and got.limits[i] == pytest.approx(q + langid.MARGIN * (math.log(got.symbols) - q), abs=1e-3)


def test_a_language_of_one_repeated_id_takes_the_widest_limit(spark):
    rows = [*corpus(), *[doc(1001, "qxz wvk zzx jqk " * 5, "dd") for _ in range(60)]]
    m = langid.fit(docs(spark, rows))
    assert m.limits[3] == max(m.limits[:3]) and m.predict(["wvk qxz jqk zzx wvk"])[0] == ["dd"]


def test_parts_give_what_the_whole_model_gives(spark):
    # More 4-grams than a worker may hold: none stays behind, with parts of several languages and of less than one.
    df = clashing(docs(spark, [*corpus(180), *[doc(1000 + i, "qxz wvk zzx jqk " * 5, "dd") for i in range(3)]]))
    whole, parts = langid.fit(df), langid.fit(df, max_held=300)
    assert isinstance(whole, langid.Model) and isinstance(parts, langid.Parted) and len(parts.bounds) > 3
    held = Counter(i for m in parts.parts() for i in m.spans if m.models[i].total)
    assert max(held.values()) > 1 and parts.symbols == whole.symbols
    assert parts.counts.count() == sum(m.total for m in whole.models)
    np.testing.assert_allclose(parts.limits, whole.limits, atol=1e-3)
    asked = docs(spark, [*[(r[0] + 100, *r[1:]) for r in corpus(30)], *odd_rows(), doc(50, "qxz jqk"), doc(51, "Ünï 𝒳 kqz \0 b")])
    got, want = (sorted((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.rejected, r.score, r.cross_entropy or 0.0) for r in langid.identify(asked, m, keep=("doc_id",)).collect()) for m in (parts, whole))
    assert [r[:4] for r in got] == [r[:4] for r in want] and len(got) == asked.count()
    np.testing.assert_allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-5, atol=1e-6)


def alike(langs, texts, letters, seed):
    """Texts of made languages that share their letters and most of their habits."""
    rng, usual = np.random.default_rng(seed), np.random.default_rng(7).dirichlet(np.full(20, 0.5), 20)
    alphabet = np.array(list("abcdefghijklmnopqrst"))
    for name in range(langs):
        own = np.random.default_rng(1000 + name).dirichlet(np.full(20, 0.5), 20)
        steps = np.cumsum(0.75 * usual + 0.25 * own, axis=1)
        for _ in range(texts):
            at, made = 0, []
            for x in rng.random(letters):
                at = min(int(np.searchsorted(steps[at], x)), 19)
                made.append(at)
            yield f"l{name:02d}", "".join(alphabet[made])


def test_many_languages_that_are_alike(spark):
    rows = [doc(i, t, k) for i, (k, t) in enumerate(alike(64, 60, 300, 1))]
    df = docs(spark, rows)
    asked = list(alike(64, 6, 300, 2))

    def right(model):
        return np.mean([a == k for a, (k, _) in zip(model.predict([t for _, t in asked])[0], asked, strict=True)])

    unbounded, usual = right(langid.fit(df, max_grams=1 << 40)), langid.fit(df)
    total = sum(len(m.hashes[4]) for m in usual.models)
    assert total > 64 * 4096 and abs(right(usual) - unbounded) <= 0.01 and unbounded > 0.5
    assert right(langid.fit(df, max_grams=total * 3 // 4)) > unbounded - 0.15


def labelled(n=400):
    rows, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        t = words(20 + i % 50, i)
        if bad:
            t = [t.upper() + "!!", " ".join(w + "$$$" for w in t.split()), " | ".join(t.split()), " ".join(w for w in t.split() for _ in range(3))][i // 4 % 4]
        rows.append(doc(i, t))
        marks.append((i, 0 if bad else 1))
    return rows, marks


@pytest.fixture(scope="module")
def quality_model(spark):
    rows, marks = labelled()
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (999_999, 1)], "doc_id long, quality int")
    return quality.fit(clashing(docs(spark, rows)), labels)


def test_quality_held_out(spark, quality_model):
    rows, marks = labelled()
    truth = dict(marks)
    got = quality.score_quality(clashing(docs(spark, rows)), quality_model, keep=("doc_id", "score")).collect()
    held = [r for r in got if __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r[1] == "mine" and r.predicted == (1 if r[2] >= 0.3 else 0) for r in got)


def test_quality_sees_every_passage(quality_model):
    def score(text):
        import pyarrow as pa

        data, starts, ends, row = quality.passages(pa.array([text]))
        h, _, _, e = quality_model.encode(quality.passage_features(data, starts, ends))
        return quality_model.score((e[:, None] * h).sum(0)[None], e.sum()[None])[0]

    good = words(3000, 77)
    bad = " ".join(w + "$$$" for w in words(3000, 78).split())
    assert score(good) > 0.9 and score(bad) < 0.1
    assert score(good + " " + bad) < score(good)


def test_quality_edges(spark, quality_model):
    rows = odd_rows()
    got = quality.score_quality(docs(spark, rows), quality_model, keep=("doc_id",)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.score)
    assert by[2] == by[3] == [pytest.approx(quality_model.prior)] and by[8][0] == by[8][1] == by[1][0]
    assert quality.score_quality(docs(spark, []), quality_model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    untrained = quality.fit(docs(spark, rows), labels)
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs(spark, rows), untrained).collect())


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    x, own, label = rng.random((7, quality.FEATURES)), np.array([0, 0, 1, 1, 1, 2, 2]), np.array([1.0, 0.0, 1.0])
    m = quality.Model()

    def loss():
        h, _, _, e = m.encode(x)
        z = np.stack([(e[own == i, None] * h[own == i]).sum(0) / e[own == i].sum() for i in range(3)])
        p = quality._sigmoid(z @ m.p["o"] + m.p["b"][0])
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    g = m._gradient(x, own, label)
    for k in m.p:
        flat = m.p[k].reshape(-1)
        for at in rng.integers(0, flat.size, 3):
            keep, eps = flat[at], 1e-6
            flat[at] = keep + eps
            up = loss()
            flat[at] = keep - eps
            down = loss()
            flat[at] = keep
            assert g[k].reshape(-1)[at] == pytest.approx((up - down) / (2 * eps), abs=1e-6), k


def test_training_takes_whole_documents(spark):
    rows = [doc(i, words(400, i, "aa" if i % 2 else "bb")) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    few, more, all_ = (quality.fit(docs(spark, rows), labels, max_passages=n) for n in (20, 10**6, 200))
    assert not np.array_equal(few.p["E"], more.p["E"]) and np.array_equal(all_.p["E"], more.p["E"])
    # A document beyond what fits is passed over as a whole; its key alone decides, and the others teach as before.
    long = doc(41, words(30_000, 9))
    marked = labels.unionAll(spark.createDataFrame([(41, 1)], "doc_id long, quality int"))
    without = quality.fit(docs(spark, [*rows, long]), marked, max_passages=200)
    assert np.array_equal(without.p["E"], more.p["E"])
    assert not np.array_equal(quality.fit(docs(spark, [*rows, long]), marked).p["E"], more.p["E"])


def test_a_repeated_key_teaches_once(spark):
    rows = [doc(i, words(60, i, "aa" if i % 2 else "bb")) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    again = [doc(i, t) for i, t in [(1, rows[1][1])] * 60 + [(1, f"zz {rows[1][1]} {k}") for k in range(60)] + [(1, "")]]
    once, many = (quality.fit(docs(spark, r), labels) for r in (rows, rows + again))
    assert all(np.array_equal(once.p[k], many.p[k]) for k in once.p)
