import random
import zlib

import numpy as np
import pytest

from cefframe.llm.toxicity import (Model, Scorer, best_threshold, drop_toxic, fit, fit_and_score, gradients, pool, score_rows,
                                   slide, train, words_of, DIMS, FILTERS, PLACES, POOLED, SLOTS, WIDE)
from conftest_llm import CLASHING, COLUMNS

BAD = ["vile", "rotten", "filth"]


def corpus(n, seed=0):
    rng = random.Random(seed)
    plain = ["w%s" % "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((" ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(600)
    return train([t for t, _ in rows], np.array([y for _, y in rows]), 0.3)


def test_held_out_accuracy(model):
    rows = corpus(400, 1)
    scores = Scorer(model).scores([t for t, _ in rows])
    y = np.array([t for _, t in rows])
    assert ((scores >= 0.5) == y).mean() > 0.95 and scores.min() >= 0 and scores.max() <= 1
    rank = np.argsort(np.argsort(scores))
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.97


def test_filters_match_plain_loops():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 3, 70, 2])
    ends = np.cumsum(sizes)
    z = rng.standard_normal((ends[-1], SLOTS)).astype(np.float32)
    groups = list(slide(z, ends))
    for s, (a, b) in enumerate(zip(ends - sizes, ends)):
        for (width, places, c) in groups:
            for i in range(a, b):
                want = sum(z[i + p, places[p]] for p in range(width) if i + p < b)
                assert np.allclose(c[i], want, atol=1e-4)
    assert [g[0] for g in groups] == [w for w, _ in PLACES] + [WIDE]
    assert np.allclose(pool(z, ends - sizes, ends)[1], np.concatenate([c[1:4].max(axis=0) for _, _, c in groups]))


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    rows = np.concatenate([[[1, 2, 0, 0, 0]], rng.integers(1, 12, (9, 5))])
    texts = [rng.integers(0, 10, n) for n in (1, 4, 60, 9)]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])
    embedding = rng.standard_normal((12, DIMS)) * 0.3
    embedding[0] = 0
    net = Model(embedding, rng.standard_normal((DIMS, SLOTS)) * 0.3, rng.standard_normal(POOLED) * 0.2,
                rng.standard_normal(POOLED) * 0.3, 0.1)

    def loss():
        logits = []
        for t in texts:  # plain loops, no code of the library
            z = net.embedding[rows[t]].sum(axis=1) @ net.filters
            best = []
            for width, places in [*PLACES, (WIDE, [slice(SLOTS - FILTERS, SLOTS)] * WIDE)]:
                best.append(np.max([sum(z[i + p, places[p]] for p in range(width) if i + p < len(t)) for i in range(len(t))], axis=0))
            logits.append(np.maximum(np.concatenate(best) + net.bias, 0) @ net.output + net.offset)
        p = 1 / (1 + np.exp(-np.array(logits)))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean() + 0.5e-4 * (net.output ** 2).sum()

    cells, g_cells, g_filters, g_bias, g_output, g_offset = gradients(net, rows, texts, y, weight)
    g_embedding = np.zeros_like(net.embedding)
    g_embedding[cells] = g_cells
    for array, g, places in ((net.embedding, g_embedding, [(r, d) for r in range(1, 12) for d in (0, 7)]),
                             (net.filters, g_filters, [(d, s) for d in (1, 9) for s in range(0, SLOTS, 5)]),
                             (net.bias, g_bias, range(POOLED)), (net.output, g_output, range(POOLED))):
        for at in places:
            middle, step = array[at], 1e-5
            array[at] = middle + step
            high = loss()
            array[at] = middle - step
            low = loss()
            array[at] = middle
            assert abs((high - low) / (2 * step) - g[at]) < 1e-4
    net.offset += 1e-5
    high = loss()
    net.offset -= 2e-5
    assert abs((high - loss()) / 2e-5 - g_offset) < 1e-4


def test_scores_do_not_depend_on_batches_or_the_cache(model, monkeypatch):
    texts = [t for t, _ in corpus(50, 2)] + ["", None, "1234 !!", "x " * 60_000]
    whole = Scorer(model).scores(texts)
    monkeypatch.setattr("cefframe.llm.toxicity.MOST_CACHED", 20)
    small = Scorer(model)
    one_by_one = np.concatenate([small.scores([t]) for t in texts])
    assert np.allclose(whole, one_by_one, atol=1e-5)
    assert whole[50] == whole[51] == whole[52]  # no words: no evidence


def test_best_threshold():
    s, y = np.array([.9, .8, .7, .2, .1]), np.array([1, 1, 0, 1, 0])
    cut = best_threshold(s, y)
    f1 = lambda c: 2 * y[s >= c].sum() / ((s >= c).sum() + y.sum())
    assert f1(cut) == max(f1(c) for c in s)


def table_of(spark, rows, extra=()):
    return spark.createDataFrame([(*r, *[1] * len(extra)) for r in rows], COLUMNS + "".join(f", `{c}` int" for c in extra))


def labelled(spark, n=500):
    rows = corpus(n, 3)
    docs = table_of(spark, [(i, t, "en" if i % 2 else None, "s", 0) for i, (t, _) in enumerate(rows)], CLASHING)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)] + [(1, 1, None), (None, 0, 1), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_fit_score_and_drop(spark):
    docs, labels, rows = labelled(spark)
    model = fit(docs, labels)
    again = fit(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(model.filters, again.filters) and model.thresholds == again.thresholds
    extra = table_of(spark, [(900, None, None, None, 0), (901, "", "xx", "s", 0), (None, "vile vile", "en", "s", 0), (5, rows[5][0], "en", "s", 0)], CLASHING)
    every = docs.unionByName(extra)
    got = score_rows(every, model).collect()
    assert len(got) == 504 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.score >= 0.5, rows[r.doc_id][1]) for r in got if r.doc_id is not None and r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in held]) > 0.9
    fitted, at_once = fit_and_score(every, labels)
    told = {(r.doc_id, r.score, r.threshold) for r in score_rows(every, fitted).collect()}
    assert at_once.columns == ["doc_id", "score", "predicted", "threshold", "rejected"]
    assert {(r.doc_id, r.score, r.threshold) for r in at_once.collect()} == told
    left = drop_toxic(every, labels)
    assert left.columns == every.columns and left.dtypes == every.dtypes
    rejected = sum(r.rejected for r in got)
    assert left.count() == 504 - rejected and rejected > 50


def test_no_labels_of_one_kind(spark):
    docs, labels, _ = labelled(spark, 30)
    for some in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        scores = [r.score for r in score_rows(docs, fit(docs, some)).collect()]
        assert len(set(scores)) == 1 and scores[0] < 0.5
    assert drop_toxic(docs.limit(0), labels).collect() == []


def test_words():
    assert words_of("Du Idiot, ÉTÉ_12x\n—ok") == ["du", "idiot", "été", "x", "ok"] and words_of(None) == []


def test_cuts_rest_on_all_labelled_rows_of_any_length(spark, monkeypatch):
    from cefframe.llm import toxicity as X
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        toxic = int(rng.random() < 0.15)
        # Bad words are common in clean texts too, so that the cut depends on the shares of the labels.
        words = [rng.choice(BAD) if rng.random() < (0.3 if toxic else 0.12) else f"w{rng.randrange(80)}" for _ in range(8)]
        rows.append((i, " ".join(words) + (" pad" * 60 if i % 5 == 0 else ""), "en", toxic))
    monkeypatch.setattr(X, "FIT_CHARS", 200)
    monkeypatch.setattr(X, "FIT_TOXIC", 60)
    monkeypatch.setattr(X, "FIT_CLEAN", 120)
    docs = table_of(spark, [(i, t, lang, "s", 0) for i, t, lang, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    met = {}
    real = X.best_cut
    monkeypatch.setattr(X, "best_cut", lambda bins, weights: met.setdefault("all", (bins, weights)) and real(bins, weights))
    model = fit(docs, labels)
    bins, weights = met["all"]
    outside = [(y, len(t) > 200) for i, t, _, y in rows if zlib.crc32(str(i).encode()) % 5]
    assert bins.n.sum() == len(outside) - 180 and bins.n[bins.long == 1].sum() == sum(long for _, long in outside)
    # Weighed, the rows that the fit did not use have the shares of all rows.
    for y in (0, 1):
        for long in (0, 1):
            own = bins.n[(bins.toxic == y) & (bins.long == long)].sum() * weights[y, long]
            assert abs(own - outside.count((y, bool(long)))) < 1e-6
    # The cut has the best F1 by those shares, within the width of a bin.
    scores = Scorer(model).scores([t for _, t, _, _ in rows])
    odds, y = np.log(scores / (1 - scores)), np.array([r[3] for r in rows])
    kept = np.array([zlib.crc32(str(r[0]).encode()) % 5 > 0 for r in rows])
    f1 = lambda c: 2 * y[kept & (odds >= c)].sum() / ((kept & (odds >= c)).sum() + y[kept].sum())
    assert f1(0) > max(f1(c) for c in np.arange(-8, 8, 0.05)) - 0.05
    assert abs(model.threshold("en") - 0.5) < 1e-9  # one language: its cut is the common one
