import math
import random

import pytest

from cefframe.llm import topk as K
from conftest_llm import CLASHING


def brute(rows, asked, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) and abs(x) * 256 < K.LIMIT for x in v)]
    queries = {}
    for i, v in usable:
        if i is not None and asked(i):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in usable if i != q]
        out += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def vectors(rng, n, dims, spread=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def check(spark, rows, k=5, step=7):
    extra = "".join(f", `{c}` int" for c in CLASHING)
    df = spark.createDataFrame([(i, v, *[0] * len(CLASHING)) for i, v in rows], "vec_id long, embedding array<float>" + extra)
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]  # as floats
    got = K.search(df, df.filter(f"vec_id % {step} = 0"), k).collect()
    assert sorted([(r.query_id, r.rank, r.vec_id, r.score) for r in got], key=str) == brute(rows, lambda i: i % step == 0, k)


@pytest.mark.parametrize("spread", [0.02, 2.0])
def test_matches_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(K, "PROBE", 20)
    monkeypatch.setattr(K, "PART", 16)
    monkeypatch.setattr(K, "CHUNK", 3)
    check(spark, vectors(random.Random(3), 250, 6, spread))


def test_odd_vectors_ties_and_repeats(spark):
    rows = vectors(random.Random(4), 40, 4) + [(7, None), (14, [1.0, None, 2.0, 0.0]), (21, [float("nan")] * 4), (50, [float("inf"), 0.0, 0.0, 0.0]),
                                               (51, []), (52, [1.0]), (53, [1.0] * 6), (None, [3.0] * 4), (None, [3.0] * 4), (28, [9.0] * 4),
                                               (54, [1e9, 0.0, 0.0, 0.0])]
    rows += [(100 + i, [5.0, 5.0, 5.0, 5.0]) for i in range(30)]
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(7, [1.0, 2.0])])
    check(spark, [(7, [1.0, 2.0]), (14, [0.5, -1.0]), (3, [0.0, 0.0])])
    check(spark, [(0, []), (7, [])])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert K.search(empty, empty).collect() == []


def test_bounds_skip_cells():
    import numpy as np
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.integers(-5, 5, (200, 3)) + c for c in ([1000, 0, 0], [0, 1000, 0], [0, 0, 1000])])
    most = float((v * v).sum(axis=1).max())
    pivots = K.fit_pivots(v, most)
    d = K.distances(K.with_norm(v, most), pivots)
    near = d.argmin(axis=1)
    rows = [{"pivot": p, "ring": 0, "n": int((near == p).sum()), "inner": d[near == p, p].min(), "outer": d[near == p, p].max()}
            for p in set(near.tolist())]
    order, bound, probe = K.Cells(pivots, rows).plan(v[:1])
    best = np.sort(K.products(v[:1], v)[0])[-5]
    reach = ((v[0] ** 2).sum() + most - bound[0] ** 2) / 2
    assert (reach < best).any()  # some cells cannot hold a better row


def exact(rows, asked, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = []
    for q, v in whole:
        if asked(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5, step=7):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in K.search(df, df.filter(f"vec_id % {step} = 0"), k).collect())


def test_large_vectors_take_part(spark, monkeypatch):
    monkeypatch.setattr(K, "PROBE", 20)
    rng = random.Random(8)
    rows = vectors(rng, 120, 6) + [(200, [70_000.0] * 6), (203, [-65_536.0, 9e4, 0.0, 1.0, 2.0, 3.0]), (205, [1e12, 0.0, 0.0, 0.0, 0.0, 0.0]),
                                   (206, [1e13, -3e11, 0.0, 0.0, 0.0, 0.5])]
    assert found(spark, rows) == exact(rows, lambda i: i % 7 == 0, 5)
    scaled = [(i, [x * 5e5 for x in v]) for i, v in vectors(rng, 120, 6)]  # scores just within a long
    assert found(spark, scaled) == exact(scaled, lambda i: i % 7 == 0, 5)


def test_products_are_exact_or_beyond():
    import numpy as np
    rng = random.Random(5)
    for bits in (20, 31, 33, 40, 62):
        a, b = ([[rng.choice([0, 1, -1, rng.randrange(-2 ** bits, 2 ** bits)]) for _ in range(5)] for _ in range(30)] for _ in range(2))
        got = K.products(np.array(a, np.int64), np.array(b, np.int64))
        for x, row in zip(a, got):
            for y, s in zip(b, row):
                want = sum(p * q for p, q in zip(x, y))
                assert int(s) == max(-K.BEYOND, min(K.BEYOND, want))


def test_scores_that_no_long_holds_are_errors(spark):
    with pytest.raises(Exception, match="a score does not fit a long; query 7"):
        found(spark, [(7, [1e8, 1.0]), (8, [1e8, 1.0])])
    with pytest.raises(Exception, match="does not fit a long; vector 8"):
        found(spark, [(7, [1.0, 1.0]), (8, [1e30, 1.0])])
    # Pairs outside the result do no harm.
    rows = [(7, [1e8, 1.0]), (8, [-1e8, 1.0])] + [(i, [1.0, float(i)]) for i in range(20, 26)]
    assert found(spark, rows) == exact(rows, lambda i: i % 7 == 0, 5)
