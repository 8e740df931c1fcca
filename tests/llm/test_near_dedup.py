import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from cefframe.llm import near_dedup as N
from cefframe.llm.common import new_run
from cefframe.llm.components import SMALL, UnionFind, connected_components
from cefframe.llm import components
from conftest_llm import CLASHING, docs_frame


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    find = UnionFind()
    for (i, a), (j, b) in combinations([s for s in sets if s[1]], 2):
        if 100 * len(a & b) >= 75 * len(a | b):
            find.join(i, j)
    return [(i, len(s), find.root(i) if s else i) for i, s in sets]


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(1, 7))) for _ in range(n)]


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k:k + rng.randrange(2)] = words(rng, rng.randrange(2))
    return w


def family(seed, members, n, most):
    rng = random.Random(seed)
    base = words(rng, n)
    return [" ".join(edited(rng, base, rng.randrange(most + 1))) for _ in range(members)]


def check(spark, docs, **kw):
    df = docs_frame(spark, docs, CLASHING)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_components(df).collect() if r.doc_id is not None)
    want = sorted((i, n, c, i == c) for i, n, c in brute([d if isinstance(d, tuple) else (k, d) for k, d in enumerate(docs)]))
    assert got == want
    return df, got


def test_matches_brute_force(spark):
    docs = ["", None, " \n\t", "one", "ONE", "one two three four", "one two three four", "One  two\tthree four five", "x y", "Ä b c d e", "ä b c d e"]
    docs += family(1, 25, 120, 6) + family(2, 12, 40, 3) + family(3, 6, 400, 30) + [" ".join(words(random.Random(9), 30_000))] * 2
    df, got = check(spark, docs)
    left = N.drop_near_copies(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [g[0] for g in got if g[3]]


def test_large_family_around_the_threshold(spark, monkeypatch):
    # Many members that link with some members only: hubs do not settle it, blocks do.
    monkeypatch.setattr(N, "BLOCK", 16)
    check(spark, family(4, 150, 100, 8))


def test_chains(spark):
    w = words(random.Random(11), 200)
    check(spark, [" ".join(w[i * 6:i * 6 + 90]) for i in range(15)])


def test_null_ids_and_empty_table(spark):
    df = docs_frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (None, None)])
    rows = N.near_components(df).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(None, None, True), (3, 3, True)} and len(rows) == 3
    assert N.drop_near_copies(df).count() == 3
    assert N.near_components(df.limit(0)).collect() == []


def test_one_id_with_several_texts(spark):
    a = " ".join(words(random.Random(21), 30))
    b = " ".join(words(random.Random(22), 26))
    near_b = " ".join([*b.split()[:-1], "changed"])
    df, got = check(spark, [(3, a), (5, a), (5, b), (9, near_b)])
    assert {g[2] for g in got} == {3}
    check(spark, [(5, b), (5, a), (9, near_b), (7, a), (7, None), (5, ""), (11, near_b), (11, "other text")])
    check(spark, [(5, a), (5, a), (5, b), (2, "x"), (5, near_b)])


def test_random_tables_with_repeated_ids(spark):
    for seed in (31, 32):
        rng = random.Random(seed)
        texts = [t for k in range(6) for t in family(seed + k, 6, 60, 5)] + ["", None, "few words"]
        docs = [(rng.randrange(40), rng.choice(texts)) for _ in range(90)]
        docs += docs[:10]
        df, got = check(spark, docs)
        kept = N.drop_near_copies(df).collect()
        names = {i: c for i, n, c, _ in got if n}
        want = [(i, t) for i, t in docs if not (t or "").split() or names[i] == i]
        assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for share in (0.3, 0.6, 0.9):
        for _ in range(30):
            n = 300
            both = int(2 * n * share / (1 + share))
            x = rng.integers(0, 2 ** 63, 2 * n - both, dtype=np.uint64)
            sig = N.super_minhash([np.unique(x[:n]), np.unique(x[n - both:])])
            errors.append((sig[0] == sig[1]).mean() - share)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.9 * np.mean([s * (1 - s) / N.SLOTS for s in (0.3, 0.6, 0.9)])  # below MinHash's variance


def test_signature_is_the_plain_definition():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (1, 2, 9, 60)]
    m = 24
    got = N.super_minhash(sets, m)
    for s, row in zip(sets, got):
        best = np.full(m, np.inf)
        for e in s:
            perm = list(range(m))
            for j in range(m):
                z = int(N.mixed(np.array([e], np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))[0])
                k = j + ((z & 0xFFFFFF) * (m - j) >> 24)
                perm[j], perm[k] = perm[k], perm[j]
                best[perm[j]] = min(best[perm[j]], j + (z >> 24) * 2.0 ** -40)
        assert np.array_equal(best, row)


def test_block_links_span_all_links():
    texts = family(5, 40, 60, 4)
    links = N.block_links(pd.DataFrame({"id": range(40), "text": texts}))
    find = UnionFind()
    for a, b in links.itertuples(index=False):
        find.join(a, b)
    want = {i: c for i, _, c in brute(list(enumerate(texts)))}
    assert all(find.root(i) == want[i] for i in range(40))


@pytest.mark.parametrize("small", [SMALL, 3])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + \
        [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)] + [(5000, 5000), (1, 1)]
    find = UnionFind()
    for a, b in edges:
        find.join(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(df, new_run(spark, "test-cc")).collect()}
    assert got == {x: find.root(x) for e in edges for x in e}
    assert connected_components(df.limit(0), new_run(spark, "test-cc")).collect() == []
