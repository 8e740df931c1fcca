import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cefframe.llm import repeats as R
from conftest_llm import CLASHING, docs_frame


def covered(texts, length):
    seen = defaultdict(list)
    for t, x in enumerate(texts):
        for i in range(len(x) - length + 1):
            seen[x[i:i + length]].append((t, i))
    out = [np.zeros(len(x), bool) for x in texts]
    for places in seen.values():
        for t, i in places if len(places) > 1 else ():
            out[t][i:i + length] = True
    return out


def test_each_window_has_one_unit_and_its_anchor():
    rng = np.random.default_rng(1)
    for k in range(120):
        data = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(0, 900)).astype(np.uint8)
        if k % 3 == 0 and len(data):
            data = np.tile(data[:rng.integers(1, 9)], 400)[:len(data)]
        first, last, anchor, value = R.units(data, 40, 12)
        n = len(data)
        assert sorted(p for a, b in zip(first, last) for p in range(a, b + 1)) == list(range(max(0, n - 39)))
        h = R.gram_hashes(data, 12) if n >= 12 else None
        for a, b, c, v in zip(first, last, anchor, value):
            for p in range(a, b + 1):
                assert p + int(h[p:p + 29].argmin()) == c and h[c] == v


def test_maximal_repeats_are_maximal_and_complete():
    rng = random.Random(1)
    for _ in range(200):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        make = lambda n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
        base, texts = make(61), []
        for _ in range(rng.randrange(1, 8)):
            cut = rng.randrange(60)
            texts.append((make(40) + base[cut:cut + rng.randrange(60)] + make(30)).encode())
        least = rng.choice([5, 9, 20])
        got = [np.zeros(len(x), bool) for x in texts]
        for length, places in R.maximal_repeats(texts, least):
            strings = {texts[s][p:p + length] for s, p in places}
            assert len(strings) == 1 and length >= least and len(places) > 1
            one = strings.pop()
            assert sum(x[i:i + length] == one for x in texts for i in range(len(x) - length + 1)) == len(places)
            assert len({texts[s][p - 1:p] if p else (s, p) for s, p in places}) > 1
            assert len({texts[s][p + length:p + length + 1] or (s, p) for s, p in places}) > 1
            for s, p in places:
                got[s][p:p + length] = True
        assert all((a == b).all() for a, b in zip(got, covered(texts, least)))


def passages(seed, n, letters="abcdefgh "):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [make(rng.randrange(150, 700)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [make(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.randrange(60)
            parts += [s[a:len(s) - rng.randrange(60)], make(rng.randrange(120))]
        texts.append("".join(parts))
    return texts


def check(spark, docs):
    df = docs_frame(spark, docs, CLASHING)
    rows = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    marks = covered([t for _, t in rows], R.LENGTH)
    want = [(str(i), len(t), int(m.sum()), int(m[:1].sum() + (m[1:] & ~m[:-1]).sum()),
             hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest()) for (i, t), m in zip(rows, marks)]
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.repeated_bytes(df).collect()]
    assert sorted(got) == sorted(want)
    return want


EDGES = ["", None, "short", "é" * 150, "In. " * 400, "x" * 5000, "x" * 199, "y" * 200, "y" * 201, (2, "same " * 60), (2, "same " * 60),
         (None, "same " * 39), "日本語テキスト" * 40]


def test_matches_brute_force(spark):
    want = check(spark, EDGES + passages(1, 60))
    assert sum(w[2] for w in want) > 5000


def test_anchors_with_many_units_are_counted_by_window(spark, monkeypatch):
    monkeypatch.setattr(R, "MOST_UNITS", 3)
    monkeypatch.setattr(R, "BLOCK_DOCS", 5)
    check(spark, EDGES + passages(2, 60) + passages(3, 20, "ab"))


def test_no_tables_are_left_in_the_catalog(spark):
    before = [t.name for t in spark.catalog.listTables()]
    check(spark, passages(5, 10))
    assert [t.name for t in spark.catalog.listTables()] == before and not any(n.startswith("llm_") for n in before)


def test_small_arrays_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BATCH_BYTES", 1)
    monkeypatch.setattr(R, "BLOCK_BYTES", 1000)
    check(spark, passages(4, 50, "abc"))


def test_empty_table(spark):
    assert R.repeated_bytes(docs_frame(spark, ["x"]).limit(0)).collect() == []


@pytest.mark.parametrize("width", [1, 2, 7, 50])
def test_sliding(width):
    values = np.random.default_rng(width).integers(0, 1000, 50, dtype=np.uint64)
    for best, plain in ((np.minimum, min), (np.maximum, max)):
        assert R.sliding(values, width, best).tolist() == [plain(values[i:i + width]) for i in range(50 - width + 1)]
