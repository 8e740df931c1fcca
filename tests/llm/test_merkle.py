import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cefframe.llm.merkle import COLUMNS, ROW_LIMIT, build_manifest, climb, verified_leaves
from conftest_llm import CLASHING


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 3
        out.append((level[run:i], level[i + 1:run + 3]))
        i //= 3
    return out


def expected(docs):
    """docs: (doc_id, text, lang, source, n_chars); sorted rows of the query."""
    groups = {}
    for d in docs:
        key, text, lang, source, n = d[:5]
        cut = text.replace("\n", "") if text is not None and key is not None and zlib.crc32(str(key).encode()) % 2 == 0 else text
        groups.setdefault(source, []).append((key, leaf_of([key, source, lang, n, text]), leaf_of([key, source, lang, n, cut])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(levels_of([r[1] for r in groups[s]]))
    top = levels_of([t[-1][0] for t in trees]) if trees else []
    out = []
    for i, s in enumerate(order):
        for pos, (key, leaf, changed) in enumerate(groups[s]):
            proof, folded = [], changed
            for left, right in siblings(trees[i], pos) + siblings(top, i):
                proof += left + right
                folded = H(*left, folded, *right)
            out.append((key, leaf, trees[i][-1][0], top[-1][0], H(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` int" for c in CLASHING)


def run(spark, docs, parts=5):
    frame = spark.createDataFrame([(*d, *[1] * len(CLASHING)) for d in docs], SCHEMA).repartition(parts)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return build_manifest(frame, [F.col(c) for c in COLUMNS], altered=[*[F.col(c) for c in COLUMNS[:-1]], text])


def made(rng, sizes):
    docs, key = [], 0
    for i, size in enumerate(sizes):
        for _ in range(size):
            key += rng.randrange(1, 3)
            docs.append((key, rng.choice([None, "", "a\nb", "no line", "é\n日本\n", "x\n" * 3000]), rng.choice([None, "en"]),
                         f"s{i:02}", rng.choice([None, 5])))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [4, 9, 10], [81, 82, 1], [250, 3, 1, 28] + [2] * 26, [1] * 90])
def test_trees_of_all_shapes(spark, sizes):
    docs = made(random.Random(len(sizes)), sizes)
    assert sorted(map(tuple, verified_leaves(run(spark, docs)).collect()), key=str) == expected(docs)


def test_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(2)
    docs = [(rng.choice([None, 1, 2, 3, -5, 7_000_000_000_000_000_001]), rng.choice([None, "", "a", "a\n"]), rng.choice([None, "-", "en"]),
             rng.choice([None, "", "ß", "z", "\U0001f642", "￮"]), rng.choice([None, 0, 3])) for _ in range(200)]
    docs += docs[:40] + [docs[0]] * 20
    assert sorted(map(tuple, verified_leaves(run(spark, docs, 9)).collect()), key=str) == expected(docs)


def test_empty_table(spark):
    manifest = run(spark, [])
    assert manifest.root is None and manifest.nodes.count() == 0
    assert verified_leaves(manifest).collect() == []


def test_nodes_are_linked_to_their_parents(spark):
    docs = made(random.Random(4), [100, 7])
    manifest = run(spark, docs)
    nodes = {(r.tree, r.level, r.idx): r for r in manifest.nodes.collect()}
    for r in nodes.values():
        run_ = [nodes[k].hash.hex() for k in ((r.tree, r.level - 1, 3 * r.idx + j) for j in range(3)) if k in nodes]
        if r.level:
            assert bytes(r.hash).hex() == H(*run_)
        if r.parent is not None:
            assert (r.tree, r.level + 1, r.idx // 3) in nodes and r.parent == r.idx // 3
    assert sum(r.level == 0 and r.tree >= 0 for r in nodes.values()) == 107
    assert [bytes(r.hash).hex() for r in nodes.values() if r.tree < 0 and r.parent is None] == [manifest.root]


def test_climb_gives_the_proof_itself_and_leaves_the_session_as_it_was(spark):
    docs = made(random.Random(5), [30])
    before = spark.conf.get(ROW_LIMIT)
    manifest = build_manifest(spark.createDataFrame([(*d, *[1] * len(CLASHING)) for d in docs], SCHEMA), [F.col(c) for c in COLUMNS])
    rows = sorted(climb(manifest).collect(), key=lambda r: r.idx)
    assert spark.conf.get(ROW_LIMIT) == before
    levels = levels_of([bytes(r.hash).hex() for r in rows])
    for i, r in enumerate(rows):
        assert bytes(r.proof).hex() == "".join("".join(a + b) for a, b in siblings(levels, i))
        assert bytes(r.folded).hex() == manifest.root  # nothing was altered


def test_long_ranges_are_cut_up(spark, monkeypatch):
    from cefframe.llm import merkle
    monkeypatch.setattr(merkle, "CHUNK", 2)
    docs = made(random.Random(6), [800, 1, 90])
    assert sorted(map(tuple, verified_leaves(run(spark, docs)).collect()), key=str) == expected(docs)
