import hashlib
import re
from collections import defaultdict

from cefframe.llm.exact_dedup import drop_copies, exact_groups
from conftest_llm import CLASHING, docs_frame


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


TEXTS = ["a  b", "a\tb", "a b", "", None, " ", "\n\n", "x" * 200_000, "x" * 200_000, "A b", "a\xa0b", "é", (3, "a b"), (3, "a b"),
         (None, "a b"), (None, "alone"), (None, "alone")]


def test_groups_match_brute_force(spark):
    df = docs_frame(spark, TEXTS, CLASHING)
    rows = df.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r.text)].append(r.doc_id)
    want = []
    for r in rows:
        g = groups[norm(r.text)]
        keep = min((i for i in g if i is not None), default=None)
        want.append((r.doc_id, keep, len(g), hashlib.sha256(norm(r.text).encode()).hexdigest()))
    got = exact_groups(df, salts=64).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(want, key=key)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and {r.text_sha256 for r in kept} == {w[3] for w in want}


def test_many_salts_give_the_same(spark):
    df = docs_frame(spark, [f"t{i % 7}" for i in range(300)])
    few, many = (sorted(map(tuple, exact_groups(df, salts=n).collect())) for n in (64, 256))
    assert few == many and {r[2] for r in few} == {42, 43}


def test_drop_copies_keeps_columns_and_one_row(spark):
    df = docs_frame(spark, TEXTS, CLASHING)
    out = drop_copies(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = out.collect()
    assert len(rows) == len({norm(r.text) for r in df.collect()}) == len({norm(r.text) for r in rows})
    assert {r.doc_id for r in rows if norm(r.text) == "a b"} == {0}


def test_empty_table(spark):
    df = docs_frame(spark, ["x"]).limit(0)
    assert exact_groups(df).collect() == [] and drop_copies(df).collect() == []
