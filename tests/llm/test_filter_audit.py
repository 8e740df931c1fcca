import itertools
import random
import re
from collections import Counter

from cefframe.llm.filter_audit import Diagram, audit_orders, audit_rows, mask_counts, plain_changes, standard_failures
from conftest_llm import CLASHING

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_plain_changes_visit_every_order_once():
    for m in range(1, 7):
        order = list(range(m))
        seen = {tuple(order)}
        for k in plain_changes(m):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.add(tuple(order))
        assert len(seen) == len(plain_changes(m)) + 1 == len(list(itertools.permutations(range(m))))


def expected(rows, letters):
    """rows: (part, fails, good, toxic); every order is run over every document."""
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        found, shapley = [], Counter()
        for order in itertools.permutations(letters):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                found.append((part, "".join(order), k + 1, len(left), len(gone),
                              sum(f in r[1] for r in mine) - len(gone), sum(set(r[1]) == {f} for r in mine),
                              sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in found]
    return sorted(out)


def test_audit_of_random_masks():
    rng = random.Random(3)
    for m in (1, 2, 3, 5):
        letters = "ABCDE"[:m]
        rows = [("p", "".join(x for x in letters if rng.random() < 0.4), rng.random() < 0.3, rng.random() < 0.2)
                for _ in range(rng.choice([1, 7, 300]))]
        counts = {}
        for _, fails, good, toxic in rows:
            mask = sum(1 << letters.index(x) for x in fails)
            counts[mask] = tuple(a + b for a, b in zip(counts.get(mask, (0, 0, 0)), (1, good, toxic)))
        assert sorted(audit_rows("p", counts, letters)) == expected(rows, letters)


def test_equal_nodes_are_one_and_swaps_keep_the_function():
    counts = {mask: (1, 0, 0) for mask in range(32)}
    diagram = Diagram(5, counts)
    assert [len(level) for level in diagram.levels] == [1] * 5  # all masks alike: one node a level
    rng = random.Random(4)
    counts = {mask: (rng.randrange(3), 0, rng.randrange(2)) for mask in range(32)}
    diagram = Diagram(5, counts)
    for k in plain_changes(5):
        diagram.swap(k)
        assert diagram.weights[0] == [tuple(map(sum, zip(*counts.values())))]
        for mask, want in counts.items():
            at = 0
            for level, bit in enumerate(diagram.order):
                at = diagram.levels[level][at][mask >> bit & 1]
            assert diagram.weights[5][at] == want
        for level in range(5):
            assert len(set(diagram.levels[level])) == len(diagram.levels[level])


def failures(text, copy):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return ("A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
            + "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text)) + "E" * copy)


def test_whole_audit_against_plain_loops(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["ABC", "x#y", "é日本", " "]
    texts = [None, "", " ", "\t\n", "word " * 300, "A" * 3, "x\x0by\x1cz", "big " * 200_000]
    texts += [" ".join(rng.choices(vocab[:rng.choice([20, 404])], k=rng.choice([10, 198, 200, 260]))) for _ in range(40)]
    ids = [None, *range(60)]
    docs = [(rng.choice(ids), rng.choice(texts), "en", rng.choice([None, "", "s1", "s2", "b'|x"]), 1, *[1] * len(CLASHING))
            for _ in range(300)]
    docs += docs[:20] + [docs[0]] * 30  # rows repeated as a whole, ids with several texts and parts
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 50), 3, 3, 5, None]]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` int" for c in CLASHING)
    frame = spark.createDataFrame(docs, schema).repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    smallest, rows = {}, []
    for key, text, *_ in docs:
        if key is not None:
            smallest[text or ""] = min(key, smallest.get(text or "", key))
    for key, text, _, source, *_ in docs:
        copy = key is not None and key > smallest[text or ""]
        mine = [x for x in labels if x[0] == key and key is not None]
        rows.append((source or "", failures(text or "", copy), any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    masks, letters = mask_counts(frame, marks, standard_failures(), copies="E")
    result = audit_orders(masks, letters)
    assert result.columns == COLUMNS
    assert sorted(map(tuple, result.collect())) == expected(rows, "ABCDE")


def test_empty_tables_and_other_filters(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    masks, letters = mask_counts(docs.limit(0), labels, standard_failures(), copies="E")
    assert audit_orders(masks, letters).collect() == []
    from pyspark.sql import functions as F
    masks, letters = mask_counts(docs, labels, {"L": F.length("text") > 3, "S": F.size("words") < 2})
    got = sorted(map(tuple, audit_orders(masks, letters).collect()))
    assert got == expected([("s", "S", 0, 0)], "LS")
