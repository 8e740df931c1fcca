import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cefframe.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from cefframe.llm.common import table
from conftest_llm import CLASHING, docs_frame
from test_near_dedup import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "mixing sources",
                                                      "BPE encoding and decoding"]


def test_run_matches_a_plain_version(spark):
    """Each stage in plain Python over the rows that the stage before kept."""
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    rows = docs.collect()
    scores = toxicity.Scorer(model).scores([r.text for r in rows])
    rows = [r for r, s in zip(rows, scores) if s < model.threshold(r.lang)]
    assert len(rows) > 150
    first = {}
    import re
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    rows = list(first.values())
    keep = {i for i, _, c in near_brute([(r.doc_id, r.text) for r in rows]) if i == c}
    rows = [r for r in rows if r.doc_id in keep]
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(rows, docs.schema)).collect()}
    library = Tokenizer.from_file(bpe.default_tokenizer())
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want += [(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((r.text or "").encode()).hexdigest())] * copies[r.doc_id]
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SF).collect() == [], name


def test_stages_take_clashing_columns_nulls_ties_and_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten"
    texts = [text, text, (1, text), (None, text), None, "", (None, None), " \n", "x", "x " * 50_000, (0, "other words here"), (1, text)]
    docs = docs_frame(spark, texts, CLASHING)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and len(docs.columns) == 5 + len(CLASHING), name
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert encoded.count() == docs.count() > 0
    kept = {(r.doc_id, r.text) for r in docs.collect()}
    assert sum(t == text for _, t in kept) == 1 and kept <= {(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("stage", [exact_dedup.drop_copies, near_dedup.drop_near_copies])
def test_dedup_stages_are_stable(spark, stage):
    once = stage(table(spark, SF, "documents"))
    assert stage(once).count() == once.count()
