import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from cefframe.llm.bpe import read_tokenizer
from cefframe.llm.pieces import MARK, MergePieces, default_model, encode_pieces, message, op12_sentencepiece
from conftest_llm import CLASHING, docs_frame


@pytest.fixture(scope="module")
def both():
    path = default_model()
    return MergePieces(read_tokenizer(path)), sentencepiece.SentencePieceProcessor(model_file=path)


BITS = ["a", "b", "aa", "the", "  ", "   ", "\n", "\t", "é", "日本", "<s>", "</s>", "<unk>", "<0x41>", "0", "12", "'s", " ", "!", "==",
        "\x00", "\x85", "　", MARK, "İ", "ffi", "🙂", "ing", "er", "́", "ß", "�", ".com", "(x", " The", "tion"]


def same(both, text):
    own, library = both
    ids, digits = own.encode(text)
    want = library.encode(text)
    assert ids.tolist() == want, text
    assert digits == ",".join(map(str, want))
    assert own.decode(ids) == library.decode(want), text


def test_random_texts_match_the_library(both):
    rng = random.Random(5)
    for _ in range(3000):
        same(both, "".join(rng.choice(BITS + [chr(rng.randrange(1, 0x3000))]) for _ in range(rng.randrange(40))))


def test_long_runs_need_steps_back(both):
    rng = random.Random(6)
    for _ in range(200):
        same(both, "".join(rng.choice("abcdefghij"[:rng.randrange(1, 10)]) for _ in range(rng.randrange(1, 500))))
    for text in ("x" * 50_000, "ab" * 20_000, " " * 3000 + "a", "\n" * 999, "日" * 5000, " a" * 4000, "=-" * 7000):
        same(both, text)


def test_runs_of_spaces_have_equal_scores(both):
    for n in range(1, 80):
        same(both, " " * n)
        same(both, "a" + " " * n + "b")
        same(both, MARK * n + " ")


def test_pieces_joined_at_random(both):
    own, library = both
    rng = random.Random(8)
    for _ in range(3000):
        same(both, "".join(rng.choice(own.names) for _ in range(rng.randrange(1, 9))))


def test_two_tokens_fit_if_merging_keeps_them(both):
    own, _ = both
    rng = random.Random(7)
    for _ in range(4000):
        a, b = rng.randrange(len(own.names)), rng.randrange(len(own.names))
        symbols = list(own.names[a] + own.names[b])
        while True:
            scores = [own.score.get(x + y, -np.inf) for x, y in zip(symbols, symbols[1:])]
            if not scores or max(scores) == -np.inf:
                break
            k = scores.index(max(scores))
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        assert own.fits(a, b) == (symbols == [own.names[a], own.names[b]])


def test_any_ids_decode_as_the_library_does(both):
    own, library = both
    rng = random.Random(9)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(260), rng.randrange(32_000), 28705]) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, np.uint32)) == library.decode(ids), ids


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_other_kinds_of_models_are_refused():
    piece = field(1, field(1, "a".encode()))
    rules = field(3, field(4, 0))
    for trainer in (field(3, 1), field(3, 2), field(3, 2) + field(35, 1) + field(24, 1)):
        with pytest.raises(ValueError):
            MergePieces(piece + field(2, trainer) + rules)
    ok = field(2, field(3, 2) + field(35, 1))
    assert MergePieces(piece + ok + rules).names == ["a"]
    with pytest.raises(ValueError):
        MergePieces(piece + ok + field(3, field(4, 0) + field(2, b"table")))
    with pytest.raises(ValueError):
        MergePieces(field(1, field(1, b"a") + field(3, 4)) + ok + rules)
    assert message(field(5, 300) + field(6, b"xy")) == {5: [300], 6: [b"xy"]}


def test_operator_rows(spark, both):
    _, library = both
    texts = ["Hello world", "", None, "naïve café \n" * 9000, "Hello world", (None, "x"), "<s> " + MARK, " lead", "tail  "]
    df = docs_frame(spark, texts, CLASHING)
    got = encode_pieces(df, default_model(), with_ids=True, with_text=True).collect()
    want = []
    for i, t in enumerate(texts):
        key, text = t if isinstance(t, tuple) else (i, t or "")
        ids = library.encode(text)
        want.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids, library.decode(ids)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert encode_pieces(df.limit(0), default_model()).collect() == []


def test_query_over_all_documents(spark, tables_dir, both):
    _, library = both
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in op12_sentencepiece(spark, tables_dir).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
