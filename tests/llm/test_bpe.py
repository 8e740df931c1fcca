import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from cefframe.llm.bpe import ByteBPE, default_tokenizer, encode_decode, read_tokenizer
from conftest_llm import CLASHING, docs_frame


@pytest.fixture(scope="module")
def both():
    path = default_tokenizer()
    return ByteBPE(read_tokenizer(path)), Tokenizer.from_file(path)


BITS = ["a", "b", "aa", "the", "  ", "\n", "\t", "é", "日本", "<|endoftext|>", "<|endof", "0", "12", "'s", "'ll", " ", "!", "==", "\x1c",
        "\x85", "　", "İ", "ffi", "🙂", "ing", "er", "́", "ß"]


def test_random_texts_match_the_library(both):
    bpe, library = both
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(BITS + [chr(rng.randrange(0x20, 0x3000))]) for _ in range(rng.randrange(40)))
        ids, digits = bpe.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert digits == ",".join(map(str, ids.tolist()))
        assert bpe.decode(ids) == text == library.decode(ids.tolist(), skip_special_tokens=False)


def test_long_pieces_need_steps_back(both):
    bpe, library = both
    rng = random.Random(6)
    for _ in range(150):
        text = "".join(rng.choice("abcdefghij"[:rng.randrange(1, 10)]) for _ in range(rng.randrange(1, 500)))
        assert bpe.encode(text)[0].tolist() == library.encode(text, add_special_tokens=False).ids
    for text in ("x" * 50_000, "ab" * 20_000, " " * 3000 + "a", "\n" * 999):
        assert bpe.encode(text)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_below_the_first_later_code_point(both):
    bpe, library = both
    for code in range(0x558):
        text = f"a{chr(code)}b 1{chr(code)}"
        pieces = [p for p in bpe.cut.split(text)]
        assert len(pieces) == 1
        assert len(bpe.pieces.findall(text)) == len(library.pre_tokenizer.pre_tokenize_str(text)), hex(code)


def test_border_test_is_that_of_two_token_encodings(both):
    bpe, _ = both
    rng = random.Random(7)
    raw = {i: bpe.pool[o:o + n].tobytes().decode("latin-1") for i, (o, n) in
           enumerate(zip(bpe.offset[bpe.outer], bpe.length[bpe.outer]))}
    for _ in range(3000):
        a, b = rng.randrange(50_000), rng.randrange(50_000)
        assert bpe.fits(a, b) == (bpe.encode_piece(raw[a] + raw[b]) == [a, b])


def test_broken_bytes_decode_to_replacement(both):
    bpe, library = both
    ids = [int(bpe.outer[0xC3]), int(bpe.outer[0x28])]
    assert bpe.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(np.array([], np.uint32)) == ""


def test_operator_rows(spark, both):
    _, library = both
    texts = ["Hello world", "", None, "naïve café " * 3000, "Hello world", (None, "x"), "<|endoftext|>"]
    df = docs_frame(spark, texts, CLASHING)
    got = encode_decode(df, default_tokenizer(), with_ids=True, with_text=True).collect()
    assert len(got) == len(texts)
    by = {(r.doc_id, r.decoded): r for r in got}
    for i, t in enumerate(texts):
        key, text = t if isinstance(t, tuple) else (i, t or "")
        ids = library.encode(text, add_special_tokens=False).ids
        r = by[key, text]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_decode(df.limit(0), default_tokenizer()).collect() == []
