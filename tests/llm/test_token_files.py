import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from cefframe.llm.bpe import read_tokenizer
from cefframe.llm.common import new_run
from cefframe.llm.token_files import (FrameReader, PartEncoder, SEEKABLE, default_tokenizer, open_fs, read_token_files,
                                      write_token_files)
from conftest_llm import CLASHING, docs_frame

TEXTS = ["Hello, world.", "", None, "Über-Straße 12 " * 4000, "a b́ c", (2, "tie"), (2, "tie"), (None, "no id"), (-5, "first"),
         (10 ** 15, "last\x1ctext\xa0end <|endoftext|>")]


def expected(df, library):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()))
    out, start = [], 0
    for known, key, text in rows:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        out.append((key if known else None, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_parts_match_whole_texts():
    data = read_tokenizer(default_tokenizer())
    encoder, library = PartEncoder(data, True), Tokenizer.from_buffer(data)
    assert encoder.plain
    rng = random.Random(3)
    bits = ["a", "B", "The", "ing", " ", "  ", "\n", ".", ",", "|", "!", "é", "É", "İ", "Σ", "ς", "ß", "ſ", "日本", "é", "́",
            "<|endoftext|>", "<|startoftext|>", "0", "12", "'s", "'ll", "\x1c", "\x85", "\xa0", "　", "🙂"]
    texts = ["".join(rng.choice(bits + [chr(rng.randrange(0x20, 0x3000))]) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_round_trip(spark, shards):
    df = docs_frame(spark, TEXTS, CLASHING)
    library = Tokenizer.from_file(default_tokenizer())
    path = new_run(spark, "test-tokens")
    manifest = write_token_files(df, default_tokenizer(), path, shards=shards).collect()
    got = read_token_files(spark, path).orderBy("start").collect()
    assert [(r.id, r.n_tokens, r.ids_crc32) for r in got] == expected(df, library)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert sum(m.n_tokens for m in manifest) == sum(r.n_tokens for r in got)
    some = read_token_files(spark, path, only=[-5, 2, 77]).collect()
    assert sorted((r.id, r.start) for r in some) == sorted((r.id, r.start) for r in got if r.id in (-5, 2))
    assert read_token_files(spark, path, only=[]).collect() == []


def test_files_are_zstandard_with_seek_table_and_checksums(spark, monkeypatch):
    df = docs_frame(spark, [f"text number {i} " * 300 for i in range(200)])
    path = new_run(spark, "test-tokens")
    m = write_token_files(df, default_tokenizer(), path, shards=1).collect()[0]
    where, root = open_fs(path)
    with where.open_input_file(f"{root}/{m.file}") as f:
        data = f.read()
    assert struct.unpack("<I", data[-4:])[0] == SEEKABLE
    import io
    reader = FrameReader(io.BytesIO(data), len(data))
    assert len(reader.sizes) > 3
    # Any zstandard reader passes over the skippable frames and sees all plain bytes.
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(plain) == sum(s[1] for s in reader.sizes)
    second = reader.frame(1)
    assert [k for k, _ in second][0] == reader.directory[1][0]
    at = int(reader.starts[2]) + reader.sizes[2][0] // 2
    broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
    with pytest.raises(Exception):
        FrameReader(io.BytesIO(broken), len(broken)).frame(2)
    assert FrameReader(io.BytesIO(broken), len(broken)).frame(1)[0][0] == second[0][0]


def test_empty_table(spark):
    path = new_run(spark, "test-tokens")
    assert write_token_files(docs_frame(spark, ["x"]).limit(0), default_tokenizer(), path).collect() == []
    assert read_token_files(spark, path).collect() == []


def test_white_space_is_kept_by_default(spark):
    from cefframe.llm import bpe
    df = docs_frame(spark, ["two  words", "a\tb\n\nc ", " x"])
    path = new_run(spark, "test-tokens")
    write_token_files(df, bpe.default_tokenizer(), path, shards=1).collect()
    library = Tokenizer.from_file(bpe.default_tokenizer())
    got = [(r.id, r.n_tokens, r.ids_crc32) for r in read_token_files(spark, path).orderBy("start").collect()]
    assert got == expected(df, library)
