"""Token ids as binary files of independent zstandard frames with a trailing seek table.

One file (shard) for each range of ids, documents in ascending id order.  A file holds

* frames: each a zstandard frame of its own, which holds a few whole documents:
  u32 number of documents, then for all of them a flag byte (1: null id), the id (i64) and the
  number of tokens (u32), then all their token ids (u32), little-endian throughout;
* a directory in a skippable frame: first and last id, documents and tokens of each frame;
* the seek table in a skippable frame, as in the public zstandard seekable format: compressed
  size, plain size and checksum (low half of XXH64 of the plain bytes) of each frame, then the
  number of frames, a flag byte and the closing magic number.

A reader seeks to the end, reads the table, and decompresses only the frames it needs; each frame
is checked against its checksum.  Each task writes a file under a name of its own attempt, and the
manifest, which Spark's writer commits, names the files that count: a lost or repeated task leaves
at most a file that no manifest names.

Texts are encoded with the tokenizers library.  The word-level tokenizer drops white space and
never joins across it, so a text's ids are the ids of its white-space separated parts in order; a
worker keeps the ids of parts it has met in a bounded table and asks the library only for new ones.
That is ``by_part=True``, for tokenizers known to be such; by default texts are encoded whole, as
byte-level tokenizers need it, which encode white space too.

Defined cases: null text counts as empty (only the end id is written); null ids come first; rows
tied on id are ordered by text; an empty table writes a manifest without files; extra columns,
whatever their names, are ignored; a text of any length is encoded whole, within one frame.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_letters, read_tokenizer
from .common import hold, map_arrow, new_run, stored, table

#: Fixed values of the zstandard seekable format.
SKIPPABLE, DIRECTORY, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1, 0x80
FRAME_TOKENS, END_ID, LEVEL = 32768, 1, 3
MOST_CACHED, LONGEST_CACHED = 700_000, 48
MANIFEST = ("shard int, file string, n_bytes long, n_docs long, n_tokens long, first_id long, last_id long")


class PartEncoder:
    """Token ids of a text by the tokenizers library, part by part.

    A part of plain letters, with or without closing punctuation, goes straight to the library's
    model: the normalizer would only put it into lower case and the pre-tokenizer only cut off the
    punctuation.  That this holds for the given tokenizer is tried out on a few words first.
    """

    def __init__(self, data: bytes, by_part: bool):
        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_part, self.plain = by_part, False
        self.known: dict[str, bytes] = {}
        self.letters = {b: c for c, b in byte_letters().items()}
        if by_part:
            self.plain = all(self._model(w) == self.library([w])[0] for w in PROBES) and \
                all(self._model(a) + self._model(b) == self.library([a + b])[0] for a in PROBES[:4] for b in PROBES[4:])
            self.known.clear()

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _model(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()

    def _new(self, part: str) -> bytes:
        simple = PLAIN.fullmatch(part) if self.plain else None
        if simple is None:
            ids = self.library([part])[0]
        elif simple[2] or not part.islower():
            word, mark = simple[1].lower(), simple[2]
            ids = (self.known.get(word) or self._new(word)) + (self.known.get(mark) or self._mark(mark) if mark else b"")
        else:
            ids = self._model(part)
        return self._keep(part, ids)

    def _mark(self, mark: str) -> bytes:
        return self._keep(mark, self._model(mark))

    def _keep(self, part: str, ids: bytes) -> bytes:
        if len(part) <= LONGEST_CACHED:
            if len(self.known) >= MOST_CACHED:
                self.known.clear()
            self.known[part] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_part:
            return self.library(texts)
        known, new = self.known, self._new
        # ASCII white space only: the tokenizer's own notion of white space is wider.
        return [b"".join([known.get(p) or new(p) for p in (PARTS.findall(t) if ODD_SPACE.search(t) else t.split())])
                for t in texts]


#: Letters whose lower case and composition hold no surprise, then closing punctuation.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0134-\u0137]+)([.,;:!?|]*)")
#: Characters that str.split() takes for white space and the contract does not.
ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
PROBES = ["the", "Übung", "wHITE", "ínstitución", ".", ",,", "!?", "|;:"]
PARTS = re.compile(r"[^\x20\x09-\x0D]+")
_ENCODERS: dict[tuple[str, bool], PartEncoder] = {}


def encoder(data: bytes, by_part: bool) -> PartEncoder:
    hold("token files", _ENCODERS.clear)
    key = (hashlib.sha256(data).hexdigest(), by_part)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PartEncoder(data, by_part)
    return _ENCODERS[key]


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


class FrameWriter:
    """Writes one file: documents in, frames, directory and seek table out."""

    def __init__(self, out):
        self.out, self.compress = out, zstandard.ZstdCompressor(level=LEVEL).compress
        self.docs: list[tuple[int | None, bytes]] = []
        self.tokens = self.written = 0
        self.frames: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.tokens += len(ids) // 4
        if self.tokens >= FRAME_TOKENS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        keys = [d for d, _ in self.docs]
        plain = b"".join([struct.pack("<I", len(keys)), bytes(d is None for d in keys),
                          np.array([d or 0 for d in keys], "<i8").tobytes(),
                          np.array([len(ids) // 4 for _, ids in self.docs], "<u4").tobytes(),
                          *[ids for _, ids in self.docs]])
        packed = self.compress(plain)
        self.out.write(packed)
        self.written += len(packed)
        some = [d for d in keys if d is not None]
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF,
                            some[0] if some else 0, some[-1] if some else -1, len(keys), self.tokens))
        self.docs, self.tokens = [], 0

    def close(self) -> int:
        self.flush()
        directory = b"".join(struct.pack("<qqIQ", *f[3:]) for f in self.frames)
        table_ = b"".join(struct.pack("<III", *f[:3]) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        tail = (struct.pack("<II", DIRECTORY, len(directory)) + directory
                + struct.pack("<II", SKIPPABLE, len(table_)) + table_)
        self.out.write(tail)
        self.out.close()
        return self.written + len(tail)


class FrameReader:
    """Reads chosen frames of one file."""

    def __init__(self, source, n_bytes: int):
        self.source = source
        source.seek(n_bytes - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = n_bytes - 9 - 12 * count
        source.seek(table_at - 8 - 28 * count - 8)
        tail = source.read(28 * count + 8 + 8 + 12 * count)
        if struct.unpack_from("<I", tail)[0] != DIRECTORY or struct.unpack_from("<I", tail, 8 + 28 * count)[0] != SKIPPABLE:
            raise ValueError("the directory does not precede the seek table")
        self.directory = [struct.unpack_from("<qqIQ", tail, 8 + 28 * i) for i in range(count)]
        self.sizes = [struct.unpack_from("<III", tail, 16 + 28 * count + 12 * i) for i in range(count)]
        self.starts = np.cumsum([0, *[s[0] for s in self.sizes]])

    def frame(self, i: int) -> list[tuple[int | None, np.ndarray]]:
        packed, size, check = self.sizes[i]
        self.source.seek(int(self.starts[i]))
        plain = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} does not match its checksum")
        n = struct.unpack_from("<I", plain)[0]
        keys = np.frombuffer(plain, "<i8", n, 4 + n)
        counts = np.frombuffer(plain, "<u4", n, 4 + 9 * n)
        ids = np.split(np.frombuffer(plain, "<u4", -1, 4 + 13 * n), np.cumsum(counts)[:-1]) if n else []
        return [(None if plain[4 + k] else int(keys[k]), ids[k]) for k in range(n)]


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int | None = END_ID, by_part: bool = False, shards: int | None = None) -> DataFrame:
    """Encode and write; returns the manifest (one row per file), itself stored under ``path``."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shipped = spark.sparkContext.broadcast(read_tokenizer(tokenizer))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def write(batches):
        task, out, writer, docs_, tokens, first, last = TaskContext.get(), None, None, 0, 0, None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys, texts = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
                if writer is None:
                    where, root = open_fs(path)
                    where.create_dir(root, recursive=True)
                    name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.tok.zst"
                    writer = FrameWriter(where.open_output_stream(posixpath.join(root, name), compression=None))
                for key, ids in zip(keys, encoder(shipped.value, by_part).encode(texts)):
                    writer.add(key, ids + end)
                    docs_, tokens = docs_ + 1, tokens + len(ids) // 4 + len(end) // 4
                some = [k for k in keys if k is not None]
                first, last = (some[0] if first is None and some else first), (some[-1] if some else last)
        if writer is not None:
            size = writer.close()
            row = [[task.partitionId()], [name], [size], [docs_], [tokens], [first], [last]]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)],
                                             ["shard", "file", "n_bytes", "n_docs", "n_tokens", "first_id", "last_id"])

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text"))
    return stored(map_arrow(ordered, write, MANIFEST), posixpath.join(path, "manifest"))


def read_token_files(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """Documents from the files: id, start (tokens of all documents before it), ids, ids_crc32, in no order.

    ``only``: a short list of ids; then files and frames that cannot hold one of them are skipped.
    """
    manifest = spark.read.schema(MANIFEST).parquet(posixpath.join(path, "manifest"))
    # One row per file: the manifest is as long as the list of files.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    wanted = sorted(set(only)) if only is not None else None
    if wanted is not None:
        files = files.filter(F.lit(False) if not wanted else F.greatest(
            *[F.col("first_id").isNotNull() & F.lit(w).between(F.col("first_id"), F.col("last_id")) for w in wanted], F.lit(False)))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                where, root = open_fs(path)
                with where.open_input_file(posixpath.join(root, row["file"])) as source:
                    reader, start = FrameReader(source, row["n_bytes"]), row["start"]
                    for i, (first, last, _, tokens) in enumerate(reader.directory):
                        if wanted is None or any(first <= w <= last for w in wanted):
                            docs = reader.frame(i)
                            sizes = [len(ids) for _, ids in docs]
                            starts = start + np.cumsum(sizes) - sizes
                            rows = [(k, s, n, zlib.crc32(ids.tobytes()), ids) for (k, ids), s, n in zip(docs, starts.tolist(), sizes)
                                    if wanted is None or k in wanted]
                            cols = list(zip(*rows)) or [()] * 5
                            yield pa.RecordBatch.from_arrays(
                                [*[pa.array(c, pa.int64()) for c in cols[:4]],
                                 pa.array([ids.astype(np.int64) for ids in cols[4]], pa.list_(pa.int64()))],
                                ["id", "start", "n_tokens", "ids_crc32", "ids"])
                        start += tokens

    spread = files.select("file", "n_bytes", "start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(spread, read, "id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), default_tokenizer(), path, by_part=True)
    return (read_token_files(spark, path)
            .select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32"))
