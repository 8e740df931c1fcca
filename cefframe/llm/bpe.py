"""Byte-level BPE: an exact linear-time encoder by backtracking, and an offset-table decoder.

Encoding a piece: one Aho-Corasick pass finds the longest token that starts at each byte.  Tokens
are then laid down from the left; a token is allowed next to its neighbour only if the two are
*compatible*, i.e. if the merge rules would really leave that border between them.  Where no token
fits, the encoder steps back and marks the position as dead, so each position is left at most once.
Compatible borders everywhere mean that the result is what applying the merges by rank gives.

Decoding: all tokens' bytes lie in one pool; a token id is an offset and a length in it.

The tokenizer file is a parameter.  The driver reads it (a few MB; its size is checked) and ships
its contents, so executors need no local copy.  Each Python worker keeps the encodings of pieces it
has met in a bounded table; that table only saves work, every piece is encoded by the method above.

Defined cases: null text counts as empty and gives no ids; ids and texts may repeat; extra columns
are ignored; a text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from ahocorasick import Automaton
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .common import hold, map_arrow, table

#: Fixed value: how byte-level BPE tokenizers of this family cut a text into pieces.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Unicode versions of the regex module and the tokenizers library agree on letters and digits below
#: U+0558; texts with later code points are cut by the library's own pre-tokenizer.
LATER = regex.compile(r"[^\u0000-\u0557]")
MOST_FILE_BYTES = 64 << 20
MOST_CACHED, MOST_PAIRS = 300_000, 400_000
LONGEST_CACHED = 48


def read_tokenizer(path: str) -> bytes:
    """The tokenizer file's contents, if it is small enough to ship to every worker."""
    with open(path, "rb") as f:
        data = f.read(MOST_FILE_BYTES + 1)
    if len(data) > MOST_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MOST_FILE_BYTES} bytes")
    return data


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder of one byte-level BPE tokenizer file (JSON)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        # Inner numbers follow the order of merging: single bytes first, then by rank.
        self.halves: list[tuple[int, int]] = [(b, b) for b in range(256)]
        names = [""] * 256
        for letter, b in letters.items():
            names[b] = letter
        inner = {name: i for i, name in enumerate(names)}
        for pair in merges:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if left + right in inner:
                raise ValueError("two merges give one token")
            inner[left + right] = len(names)
            names.append(left + right)
            self.halves.append((inner[left], inner[right]))
        self.joined = {pair: 256 + i for i, pair in enumerate(self.halves[256:])}
        raw = ["".join(chr(letters[c]) for c in name) for name in names]
        number = {s: i for i, s in enumerate(raw)}
        self.size = [len(s) for s in raw]
        self.outer = np.array([vocab[name] for name in names], np.uint32)
        self.shorter = [next((number[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in number), -1) for s in raw]
        self.longest = Automaton()
        for i, s in enumerate(raw):
            self.longest.add_word(s, (i, len(s)))
        self.longest.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
                                 if self.special else r"((?!))")
        self.pieces = regex.compile(PIECES)
        self.library_cut = ByteLevel(add_prefix_space=False)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[bytes, str]] = {}
        # The offset table: id -> where its bytes start in the pool, and how many they are.
        most = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * most
        for i, s in enumerate(raw):
            texts[self.outer[i]] = s.encode("latin-1")
        for content, i in self.special.items():
            texts[i] = content.encode()
        self.length = np.array([len(t) for t in texts], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(texts), np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave a border between these two tokens (kept in the pair table)."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > MOST_PAIRS:
                self.compatible.clear()
            known = self.compatible[left, right] = self._border_stays(left, right)
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens step by step: a merge across the border would have
        # happened if it came before the step that made the border's present neighbours.
        a, b, before = left, right, len(self.halves)
        while True:
            if self.joined.get((a, b), before) < before:
                return False
            if a > b and a >= 256:
                before, a = a, self.halves[a][1]
            elif b >= 256:
                # At equal rank the left of two overlapping merges goes first.
                before, b = b + 1, self.halves[b][0]
            elif a >= 256:
                before, a = a, self.halves[a][1]
            else:
                return True

    def encode_piece(self, s: str) -> list[int]:
        """Inner token numbers of a piece given as latin-1 text of its bytes."""
        n = len(s)
        best = [0] * (n + 1)
        for end, (token, size) in self.longest.iter(s):
            best[end - size + 1] = token
        size, shorter, fits = self.size, self.shorter, self.fits
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, best[0]
        while at < n:
            if not dead[at + size[token]] and (not out or fits(out[-1], token)):
                out.append(token)
                at += size[token]
                token = best[at]
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: step back
                dead[at] = 1
                last = out.pop()
                at -= size[last]
                token = shorter[last]
        return out

    def _cut(self, text: str) -> list[str]:
        if LATER.search(text):
            return [text[a:b] for _, (a, b) in self.library_cut.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def _piece(self, piece: str) -> tuple[bytes, str]:
        ids = self.outer[self.encode_piece(piece.encode().decode("latin-1"))]
        entry = (ids.tobytes(), ",".join(map(str, ids.tolist())))
        if len(piece) <= LONGEST_CACHED:
            if len(self.known) >= MOST_CACHED:
                self.known.clear()
            self.known[piece] = entry
        return entry

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Token ids (uint32), and the same ids as decimals joined by commas."""
        found: list[tuple[bytes, str]] = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                token = self.special[part]
                found.append((np.uint32(token).tobytes(), str(token)))
                continue
            known, miss = self.known, self._piece
            found += [known.get(p) or miss(p) for p in self._cut(part)]
        return (np.frombuffer(b"".join([f[0] for f in found]), np.uint32), ",".join([f[1] for f in found]))

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        size = self.length[ids]
        ends = np.cumsum(size)
        index = np.repeat(self.offset[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return self.pool[index].tobytes().decode("utf-8", "replace")


_BUILT: dict[str, ByteBPE] = {}


def built(data: bytes) -> ByteBPE:
    """One encoder for each worker process and tokenizer file."""
    hold("bpe", _BUILT.clear)
    key = hashlib.sha256(data).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ByteBPE(data)
    return _BUILT[key]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded text if asked)."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))
    schema = ("id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", ids array<long>" * with_ids + ", decoded string" * with_text)

    def run(batches):
        bpe = built(shipped.value)
        for batch in batches:
            cols: list[list] = [[] for _ in range(3 + with_ids + with_text)]
            for cell in batch.column(1):
                ids, digits = bpe.encode(cell.as_py() or "")
                text = bpe.decode(ids)
                row = [len(ids), hashlib.sha256(digits.encode()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest()]
                for col, value in zip(cols, row + [ids.tolist()] * with_ids + [text] * with_text):
                    col.append(value)
            kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int64())] * with_ids + [pa.string()] * with_text
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_text)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, schema).withColumnRenamed("id", id_col)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), default_tokenizer())
